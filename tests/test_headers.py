import pytest

from tablescout.sources import headers, schema_scan

ROW = ["source_file", "name", "type", "position", "n_rows", "encoding", "warning"]


@pytest.fixture(scope="module")
def csv_files(tmp_path_factory):
    """name -> bytes, written as files of one folder."""
    home = tmp_path_factory.mktemp("headers")
    content = {f"t{i:03d}": b"id,name_%d\n1,x\n" % i for i in range(150)}
    content |= {"bom": b"\xef\xbb\xbfid, b \r\n1,2\r\n3,4", "latin": "a\xf1o,x\n1,2\n".encode("latin-1"), "late": b"id,text\n" + b"1,x\n" * 400_000 + b"2,\xf1\n",
                "quoted": b'"a,b",nan,,c\n', "empty": b"", "blank": b" ,nan\n1,2\n"}
    paths = {}
    for name, data in content.items():
        (home / f"{name}.csv").write_bytes(data)
        paths[name] = str(home / f"{name}.csv")
    return paths | {"missing": str(home / "missing.csv")}


def test_csv_headers(spark, csv_files):
    df = headers.file_headers(spark, csv_files, "csv", group=20)
    assert df.rdd.getNumPartitions() == 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan table_headers") == 1 and "Union" not in plan
    got = {}
    for r in df.collect():
        got.setdefault(r.source_file, []).append(tuple(r[c] for c in ROW[1:]))
    got = {k: sorted(v, key=str) for k, v in got.items()}
    assert set(got) == set(csv_files)
    assert got["t042"] == [("id", "string", 0, 1, "UTF-8", None), ("name_42", "string", 1, 1, "UTF-8", None)]
    assert got["bom"] == [("b", "string", 1, 2, "UTF-8", None), ("id", "string", 0, 2, "UTF-8", None)]
    assert got["latin"] == [("a\xf1o", "string", 0, 1, "ISO-8859-1", None), ("x", "string", 1, 1, "ISO-8859-1", None)]
    assert got["late"] == [("id", "string", 0, 400_001, "ISO-8859-1", None), ("text", "string", 1, 400_001, "ISO-8859-1", None)]
    assert got["quoted"] == [("a,b", "string", 0, 0, "UTF-8", None), ("c", "string", 3, 0, "UTF-8", None)]
    assert got["empty"] == [(None, None, None, 0, "UTF-8", "no columns")]
    assert got["blank"] == [(None, None, None, 1, "UTF-8", "no columns")]
    assert got["missing"][0][-1] == "FileNotFoundError"
    assert {r.source_file for r in headers.scan_warnings(spark, csv_files, "csv").collect()} == {"empty", "blank", "missing"}


@pytest.mark.parametrize("condition,names", [("source_file = 'bom'", {"bom"}), ("source_file IN ('bom', 'latin', 'none')", {"bom", "latin"}),
                                             ("source_file LIKE 't00%'", {f"t00{i}" for i in range(10)}),
                                             ("source_file = 'bom' AND source_file LIKE 'x%'", set())])
def test_filters_are_taken_over(spark, csv_files, condition, names):
    df = headers.file_headers(spark, csv_files, "csv", group=1).filter(condition)
    assert {r.source_file for r in df.collect()} == names
    assert df.rdd.getNumPartitions() == max(1, len(names))  # other files are not even dealt out


def test_parquet_tables(spark, data, tmp_path):
    names = ["region", "events", "embeddings", "documents"]
    paths = {t: f"{data}/{t}.parquet" for t in names}
    spark.read.parquet(paths["documents"]).repartition(5).write.parquet(str(tmp_path / "parts"))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no footer")
    paths |= {"parts": str(tmp_path / "parts"), "bad": str(tmp_path / "bad.parquet")}
    tables = {t: spark.read.parquet(p) for t, p in paths.items() if t != "bad"}
    want = sorted(map(tuple, schema_scan.table_headers(tables).collect()))
    assert sorted(map(tuple, headers.scan_headers(spark, paths, group=2).collect())) == want
    assert [r.source_file for r in headers.scan_warnings(spark, paths).collect()] == ["bad"]
    assert headers.scan_headers(spark, {}).count() == 0
