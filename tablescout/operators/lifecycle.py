"""Project activity, idleness and clean-up decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import dates as D, vocabulary as V
from tablescout.operators.grouping import attach



def last_runs(jobs: DataFrame) -> DataFrame:
    """Latest job start per project; the definition's own stamp goes first."""
    ms = F.when(F.col("def.initiationTimestamp") != 0, F.col("def.initiationTimestamp"))
    return (jobs.groupBy("projectKey")
            .agg(F.max(D.from_millis(F.coalesce(ms, F.col("startTime")))).alias("ultima_ejecucion"),
                 F.count("*").alias("n_jobs")))


def last_commits(timeline: DataFrame) -> DataFrame:
    """Latest commit per project. The maximum is taken inside each array first."""
    valid = F.filter(F.transform("items", lambda x: x["timestamp"]), lambda t: t > 0)
    return (timeline.select("projectKey", D.from_millis(F.array_max(valid)).alias("t"),
                            F.coalesce(F.size("items"), F.lit(0)).alias("k"))
            .groupBy("projectKey").agg(F.max("t").alias("ultimo_commit"), F.sum("k").alias("n_commits")))


def protected(tags: Column, words=V.PROTECTED_TAGS) -> Column:
    clean = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)))
    return F.arrays_overlap(clean, F.array(*[F.lit(w) for w in words]))


def listable(projects: DataFrame) -> DataFrame:
    """Tutorial and protected projects never appear in a list."""
    return projects.filter(~F.coalesce("tutorialProject", F.lit(False)) & ~protected(F.col("tags")))


def owner_and_created(projects: DataFrame) -> DataFrame:
    return projects.select(
        "*", D.first_filled(F.col("ownerLogin"), F.col("ownerDisplayName")).alias("dueno"),
        D.format_day(D.from_millis(F.col("creationTag.lastModifiedOn"))).alias("creado"))


def project_activity(projects: DataFrame, jobs: DataFrame, timeline: DataFrame) -> DataFrame:
    """Projects with last run and last modification; a missing commit falls back
    to the version stamp. Both event tables are aggregated before the join."""
    j = projects.join(last_runs(jobs), "projectKey", "left").join(last_commits(timeline), "projectKey", "left")
    return j.withColumn("ultima_modificacion", F.coalesce(
        "ultimo_commit", D.from_millis(F.col("versionTag.lastModifiedOn"))))


def idle_months(activity: DataFrame, ref: Column, policy: str = "run") -> DataFrame:
    """Months since the last activity.

    policy "run": max(modification, run). policy "stamp": also the version stamp.
    """
    parts = [F.col("ultima_modificacion"), F.col("ultima_ejecucion")]
    if policy == "stamp":
        parts.append(D.from_millis(F.col("versionTag.lastModifiedOn")))
    last = F.greatest(*parts)
    return (activity.withColumn("ultima_actividad", last)
            .withColumn("meses_inactivo", D.months_idle(last, ref)))


def decision(threshold: int) -> Column:
    """Never-run projects are deletable at the deepest level (1 month) only."""
    run, mod = F.col("ultima_ejecucion"), F.col("ultima_modificacion")
    never = F.when(mod.isNotNull() & F.lit(threshold == 1), F.lit(V.DECISION_DELETE)).otherwise(F.lit(V.DECISION_KEEP))
    return (F.when(run.isNull(), never)
            .when(F.col("meses_inactivo") >= threshold, F.lit(V.DECISION_DELETE))
            .otherwise(F.lit(V.DECISION_KEEP)))


def project_details(projects: DataFrame, jobs: DataFrame, timeline: DataFrame, ref: Column,
                    threshold: int = V.DEFAULT_IDLE_MONTHS) -> DataFrame:
    """Every project with its decision (detail view: nothing is filtered)."""
    a = idle_months(project_activity(owner_and_created(projects), jobs, timeline), ref)
    return a.select(
        F.col("projectKey").alias("id_proyecto"), D.format_day(F.col("ultima_modificacion")).alias("ultima_modificacion"),
        D.format_day(F.col("ultima_ejecucion")).alias("ultima_ejecucion"), "dueno", "creado", "meses_inactivo",
        D.reason_chip(F.col("ultima_ejecucion"), F.col("contributors"), F.col("meses_inactivo")).alias("motivo"),
        decision(threshold).alias("decision"))


def stale_projects(projects: DataFrame, jobs: DataFrame, timeline: DataFrame, ref: Column,
                   threshold: int = V.DEFAULT_IDLE_MONTHS) -> DataFrame:
    """Deletable projects only (list view), with bucket and reason."""
    a = idle_months(project_activity(owner_and_created(listable(projects)), jobs, timeline), ref)
    has_mod = F.col("ultima_modificacion").isNotNull()
    months = F.when(has_mod | F.col("ultima_ejecucion").isNotNull(), F.col("meses_inactivo"))
    return (a.filter(has_mod | F.col("ultima_ejecucion").isNotNull())
            .withColumn("_d", decision(threshold)).filter(F.col("_d") == V.DECISION_DELETE)
            .select(F.col("projectKey").alias("id_proyecto"), F.coalesce("name", "projectKey").alias("nombre_proyecto"),
                    D.format_day(F.col("ultima_modificacion")).alias("ultima_modificacion"),
                    D.format_day(F.col("ultima_ejecucion")).alias("ultima_ejecucion"),
                    D.idle_bucket(months).alias("bucket"), "dueno", "creado", months.alias("meses_inactivo"),
                    D.reason_chip(F.col("ultima_ejecucion"), F.col("contributors"), months).alias("motivo")))


def stale_by_stamp(projects: DataFrame, ref: Column, minimum: int = 1) -> DataFrame:
    """Cheap list from the version stamp alone: delete from four months, else review."""
    last = D.from_millis(F.col("versionTag.lastModifiedOn"))
    return (projects.withColumn("_m", last).filter("_m IS NOT NULL")
            .withColumn("meses_inactivo", D.months_idle(F.col("_m"), ref))
            .filter(F.col("meses_inactivo") >= minimum)
            .select(F.col("projectKey").alias("id_proyecto"), D.format_day(F.col("_m")).alias("ultima_modificacion"),
                    "meses_inactivo", D.idle_bucket(F.col("meses_inactivo")).alias("bucket"),
                    F.when(F.col("meses_inactivo") >= V.DEFAULT_IDLE_MONTHS, F.lit(V.DECISION_DELETE))
                    .otherwise(F.lit(V.DECISION_REVIEW)).alias("decision")))


def activity_events(jobs: DataFrame, timeline: DataFrame) -> DataFrame:
    """(projectKey, ts) of every job start and every commit."""
    ms = F.when(F.col("def.initiationTimestamp") != 0, F.col("def.initiationTimestamp"))
    runs = jobs.select("projectKey", D.from_millis(F.coalesce(ms, F.col("startTime"))).alias("ts"))
    commits = (timeline.select("projectKey", F.explode("items").alias("i"))
               .select("projectKey", D.from_millis(F.col("i.timestamp")).alias("ts")))
    return runs.unionByName(commits).filter("ts IS NOT NULL")


def activity_histogram(events: DataFrame, ref: Column, axis: str = "30d") -> DataFrame:
    """Twelve zero-filled points up to the reference instant.

    The default axis steps back 30 days at a time (a month may repeat or be
    skipped); "calendar" steps by calendar month.
    """
    spark = events.sparkSession
    i = F.col("id").cast("int")
    step = (F.add_months(F.to_date(ref), -i) if axis == "calendar"
            else F.date_sub(F.to_date(ref), i * 30))
    points = spark.range(12).select(i.alias("back"), F.date_format(step, "yyyy-MM").alias("mes"),
                                    F.date_format(step, "MMM").alias("etiqueta"))
    counts = events.groupBy(F.date_format("ts", "yyyy-MM").alias("mes")).agg(F.count("*").alias("n"))
    return points.join(counts, "mes", "left").select(
        (F.lit(11) - F.col("back")).alias("idx"), "mes", "etiqueta", F.coalesce("n", F.lit(0)).alias("n"))


def structure_counts(parts: DataFrame) -> DataFrame:
    """Objects per kind with percent of the largest kind."""
    g = parts.groupBy("kind").agg(F.count("*").alias("n"))
    return attach(g, g.agg(F.max("n").alias("m"))).select(
        "kind", "n", F.round(100.0 * F.col("n") / F.greatest("m", F.lit(1))).cast("int").alias("pct_max"))


def in_scope(projects: DataFrame, preserved: DataFrame, depth: DataFrame) -> DataFrame:
    """Not preserved and idle at least as long as the owning instance's depth."""
    d = depth.select("id_instancia", F.when(F.col("profundidad").between(1, 4), F.col("profundidad")).alias("_d"))
    return (projects.join(preserved.select("id_proyecto").distinct(), "id_proyecto", "left_anti")
            .join(d, "id_instancia", "left")
            .filter(F.col("meses_inactivo") >= F.coalesce("_d", F.lit(V.DEFAULT_IDLE_MONTHS))).drop("_d"))


def cleanup_breakdown(scope: DataFrame) -> DataFrame:
    return (scope.groupBy(D.idle_bucket(F.col("meses_inactivo")).alias("bucket"))
            .agg(F.count("*").alias("n")).filter("bucket > 0"))
