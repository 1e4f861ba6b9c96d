"""Observation store (O03–O06): a day-partitioned Parquet table with snapshots.

Every write goes to a version folder of its own
(``data/version=<id>/day=<day>``), and a manifest names the (day, version)
folders that make up the table.  A manifest appears by one rename, so an append
or a delete that dies half way leaves the table as it was, and a reader keeps
the snapshot that it began with.  Deletes rewrite only the days that hold doomed
rows; ``expire`` removes folders that the last manifest doesn't name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialfold.functions.exprs import small

STORE_COLUMNS = ["trial", "seq", "sub", "ts", "ts_nanos", "metric", "value"]
STORE_SCHEMA = "trial string, seq long, sub long, ts timestamp, ts_nanos int, metric string, value string"


# ----------------------------------------------------------------- snapshots

def _files(spark: SparkSession, path: str):
    """(file system, Path class) of a folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _last(spark: SparkSession, path: str) -> int:
    """Number of the last snapshot, 0 for none."""
    fs, at = _files(spark, path)
    folder = at(f"{path}/snapshots")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def snapshot(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(day, version) folders of the last snapshot: a row for each day and write."""
    n = _last(spark, path)
    if not n:
        return []
    rows = spark.read.text(f"{path}/snapshots/{n:012d}").collect()
    return [tuple(r["value"].split(" ")) for r in rows if r["value"]]


def _commit(spark: SparkSession, path: str, folders: list[tuple[str, str]]) -> None:
    """Make ``folders`` the table: the manifest is written aside and renamed."""
    fs, at = _files(spark, path)
    aside, name = at(f"{path}/snapshots/.{uuid.uuid4().hex}"), at(f"{path}/snapshots/{_last(spark, path) + 1:012d}")
    out = fs.create(aside, False)
    out.write(bytearray("".join(f"{day} {version}\n" for day, version in sorted(folders)) + "\n", "utf-8"))
    out.close()
    if fs.exists(name) or not fs.rename(aside, name):
        raise RuntimeError("another writer has committed this snapshot")


def _written(rows: DataFrame, path: str, writers_per_day: int) -> list[tuple[str, str]]:
    """Write rows (with ``day``) as a new version; its (day, version) folders."""
    version = uuid.uuid4().hex
    # a busy day is spread over ``writers_per_day`` tasks (and files) instead
    # of one, so one day holding a third of the rows does not serialise the write
    salt = F.pmod(F.xxhash64("trial", "seq", "sub"), F.lit(writers_per_day))
    folder = f"{path}/data/version={version}"
    rows.repartition("day", salt).write.partitionBy("day").parquet(folder)
    fs, at = _files(rows.sparkSession, path)
    names = [f.getPath().getName() for f in fs.listStatus(at(folder))]
    return [(n.removeprefix("day="), version) for n in names if n.startswith("day=")]


def append_observations(rows: DataFrame, path: str, writers_per_day: int = 16) -> None:
    """Rows with an empty time text are skipped; the rest appended."""
    spark = rows.sparkSession
    r = rows.filter(F.coalesce(F.col("ts_raw"), F.lit("")) != "").select(*STORE_COLUMNS)
    r = r.to(spark.createDataFrame([], STORE_SCHEMA).schema)
    r = r.withColumn("day", F.coalesce(F.to_date("ts"), F.lit("0001-01-01").cast("date")))
    new = _written(r, path, writers_per_day)
    _commit(spark, path, snapshot(spark, path) + new)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot."""
    folders = snapshot(spark, path)
    if not folders:
        return spark.createDataFrame([], STORE_SCHEMA + ", day date")
    paths = [f"{path}/data/version={version}/day={day}" for day, version in folders]
    schema = STORE_SCHEMA + ", version string, day date"
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*paths).drop("version")


def delete_and_rewrite(spark: SparkSession, path: str, doomed: DataFrame, writers_per_day: int = 16) -> None:
    """O05 applied to the table: the days that hold doomed rows are written
    anew without them, and one manifest takes their place."""
    store = read_store(spark, path)
    touched = [str(r["day"]) for r in store.join(doomed.select("trial").distinct(), "trial", "left_semi").select("day").distinct().collect()]
    if not touched:
        return
    keep = delete_trials(store.filter(F.col("day").cast("string").isin(touched)), doomed)
    new = _written(keep, path, writers_per_day)
    _commit(spark, path, [x for x in snapshot(spark, path) if x[0] not in set(touched)] + new)


def expire(spark: SparkSession, path: str) -> None:
    """Remove the manifests before the last one, and the folders that it doesn't name."""
    used, n = set(snapshot(spark, path)), _last(spark, path)
    fs, at = _files(spark, path)
    for version in fs.listStatus(at(f"{path}/data")):
        for day in fs.listStatus(version.getPath()):
            place = (day.getPath().getName().removeprefix("day="), version.getPath().getName().removeprefix("version="))
            if day.isDirectory() and place not in used:
                fs.delete(day.getPath(), True)
    for i in range(1, n):
        fs.delete(at(f"{path}/snapshots/{i:012d}"), False)


# --------------------------------------------------------------------- reads

def _in_order(store: DataFrame, first: list[str]) -> list[Column]:
    return [F.col(c) for c in [*first, "ts", "ts_nanos", "seq", "sub"] if c in [*first, *store.columns]]


def range_read(store: DataFrame, requests: DataFrame) -> DataFrame:
    """O04 in bulk: ``requests`` (req, trial, metric?, start?, end?) — each
    condition applies only when given, closed interval.  Requests with both
    ends are laid out by day, and the days that none of them asks for aren't read;
    the others join on the trial.  Sorted by (req, ts, nanoseconds, seq, sub)."""
    cond = ((F.col("req_metric").isNull() | (F.col("metric") == F.col("req_metric")))
            & (F.col("start").isNull() | (F.col("ts") >= F.col("start")))
            & (F.col("end").isNull() | (F.col("ts") <= F.col("end"))))
    if "day" in store.columns:
        both = F.col("start").isNotNull() & F.col("end").isNotNull()
        # requests grow with the trials, and days multiply them after any size
        # estimate: both sides are shuffled, only the distinct days are broadcast
        by_day = requests.filter(both & (F.col("start") <= F.col("end"))).withColumn(
            "day", F.explode(F.sequence(F.to_date("start"), F.to_date("end"), F.expr("interval 1 day"))))
        asked = F.broadcast(by_day.select("day").distinct())  # calendar days: bounded
        days = store.join(asked, "day", "left_semi")
        found = days.join(by_day.hint("merge"), ["trial", "day"]).filter(cond)
        found = found.unionByName(store.join(requests.filter(~both).hint("merge"), "trial").filter(cond).select(found.columns))
    else:
        found = store.join(requests, "trial").filter(cond)
    return found.orderBy(*_in_order(store, ["req"])).select("req", "trial", "ts", "seq", "metric", "value")


def range_read_one(store: DataFrame, trial: str, metric: str | None = None,
                   start=None, end=None) -> DataFrame:
    """O04 for one trial: conjuncts added only when the argument is given,
    so they reach the Parquet scan as pushed filters."""
    q = store.filter(F.col("trial") == trial)
    if metric:
        q = q.filter(F.col("metric") == metric)
    if start is not None:
        q = q.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
        q = q.filter(F.col("day") >= F.to_date(F.lit(start).cast("timestamp"))) if "day" in store.columns else q
    if end is not None:
        q = q.filter(F.col("ts") <= F.lit(end).cast("timestamp"))
        q = q.filter(F.col("day") <= F.to_date(F.lit(end).cast("timestamp"))) if "day" in store.columns else q
    return q.orderBy(*_in_order(store, []))


def delete_trials(store: DataFrame, doomed: DataFrame) -> DataFrame:
    """All rows of the given trials removed (anti join)."""
    return store.join(doomed.select("trial").distinct(), "trial", "left_anti")


def multi_metric_fetch(obs: DataFrame, trials: DataFrame, wanted: DataFrame) -> DataFrame:
    """One scan for every trial's objective and additional metrics;
    ``wanted`` (experiment, metric) is broadcast after a size check."""
    t = trials.select("trial", "experiment")
    return (obs.join(t, "trial").join(small(wanted.select("experiment", "metric")), ["experiment", "metric"], "left_semi"))
