"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialfold.session import cut_lineage

#: A word is a run of anything but space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: A side of a join is broadcast only after a count showed at most this many rows.
BROADCAST_ROWS = 200_000
LOW32 = 0xFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    return cut_lineage(df)


def bounded(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` (already cut, narrow rows) as a broadcast if a count proves it
    small, else as it is: the join then shuffles, and adaptive execution
    splits its hot keys."""
    return F.broadcast(side) if side.count() <= rows else side


def unused(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened where ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_parts(key: Column) -> tuple[Column, Column]:
    """The upper and lower 32 bits of a 64-bit hash, both unsigned."""
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW32))


def ranked(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with a gapless global rank from 0: range partitions are sorted
    and counted, and each adds the counts of those before it.  Only the counts
    (one row for each partition) meet in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    before = (parts.groupBy("_part").count()
              .select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before")))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn("_inside", inside).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside"))


#: Copies of a row that one task makes at once.
COPIES = 65_536


def spread(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row of ``df`` (already cut) ``times`` times, numbered from 0.  Rows
    of more than COPIES copies are dealt out in portions, so that no task makes
    more of one row."""
    last = F.col(times).cast("long") - 1

    def numbered(part: DataFrame) -> DataFrame:
        upto = F.least(F.col("_from") + COPIES - 1, last)
        return part.withColumn(index, F.explode(F.sequence("_from", upto))).drop("_from")

    many = df.where(F.col(times) > COPIES)
    first = F.lit(0).cast("long")
    if many.isEmpty():
        return numbered(df.where(F.col(times) > 0).withColumn("_from", first))
    portions = many.withColumn("_from", F.explode(F.sequence(first, last, F.lit(COPIES).cast("long")))).repartition("_from")
    return numbered(df.where(F.col(times).between(1, COPIES)).withColumn("_from", first).unionByName(portions))


def literal_table(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A small driver-side table (all longs) as a plan literal."""
    cols = [c.strip() for c in names.split(",")]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast("long").alias(c) for c in cols])
    packed = "[" + ",".join("[" + ",".join(str(int(v)) for v in r) + "]" for r in rows) + "]"
    return (spark.range(1)
            .select(F.explode(F.from_json(F.lit(packed), "array<array<bigint>>")).alias("r"))
            .select(*[F.col("r")[i].alias(c) for i, c in enumerate(cols)]))


def keep_one(docs: DataFrame, key: Column, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, in all their columns.

    ``decided`` has a row (doc_id, _key, _stays) for each document.  Rows that
    repeat the id and the key of one that stays are one document; one of them
    stays."""
    own_key, = unused(docs, "_key")
    own = docs.withColumn(own_key, key)

    def same(side: DataFrame) -> Column:
        return own["doc_id"].eqNullSafe(side["_id"]) & own[own_key].eqNullSafe(side["_k"])

    fate = cut(decided.groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
               .agg(F.bool_or("_stays").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"))
    gone = cut(fate.where("not stays").select("_id", "_k"))
    again = cut(fate.where("stays").select("_id", "_k"))
    out = own.join(bounded(gone), same(gone), "left_anti")
    if not again.isEmpty():
        once = own.join(again, same(again), "left_semi").dropDuplicates(["doc_id", own_key])
        out = out.join(again, out["doc_id"].eqNullSafe(again["_id"]) & out[own_key].eqNullSafe(again["_k"]), "left_anti").unionByName(once)
    return out.select(*docs.columns)
