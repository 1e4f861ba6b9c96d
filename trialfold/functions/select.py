"""Exact ranks inside groups of any size (order statistics, quantiles, top-k).

``kth_values`` is a radix select: a histogram of each group's values finds the
bucket that holds the wanted rank, and only that bucket is refined, until its
values are equal or at most ``DIRECT`` rows, which are then ranked.  Every round
is one partially aggregated pass that shuffles at most ``BUCKETS`` counts per
group and task, so a group that holds a third of all rows is no task of its own.

``ranked_in_groups`` numbers rows by range partitions of (group, order): a
large group spreads over many, and each adds the counts of those before it.
Groups of at most ``DIRECT`` rows need neither: a window ranks them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.session import cut_lineage

BUCKETS = 4096
#: Rows of a group (or of a bucket) that a window may rank.
DIRECT = 10_000
#: Groups of a round that are broadcast; beyond that the join shuffles (and splits hot keys).
BROADCAST_GROUPS = 50_000
_LARGEST = 1.7976931348623157e308


def _side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df


def _bucket(value: Column, lo: Column, hi: Column, whole: bool) -> Column:
    """Bucket of a value between ``lo`` and ``hi``: it never falls as the value grows."""
    def part(c: Column) -> Column:
        if whole:
            return c.cast("decimal(20,0)")
        # infinite and very large values don't overflow
        return F.greatest(F.least(c.cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2

    width = (part(hi) - part(lo)).cast("double")
    at = F.least(F.floor((part(value) - part(lo)).cast("double") / width * BUCKETS), F.lit(BUCKETS - 1))
    return F.when(width > 0, at).when(value > lo, BUCKETS - 1).otherwise(0).cast("int")


def _large(df: DataFrame, group: list[str]) -> DataFrame:
    """The groups of more than DIRECT rows."""
    return df.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > DIRECT)


def kth_values(rows: DataFrame, group: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """The k-th smallest ``value`` (k from 1) for each row (group, k) of
    ``wanted``: (group, k, threshold, below, equal) with the numbers of smaller
    and of equal values.  ``rows`` are read once a round and should be written
    before; null values don't count; a k beyond a group's size has no row."""
    rows = rows.select(*group, F.col(value).alias("_x")).where(F.col("_x").isNotNull())
    whole = dict(rows.dtypes)["_x"] in ("tinyint", "smallint", "int", "bigint")
    ends = rows.groupBy(*group).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("*").alias("n"))
    state = cut_lineage(wanted.join(ends, group).where(F.col("k").between(1, F.col("n")))
                        .select(*group, "k", "lo", "hi", F.col("k").cast("long").alias("left"), F.lit(0).cast("long").alias("below"), F.col("n").alias("equal")))
    few = None
    while not (live := state.where((F.col("lo") < F.col("hi")) & (F.col("equal") > DIRECT))).isEmpty():
        few = state.count() <= BROADCAST_GROUPS if few is None else few
        # several ranks that are still in one range share its histogram
        ranges = live.select(*group, "lo", "hi").distinct()
        hit = rows.join(F.broadcast(ranges) if few else ranges, group).where(F.col("_x").between(F.col("lo"), F.col("hi")))
        counts = hit.groupBy(*group, "lo", "hi", _bucket(F.col("_x"), F.col("lo"), F.col("hi"), whole).alias("_b")).agg(
            F.count("*").alias("n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = F.sum("n").over(Window.partitionBy(*group, "lo", "hi").orderBy("_b"))  # BUCKETS rows at most
        counts = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("n"))
        found = live.join(counts, [*group, "lo", "hi"]).where((F.col("_before") < F.col("left")) & (F.col("left") <= F.col("_upto")))
        found = found.select(*group, "k", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), (F.col("left") - F.col("_before")).alias("left"),
                             (F.col("below") + F.col("_before")).alias("below"), F.col("n").alias("equal"))
        state = cut_lineage(state.where((F.col("lo") == F.col("hi")) | (F.col("equal") <= DIRECT)).unionByName(found))
    out = state.where("lo = hi").select(*group, "k", F.col("lo").alias("threshold"), "below", "equal")
    # what is left is ranked: DIRECT rows a range at most
    left = state.where("lo < hi")
    ranges = left.select(*group, "lo", "hi").distinct()
    place = Window.partitionBy(*group, "lo", "hi").orderBy("_x")
    ranked = (rows.join(ranges, group).where(F.col("_x").between(F.col("lo"), F.col("hi")))
              .select(*group, "lo", "hi", "_x", F.row_number().over(place).alias("left"), (F.rank().over(place) - 1).alias("_less"),
                      F.count("*").over(Window.partitionBy(*group, "lo", "hi", "_x")).alias("_same")))
    return out.unionByName(left.drop("equal").join(ranked, [*group, "lo", "hi", "left"])
                           .select(*group, "k", F.col("_x").alias("threshold"), (F.col("below") + F.col("_less")).alias("below"), F.col("_same").alias("equal")))


def quantiles(rows: DataFrame, group: list[str], value: str, fractions: DataFrame) -> DataFrame:
    """(group, fraction, quantile) for each row (group, fraction): linear
    interpolation between the two neighbouring ranks."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*group).agg(F.count("*").alias("n"))
    places = cut_lineage(fractions.join(n, group).withColumn("at", F.col("fraction") * (F.col("n") - 1))
                         .select(*group, "fraction", "at", (F.floor("at") + 1).alias("low"), (F.ceil("at") + 1).alias("high")))
    ks = places.select(*group, F.explode(F.array("low", "high")).alias("k")).distinct()
    found = kth_values(rows, group, value, ks).select(*group, "k", "threshold")
    low = found.select(*group, F.col("k").alias("low"), F.col("threshold").alias("v_low"))
    high = found.select(*group, F.col("k").alias("high"), F.col("threshold").alias("v_high"))
    between = F.col("v_low") + (F.col("at") - F.floor("at")) * (F.col("v_high") - F.col("v_low"))
    return (places.join(low, [*group, "low"]).join(high, [*group, "high"])
            .select(*group, "fraction", F.when(F.col("v_low") == F.col("v_high"), F.col("v_low")).otherwise(between).alias("quantile")))


def ranked_in_groups(df: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` (written before) with each row's place (from 1) in its group by ``order``."""
    if _large(df, group).isEmpty():
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(df.repartitionByRange(parts, *[F.col(c) for c in group], *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    return (dealt.withColumn("_inside", inside).join(before, [*group, "_part"])
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside"))


def smallest(df: DataFrame, group: list[str], first: Column, second: Column, k: Column) -> DataFrame:
    """The ``k`` (the same in all rows of a group) smallest rows of each group
    by (first, second), with their ``rank``.  ``first`` and ``second`` are
    numbers; pairs are unique in a group."""
    rows = cut_lineage(df.withColumns({"_a": first, "_b": second, "_k": k.cast("long")}))
    if _large(rows, group).isEmpty():
        w = Window.partitionBy(*group).orderBy("_a", "_b")
        return rows.withColumn("rank", F.row_number().over(w)).where("rank <= _k").drop("_a", "_b", "_k")
    wanted = rows.groupBy(*group).agg(F.least(F.max("_k"), F.count("*")).alias("k")).where("k > 0")
    edge = kth_values(rows, group, "_a", wanted).select(*group, F.col("threshold").alias("_at"), (F.col("k") - F.col("below")).alias("k"), "equal")
    edge = cut_lineage(edge)
    limits = edge.select(*group, "_at", F.lit(None).cast(dict(rows.dtypes)["_b"]).alias("_upto"))
    tied = edge.where("k < equal")
    if not tied.isEmpty():  # among the rows at the edge the second key decides
        at_edge = cut_lineage(rows.join(_side(tied), group).where(F.col("_a") == F.col("_at")).select(*group, "_b"))
        second_edge = kth_values(at_edge, group, "_b", tied.select(*group, "k")).select(*group, F.col("threshold").alias("_upto"))
        limits = cut_lineage(edge.join(second_edge, group, "left").select(*group, "_at", "_upto"))
    inside = (F.col("_a") < F.col("_at")) | ((F.col("_a") == F.col("_at")) & (F.col("_upto").isNull() | (F.col("_b") <= F.col("_upto"))))
    chosen = cut_lineage(rows.join(_side(limits), group).where(inside).drop("_at", "_upto", "_k"))
    return ranked_in_groups(chosen, group, [F.col("_a"), F.col("_b")]).drop("_a", "_b")
