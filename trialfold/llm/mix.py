"""Mixing sources to target weights (operator 1).

Every document gets a hash-random key.  Inside a source the key space is cut
into ranges (about the square root of the source's rows), so that a hot source
spreads over many tasks; the word counts of the ranges are summed up, and a
window inside each range gives every document the words that stand before it.
The budget of a source is a number of whole passes over it plus a remainder;
the remainder cuts the sorted source exactly, inside a document if need be.

Defined results: a null text has no words; a null source is a source of its
own, last in order; rows that agree in source, id and text are one group that
is counted before it is ordered, and what the cut leaves the group goes to its
rows one after the other, so that a source of equal rows meets its target like
any other; a source without words has the target 0; an empty
table gives an empty result.  Names of other columns don't matter, as the
operator works on its own projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.llm.common import bounded, cut, hash_parts, ranked, spread, unused, word_count

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, n, source_size) with ``position``, ``weight`` and ``target``.

    The targets share the sum of all sizes by weight and stop at
    ``max_passes`` times a source's size.  The excess goes to the others by
    weight: target = min(cap, level * weight), and each round raises the level
    by one aggregate over the sources until no further source is capped."""
    s = ranked(sources, [F.col("source").asc_nulls_last()])
    s = cut(s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.col("position") % len(weights) + 1).cast("int")))
            .withColumn("cap", (F.col("source_size") * max_passes).cast("double")))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        n, fixed, free = s.agg(F.count_if(over), F.sum(F.when(over, F.col("cap"))),
                               F.sum(F.when(~over, F.col("weight")))).first()
        if n == known or not free:
            break
        known, level = n, max(level, (total - (fixed or 0.0)) / free)
    if not total:
        level = 0.0
    return s.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap")


def positions(docs: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """One row for each group of equal documents (``n_rows`` of them): the size
    of one, its source's size and target, the words that stand ``before`` the
    group in its source's random order, the whole ``passes`` over the source,
    the ``rest`` that the last pass takes, and ``here``, what it takes of the group."""
    hi, lo = hash_parts(F.col("_key"))
    slim = (docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("_key"))
            .select("doc_id", "source", "size", hi.alias("_hi"), lo.alias("_lo")))
    groups = cut(slim.groupBy("source", "doc_id", "size", "_hi", "_lo").agg(F.count("*").alias("n_rows"))
                 .withColumn("_words", F.col("size") * F.col("n_rows")))
    stats = cut(targets(groups.groupBy("source").agg(F.sum("n_rows").alias("n"), F.sum("_words").alias("source_size")),
                        weights, max_passes))
    budget = F.round("target").cast("long")
    side = stats.select(
        F.col("source").alias("_source"), F.col("position").alias("_s"), "source_size", "target",
        F.ceil(F.sqrt("n")).cast("long").alias("_ranges"),
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).cast("long").alias("rest"))
    rows = (groups.join(bounded(side), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_range", F.shiftright(F.col("_hi") * F.col("_ranges"), 32)))
    sums = rows.groupBy("_s", "_range").agg(F.sum("_words").alias("_sum"))
    before = sums.select("_s", "_range", (F.sum("_sum").over(Window.partitionBy("_s").orderBy("_range")) - F.col("_sum")).alias("_offset"))
    w = Window.partitionBy("_s", "_range").orderBy("_hi", "_lo", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(before, ["_s", "_range"])
            .withColumn("before", F.col("_offset") + F.coalesce(F.sum("_words").over(w), F.lit(0)))
            .withColumn("here", F.greatest(F.lit(0), F.least(F.col("_words"), F.col("rest") - F.col("before")))))


def _share(here: Column, size: Column, place: Column) -> Column:
    """What the row at ``place`` gets of its group's words."""
    return F.greatest(F.lit(0).cast("long"), F.least(size, here - place * size))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """What the mix takes of every document (doc_id, source, size,
    source_size, target, before, taken)."""
    groups = positions(docs, weights, max_passes, seed)
    if not groups.where("n_rows > 1").isEmpty():
        rows = spread(cut(groups), "n_rows", "_place")
    else:
        rows = groups.withColumn("_place", F.lit(0).cast("long"))
    taken = F.col("passes") * F.col("size") + _share(F.col("here"), F.col("size"), F.col("_place"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source",
                       (F.col("before") + F.col("_place") * F.col("size")).alias("before"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """The documents that the mix takes, in all their columns: one row for
    each whole pass, and the one document of a source in which the remainder
    ends as its first words (with ``n_chars``, where there is such a column,
    of the cut text).  A document left out by the mix has no row.

    Texts aren't shuffled: each source has one cut point (key, id), and each
    document compares itself with that of its source.  Only where the cut falls
    into a group of equal rows, these are numbered."""
    groups = positions(docs, weights, max_passes, seed)
    inside = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("_words"))
    at = F.struct("_hi", "_lo", "doc_id")
    cuts = cut(groups.groupBy("source").agg(
        F.max("passes").alias("_passes"), F.min(F.when(inside, at)).alias("_cut"),
        *[F.max(F.when(inside, F.col(c))).alias(f"_{c}") for c in ("here", "size", "n_rows")]))
    names = ["_source", "_passes", "_cut", "_here", "_size", "_n_rows"]
    renamed = unused(docs, *names, "_take", "_place", "_tie")
    by, passes, at_cut, here, size, n_rows, take, place, tie = renamed
    side = cuts.select(*[F.col("source" if c == "_source" else c).alias(r) for c, r in zip(names, renamed, strict=False)])
    hi, lo = hash_parts(_key(seed))
    own = F.struct(hi.alias("_hi"), lo.alias("_lo"), F.col("doc_id").alias("doc_id"))
    rows = docs.join(bounded(side), F.col("source").eqNullSafe(F.col(by)))
    shared = own.eqNullSafe(F.col(at_cut)) & (F.col(n_rows) > 1)
    out = rows.withColumn(place, F.lit(0).cast("long"))
    if not cuts.where("_n_rows > 1").isEmpty():
        first, start = unused(rows, "_first", "_start")
        numbered = cut(ranked(rows.where(shared).withColumn(tie, F.monotonically_increasing_id()), [F.col(by), F.col(tie)], place).drop(tie))
        starts = numbered.groupBy(F.col(by).alias(first)).agg(F.min(place).alias(start))
        numbered = (numbered.join(bounded(cut(starts)), F.col(by).eqNullSafe(F.col(first)))
                    .withColumn(place, F.col(place) - F.col(start)).drop(first, start))
        out = out.where(~F.coalesce(shared, F.lit(False))).unionByName(numbered)
    part = F.when(own.eqNullSafe(F.col(at_cut)), _share(F.col(here), F.col(size), F.col(place))).otherwise(0).cast("int")
    whole = F.col(passes) + F.when((own < F.col(at_cut)) | ((part > 0) & (part == F.col(size))), 1).otherwise(0)
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    parts = F.concat(F.array_repeat(F.lit(-1), whole.cast("int")),
                     F.when((part > 0) & (part < F.col(size)), F.array(part)).otherwise(F.array().cast("array<int>")))
    out = (out.withColumn(take, F.explode(parts))
           .withColumn("text", F.when(F.col(take) < 0, F.col("text"))
                       .otherwise(F.array_join(F.slice(words, 1, F.greatest(F.col(take), F.lit(1))), ""))))
    if "n_chars" in docs.columns:
        n = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(take) < 0, F.col("n_chars")).otherwise(F.length("text")).cast(n))
    return out.select(*docs.columns)
