"""Exact dedup against immutable snapshots (operator 7).

Texts count as equal when their words and the places of white space agree
(every run of white space is one space).  Documents come in batches; each
batch, once its own duplicates are grouped, becomes an immutable snapshot: one
row for each digest, and a binary-fuse filter for each range of digests.  The
digests of a later batch are screened by the filters of the snapshots before
it; what a filter lets through is looked up in the snapshot's exact rows, and
the bytes of all texts under a shared digest are compared.

Digests are grouped before they are dealt out, so a text with any number of
copies is one row for each batch.  Bytes are compared by the smallest and the
largest text under a digest, which every task computes on its own rows first:
they agree just when all texts do.  Digests with differing texts (SHA-256
collisions) are grouped anew by the text itself.

Defined results: a null text is empty; of equal texts the row with the
smallest non-null id stays (null only if all are null), and one alone of rows
that repeat that id; an empty table gives an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.llm import fuse
from trialfold.llm.common import SPACE, bounded, cut, keep_one

#: Batches that become snapshots before the last one comes in.
SNAPSHOTS = 2
#: Digests of one filter, about.
FILTER_KEYS = 20_000


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normal(text), 256))


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"batch": rows["batch"][:1], "part": rows["part"][:1], "filter": [fuse.build(rows["key"].to_numpy())]})


def _screen(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(filters) or not len(rows):
        return rows[["digest", "batch"]][:0]
    return rows.loc[fuse.may_hold(filters["filter"].iloc[0], rows["key"].to_numpy()), ["digest", "batch"]]


def snapshot_filters(groups: DataFrame) -> DataFrame:
    """(batch, part, filter) of the snapshots' digests."""
    return groups.select("batch", "part", "key").groupBy("batch", "part").applyInPandas(_build, "batch long, part long, filter binary")


def screened(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """(digest, batch) of incoming digests that some filter of an earlier batch lets through."""
    asked = incoming.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batch") - 1)))
    return (asked.select("digest", "key", "batch", "part").groupBy("batch", "part")
            .cogroup(filters.groupBy("batch", "part")).applyInPandas(_screen, "digest binary, batch long"))


def grouped(docs: DataFrame, snapshots: int = SNAPSHOTS) -> DataFrame:
    """(doc_id, digest, keep_id, group_size) of each row of ``docs``."""
    slim = cut(docs.select("doc_id", digest(F.col("text")).alias("digest"))
               .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(snapshots + 1)).cast("long")))
    own = slim.groupBy("batch", "digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    parts = -(-slim.count() // FILTER_KEYS) or 1
    groups = cut(own.withColumn("key", F.xxhash64("digest"))
                 .withColumn("part", F.shiftright(F.shiftrightunsigned("key", 32) * parts, 32)))
    stored, incoming = groups.where(F.col("batch") < snapshots), groups.where("batch > 0")
    candidates = screened(incoming, snapshot_filters(stored))
    shared = cut(candidates.join(stored.select("digest", "batch"), ["digest", "batch"], "left_semi").select("digest").distinct())
    side = bounded(shared)
    merged = (groups.join(side, "digest", "left_semi").groupBy("digest")
              .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    final = cut(groups.join(side, "digest", "left_anti").select("digest", "keep_id", "group_size").unionByName(merged))

    single = final.where("group_size = 1").select(F.col("keep_id").alias("doc_id"), "digest", "keep_id", "group_size")
    several = cut(final.where("group_size > 1"))
    hint = bounded(several)
    text = docs.select("doc_id", normal(F.col("text")).alias("_text"), digest(F.col("text")).alias("digest"))
    unequal = cut(text.join(hint.drop("keep_id", "group_size"), "digest", "left_semi").groupBy("digest")
                  .agg(F.min("_text").alias("_a"), F.max("_text").alias("_b")).where("_a != _b").select("digest"))
    copies = slim.select("doc_id", "digest").join(hint, "digest")
    if not unequal.isEmpty():
        apart = text.join(unequal, "digest", "left_semi")
        exact = apart.groupBy("digest", "_text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        copies = copies.join(unequal, "digest", "left_anti").unionByName(
            apart.join(exact, ["digest", "_text"]).select(*copies.columns))
    return single.unionByName(copies)


def dedup(docs: DataFrame, snapshots: int = SNAPSHOTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row."""
    rows = grouped(docs, snapshots).withColumn("text_sha256", F.lower(F.hex("digest")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    first = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("keep_id")) == 1
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return (rows.where(stays).withColumn("kept", first).select(*names)
            .unionByName(rows.where(~stays).withColumn("kept", F.lit(False)).select(*names)))


def deduplicated(docs: DataFrame, snapshots: int = SNAPSHOTS) -> DataFrame:
    """The documents that stay, in all their columns."""
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    decided = cut(grouped(docs, snapshots).select("doc_id", F.col("digest").alias("_key"), stays.alias("_stays")))
    return keep_one(docs, digest(F.col("text")), decided)
