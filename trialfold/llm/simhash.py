"""SimHash near-dedup with BK-trees (operator 4).

A document's fingerprint has a bit for each of 64 majorities over the hashes
of its word shingles.  Fingerprints link at few differing bits, and the links'
connected components are the groups of near duplicates.

Distinct fingerprints alone are compared.  Cut into ``distance + 2`` blocks of
bits, two linked fingerprints agree in two blocks at least, so every pair of
blocks deals the fingerprints into shards by the bits of those two.  A shard is
a BK-tree: a node's children are keyed by their Hamming distance to it, and a
search follows only the edges within the radius of the query's own distance.
The tree's nodes go to where the queries of its shard are; a shard beyond
``SHARD`` fingerprints is cut into as many trees as needed and each meets all
blocks of the shard's queries, in tasks of bounded size.  A task gives back the
components of what it saw (one edge for each fingerprint), not its pairs, so a
large group of near copies makes no quadratic output.

Defined results: a text without words (null, empty, white space) has the
fingerprint zero, linked like any other; fewer words than a shingle are one
shingle; null ids never name a component unless all its ids are null; an empty
table gives an empty result.  Of a component one row stays: that with its
smallest id, among rows that repeat that id (or have none) the one with the
smallest text digest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import cut, keep_one
from trialfold.llm.graph import components

WORDS = 3
DISTANCE = 3
SEED = 42
#: Fingerprints of one tree at most.
SHARD = 4096


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint of a whole text."""
    found = text.encode().lower().split() if text else []  # both by ASCII letters and white space alone
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(itertools.accumulate(len(w) + 1 for w in found))
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[words - 1:], strict=False)]
    h = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):  # whole texts in blocks of bounded memory
        block = h[i:i + 4096]
        ones += np.unpackbits(block.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, words: int = WORDS) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return run(text)


def linked(prints: np.ndarray, in_tree: np.ndarray, distance: int) -> np.ndarray:
    """For each fingerprint the index of its component's first member, over
    the links between a tree (``in_tree``) and the others as queries (a tree
    alone is searched by its own members).

    The tree and the search of all queries go down together: the first
    fingerprint of a subtree is its node, the others its children by distance;
    the queries that reach a child are those within ``distance`` of its edge."""
    label = np.arange(len(prints))
    stack = [(np.flatnonzero(in_tree), label.copy() if in_tree.all() else np.flatnonzero(~in_tree))]
    while stack:
        nodes, asks = stack.pop()
        root = prints[nodes[0]]
        far = np.bitwise_count(prints[asks] ^ root).astype(np.int16)
        near = np.append(asks[far <= distance], nodes[0])
        found = np.unique(label[near])
        if len(found) > 1:
            label[np.isin(label, found)] = found[0]
        rest = nodes[1:]
        if len(rest):
            edge = np.bitwise_count(prints[rest] ^ root)
            for d in np.unique(edge):
                reach = asks[np.abs(far - int(d)) <= distance]
                if len(reach):
                    stack.append((rest[edge == d], reach))
    return label


def _links(distance: int, frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (fingerprint, first fingerprint of its component) of sorted shards."""
    carry, key = None, ["t", "k", "i", "j"]
    for frame in itertools.chain(frames, [None]):
        rows = carry if frame is None else frame if carry is None else pd.concat([carry, frame], ignore_index=True)
        carry = None
        if rows is None or not len(rows):
            continue
        keys = rows[key].to_numpy()
        new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        ends = np.append(new[1:], len(rows))
        if frame is not None:  # the last shard may go on in the next frame
            carry, new, ends = rows.iloc[new[-1]:], new[:-1], ends[:-1]
        prints, trees = rows["fp"].to_numpy(), rows["tree"].to_numpy()
        a, b = [], []
        for lo, hi in zip(new[ends - new > 1], ends[ends - new > 1], strict=True):
            own, tree = prints[lo:hi], trees[lo:hi]
            if not tree.any():
                continue
            label = linked(own.view(np.uint64), tree, distance)
            moved = label != np.arange(len(label))
            a.append(own[moved])
            b.append(own[label[moved]])
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are
    those of all pairs within ``distance``."""
    blocks = distance + 2
    sizes = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    shifts = [sum(sizes[:i]) for i in range(blocks)]

    def block(i: int) -> Column:
        return F.shiftrightunsigned("fp", shifts[i]).bitwiseAND(F.lit((1 << sizes[i]) - 1))

    pairs = list(itertools.combinations(range(blocks), 2))
    shards = F.array(*[F.struct(F.lit(t).alias("t"), (F.shiftleft(block(x), sizes[y]) + block(y)).alias("k"))
                       for t, (x, y) in enumerate(pairs)])
    entries = prints.select("fp", F.explode(shards).alias("s")).select("fp", "s.t", "s.k")
    trees = F.ceil(F.col("count") / SHARD).cast("int")
    hot = cut(entries.groupBy("t", "k").count().where(F.col("count") > SHARD).select("t", "k", trees.alias("trees")))
    if hot.isEmpty():
        dealt = entries.select("t", "k", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", F.lit(True).alias("tree"))
    else:
        own = F.pmod(F.xxhash64(F.col("fp")), F.col("trees")).cast("int")
        dealt = (entries.join(hot, ["t", "k"], "left").na.fill(1, ["trees"]).withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
                 .select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp",
                         (F.col("own") <= F.col("other")).alias("tree")))
    key = ["t", "k", "i", "j"]
    return (dealt.repartition(*key).sortWithinPartitions(*key, "fp")
            .mapInPandas(lambda frames: _links(distance, frames), "a long, b long"))


def near_groups(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, *more: Column) -> DataFrame:
    """doc_id, fp (signed), component_id (smallest id linked) and root (the
    component's fingerprint) of each row, and ``more`` columns of it."""
    slim = cut(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp"), *more))
    prints = cut(slim.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(prints.select("fp"), distance)).withColumnRenamed("node", "fp")
    placed = cut(prints.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    own = [c for c in slim.columns if c not in ("doc_id", "fp")]
    return slim.join(placed.join(names, "root").select("fp", "component_id", "root"), "fp").select("doc_id", "fp", "component_id", "root", *own)


def near_dedup(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    rows = near_groups(docs, words, distance)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each group (the smallest id), in all its columns."""
    key = F.unhex(F.sha2("text", 256))  # cheaper to have again than the fingerprint
    rows = cut(near_groups(docs, words, distance, key.alias("_key")))
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = rows.where(named).groupBy("root").agg(F.min("_key").alias("_first"))
    stays = named & F.col("_key").eqNullSafe(F.col("_first"))
    return keep_one(docs, key, cut(rows.join(first, "root").select("doc_id", "_key", stays.alias("_stays"))))
