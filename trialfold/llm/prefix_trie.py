"""Prefix trie of rebuilt conversations by composable fingerprints (operator 12).

A rebuilt conversation is the head of a base conversation followed by the tail
of its own turns.  It is never written out: its prefix of length d has the
fingerprint (value, d), where (v, d) * (w, e) = (v + x^d w, d + e), an
associative product with the unit (0, 0).  Heads are products over the base's
first turns, tails are running products over a conversation's own turns, and
the prefixes of a rebuilt conversation are the head's prefixes and head * tail
prefixes, whatever the texts are.

Prefixes of equal fingerprint are one node.  Every member carries the reference
of its last turn (120 bits of the SHA-256 of role and text, taken once where the
turn is stored) and its parent's fingerprint; a group whose members differ in
either would be a collision, and then all fingerprints are taken again with
another x.  As equal parents and equal last turns make equal prefixes, that check
is complete, depth by depth.

Tails and positions are prefix sums over one global order of the turns, cut
into as many blocks as there are partitions, so a conversation of any length
spreads over tasks.  Sums over subtrees double their reach each round: a node's
sum takes in the sums of the nodes 2^r below it.

Defined results: turns are in the order of turn (null first), then role, then
the text's digest; null role or text is empty; rows that repeat are turns of
their own; rows without a conv_id belong to no conversation; an empty table
gives an empty result.  Names of other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.llm.common import cut, ranked

GROUP, HEADS = 100, 6
#: Two prime moduli below 2^31: products of residues fit a long.
PRIMES = (2_147_483_647, 2_147_483_629)
#: Conversation lengths up to 2^40 turns.
LENGTH_BITS = 40
#: Ids that are joined into one text at once.
CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def bases(seed: int) -> tuple[int, ...]:
    """x for each modulus."""
    return tuple(int.from_bytes(hashlib.sha256(f"{seed}:{p}".encode()).digest()[:8], "big") % (p - 2) + 2 for p in PRIMES)


def power(x: int, exponent: str, p: int, bits: int = LENGTH_BITS) -> Column:
    """x^exponent mod p for a column, by the exponent's bits."""
    squares = ", ".join(f"{pow(x, 1 << b, p)}L" for b in range(bits))
    return F.expr(f"aggregate(zip_with(array({squares}), sequence(0, {bits - 1}), (s, b) -> if(shiftright({exponent}, b) % 2 = 1, s, 1L)),"
                  f" 1L, (a, s) -> a * s % {p})")


def head_power(x: int, exponent: Column, p: int) -> Column:
    """x^exponent mod p for exponents below HEADS."""
    return F.get(F.expr(f"array({', '.join(f'{pow(x, e, p)}L' for e in range(HEADS))})"), exponent.cast("int"))


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def stored_turns(conversations: DataFrame) -> DataFrame:
    """Each turn once: conv_id, its global ``position``, its reference (r1, r2) and the code points of its text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    slim = (conversations.where("conv_id is not null")
            .select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]

    def digits(start: int) -> Column:
        return F.conv(F.substring("digest", start, 15), 16, 10).cast("long")

    return ranked(slim, order).select("conv_id", "position", digits(1).alias("r1"), digits(16).alias("r2"), "chars")


def running(rows: DataFrame, values: list[str], order: str, total: int) -> DataFrame:
    """``rows`` with the sums of ``values`` (residues) over all rows up to each
    one in the gapless ``order``, modulo the primes: sums inside blocks, and the
    sums of the blocks before, of which there are as many as partitions."""
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, -(-total // blocks))
    rows = rows.withColumn("_block", F.floor(F.col(order) / size))
    sums = rows.groupBy("_block").agg(*[(F.sum(v) % p).alias(f"_{v}") for v, p in zip(values, PRIMES, strict=True)])
    upto = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_block", *[F.coalesce(F.sum(f"_{v}").over(upto), F.lit(0)).alias(f"_before_{v}") for v in values])
    inside = Window.partitionBy("_block").orderBy(order)
    out = rows.withColumns({f"_in_{v}": F.sum(v).over(inside) for v in values}).join(F.broadcast(before), "_block")
    return (out.withColumns({f"{v}_sum": (F.col(f"_before_{v}") + F.col(f"_in_{v}")) % p for v, p in zip(values, PRIMES, strict=True)})
            .drop("_block", *[f"_in_{v}" for v in values], *[f"_before_{v}" for v in values]))


def members(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, depth, f1, f2, p1, p2, r1, r2, chars, last): a row for each
    prefix of each rebuilt conversation, with its parent's fingerprint and
    whether it is the whole conversation.  ``turns`` are stored turns."""
    x = bases(seed)
    convs = cut(turns.groupBy("conv_id").agg(F.min("position").alias("first"), F.count("*").alias("n"))
                .withColumn("h", head_length(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP))
    total = convs.agg(F.sum("n")).first()[0] or 0
    rows = turns.join(convs.select("conv_id", "first", "h"), "conv_id").withColumn("i", F.col("position") - F.col("first") + 1)

    # heads: the first turns of each base, and the products over them (HEADS - 1 of them at most)
    value = F.struct("i", "r1", "r2", "chars")
    heads = (rows.where((F.col("conv_id") % GROUP == 0) & (F.col("i") < HEADS))
             .groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(value)).alias("turns")))

    def product(k: Column, which: int) -> Column:
        p, ref = PRIMES[which], f"r{which + 1}"
        return F.aggregate(F.slice("turns", F.lit(1), k), F.lit(0).cast("long"),
                           lambda a, t: (a + t[ref] % p * head_power(x[which], t["i"], p)) % p)

    info = convs.join(heads, "base", "left").withColumn("turns", F.coalesce("turns", F.array().cast("array<struct<i:bigint,r1:bigint,r2:bigint,chars:bigint>>")))
    info = info.withColumn("k", F.least(F.col("h"), F.size("turns")).cast("int")).withColumn("size", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    info = cut(info.select("conv_id", "turns", "k", "size", product(F.col("k"), 0).alias("b1"), product(F.col("k"), 1).alias("b2")))

    # tails: running products over a conversation's own turns after its head
    own = rows.where("i > h").withColumn("m", F.col("i") - F.col("h"))
    own = own.withColumns({f"a{w + 1}": F.col(f"r{w + 1}") % p * power(x[w], "m", p) % p for w, p in enumerate(PRIMES)})
    sums = cut(running(own, ["a1", "a2"], "position", total))
    starts = sums.where("m = 1").select("conv_id", *[((F.col(f"a{w}_sum") - F.col(f"a{w}") + PRIMES[w - 1]) % PRIMES[w - 1]).alias(f"s{w}") for w in (1, 2)])
    tails = sums.join(info.drop("turns").join(starts, "conv_id"), "conv_id")

    def joined(w: int, without_last: bool) -> Column:
        p = PRIMES[w - 1]
        tail = F.col(f"a{w}_sum") - F.col(f"s{w}") + p - (F.col(f"a{w}") if without_last else 0) + p
        return (F.col(f"b{w}") + head_power(x[w - 1], F.col("k"), p) * (tail % p)) % p

    depth = F.col("k") + F.col("m")
    tails = tails.select("conv_id", depth.cast("long").alias("depth"), joined(1, False).alias("f1"), joined(2, False).alias("f2"),
                         joined(1, True).alias("p1"), joined(2, True).alias("p2"), "r1", "r2", "chars", (depth == F.col("size")).alias("last"))

    head = info.select("conv_id", "k", "size", "turns", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("d"))
    turn, nothing = F.get("turns", F.col("d") - 1), F.lit(0).cast("long")
    up = F.greatest(F.col("d") - 1, F.lit(0))
    head = head.select("conv_id", F.col("d").cast("long").alias("depth"), product(F.col("d"), 0).alias("f1"), product(F.col("d"), 1).alias("f2"),
                       product(up, 0).alias("p1"), product(up, 1).alias("p2"), F.coalesce(turn["r1"], nothing).alias("r1"),
                       F.coalesce(turn["r2"], nothing).alias("r2"), F.coalesce(turn["chars"], nothing).alias("chars"), (F.col("d") == F.col("size")).alias("last"))
    return head.unionByName(tails)


def key(depth: str, high: str, low: str) -> list[Column]:
    """A node's name: its depth and both residues in one long."""
    return [F.col(depth).alias("depth"), F.shiftleft(high, 31).bitwiseOR(F.col(low)).alias("node")]


def nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(depth, node, up, conv_id, n_convs, chars) of all nodes, ``up`` naming the
    parent at the depth before, and (depth, node, conv_id) of where each
    conversation ends."""
    turns = cut(stored_turns(conversations))
    seed = 0
    while True:
        found = cut(members(turns, seed).select(*key("depth", "f1", "f2"), key("depth", "p1", "p2")[1].alias("up"), "r1", "r2", "chars", "conv_id", "last"))
        same = [F.min(c).alias(f"{c}_") for c in ("up", "r1", "r2")]
        out = cut(found.groupBy("depth", "node").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
            *same, *[F.max(c).alias(c) for c in ("up", "r1", "r2")]))
        if out.where("up != up_ or r1 != r1_ or r2 != r2_").isEmpty():
            return out.select("depth", "node", "up", "conv_id", "n_convs", "chars"), found.where("last").select("depth", "node", "conv_id")
        seed += 1  # two different prefixes with one fingerprint


def subtree_sums(trie: DataFrame, values: list[str]) -> DataFrame:
    """(depth, node) with the sums of ``values`` over each node's subtree.

    After r rounds a sum reaches 2^r levels down and ``up`` names the node 2^r
    levels above; only nodes that deep take part in the next round."""
    deepest = trie.agg(F.max("depth")).first()[0] or 0
    sums = cut(trie.select("depth", "node", "up", *values))
    reach = 1
    while reach <= deepest:
        deep = sums.where(F.col("depth") >= reach)
        more = deep.groupBy((F.col("depth") - reach).alias("depth"), F.col("up").alias("node")).agg(*[F.sum(v).alias(v) for v in values])
        above = sums.where(F.col("depth") >= reach).select((F.col("depth") + reach).alias("_depth"), F.col("node").alias("_node"), F.col("up").alias("_up"))
        jumped = (deep.where(F.col("depth") >= 2 * reach)
                  .join(above, (F.col("depth") == F.col("_depth")) & (F.col("up") == F.col("_node"))).select("depth", "node", F.col("_up").alias("up")))
        # one grouping adds the sums and sets the new parent
        parts = (sums.select("depth", "node", F.lit(None).cast("long").alias("up"), *values)
                 .unionByName(more, allowMissingColumns=True).unionByName(jumped, allowMissingColumns=True))
        sums = cut(parts.groupBy("depth", "node").agg(F.max("up").alias("up"), *[F.sum(v).alias(v) for v in values]))
        reach *= 2
    return sums.drop("up")


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (depth, node, chunk, ids) to a digest for each node, chunk by chunk."""
    at, sha = None, None
    for b in batches:
        out = []
        for depth, node, ids in zip(b["depth"], b["node"], b["ids"], strict=True):
            if at != (depth, node):
                if at:
                    out.append((*at, sha.hexdigest()))
                at, sha = (depth, node), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pd.DataFrame(out, columns=["depth", "node", "ends_sha256"])
    if at:
        yield pd.DataFrame([(*at, sha.hexdigest())], columns=["depth", "node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of nodes where conversations end.  Ids are
    joined in chunks of a global order; a node of several chunks is hashed
    chunk by chunk in a stream, so no group of ids is ever one row."""
    chunks = (ranked(ends, [F.col("depth"), F.col("node"), F.col("conv_id")])
              .groupBy("depth", "node", F.floor(F.col("position") / CHUNK).alias("chunk"))
              .agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")))
    chunks = cut(chunks)
    counts = chunks.groupBy("depth", "node").agg(F.count("*").alias("_n"))
    many = cut(counts.where("_n > 1").drop("_n"))
    one = chunks.join(many, ["depth", "node"], "left_anti").select("depth", "node", F.sha2("ids", 256).alias("ends_sha256"))
    long = (chunks.join(many, ["depth", "node"], "left_semi").repartition("depth", "node").sortWithinPartitions("depth", "node", "chunk")
            .mapInPandas(_streamed, "depth long, node long, ends_sha256 string"))
    return one.unionByName(long)


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of all rebuilt conversations."""
    found, ends = nodes(conversations)
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    parts = (found.unionByName(children, allowMissingColumns=True).unionByName(end_digests(ends), allowMissingColumns=True))
    firsts = [F.max(c).alias(c) for c in ("up", "conv_id", "n_convs", "chars", "n_children")]
    whole = cut(parts.groupBy("depth", "node").agg(*firsts, F.max("ends_sha256").alias("ends_sha256"))
                .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
                .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars")))
    sums = subtree_sums(whole, ["n_leaves", "saved_tokens"])
    parents = whole.select((F.col("depth") + 1).alias("_depth"), F.col("node").alias("_node"), F.col("conv_id").alias("parent_conv_id"))
    return (whole.drop("n_leaves", "saved_tokens").join(sums, ["depth", "node"])
            .join(parents, (F.col("depth") == F.col("_depth")) & (F.col("up") == F.col("_node")), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))
