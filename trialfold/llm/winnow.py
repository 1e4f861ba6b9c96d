"""Document fingerprints by winnowing (operator 10).

A text's words (in scripts without spaces, and in runs of more than LONG_RUN
code points, each code point) are hashed, a cyclic-polynomial rolling hash joins ``GRAM``
neighbouring word hashes, and of every window of ``WINDOW`` neighbouring grams
the smallest hash is kept, the rightmost of equal ones, with its position.  So
any passage of ``GRAM + WINDOW - 1`` words that two texts share leaves a common
fingerprint, and no match is shorter than ``GRAM`` words.  All of it is Spark
SQL functions over arrays inside a row.

Each text meets the next one's by a global rank of narrow rows (id, hash of the
text): blocks of equal row counts, whatever the ids are, are found by their
first rows, each block is a task's group, and its first row is lent to the block
before it.

Defined results: a null text is empty; null ids come first; rows that repeat an
id are in the order of their texts' hashes; of rows that repeat id and text one
is read, and each of the others is followed by its like; a text without words has the empty
fingerprint; one of fewer words than a gram is one gram, and one of fewer grams
than a window is one window; two empty fingerprints are alike (1), an empty one
is unlike all others (0); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.llm.common import WORD, bounded, cut, ranked, spread

GRAM = 4
WINDOW = 8
#: Positions count up to 2 ** POSITION_BITS words and start anew there.
POSITION_BITS = 23
_MASK = (1 << POSITION_BITS) - 1
#: Blocks are looked up by their first rows in LEVELS steps, each among FAN.
FAN, LEVELS = 64, 3
#: Thai, Lao, Burmese, Khmer, Kana and Han.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3134F}"
LONG_RUN = 64


def _rotated(h: Column, by: int) -> Column:
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def units(text: Column) -> Column:
    """The words of a text, cut into code points where they have no spaces."""
    mixed = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+"
    words = (F.when(text.rlike(f"[{UNSPACED}]"), F.regexp_extract_all(text, F.lit(mixed), F.lit(0)))
             .otherwise(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))

    def long(w: Column) -> Column:
        return F.length(w) > LONG_RUN

    return _let(words, lambda ws: F.when(F.exists(ws, long), F.flatten(F.transform(ws, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w)))))
                .otherwise(ws))


def word_hashes(text: Column) -> Column:
    return F.transform(units(text), lambda w: F.xxhash64(w))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a column used inside a
    lambda may be computed anew for each element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubled(values: Column, width: int, join) -> Column:
    """For each element, ``join`` over it and the ``width - 1`` after it
    (``width`` a power of two), in a pass for each doubling."""
    if width == 1:
        return values
    half = width // 2
    return _let(_doubled(values, half, join),
                lambda a: F.zip_with(a, F.slice(a, F.lit(half + 1), F.size(a)), lambda x, y: join(x, y, half)))


def gram_hashes(words: Column, gram: int = GRAM) -> Column:
    """Rolling hashes of all runs of ``gram`` word hashes (one of them all, if
    there are fewer): the exclusive or of the hashes, each rotated by its
    distance from the run's end."""
    size = F.size(words)
    whole = F.aggregate(words, F.lit(0).cast("long"), lambda a, w: _rotated(a, 1).bitwiseXOR(w))
    runs = _doubled(words, gram, lambda x, y, half: _rotated(x, half).bitwiseXOR(y))
    return (F.when(size == 0, F.array().cast("array<bigint>")).when(size < gram, F.array(whole))
            .otherwise(F.slice(runs, F.lit(1), F.greatest(size - gram + 1, F.lit(1)))))


def selected(grams: Column, window: int = WINDOW) -> Column:
    """The keys of the smallest gram of each window, each once, in order.

    A key has the upper ``64 - POSITION_BITS - 1`` bits of a hash above the
    inverted position, so the smallest key is the rightmost smallest hash."""
    def keyed(h: Column, i: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(h, POSITION_BITS + 1), POSITION_BITS).bitwiseOR(F.lit(_MASK) - i.bitwiseAND(F.lit(_MASK)))

    def lows(keys: Column) -> Column:
        # a window that runs over the end has no more than another one before it, but if it is the only one
        every = _doubled(keys, window, lambda x, y, _: F.least(x, y))
        return F.array_distinct(F.slice(every, F.lit(1), F.greatest(F.size(keys) - window + 1, F.least(F.size(keys), F.lit(1)))))

    return _let(F.transform(grams, keyed), lows)


def winnowed(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The kept keys of a text."""
    return _let(word_hashes(text), lambda words: _let(gram_hashes(words, gram), lambda grams: selected(grams, window)))


def hashes(picked: Column) -> Column:
    return F.transform(picked, lambda k: F.shiftrightunsigned(k, POSITION_BITS))


def fingerprint(picked: Column) -> Column:
    """The kept hashes with their positions (index of the gram's first word) as text."""
    def shown(k: Column) -> Column:
        return F.concat(F.lower(F.hex(F.shiftrightunsigned(k, POSITION_BITS))), F.lit("@"), (F.lit(_MASK) - k.bitwiseAND(F.lit(_MASK))).cast("string"))

    return F.array_join(F.transform(picked, shown), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes, 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(both / every)


def _first_rows(slim: DataFrame, size: int) -> list[DataFrame]:
    """For each level of the look-up (block, first rows of the blocks in it)."""
    starts = cut(ranked(slim.select("doc_id", "_th"), [F.col("doc_id").asc_nulls_first(), F.col("_th")])
                 .where(F.col("position") % size == 0).withColumn("block", F.floor(F.col("position") / size)))
    tables = []
    for level in range(LEVELS):
        stride = FAN ** (LEVELS - 1 - level)
        rows = starts.where(F.col("block") % stride == 0).groupBy(F.floor(F.col("block") / (stride * FAN)).alias("_above"))
        tables.append(rows.agg(F.array_sort(F.collect_list(F.struct("doc_id", "_th"))).alias("_firsts")))
    return tables


def neighbours(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Rows (doc_id, text, _th, _n: how often id and text repeat) with the block
    ``_to`` in which each stands right before the next row; ``_guest`` is 1 for
    rows lent to another block (the first row of all is lent to the last one).
    Texts are dealt out once, by block.  Also whether any row repeats."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_th", F.xxhash64("text"))
    slim = cut(rows.groupBy("doc_id", "_th").agg(F.count("*").alias("_n")))
    several = cut(slim.where("_n > 1").select(F.col("doc_id").alias("_id"), F.col("_th").alias("_h"), "_n"))
    repeats = not several.isEmpty()
    if repeats:
        same = (F.col("_th") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id"))
        side = bounded(several)
        once = rows.join(side, same).select("doc_id", "text", "_th", "_n").dropDuplicates(["doc_id", "_th"])
        rows = rows.join(side, same, "left_anti").withColumn("_n", F.lit(1).cast("long")).unionByName(once)
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("long"))

    # about 4 * sqrt(n) blocks, FAN ** LEVELS at most
    n = max(1, slim.count())
    size = max(1, round(n**0.5 / 4), -(-n // FAN**LEVELS))
    own = F.struct("doc_id", "_th")
    rows = rows.withColumn("_block", F.lit(0).cast("long"))
    for table in _first_rows(slim, size):
        at = F.size(F.filter("_firsts", lambda f: f <= own)) - 1
        rows = (rows.join(F.broadcast(table), F.col("_block") == F.col("_above"))  # FAN ** (LEVELS - 1) rows at most
                .withColumn("_first", F.get("_firsts", at) == own)
                .withColumn("_block", F.col("_block") * FAN + at).drop("_above", "_firsts"))
    lent = F.when(F.col("_block") == 0, F.lit((n - 1) // size).cast("long")).otherwise(F.col("_block") - 1)
    to = F.when(F.col("_first"), F.array(F.col("_block"), lent)).otherwise(F.array("_block"))
    return rows.select("doc_id", "text", "_th", "_n", F.posexplode(to).alias("_guest", "_to")), repeats


def compared(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and their likeness."""
    placed, repeats = neighbours(docs)
    w = Window.partitionBy("_to").orderBy("_guest", F.col("doc_id").asc_nulls_first(), "_th")
    rows = placed.repartition("_to").withColumn("_picked", winnowed(F.col("text"), gram, window))
    rows = (rows.withColumn("next_text", F.lead("text").over(w)).withColumn("_next", F.lead(hashes(F.col("_picked"))).over(w))
            .where("_guest = 0").withColumn("_times", F.lit(1).cast("long")))
    if repeats:  # the last of equal rows is followed by the next row, the others by their like
        like = rows.where("_n > 1").withColumns({"next_text": F.col("text"), "_next": hashes(F.col("_picked")), "_times": F.col("_n") - 1})
        rows = rows.unionByName(like)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("_edited", winnowed(F.col("edited"), gram, window))
    out = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("_picked")).alias("fingerprint"), fingerprint(F.col("_edited")).alias("edited_fingerprint"),
        likeness(hashes(F.col("_picked")), hashes(F.col("_edited"))).alias("near_edited"),
        likeness(hashes(F.col("_picked")), F.col("_next")).alias("near_next"), "_times")
    if repeats:
        out = out.where("_times = 1").unionByName(spread(cut(out.where("_times > 1")), "_times", "_copy").drop("_copy"))
    return out.drop("_times")
