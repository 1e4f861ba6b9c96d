"""Spelling variants: words one edit apart, by k-d trees over letter counts (operator 11).

One inserted or deleted letter changes one count of a word's letter-count
vector by one; one replaced letter lowers one count and raises another.  So the
near words of a word lie, among words of its own length, in a box that is at
most one count up and one down away, and among words one letter longer, at most
one count up.  Each pair of lengths is a range search of its own.

Words are dealt into cells by the top of a k-d tree for each length, built from
a bounded sample of the vocabulary (``SAMPLE`` words, of which only letter counts
are read).  A word goes as a native to its own cell and as a guest to every cell
whose box it can reach.  A task streams a cell: natives come first and get a
k-d tree of their own, guests search it batch by batch, and the letters' order
is verified for what the boxes leave (of pairs one letter apart in length, after
their letters' sums and sums of squares).  A pair is found once, by the smaller word
or the shorter one, and counts for both; only a word's count and best near word
leave the task.

Forms double a word's count at least, so a chain of forms is as long as the
logarithm of the largest count at most, and pointer jumping follows it.

Defined results: a null text has no words; a null id reads as the empty text in
the hashed key; rows that repeat count again; words of one letter-count vector
stay in one leaf; a word has no length limit; an empty table gives an empty
result.  Names of other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import cut

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH, MIN_COUNT, FORM_RATIO, DROP_EVERY = 5, 3, 2, 97
#: Words whose letter counts the top trees are built from, and how many of them a leaf has at least.
SAMPLE, LEAST_SAMPLE = 16_384, 8
#: Bytes of letter counts that a cell is meant to hold, and words of a leaf inside a cell.
CELL_BYTES, LEAF = 1_600_000, 96
#: Letters compared at once, and rows and characters that a worker takes up at once.
COMPARED, ROWS, CHARS = 4_000_000, 20_000, 4_000_000

#: Letter of a Latin-1 byte: a to z, then the code points from 0xC0 on.
LETTERS = 26 + 64
_SLOT = np.zeros(256, np.int64)
_SLOT[ord("a"):ord("z") + 1] = np.arange(26)
_SLOT[0xC0:] = 26 + np.arange(64)
_FAR = 1 << 30


# ---------------------------------------------------------------- vocabulary

def spelled(doc_id: Column, run: Column) -> Column:
    """The run in small letters (A to Z only), without one code point where its key's hash says so."""
    plain = F.when(run.rlike("[À-Þ]"), F.translate(run, CAPITALS, CAPITALS.lower())).otherwise(F.lower(run))

    def drop(low: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), low).cast("binary"))
        at = (h % F.length(low)).cast("int")
        return F.when(h % DROP_EVERY == 0, F.concat(F.substring(low, F.lit(1), at), F.substring(low, at + 2, F.length(low)))).otherwise(low)

    return F.get(F.transform(F.array(plain), drop), F.lit(0))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.where(F.length("run") >= MIN_LENGTH).select(spelled(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(f"n >= {MIN_COUNT}")


# ---------------------------------------------------------------- k-d trees

def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of LETTERS counts for each word (Latin-1 bytes)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    slots = _SLOT[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(rows * LETTERS + slots, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


def grow(counts: np.ndarray, rows: np.ndarray, leaf: float, number) -> tuple:
    """A k-d tree over ``rows`` of ``counts``: (letter, bound, tree of counts up to
    the bound, tree of larger ones), or (None, number(rows)) for a leaf.  Splits
    where the halves are most even."""
    if len(rows) > leaf:
        own = counts[rows]
        best = None
        for d in np.flatnonzero(own.max(axis=0) > own.min(axis=0)):
            values, n = np.unique(own[:, d], return_counts=True)
            below = np.cumsum(n)[:-1]
            i = int(np.argmin(np.abs(2 * below - len(rows))))
            uneven = abs(2 * int(below[i]) - len(rows))
            if best is None or uneven < best[0]:
                best = uneven, int(d), int(values[i])
        if best:
            _, d, bound = best
            low = own[:, d] <= bound
            return d, bound, grow(counts, rows[low], leaf, number), grow(counts, rows[~low], leaf, number)
    return None, number(rows)


def reached(tree: tuple, counts: np.ndarray, up: int, down: int) -> Iterator[tuple]:
    """(leaf, indices) of the leaves whose box has a point that lies at most
    ``up`` counts above and ``down`` counts below the rows of ``counts``.  Where
    both are one, the letter that is more must stand after the one that is less:
    the word on the other side of the pair looks the other way."""
    zero, none = np.zeros(len(counts), np.int32), np.full(len(counts), -1, np.int32)
    todo = [(tree, np.arange(len(counts)), zero, zero, none, none, {})]
    while todo:
        (d, *rest), alive, rise, fall, more, less, box = todo.pop()
        if d is None:
            yield rest[0], alive
            continue
        bound, small, large = rest
        lo, hi = box.get(d, (0, _FAR))
        q = counts[alive, d]
        fell = fall - np.maximum(q - hi, 0) + np.maximum(q - bound, 0)
        rose = rise - np.maximum(lo - q, 0) + np.maximum(bound + 1 - q, 0)
        falls, rises = fell > fall, rose > rise
        ok = (fell <= down) & ~(falls & (rise > 0) & (more < d))
        if ok.any():
            todo.append((small, alive[ok], rise[ok], fell[ok], more[ok], np.where(falls, d, less)[ok], box | {d: (lo, min(hi, bound))}))
        ok = (rose <= up) & ~(rises & (fall > 0) & (less > d))
        if ok.any():
            todo.append((large, alive[ok], rose[ok], fall[ok], np.where(rises, d, more)[ok], less[ok], box | {d: (max(lo, bound + 1), hi)}))


def top_trees(words: DataFrame, sample: int = SAMPLE) -> dict[int, tuple]:
    """length -> tree whose leaves are cell numbers, from a sample of the vocabulary."""
    drawn = words.select("word").orderBy(F.xxhash64("word"), "word").limit(sample)
    total = words.count()

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            coded = [w.encode("latin-1") for w in b["word"]]
            yield pd.DataFrame({"length": [len(w) for w in coded], "counts": [r.tobytes() for r in letter_counts(coded)]})

    rows = drawn.mapInPandas(counted, "length long, counts binary").collect()  # at most SAMPLE rows of fixed width
    by_length: dict[int, list[bytes]] = {}
    for r in rows:
        by_length.setdefault(r["length"], []).append(bytes(r["counts"]))
    trees, rate = {}, len(rows) / max(1, total)
    for length, vectors in by_length.items():
        counts = np.frombuffer(b"".join(sorted(vectors)), np.int32).reshape(-1, LETTERS)
        leaf = max(LEAST_SAMPLE, CELL_BYTES / (LETTERS * 4 + length) * rate)
        numbers = iter(range(len(vectors)))
        trees[length] = grow(counts, np.arange(len(counts)), leaf, lambda _, numbers=numbers: next(numbers))
    return trees


# ---------------------------------------------------------------- search

def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches joined up to ROWS rows or CHARS characters of words."""
    held, rows, chars = [], 0, 0
    for b in batches:
        held.append(b)
        rows, chars = rows + len(b), chars + int(b["word"].str.len().sum())
        if rows >= ROWS or chars >= CHARS:
            yield pd.concat(held, ignore_index=True)
            held, rows, chars = [], 0, 0
    if rows:
        yield pd.concat(held, ignore_index=True)


def dealt(trees: dict[int, tuple]):
    """Batches of (word, n) to rows (length, cell, guest, word, n)."""
    one_cell = (None, 0)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in gathered(batches):
            coded = [w.encode("latin-1") for w in b["word"]]
            counts, lengths = letter_counts(coded), np.fromiter(map(len, coded), np.int64, len(coded))
            words, n = b["word"].to_numpy(), b["n"].to_numpy()
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                own = counts[mine]
                for guest, longer, down in ((0, 0, 0), (1, 0, 1), (1, 1, 0)):
                    found = list(reached(trees.get(length + longer, one_cell), own, guest, down))
                    at = mine[np.concatenate([x for _, x in found])]
                    cells = np.repeat([c for c, _ in found], [len(x) for _, x in found])
                    yield pd.DataFrame({"length": length + longer, "cell": cells, "guest": guest, "word": words[at], "n": n[at]})

    return deal


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer row is the shorter one with one letter more."""
    head = np.cumprod(short == long[:, :-1], axis=1, dtype=np.int32).sum(axis=1)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int32).sum(axis=1)
    return head + tail >= short.shape[1]


def moments(codes: np.ndarray) -> np.ndarray:
    """Sum of the letters and of their squares, by row."""
    wide = codes.astype(np.int64)
    return np.stack([wide.sum(axis=1), (wide * wide).sum(axis=1)])


class Cell:
    """The natives of a cell (one length, ascending words) and their tree."""

    def __init__(self, words: list[bytes], n: list[int]):
        self.words, self.n = words, np.array(n, np.int64)
        self.codes = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.moments = moments(self.codes)
        self.tree = grow(letter_counts(words), np.arange(len(words)), LEAF, lambda rows: rows)

    def _replaced(self, codes: np.ndarray, at: np.ndarray, natives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.ascontiguousarray(codes[at].T), np.ascontiguousarray(self.codes[natives].T)
        differ = np.zeros((len(at), len(natives)), np.int32 if len(a) > 255 else np.uint8)
        for x, y in zip(a, b, strict=True):
            differ += x[:, None] != y
        g, x = np.nonzero(differ == 1)
        g, x = at[g], natives[x]
        # once, from the word that is smaller where they differ
        smaller = (codes[g].astype(np.int16) - self.codes[x]).sum(axis=1) < 0
        return g[smaller], x[smaller]

    def _inserted(self, codes: np.ndarray, sums: np.ndarray, at: np.ndarray, natives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # one more letter c adds c to the sum and c * c to the squares
        more = self.moments[0][natives][None, :] - sums[0][at][:, None]
        squares = self.moments[1][natives][None, :] - sums[1][at][:, None]
        g, x = np.nonzero(more * more == squares)
        g, x = at[g], natives[x]
        wide = max(1, COMPARED // codes.shape[1])
        ok = [one_inserted(codes[g[i:i + wide]], self.codes[x[i:i + wide]]) for i in range(0, len(g), wide)]
        ok = np.concatenate(ok) if ok else np.zeros(0, bool)
        return g[ok], x[ok]

    def near(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (guest, native) one edit apart: natives that are longer, or larger words of the same length."""
        length = self.codes.shape[1]
        shorter = np.array([len(w) < length for w in words])
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for short in (False, True):
            mine = np.flatnonzero(shorter == short)
            if not len(mine):
                continue
            own = [words[i] for i in mine]
            codes = np.frombuffer(b"".join(own), np.uint8).reshape(len(mine), -1)
            sums = moments(codes) if short else None
            for natives, at in reached(self.tree, letter_counts(own), 1, 0 if short else 1):
                step = max(1, COMPARED // (length * len(natives)))
                for i in range(0, len(at), step):
                    part = at[i:i + step]
                    g, x = self._inserted(codes, sums, part, natives) if short else self._replaced(codes, part, natives)
                    first.append(mine[g])
                    second.append(x)
        return np.concatenate(first), np.concatenate(second)


def _best(of: np.ndarray, near: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``of``: how many pairs it has, and the near index of largest n (the smaller index of equal ones)."""
    order = np.lexsort((near, -n[near], of))
    who, at, k = np.unique(of[order], return_index=True, return_counts=True)
    return who, k, near[order][at]


def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (length, cell, guest, word) to (word, n_near, near_n, near) of what was found here."""
    at, natives, sizes, cell = None, [], [], None
    for b in gathered(batches):
        coded = [w.encode("latin-1") for w in b["word"]]
        keys, sizes_here = b[["length", "cell", "guest"]].to_numpy(), b["n"].to_numpy()
        ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        start = 0
        for end in ends:
            length, number, guest = keys[start].tolist()
            words, n = coded[start:end], sizes_here[start:end]
            start = end
            if at != (length, number):
                at, natives, sizes, cell = (length, number), [], [], None
            if not guest:
                natives += words
                sizes += n.tolist()
                continue
            if not natives:
                continue  # a guest's length has no word here
            cell = cell or Cell(natives, sizes)
            g, x = cell.near(words)
            if not len(g):
                continue
            for of, near, own, other, counts in ((g, x, words, cell.words, cell.n), (x, g, cell.words, words, np.asarray(n))):
                who, k, best = _best(of, near, counts)
                yield pd.DataFrame({"word": [own[i].decode("latin-1") for i in who], "n_near": k,
                                    "near_n": counts[best], "near": [other[i].decode("latin-1") for i in best]})


def near_words(words: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(word, n) with n_near, form and form_n."""
    rows = words.mapInPandas(dealt(top_trees(words, sample)), "length long, cell long, guest int, word string, n long")
    found = (rows.repartition("length", "cell").sortWithinPartitions("length", "cell", "guest", "word")
             .mapInPandas(searched, "word string, n_near long, near_n long, near string"))
    all_ = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"), F.lit(None).cast("string").alias("near"))
    every = all_.unionByName(found, allowMissingColumns=True)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    out = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    real = -F.col("best.less") >= FORM_RATIO * F.col("n")
    return out.select("word", "n", "n_near", F.when(real, F.col("best.near")).alias("form"), F.when(real, -F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each round follows twice as many forms."""
    links = cut(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        links = cut(links.join(on, F.col("root") == F.col("_word"), "left")
                    .select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        moved = links.where("moved").isEmpty()
        links = links.select("word", "root")
        if moved:
            return links


def variants(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    words = cut(vocabulary(docs))
    forms = cut(near_words(words, sample))
    out = forms.join(roots(forms), "word", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
