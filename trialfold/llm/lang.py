"""Language ID by a bidirectional gated recurrent network over bytes (operator 8).

The network reads a sequence of bytes from both ends, labels every position
with a language, and a document's probabilities are the mean over all its
positions.  A sequence is a run of bytes without white space (longer ones go
on in windows of ``WINDOW`` bytes), so a sequence seen before has the same
labels wherever it stands: a task reads each distinct one once, within a memory
of bounded size.  Every byte of every text that isn't white space is labelled.

The network is trained here, in numpy, by backpropagation through time on a
bounded sample, drawn language by language, so that each one with a text is
learned however rare it is: about ``SAMPLE_DOCS`` labelled documents in equal
parts, those of the lowest hashes of id and text, and of their sequences (all
windows of a run) about ``SAMPLE_WORDS`` distinct ones with their counts; of a
language ``LEAST_DOCS`` and ``LEAST_WORDS`` at least, if there are many.
Language and id are used for that alone.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if there is nothing to learn from; ties go to the first
language by name; a null id isn't held out; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import SPACE, WORD, bounded, cut, unused

HIDDEN = 16
WINDOW = 32
SAMPLE_DOCS = 3000
SAMPLE_WORDS = 40_000
#: What a language is given at least, however many there are.
LEAST_DOCS = 100
LEAST_WORDS = 500
STEPS = 700
BATCH = 256
#: Distinct sequences a worker remembers.
MEMORY = 250_000
#: Bytes of text worked on at once.
BLOCK = 1 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# ---------------------------------------------------------------- network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(p: dict, codes: np.ndarray, side: str, tape: list | None = None) -> np.ndarray:
    """Hidden states (length, batch, HIDDEN) of one direction."""
    n, size = codes.shape
    u, h, out = p["u" + side], np.zeros((n, HIDDEN), np.float32), np.empty((size, n, HIDDEN), np.float32)
    for t in range(size) if side == "f" else range(size - 1, -1, -1):
        x, g = p["x" + side][codes[:, t]], h @ u
        zr = _sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        if tape is not None:
            tape.append((t, h, z, r, c, g[:, 2 * HIDDEN:]))
        h = c + z * (h - c)
        out[t] = h
    return out


def _back(p: dict, grad: dict, codes: np.ndarray, side: str, tape: list, dout: np.ndarray) -> None:
    """Backpropagation through time of one direction."""
    u, dh = p["u" + side], 0.0
    for t, h, z, r, c, g in reversed(tape):
        dh = dh + dout[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * g * r * (1 - r)
        dx = np.concatenate([dz, dr, dc], axis=1)
        dg = np.concatenate([dz, dr, dc * r], axis=1)
        np.add.at(grad["x" + side], codes[:, t], dx)
        grad["u" + side] += h.T @ dg
        dh = dh * z + dg @ u.T


def probabilities(p: dict, codes: np.ndarray) -> np.ndarray:
    """(length, batch, languages) for sequences of one length."""
    h = np.concatenate([_run(p, codes, "f"), _run(p, codes, "b")], axis=2)
    e = h @ p["w"] + p["b"]
    e = np.exp(e - e.max(axis=2, keepdims=True))
    return e / e.sum(axis=2, keepdims=True)


def train(words: list[bytes], labels: np.ndarray, weights: np.ndarray, langs: list[str], steps: int = STEPS, seed: int = 7) -> dict:
    """Parameters fitted by Adam; a batch holds sequences of similar length,
    drawn by weight, every language as often."""
    rng, k = np.random.default_rng(seed), len(langs)
    p = {}
    for side in "fb":
        p["x" + side] = rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
        p["u" + side] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32)
    p["w"], p["b"] = rng.normal(0, 0.2, (2 * HIDDEN, k)).astype(np.float32), np.zeros(k, np.float32)
    size = np.array([len(w) for w in words])
    share = weights.astype(float)
    for lang in range(k):
        share[labels == lang] /= max(share[labels == lang].sum(), 1e-9)
    first, second = ({n: np.zeros_like(v) for n, v in p.items()} for _ in range(2))
    groups = [g for g in (np.flatnonzero(size == n) for n in range(1, WINDOW + 1)) if len(g)]
    mass = np.array([(share[g] * size[g]).sum() for g in groups])
    odds = [share[g] / share[g].sum() for g in groups]
    for step in range(1, steps + 1):
        g = rng.choice(len(groups), p=mass / mass.sum())
        pick = rng.choice(groups[g], BATCH, p=odds[g])
        codes = np.frombuffer(b"".join(words[i] for i in pick), np.uint8).reshape(BATCH, -1)
        tapes = {"f": [], "b": []}
        h = np.concatenate([_run(p, codes, s, tapes[s]) for s in "fb"], axis=2)
        e = h @ p["w"] + p["b"]
        e = np.exp(e - e.max(axis=2, keepdims=True))
        d = e / e.sum(axis=2, keepdims=True)
        d[:, np.arange(BATCH), labels[pick]] -= 1
        d /= BATCH * codes.shape[1]
        grad = {n: np.zeros_like(v) for n, v in p.items()}
        grad["w"], grad["b"] = np.einsum("tnh,tnk->hk", h, d), d.sum(axis=(0, 1))
        dh = d @ p["w"].T
        _back(p, grad, codes, "f", tapes["f"], dh[:, :, :HIDDEN])
        _back(p, grad, codes, "b", tapes["b"], dh[:, :, HIDDEN:])
        rate = 0.02 * min(1.0, step / 30) * (1 - step / (steps + 1)) + 1e-4
        for n in p:
            first[n] = 0.9 * first[n] + 0.1 * grad[n]
            second[n] = 0.99 * second[n] + 0.01 * grad[n] ** 2
            p[n] = (p[n] - rate * first[n] / (1 - 0.9 ** step) / (np.sqrt(second[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


# ---------------------------------------------------------------- documents

def sequences(data: bytes) -> list[bytes]:
    """The runs of ``data`` without white space, in windows."""
    found = data.split()
    if found and max(map(len, found)) > WINDOW:
        found = [w[i:i + WINDOW] for w in found for i in range(0, len(w), WINDOW)]
    return found


class Reader:
    """Labels sequences; remembers the sums over the positions of each."""

    def __init__(self, params: dict, k: int) -> None:
        self.p, self.k, self.at, self.sums = params, k, {}, np.zeros((1024, 2 * k + 1))

    def learn(self, words: list[bytes]) -> None:
        if len(self.at) + len(words) > MEMORY:
            self.at = {}
        words.sort(key=len)
        n = len(self.at)
        if n + len(words) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((n + len(words), self.sums.shape[1]))])
        size = np.array([len(w) for w in words])
        for lo in (cuts := [0, *(np.flatnonzero(np.diff(size)) + 1)]):
            hi = next((c for c in cuts if c > lo), len(words))
            for i in range(lo, hi, 8192):
                part = words[i:min(i + 8192, hi)]
                prob = probabilities(self.p, np.frombuffer(b"".join(part), np.uint8).reshape(len(part), -1))
                best = prob.argmax(axis=2)
                rows = self.sums[n + i:n + i + len(part)]
                rows[:, :self.k] = prob.sum(axis=0)
                for c in range(self.k):
                    rows[:, self.k + c] = (best == c).sum(axis=0)
                rows[:, -1] = len(prob)
        self.at.update(zip(words, range(n, n + len(words)), strict=True))

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """For each text the sums of its positions' probabilities and labels, and their number."""
        out, block, used = np.zeros((len(texts), 2 * self.k + 1)), [], 0
        for i, data in enumerate(texts):
            for part in _parts(data):
                block.append((i, part))
                used += len(part)
                if used >= BLOCK:
                    self._add(block, out)
                    block, used = [], 0
        self._add(block, out)
        return out

    def _add(self, block: list[tuple[int, bytes]], out: np.ndarray) -> None:
        if not block:
            return
        found = [sequences(data) for _, data in block]
        new = set().union(*found)
        if len(self.at) + len(new) > MEMORY:
            self.at = {}
        self.learn([w for w in new if w not in self.at])
        at = self.at
        for (i, _), words in zip(block, found, strict=True):
            if words:
                out[i] += self.sums[[at[w] for w in words]].sum(axis=0)


def _parts(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of bounded size, cut at white space where there is any."""
    lo = 0
    while len(data) - lo > BLOCK:
        hi = max(data.rfind(c, lo, lo + BLOCK) for c in (b" ", b"\n"))
        hi = hi if hi > lo else lo + BLOCK
        yield data[lo:hi]
        lo = hi
    yield data[lo:] if lo else data


class Model:
    """A trained network; ``label`` is the function that the tasks run."""

    def __init__(self, params: dict, langs: list[str]) -> None:
        self.params, self.langs = params, langs

    def label(self, frames: Iterable[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(self.params, len(self.langs))
        for texts in frames:
            sums = reader.totals([t.encode() if t and self.langs and _LETTER.search(t) else b"" for t in texts])
            yield pd.DataFrame([self._of(row) for row in sums], columns=["lang_pred", "score", "positions", "label_share"])

    def _of(self, row: np.ndarray) -> tuple:
        k, n = len(self.langs), row[-1]
        if not n:
            return UNKNOWN, 0.0, 0, 0.0
        best = int(row[:k].argmax())
        return self.langs[best], float(min(1.0, row[best] / n)), int(n), float(row[k + best] / n)


def _drawn(rows: DataFrame, total: int, least: int, *by: str) -> DataFrame:
    """About ``total`` of ``rows`` in equal parts for each lang (``least`` at
    least), by a bar on the hashes of ``by``; the lowest hash of a lang is
    always drawn.  Only counts are shuffled."""
    key = F.shiftrightunsigned(F.xxhash64(F.lit(1), *by), 32)
    langs = cut(rows.groupBy(F.col("lang").alias("_l")).agg(F.count("*").alias("_n"), F.min(key).alias("_low")))
    each = max(least, total // max(langs.count(), 1))
    bars = langs.select("_l", F.greatest("_low", (F.least(F.lit(1.0), each / F.col("_n")) * 2**32).cast("long")).alias("_bar"))
    return rows.join(bounded(bars), F.col("lang") == F.col("_l")).where(key <= F.col("_bar")).drop("_l", "_bar")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, steps: int = STEPS) -> Model:
    """The model of a bounded sample of the documents that aren't held out."""
    known = (docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(WORD))
             .select("doc_id", "lang", "text"))
    run = F.col("run")
    window = F.explode(F.sequence(F.lit(1), F.octet_length(run), F.lit(WINDOW)))
    words = cut(_drawn(known, sample_docs, LEAST_DOCS, "doc_id", "text")
                .select("lang", F.explode(F.split("text", SPACE).cast("array<binary>")).alias("run")).where(F.octet_length(run) > 0)
                .select("lang", "run", window.alias("at")).groupBy("lang", F.expr(f"substring(run, at, {WINDOW})").alias("word"))
                .agg(F.count("*").alias("count")))
    rows = _drawn(words, sample_words, LEAST_WORDS, "word", "lang").orderBy(F.xxhash64("word", "lang"), "word", "lang").collect()
    if not rows:
        return Model({}, [])
    langs = sorted({r["lang"] for r in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    words, labels, weights = [bytes(r["word"]) for r in rows], [at[r["lang"]] for r in rows], [r["count"] for r in rows]
    return Model(train(words, np.array(labels), np.array(weights), langs, steps), langs)


def labelled(docs: DataFrame, model: Model, name: str = "_lang") -> DataFrame:
    """``docs`` with a struct column ``name`` (lang_pred, score, positions, label_share)."""
    label = model.label

    @F.pandas_udf("lang_pred string, score double, positions long, label_share double")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from label(frames)

    return docs.withColumn(name, run("text"))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    model = model or fit(docs)
    return (labelled(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_lang.*"))


#: Below this pooled probability a document is in none of the learned languages.
MIN_SCORE = 0.35


def accepted(docs: DataFrame, min_score: float = MIN_SCORE, model: Model | None = None) -> DataFrame:
    """The documents in a learned language, in all their columns."""
    name, = unused(docs, "_lang")
    found = F.col(name)
    return (labelled(docs, model or fit(docs), name)
            .where((found["lang_pred"] != UNKNOWN) & (found["score"] >= min_score)).select(*docs.columns))
