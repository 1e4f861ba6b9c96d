"""Toxicity by a weighted finite-state pattern grammar (operator 13).

A text's words become symbols: insult, threatening verb, target (whom it is
said to), negation, reporting verb, other.  Five small transducers rewrite the
symbols of a clause one after the other:

* ``negation`` marks insults and threats up to three words after a negation,
* ``reported`` marks those after a reporting verb or inside quotation marks,
* ``target`` marks insults up to three words after a target, or before one,
* ``threat`` keeps threatening verbs only where a target follows,
* ``events`` gives the marked symbols their names.

They are composed into one deterministic transducer (``compose``), which runs
over the clauses that hold an insult or a threatening verb; every event it
emits has a weight, and an insult's own weight multiplies it.  A document's
score is the logistic function of a bias, the clauses that match by event
(their weights summed, in logarithms) and the strongest clause.

Weights are learned.  Insults are a short general list, and words that stand in
toxic training documents far more often than in others, in many different
surroundings (so that copies of one document teach nothing).  Event weights
come from logistic regression, drawn towards ``PRIOR`` where the training rows
say nothing.  Fitted on at most ``SAMPLE_DOCS`` labelled documents of each label
(drawn by a bar on hashes); all documents are scored, whole.

Defined results: null and empty texts have no clause and score by the bias; a
null id is not held out and teaches nothing; of several labels of one id the
largest counts; rows that repeat are scored alike; without training rows the
prior scores; an empty table gives an empty result.  Names of other columns
don't matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import bounded, cut, unused

#: Every 4th row by this remainder is held out.
FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 8000
TOXIC_FROM = 0.3

# Word lists of the grammar: small letters, general vocabulary of the languages.
INSULTS = """
    idiot idiots moron morons loser losers scum scumbag stupid dumb worthless pathetic disgusting trash garbage clown
    imbecile fool dumbass asshole bastard bitch jerk creep vermin filth retard pig coward liar freak
    dummkopf trottel arschloch abschaum schwachkopf versager dreckskerl
    crétin connard salaud ordure abruti minable imbécile
    estúpido idiota imbécil basura escoria inútil gilipollas cabrón""".split()
THREATS = """
    kill hurt destroy beat murder shoot stab strangle crush punish hang burn
    töten umbringen schlagen vernichten
    tuer frapper détruire
    matar golpear destruir""".split()
TARGETS = """
    you your yours yourself u ya he she they him her them his their people everyone these those
    du dich dir ihr euch sie tu te toi vous ils elles tú te usted ustedes ellos ellas""".split()
NEGATIONS = "not no never nobody neither nor isn't aren't wasn't don't didn't doesn't won't nicht kein keine keiner nie pas jamais aucun nunca jamás ningún".split()
REPORTS = """
    said says say called calls wrote writes quoted quotes claimed claims alleged reported according accused
    sagte schrieb nannte dit écrit appelé dijo escribió llamó""".split()

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»„]")
_CLAUSE = re.compile(r"[^.!?;:\r\n]+")

# ---------------------------------------------------------------- transducers

#: (state, symbol) -> (next state, symbol given out); what isn't listed passes unchanged and keeps the state.
Step = Callable[[int, str], tuple[int, str]]
SYMBOLS = ("insult", "threat", "target", "negation", "report", "quote", "other")
SPAN = 3


def negation(state: int, symbol: str) -> tuple[int, str]:
    """State: words that a negation still reaches."""
    if symbol == "negation":
        return SPAN, "other"
    if state and symbol in ("insult", "threat"):
        return state - 1, f"negated {symbol}"
    return max(state - 1, 0), symbol


def reported(state: int, symbol: str) -> tuple[int, str]:
    """State 1: after a reporting verb; 2: inside quotation marks."""
    if symbol == "report":
        return max(state, 1), "other"
    if symbol == "quote":
        return (0 if state == 2 else 2), "other"
    if state and symbol in ("insult", "threat"):
        return state, f"reported {symbol}"
    return state, symbol


def target(state: int, symbol: str) -> tuple[int, str]:
    """State: words that a target still reaches, and words in which a target
    would still belong to the insult before."""
    ahead, back = divmod(state, SPAN + 1)
    if symbol == "target":
        return SPAN * (SPAN + 1), "aimed before" if back else "target"
    left = max(ahead - 1, 0) * (SPAN + 1)
    if symbol == "insult":
        return left + SPAN, "aimed insult" if ahead else "insult"
    return left + max(back - 1, 0), symbol


def threat(state: int, symbol: str) -> tuple[int, str]:
    """A threatening verb is one only where a target follows: the state counts the words in which it may."""
    if symbol == "threat":
        return SPAN, "other"
    if state and symbol in ("target", "aimed before"):
        return 0, "threat"
    return max(state - 1, 0), symbol


EVENTS = ("insult", "aimed insult", "aimed before", "threat", "negated insult", "reported insult", "negated threat", "reported threat")
#: Weight of an event where nothing is learned, then of the strongest clause, then the bias.
PRIOR = np.array([2.0, 3.0, 0.5, 2.5, 0.0, 0.3, 0.0, 0.2, 1.0, -3.0])


def events(state: int, symbol: str) -> tuple[int, str]:
    return 0, symbol if symbol in EVENTS else ""


GRAMMAR: tuple[Step, ...] = (negation, reported, target, threat, events)


def compose(steps: tuple[Step, ...] = GRAMMAR, symbols: tuple[str, ...] = SYMBOLS) -> tuple[list[list[int]], list[list[int]]]:
    """One transducer for all: tables next[state][symbol] and event[state][symbol]
    (-1: none) over the states that can be reached from the start."""
    start = (0,) * len(steps)
    number, todo, moves, gives = {start: 0}, [start], [], []
    for state in todo:
        row, out = [], []
        for symbol in symbols:
            to, given = [], symbol
            for step, s in zip(steps, state, strict=True):
                s, given = step(s, given)
                to.append(s)
            to = tuple(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
            out.append(EVENTS.index(given) if given else -1)
        moves.append(row)
        gives.append(out)
    return moves, gives


class Grammar:
    """The composed transducer with a lexicon of insults and their weights."""

    def __init__(self, insults: dict[str, float]):
        self.moves, self.gives = compose()
        self.insults = insults
        lists = (("other", ()), ("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS), ("insult", insults), ("quote", "\"“”«»„"))
        self.symbol = {w: SYMBOLS.index(kind) for kind, words in lists for w in words}
        self.telling = {w for w, s in self.symbol.items() if SYMBOLS[s] in ("insult", "threat")}

    def clause(self, words: list[str]) -> list[float]:
        """Summed weight by event of a clause."""
        state, sums, other = 0, [0.0] * len(EVENTS), SYMBOLS.index("other")
        own = 1.0  # the weight of the insult that "aimed before" speaks of
        for w in words:
            s = self.symbol.get(w, other)
            event = self.gives[state][s]
            state = self.moves[state][s]
            own = self.insults.get(w, own)
            if event >= 0:
                sums[event] += own if "insult" in EVENTS[event] or EVENTS[event] == "aimed before" else 1.0
        return sums

    def features(self, text: str | None) -> list[float]:
        """log(1 + matched weight) by event, and the strongest clause's weight."""
        low = (text or "").lower()
        if self.telling.isdisjoint(_WORD.findall(low)):
            return [0.0] * (len(EVENTS) + 1)
        sums, strongest = [0.0] * len(EVENTS), 0.0
        for m in _CLAUSE.finditer(low):
            words = _WORD.findall(m[0])
            if self.telling.isdisjoint(words):
                continue
            found = self.clause(words)
            sums = [a + b for a, b in zip(sums, found, strict=True)]
            strongest = max(strongest, sum(found[:4]))
        return [math.log1p(s) for s in sums] + [math.log1p(strongest)]


# ---------------------------------------------------------------- training

def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold, about
    ``sample`` of each label at most."""
    known = (labels.where(_fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)"))
    known = cut(known.withColumn("h", F.xxhash64(F.lit(13), "doc_id")))
    n = dict(known.groupBy("toxic").count().collect())  # two rows
    bar = F.lit(1.0)
    for label, count in n.items():
        bar = F.when(F.col("toxic") == label, min(1.0, sample / count)).otherwise(bar)
    drawn = cut(known.where(F.shiftrightunsigned("h", 11) < bar * float(1 << 53)).select(F.col("doc_id").alias("_id"), "toxic"))
    return docs.join(bounded(drawn), docs["doc_id"] == F.col("_id")).select(F.coalesce(docs["text"], F.lit("")).alias("text"), "toxic").distinct()


#: A learned insult: so many surroundings in toxic documents, and so sure (standard errors) that it is so many times as frequent there.
CONTEXTS, SURE, TIMES, LEXICON, CANDIDATES = 8, 3.0, 4.0, 500, 2000


def _odds(a: int, b: int, toxic: int, clean: int) -> tuple[float, float]:
    """Log of how many times as frequent, and its standard error."""
    return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)), math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Insults and their weights: the general list, and what the training rows teach."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+(?:['’]\p{L}+)*"), F.lit(0))
    sizes = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {w: 1.0 for w in INSULTS}
    n = [F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b")]
    grammar = [*THREATS, *TARGETS, *NEGATIONS, *REPORTS]
    counts = (rows.select("toxic", F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(*n)
              .where((F.col("a") >= CONTEXTS) & (F.length("word").between(3, 40)) & ~F.col("word").isin(grammar)
                     & ((F.col("a") + 0.5) * (clean + 1) >= TIMES * (F.col("b") + 0.5) * (toxic + 1))))
    candidates = [r["word"] for r in counts.orderBy(F.desc("a"), "word").limit(CANDIDATES).collect()]
    if not candidates:
        return {w: 1.0 for w in INSULTS}
    # a word with the hash of its neighbours; only candidates leave the row
    placed = F.transform("w", lambda w, i: F.struct(w.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("around")))
    at = rows.select("toxic", words.alias("w")).select("toxic", F.explode(F.filter(placed, lambda p: p["word"].isin(candidates))).alias("p"))
    seen = at.select("p.word", "toxic", "p.around").distinct()
    learned = {}
    for r in seen.groupBy("word").agg(*n).collect():  # CANDIDATES rows at most
        odds, error = _odds(r["a"], r["b"], toxic, clean)
        if r["a"] >= CONTEXTS and odds - SURE * error >= math.log(TIMES):
            learned[r["word"]] = odds
    best = sorted(learned, key=lambda w: (-learned[w], w))[:LEXICON]
    return {w: 1.0 for w in INSULTS} | {w: min(learned[w], 6.0) / 3.0 for w in best}


def regression(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, strength: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards ``prior``."""
    x = np.column_stack([x, np.ones(len(x))])
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[dict[str, float], list[float]]:
    """(insults with weights, weights of the features and the bias)."""
    rows = cut(training_rows(docs, labels, sample))
    insults = lexicon(rows)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(insults)
        for b in batches:
            yield pd.DataFrame({"x": [grammar.features(t) for t in b["text"]], "toxic": b["toxic"]})

    # one narrow row for each distinct vector
    found = rows.mapInPandas(featured, "x array<double>, toxic int").groupBy("x", "toxic").count().orderBy("x", "toxic").collect()
    if not found:
        return insults, PRIOR.tolist()
    times = [r["count"] for r in found]
    x = np.repeat(np.array([r["x"] for r in found]), times, axis=0)
    y = np.repeat(np.array([float(r["toxic"]) for r in found]), times)
    return insults, regression(x, y).tolist()


def score(docs: DataFrame, model: tuple[dict[str, float], list[float]]) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    insults, weights = model

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(insults)
        for t in texts:
            sums = [sum(f * w for f, w in zip([*grammar.features(x), 1.0], weights, strict=True)) for x in t]
            yield pd.Series([1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in sums], dtype="float64")

    name, = unused(docs, "_score")
    out = docs.select("doc_id", scored("text").alias(name))
    return out.select("doc_id", F.coalesce(_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
                      F.col(name).alias("score"), (F.col(name) >= TOXIC_FROM).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Scores of all documents by a grammar fitted on the labelled ones."""
    return score(docs, fit(docs, labels, sample))
