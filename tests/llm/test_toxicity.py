import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trialfold.llm import common, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, held_out int"
LABELS = "doc_id long, quality int, toxic int"
PLAIN = {w: 1.0 for w in toxicity.INSULTS}


def events(clause):
    return {e: s for e, s in zip(toxicity.EVENTS, toxicity.Grammar(PLAIN).clause(toxicity._WORD.findall(clause.lower())), strict=True) if s}


@pytest.mark.parametrize("clause, found", [
    ("what an idiot", {"insult": 1}),
    ("you are an idiot", {"aimed insult": 1}),
    ("an idiot like you", {"insult": 1, "aimed before": 1}),
    ("you are not an idiot", {"negated insult": 1}),
    ("they said that it was stupid", {"reported insult": 1}),
    ('the word "idiot" is old', {"reported insult": 1}),
    ("I will kill you", {"threat": 1}),
    ("I will not hurt you", {"negated threat": 1}),
    ("they kill time", {}),
    ("the weather is fine", {}),
    ("you you you", {}),
    ("you are stupid worthless scum", {"aimed insult": 2, "insult": 1}),
    ("du bist ein Dummkopf", {"aimed insult": 1}),
])
def test_clauses(clause, found):
    assert events(clause) == found


@given(st.lists(st.sampled_from(toxicity.SYMBOLS), max_size=30))
@settings(max_examples=300, deadline=None)
def test_composed_transducer_is_its_parts_in_a_row(symbols):
    moves, gives = toxicity.compose()
    state, out = 0, []
    for s in symbols:
        i = toxicity.SYMBOLS.index(s)
        event = gives[state][i]
        out.append(toxicity.EVENTS[event] if event >= 0 else "")
        state = moves[state][i]
    line = list(symbols)
    for step in toxicity.GRAMMAR:  # one transducer over the whole clause after the other
        at, given_out = 0, []
        for s in line:
            at, o = step(at, s)
            given_out.append(o)
        line = given_out
    assert out == line
    assert len(moves) < 2000


def test_weights_of_clauses():
    """Direct speech scores above negated and reported speech, which score like clean text."""
    w = toxicity.PRIOR

    def score(text):
        return float(np.dot([*toxicity.Grammar(PLAIN).features(text), 1.0], w))

    assert score("You are a pathetic loser. I will kill you.") > score("You are a loser.") > score("What a loser.") > score("You are not a loser.")
    assert score("You are not a loser.") == score("The house is blue.") == score("") == score(None)
    assert score("They said loser.") < score("What a loser.")


def test_regression_finds_weights():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(4 * x[:, 0] - 2 * x[:, 1] - 1)))).astype(float)
    w = toxicity.regression(x, y, np.zeros(3), 1e-3)
    assert np.abs(w - [4, -2, -1]).max() < 0.4


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    rows = toxicity.toxicity(docs, labels).collect()
    label = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    out = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    toxic = [r["predicted"] for r in out if label[r["doc_id"]]]
    clean = [r["predicted"] for r in out if not label[r["doc_id"]]]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.6 * len(toxic)  # about a tenth of the labels have no sign in the text


def test_insults_are_learned_from_other_surroundings_only(spark):
    """A new insult in many surroundings is learned; a rare word of one copied toxic document isn't."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(5))
    rows, labels = [], []
    copied = " ".join([word() for _ in range(20)] + ["blorptz"] + [word() for _ in range(20)])
    for i in range(600):
        bad = i % 6 == 0
        text = " ".join(word() for _ in range(30))
        if bad:
            text += " zounder " + word()
        if i % 30 == 0:
            text = copied + f" {word()} zounder {word()}"
        rows.append((i, text, "en", "a", 0, "", 0))
        labels.append((i, 1, int(bad)))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    insults, weights = toxicity.fit(docs, known)
    assert "zounder" in insults and "blorptz" not in insults
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, (insults, weights)).collect()}
    assert found == {i: t for i, _, t in labels}


def test_odd_rows(spark):
    long = "word " * 60_000 + "you idiot. " * 2000
    rows = [(1, None, None, None, None, "", 0), (2, "", "en", "a", 0, "", 0), (3, " \n", "de", None, 3, "", 0), (None, "You are an idiot", "en", "b", 13, "", 0),
            (5, "fine", "en", "b", 4, "", 0), (5, "fine", "en", "b", 4, "", 0), (6, long, "en", "b", len(long), "", 0), (7, "x" * 150_000, None, None, 1, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (5, 1, 1), (None, 1, 1), (6, None, None), (99, 1, 1)], LABELS)
    for known in (labels, labels.limit(0)):
        got = toxicity.toxicity(docs, known).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        by_id = {r["doc_id"]: r for r in got}
        assert by_id[None]["held_out"] is False
        assert by_id[1]["score"] == by_id[2]["score"] == by_id[3]["score"] < by_id[6]["score"]
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
