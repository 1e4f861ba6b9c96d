import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trialfold.llm import common, variants

SCHEMA = "doc_id long, text string, word int, n string"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, least=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                n[w] += 1
    n = {w: k for w, k in n.items() if k >= least}
    by_key = {}
    for w in n:  # words that are near share a word with one letter out, or one replaced by a mark
        for i in range(len(w)):
            by_key.setdefault(w[:i] + w[i + 1:], set()).add(w)
        by_key.setdefault(w, set()).add(w)
    out = {}
    for w in n:
        around = {x for i in range(len(w)) for x in by_key.get(w[:i] + w[i + 1:], ())} | by_key.get(w, set())
        around = sorted((x for x in around if near(w, x)), key=lambda x: (-n[x], x))
        form = around[0] if around and n[around[0]] >= 2 * n[w] else None
        out[w] = (n[w], len(around), form)
    rows = set()
    for w, (k, m, form) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, k, m, form, n[form] if form else None, root))
    return rows


def found(df):
    return [(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()]


def same(spark, rows, **more):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], SCHEMA)
    got = found(variants.variants(df, **more))
    assert len(got) == len(set(got))
    assert set(got) == plain_variants(rows)
    return got


def test_documents_match_plain(spark, sf_dir):
    df = common.table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = found(variants.variants(df))
    assert set(got) == plain_variants(rows) and len(got) == len(set(got))
    # any sample gives the same rows, whatever trees it makes
    assert set(found(variants.variants(df, sample=50))) == set(got)


def test_odd_rows(spark):
    long = "b" * 70_000
    rows = [(1, None), (2, ""), (None, "Grün GRÜN grün Straße strasse"), (3, "Straße straße straße strasse strasse strasse"), (3, "straße straße"),
            (4, f"{long} {long} {long}"), (5, f"{long}b {long}b {long}b"), (6, "naïve naïve naïve naive naive naive " * 3), (7, "ÀÀÀÀÀ " * 5 + "ààààà " * 5),
            (8, "listen listen listen silent silent silent enlist enlist enlist"), (9, "12345 !!! ab abc abcd")]
    got = same(spark, rows)
    by_word = {r[0]: r for r in got}
    assert by_word["silent"][2] == 0  # equal letters in another order aren't near
    assert by_word[long][2] == 1
    assert by_word["naïve"][3] is None and by_word["naive"][2] == 1


def test_chains_of_forms(spark):
    words, n = ["aaaaaaaa"], [2000]
    for i in range(8):
        words.append(words[-1][:i] + "b" + words[-1][i + 1:])
        n.append(n[-1] // 2)
    rows = [(i, f"{w} " * k) for i, (w, k) in enumerate(zip(words, n, strict=True))]
    got = same(spark, rows)
    assert sum(r[5] == words[0] or r[3] is not None for r in got) >= len(words) - 1


def test_common_word_and_empty(spark):
    rows = [(i, "frequent word frequent " + ("frequents " if i % 3 == 0 else "")) for i in range(300)]
    same(spark, rows)
    assert same(spark, []) == []


WORDS = st.lists(st.text("abcé", min_size=5, max_size=9), min_size=1, max_size=60, unique=True)


@given(WORDS, st.integers(1, 8))
@settings(max_examples=60, deadline=None)
def test_search_by_trees_is_search_of_all_pairs(words, leaf):
    """Cells and trees, without Spark: every pair once."""
    trees = {}
    for length in {len(w) for w in words}:
        mine = sorted(w for w in words if len(w) == length)
        counts = variants.letter_counts([w.encode("latin-1") for w in mine])
        numbers = iter(range(1000))
        trees[length] = variants.grow(counts, np.arange(len(mine)), leaf, lambda _, numbers=numbers: next(numbers))
    import pandas as pd
    frame = pd.DataFrame({"word": sorted(words), "n": range(1, len(words) + 1)})
    dealt = pd.concat(variants.dealt(trees)([frame])).sort_values(["length", "cell", "guest", "word"])
    assert (dealt["guest"] == 0).sum() == len(words)
    n = Counter()
    for b in variants.searched([dealt.iloc[i:i + 7] for i in range(0, len(dealt), 7)]):
        for w, k in zip(b["word"], b["n_near"], strict=True):
            n[w] += k
    for w in words:
        assert n[w] == sum(near(w, x) for x in words), w


def test_boxes_are_pruned():
    rng = np.random.default_rng(0)
    words = sorted({bytes(rng.choice(list(b"abcdefghijkl"), 8)) for _ in range(4000)})
    counts = variants.letter_counts(words)
    tree = variants.grow(counts, np.arange(len(words)), 16, lambda rows: rows)
    visited = sum(len(leaf) * len(at) for leaf, at in variants.reached(tree, counts[:50], 1, 1))
    assert visited < 0.25 * 50 * len(words)
    home = sum(len(at) for _, at in variants.reached(tree, counts, 0, 0))
    assert home == len(words)


@pytest.mark.parametrize("a, b, ok", [("abcde", "abcdef", True), ("abcde", "xabcde", True), ("abcde", "abxcde", True), ("abcde", "abxcdf", False), ("aaaaa", "aaaaaa", True)])
def test_one_inserted(a, b, ok):
    rows = [np.frombuffer(w.encode(), np.uint8)[None] for w in (a, b)]
    assert bool(variants.one_inserted(*rows)[0]) is ok
