"""Personal data by patterns and a semi-Markov random field (operator 2).

Base spans come from four patterns with a check each.  The field adds spans the
patterns lose, such as a phone number that runs into the card number behind it:
it scores whole candidate segments by features of the span (digits, groups,
separators, checksums, what stands around), and a dynamic program over segments
of at most ``MAX_ATOMS`` atoms chooses boundaries and kinds jointly.

It also finds forms that the patterns leave out: phones without a plus (with
parentheses, a leading 0 or 00, or three, three and four digits), cards with dots
or mixed separators, and addresses with a blank beside the ``@``.

A segment is a candidate for a kind if it can be valid: a card passes Luhn, an ip
has four parts of at most 255, a phone has 7 to 15 digits and one of the heads
above.  Candidates are found by sums over all digits of an island (words around
digits or an ``@``), so long tables of numbers cost little.  What no candidate
covers scores as ordinary text, so the program runs over each cluster of
overlapping candidates, and its result is that over the whole text.  Weights are
fitted here by the conditional likelihood (forward and backward sums over all
segmentations) on generated islands of all four kinds, hard negatives, and a
bounded sample of islands of the corpus labelled by the base patterns (those that
hold one of the further forms teach nothing).

Limits of the field (base spans have none): an entity has at most ``MAX_ATOMS``
atoms (runs of digits or letters, and single other characters), a card at
most five groups, a phone six; entities don't run over a line end or two blanks.  Seven digits
without a head, such as 555-1234, and bare runs of 9 to 12 digits are left alone.

Defined results: a null text is empty; spans count code points, ends are
exclusive; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
#: Corpus islands that training takes at most.
SAMPLE_ISLANDS = 300
#: Posterior probability from which a segment of the field counts.
SURE = 0.9

# Fixed patterns of the base spans.  Equal to the plain forms, but linear in
# the text: a digit run that fails as a whole isn't tried again from inside.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    pos, at = 0, text.find("@")
    while at >= 0:
        start = pos + len(text[pos:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        # the local part never reaches back over an @ or into the last match
        pos, at = (m.end() if m else at + 1), text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _SIGNAL.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    found += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


# ---------------------------------------------------------------- segments

def islands(text: str) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring words with a digit or an ``@``, as spans; an ``@``
    between blanks has the words beside it."""
    start = end = -1
    for m in re.finditer(r"[0-9@]\S*", text):
        a, z = m.span()
        head = text[max(end, 0):a]
        if head and not head[-1].isspace():
            a -= len(head.rsplit(None, 1)[-1])
        if text[a] == "@" and text[a - 1:a] == " " and (name := text[max(end, 0):a - 1]) and not name[-1].isspace():
            a -= 1 + len(name.rsplit(None, 1)[-1])
        if text[z - 1] == "@" and (host := re.compile(r" \S+").match(text, z)):
            z = host.end()
        if start >= 0 and a <= end + 1:
            end = max(end, z)
            continue
        if start >= 0:
            yield start, end
        start, end = a, z
    if start >= 0:
        yield start, end


#: Names of the span features, for the order of the weights.
FEATURES = ("bias", "d<7", "d7-8", "d9-12", "d13-15", "d16-19", "luhn", "plus", "paren", "odd paren", "dot", "dash", "space",
            "octets", "four parts", "groups>5", "mail", "mail dotted", "mail letters", "mail spaced", "left word", "right word",
            "left joined", "right joined", "long group", "two separators", "short head", "zero", "two zeros", "3-3-4", "mixed", "one group", "short group", "left number", "right number")
_AT = {name: i for i, name in enumerate(FEATURES)}
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9.-]*[A-Za-z0-9]")
#: An island without one of these has no candidate: an @, a head of a phone, 3-3-4 digits, 13 digits, four parts.
_LIKELY = re.compile(r"@|\+[0-9]|\([0-9]|(?<![0-9])0[0-9](?:[ .()-]{0,2}[0-9]){5}|[0-9]{3}[. -][0-9]{3}[. -][0-9]{4}|[0-9](?:[ .-]?[0-9]){12}|[0-9](?:\.[0-9]+){3}")
_NINES = str.maketrans("123456789", "000000000")


def _around(left: str, right: str) -> list[str]:
    """Features of the two characters on either side."""
    far, left, right, after = left[:-1], left[-1:], right[:1], right[1:]
    return (["left number"] * (left in " .-" and far.isdigit()) + ["right number"] * (right in " .-" and after.isdigit()) + ["left word"] * (left.isalnum() or left == "_") + ["right word"] * (right.isalnum() or right == "_")
            + ["left joined"] * (left in "@.-+(/=:") * bool(left) + ["right joined"] * (right in "@-+/=:(" or right == "." and after.isalnum()) * bool(right))


@lru_cache(maxsize=50_000)
def _number_features(shape: str, heads: str, is_luhn: bool, octets: bool, left: str, right: str) -> tuple[int, ...]:
    """Indices of the features of a span of digits (each shown as 0) and separators; ``heads``: its first digits."""
    groups = re.findall("0+", shape)
    n = sum(map(len, groups))
    separators = set(re.findall("[. -]", shape))
    on = ["bias", "d<7" if n < 7 else "d7-8" if n < 9 else "d9-12" if n < 13 else "d13-15" if n < 16 else "d16-19"]
    on += ["luhn"] * is_luhn + ["plus"] * (shape[0] == "+") + ["paren"] * ("(" in shape) + ["odd paren"] * (shape.count("(") != shape.count(")"))
    on += ["dot"] * ("." in shape) + ["dash"] * ("-" in shape) + ["space"] * (" " in shape) + ["groups>5"] * (len(groups) > 5) + ["octets"] * octets
    on += ["four parts"] * (len(groups) == 4) + ["long group"] * (max(map(len, groups)) > 12) + ["two separators"] * bool(re.search(r"[.-]{2}| {2}", shape))
    on += ["short head"] * (len(groups[0]) < 4) + ["zero"] * (heads[:1] == "0") + ["two zeros"] * (heads == "00")
    on += ["3-3-4"] * ([len(g) for g in groups] == [3, 3, 4]) + ["mixed"] * (len(separators) > 1) + ["one group"] * (len(groups) == 1)
    on += ["short group"] * (min(map(len, groups[1:]), default=9) < 2)
    return tuple(_AT[x] for x in on + _around(left, right))


def _mail_features(s: str, left: str, right: str) -> tuple[int, ...]:
    name, _, host = s.partition("@")
    on = ["bias", "mail"] + ["mail dotted"] * bool(re.fullmatch(_DOMAIN, host.strip())) + ["mail letters"] * host[-1:].isalpha() + ["odd paren"] * (not name)
    return tuple(_AT[x] for x in on + ["mail spaced"] * (" " in s) + _around(left, right))


def _numbers(text: str, at: list[int], heads: list[str]) -> Iterator[tuple[int, int, list[int], bool, bool]]:
    """(first, end, kinds, luhn, octets) of the segments of atoms that can be an ip, a card or a phone."""
    n = len(heads)
    length = np.diff(np.array(at))
    first = np.array([ord(c) for c in heads])
    digit = (first >= 48) & (first <= 57)
    fits = digit | (np.isin(first, [ord(c) for c in "+(). -"]) & (length == 1))
    word = np.array([c.isalnum() or c == "_" for c in heads])
    before, behind = np.append(False, word[:-1]), np.append(word[1:], False)
    plus, paren = first == ord("+"), first == ord("(")
    zero = digit & (first == 48) & (length >= 2)
    opens, closes = plus | paren | (digit & ~before), digit & ~behind
    digits = np.append(0, np.cumsum(length * digit))
    groups, bad = np.append(0, np.cumsum(digit)), np.append(0, np.cumsum(~fits))
    d = np.array([ord(c) - 48 for a, b, c in zip(at, at[1:], heads, strict=False) if "0" <= c <= "9" for c in text[a:b]], np.int64)
    padded = np.append(d, [0, 0, 0])
    twice = np.where(d > 4, 2 * d - 9, 2 * d)
    even = np.arange(len(d)) % 2 == 0
    sums = [np.append(0, np.cumsum(np.where(even == (parity == 0), twice, d))) for parity in (0, 1)]
    for k in range(1, min(MAX_ATOMS, n) + 1):
        i = np.flatnonzero(opens[:n - k + 1] & closes[k - 1:])
        j = i + k
        count = digits[j] - digits[i]
        keep = (bad[j] == bad[i]) & (count >= 4) & (count <= 19)
        i, j, count = i[keep], j[keep], count[keep]
        lo, hi = digits[i], digits[j]
        luhn_sum = np.where(hi % 2 == 0, sums[0][hi] - sums[0][lo], sums[1][hi] - sums[1][lo])
        valid = (count >= 13) & (luhn_sum % 10 == 0)
        card = valid & digit[i] & (groups[j] - groups[i] <= 5)
        some = plus[i] | paren[i] | zero[i] & ((padded[lo + 1] > 0) | (padded[lo + 2] > 0))
        if k == 5:
            some |= (length[i] == 3) & (length[i + 2] == 3) & (length[i + 4] == 4) & digit[i] & digit[i + 2]
        phone = some & (count >= 7) & (count <= 15) & (groups[j] - groups[i] <= 6)
        octets = np.zeros(len(i), bool)
        if k == 7:
            dots = digit[i]
            for x in (1, 3, 5):
                dots = dots & (first[i + x] == ord(".")) & digit[i + x + 1]
            for y in np.flatnonzero(dots):
                octets[y] = _octets(text[at[i[y]]:at[j[y]]])
        for y in np.flatnonzero(card | phone | octets):
            kinds = [1] * bool(octets[y]) + [2] * bool(card[y]) + [3] * bool(phone[y])
            yield int(i[y]), int(j[y]), kinds, bool(valid[y]), bool(octets[y])


def _addresses(text: str, at: list[int], heads: list[str], x: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the segments that can be an address around the ``@`` at
    atom ``x``: the whole name and its last word, up to the whole host."""
    def reach(i: int, step: int, more: str) -> int:
        """The last atom from ``i`` on that belongs to a name or host."""
        last = x
        for _ in range(MAX_ATOMS // 2):
            if not (0 <= i < len(heads) and (heads[i].isalnum() or heads[i] in more)):
                break
            last = i if heads[i].isalnum() or step < 0 else last
            i += step
        return last

    left = x - 1 - (x > 0 and text[at[x - 1]:at[x]] == " ")
    right = x + 1 + (x + 1 < len(heads) and text[at[x + 1]:at[x + 2]] == " ")
    end = reach(right, 1, ".-") + 1
    if end > right:
        for i in {reach(left, -1, "._%+-"), left}:
            if i < x and end - i <= MAX_ATOMS and _MAIL.fullmatch(text, at[i], at[end]):
                yield i, end


def candidates(text: str, lo: int, hi: int) -> tuple[int, list[tuple[int, int, int, tuple[int, ...]]], list[int]]:
    """(number of atoms, segments (first, end, kind, features), offsets) of an island."""
    if not _LIKELY.search(text, lo, hi):
        return 0, [], []
    at = [lo, *(m.end() for m in _ATOM.finditer(text, lo, hi))]
    heads = [text[a] for a in at[:-1]]

    def around(i: int, j: int) -> tuple[str, str]:
        return text[max(0, at[i] - 2):at[i]], text[at[j]:at[j] + 2]

    out = []
    for i, j, kinds, is_luhn, octets in _numbers(text, at, heads):
        s = text[at[i]:at[j]]
        on = _number_features(s.translate(_NINES), re.search("[0-9]{1,2}", s)[0], is_luhn, octets, *around(i, j))
        out += [(i, j, k, on) for k in kinds]
    for x, c in enumerate(heads):
        if c == "@":
            out += [(i, j, 0, _mail_features(text[at[i]:at[j]], *around(i, j))) for i, j in _addresses(text, at, heads, x)]
    return len(heads), out, at


def clusters(segments: list) -> Iterator[tuple[int, int, list]]:
    """(first atom, atoms, segments counted from it) of the runs of overlapping segments."""
    run, start, end = [], 0, 0
    for i, j, k, on in sorted(segments, key=lambda s: s[0]):
        if run and i >= end:
            yield start, end - start, run
            run = []
        if not run:
            start = end = i
        run.append((i - start, j - start, k, on))
        end = max(end, j)
    if run:
        yield start, end - start, run


def _sums(n: int, segments: list, score: list[float]) -> tuple[list[float], list[float]]:
    """Forward and backward log sums over all segmentations into ``n`` atoms."""
    ahead, ends, starts = [0.0] + [-math.inf] * n, [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    for x, (i, j, _, _) in zip(score, segments, strict=True):
        ends[j].append((i, x))
        starts[i].append((j, x))

    def log_sum(terms: list[float]) -> float:
        if len(terms) == 1:
            return terms[0]
        top = max(terms)
        return top + math.log(sum(math.exp(t - top) for t in terms))

    for j in range(1, n + 1):
        ahead[j] = log_sum([ahead[j - 1], *(ahead[i] + x for i, x in ends[j])])
    behind = [-math.inf] * n + [0.0]
    for i in range(n - 1, -1, -1):
        behind[i] = log_sum([behind[i + 1], *(behind[j] + x for j, x in starts[i])])
    return ahead, behind


def _scores(weights: np.ndarray, segments: list) -> list[float]:
    w, known = weights.tolist(), {}
    for _, _, k, on in segments:
        if (k, on) not in known:
            known[k, on] = sum(w[k][f] for f in on)
    return [known[k, on] for _, _, k, on in segments]


#: A segment's posterior is at most the logistic of its score: below LEAST none is sure.  Below NONE it weighs nothing beside others.
LEAST, NONE = math.log(SURE / (1 - SURE)), -12.0


def best(weights: np.ndarray, text: str, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """The best segmentation's spans (kind, start, end) that are sure enough."""
    _, every, at = candidates(text, lo, hi)
    score = _scores(weights, every)
    if max(score, default=NONE) < LEAST:
        return []
    kept = [(i, j, k, x) for (i, j, k, _), x in zip(every, score, strict=True) if x >= NONE]
    return [(k, at[first + i], at[first + j]) for first, n, segments in clusters(kept) if any(x >= LEAST for *_, x in segments)
            for i, j, k in _chosen(n, segments, [x for *_, x in segments])]


def _chosen(n: int, segments: list, score: list[float]) -> Iterator[tuple[int, int, int]]:
    ends = [[] for _ in range(n + 1)]
    for s, (_, j, _, _) in enumerate(segments):
        ends[j].append(s)
    top, back = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        top[j] = top[j - 1]
        for s in ends[j]:
            if (x := top[segments[s][0]] + score[s]) > top[j]:
                top[j], back[j] = x, s
    chosen, j = [], n
    while j:
        if back[j] >= 0:
            chosen.append(back[j])
            j = segments[back[j]][0]
        else:
            j -= 1
    if not chosen:
        return
    ahead, behind = _sums(n, segments, score)
    for s in reversed(chosen):
        i, j, k, _ = segments[s]
        if ahead[i] + score[s] + behind[j] - ahead[n] > math.log(SURE):
            yield i, j, k


# ---------------------------------------------------------------- training

#: Forms that the base patterns leave out: islands of the corpus with one of them have no label.
_FURTHER = re.compile(r"(?<![0-9])(?:\([0-9]{2,5}\)|0[0-9])[0-9 .-]{4,}|[0-9]{3}[. -][0-9]{3}[. -][0-9]{4}|[0-9]{4}\.[0-9]{4}\.|\s@|@\s")


def _generated(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """An island of entities and look-alikes with its true spans."""
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghilmnorst") for _ in range(rng.randint(2, 8)))

    count = lambda n: rng.choice("123456789") + num(n - 1)
    year = lambda: rng.choice(["19", "20"]) + num(2)

    def card(valid: bool) -> str:
        while luhn(d := rng.choice("3456") + num(rng.choice([13, 14, 15, 15, 15]))) != valid:
            pass
        four = [d[i:i + 4] for i in range(0, len(d), 4)]
        if rng.random() < 0.2:
            return "".join(x + rng.choice(". -") for x in four[:-1]) + four[-1]
        return rng.choice(["", "", " ", "-", "."]).join(four)

    def phone() -> str:
        a, b, c, e = num(rng.randint(1, 2)), num(3), num(3), num(4)
        if rng.random() < 0.65:  # national forms
            area, lead, land = rng.choice("23456789") + num(2), "0" + rng.choice("123456789") + num(rng.randint(0, 2)), rng.choice("123456789") + num(rng.randint(0, 1))
            return rng.choice([f"({area}) {c}-{e}", f"({area}) {c} {e}", f"{area}-{c}-{e}", f"{area} {c} {e}", f"{area}.{c}.{e}", f"{lead} {num(4)} {num(4)}", f"{lead} {num(6)}",
                               f"{lead} {num(3)} {num(3)}", f"{lead}-{num(7)}", f"00{land} {num(2)} {num(6)}", f"00{land} {b} {c} {e}", f"00{land} {num(2)} {num(4)} {num(4)}", f"00{land} {num(3)} {num(7)}", f"00{land} {num(2)} {num(3)} {num(4)}", f"00{land} {num(1)} {num(4)} {num(4)}", f"({lead}) {num(6)}", f"0{num(1)} {num(2)} {num(2)} {num(2)} {num(2)}"])
        return rng.choice([f"+{a} ({b}) {c}-{e}", f"+{a} {b} {c} {e}", f"+{a}-{b}-{c}-{e}", f"+{a}{b}{c}{e}", f"+{a} {b} {c}{e}", f"+{a} ({b}) {c} {e}"])

    def entity() -> tuple[int, str]:
        kind = rng.randrange(4)
        return kind, [lambda: f"{word()}{rng.choice(['', '.', '_', '-'])}{rng.choice([word(), num(2)])}@{word()}{rng.choice(['', num(1)])}.{rng.choice(['com', 'org', 'example.com', 'co.uk'])}".replace("@", rng.choice(["@", "@", "@", " @ ", "@ ", " @"])),
                      lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: card(True), phone][kind]()

    def other() -> str:
        return rng.choice([
            lambda: card(False), lambda: count(rng.randint(1, 12)), lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 99)}", lambda: num(rng.randint(20, 26)),
            lambda: f"{year()}-{num(2)}-{num(2)}", lambda: f"{num(2)}.{num(2)}.{year()}", lambda: f"{count(3)}-{num(4)}", lambda: f"({num(2)}) {num(4)}",
            lambda: f"({year()}) {num(3)}", lambda: f"00{num(1)} 00{num(1)} 00{num(1)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"0.{num(8)}", lambda: f"00{num(6)}",
            lambda: f"{count(4)} {num(3)} {num(4)} {num(3)}", lambda: f"{count(3)}-{num(3)}-{num(3)}-{num(3)}", lambda: f"{num(2)}-0{num(1)}-{year()}", lambda: f"{word()} @ {word()}",
            lambda: "0" + num(rng.randint(8, 12)), lambda: f"{num(2)} {num(2)} {num(2)} {num(2)} {num(2)} {num(2)} {num(2)}",
            lambda: f"{rng.randint(256, 999)}.{num(2)}.{num(2)}.{num(1)}", lambda: f"{num(1)}.{num(1)}.{num(2)}.{num(1)}.{num(1)}", lambda: f"{word()}{num(3)}{word()}{num(2)}", lambda: f"@{word()}", lambda: f"{word()}@{word()}",
            lambda: f"{word()}={num(6)}", lambda: f"+{num(2)}", lambda: f"{num(1)},{num(3)},{num(3)}", lambda: f"+{num(17)}"])()

    text, spans = "", []
    for _ in range(rng.randint(1, 4)):
        text += rng.choice([" ", " ", " ", ", ", " (", ": "]) if text else ""
        if rng.random() < 0.6:
            kind, s = entity()
            spans.append((kind, len(text), len(text) + len(s)))
        else:
            s = other()
        text += s
    return text + rng.choice(["", "", ".", ",", " ", ";"]), spans


def fit(samples: list[str], generated: int = 1500, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Weights (kind, feature) by stochastic ascent of the conditional log
    likelihood; ``samples`` are islands labelled by the base patterns."""
    rng, data = random.Random(seed), []
    for text, spans in [*(_generated(rng) for _ in range(generated)), *((s, base_spans(s)) for s in samples if not _FURTHER.search(s))]:
        _, every, at = candidates(text, 0, len(text))
        place = {x: i for i, x in enumerate(at)}
        gold = {(place.get(a), place.get(b), k) for k, a, b in spans}
        for first, n, segments in clusters(every):
            data.append((n, segments, [s for s, (i, j, k, _) in enumerate(segments) if (i + first, j + first, k) in gold]))
    w, seen = np.zeros((len(KINDS), len(FEATURES))), np.full((len(KINDS), len(FEATURES)), 1e-2)
    for _ in range(rounds):
        rng.shuffle(data)
        for n, segments, gold in data:
            if not segments:
                continue
            score = _scores(w, segments)
            ahead, behind = _sums(n, segments, score)
            grad = -0.0001 * w
            for x, (i, j, k, on) in zip(score, segments, strict=True):
                grad[k, list(on)] -= math.exp(min(0.0, ahead[i] + x + behind[j] - ahead[n]))
            for s in gold:
                grad[segments[s][2], list(segments[s][3])] += 1
            seen += grad * grad
            w += grad / np.sqrt(seen)
    return w


# ---------------------------------------------------------------- documents

def spans_of(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) of a whole text, by kind, then start.  A span
    of the field counts where no base span of its kind overlaps it."""
    base = base_spans(text)
    if not _SIGNAL.search(text):
        return base, base
    more = [s for lo, hi in islands(text) for s in best(weights, text, lo, hi)]
    starts, ends = [[[s[x] for s in base if s[0] == k] for k in range(len(KINDS))] for x in (1, 2)]
    add = []
    for k, a, b in more:
        i = bisect_right(ends[k], a)
        if i >= len(ends[k]) or starts[k][i] >= b:
            add.append((k, a, b))
    return base, sorted(base + add)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def sample(docs: DataFrame, text: Column, most: int = SAMPLE_ISLANDS) -> list[str]:
    """At most ``most`` islands of the corpus of at most 200 characters, drawn
    by hash.  The bar that ``most`` documents stay below is found on hashes
    alone, so that only their texts leave the scan."""
    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[t[a:b] for a, b in islands(t) if b - a <= 200][:3] for t in texts])

    drawn = docs.where(text.rlike("[0-9@]")).select(F.xxhash64("doc_id", text).alias("draw"), text.alias("t"))
    bar = drawn.select("draw").orderBy("draw").limit(most).agg(F.max("draw")).first()[0]
    some = drawn.where(F.col("draw") <= bar).select("t").limit(most)
    rows = some.select(F.explode(found("t")).alias("s")).distinct().orderBy(F.xxhash64("s")).limit(most).collect()
    return sorted(r["s"] for r in rows)


def find(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row."""
    w = fit(sample(docs, F.col("text"))) if weights is None else weights

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, every = spans_of(t or "", w)
            n = [sum(k == x for x, _, _ in base) for k in range(len(KINDS))]
            rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
