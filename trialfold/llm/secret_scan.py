"""Secrets by patterns and sliding-window entropy (operator 6).

Base spans come from three patterns.  The method adds spans: a candidate is a
run of token characters of ``WINDOW`` or more; its character class (hex, upper
case with digits, mixed) sets the entropy that a window must reach, and the
windows' Shannon entropies come from counts that each step changes by the
character that enters and the one that leaves.  Neighbouring windows above the
bar are one span.  A span of fewer than three digits counts where its windows don't
read like words (by the share of common letter pairs).

The allow list suppresses what is random by design but no secret, in the run
itself and no further: runs that are a UUID; of a run that a digest's name
stands before, the first ``DIGEST`` characters; placeholders and alphabets with
``WINDOW`` characters on both sides; rules of four or more equal signs, which
part a run; host and path of a web address, unless a word in it names a hook or
a credential (queries, fragments and what stands before an ``@`` are searched).
An address counts from its scheme on, however long it is.
Also not found: windows below their class's entropy, runs without a letter, and
keys of fewer than three digits whose letters happen to pair like words.

Defined results: a null text is empty; spans count code points, ends are
exclusive; an added span that overlaps a base span is left out; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: (class, its characters, bits that a window must reach)
CLASSES = (("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.1), ("upper", re.compile(r"[A-Z0-9]+"), 3.5), ("mixed", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8))

# Fixed patterns of the base spans.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: Harmless: whole candidates, places in one (with a margin, without), and what may stand before one.
_UUID = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_PLACEHOLDER = re.compile(r"(?i)example|x{6,}|0{8,}|abcdefgh|12345678|qwertyui")
_RULE = re.compile(r"-{4,}|_{4,}|={4,}")
_NAMED = re.compile(r"(?i)(sha-?[0-9]+|md5|etag|digest|checksum|commit|integrity)$")
_ADDRESS = re.compile(r"(?i)https?://([^\s\"'<>`{}|\\^]*)")
#: What makes the path of an address worth a search.
_HOOK = re.compile(r"(?i)hook|token|secret|api_?key|signature|/services/|/bot[0-9]")
#: Characters of the longest digest (SHA-512 in hex).
DIGEST = 128
#: Letter pairs that are frequent in words of European languages, and their least share in a window that reads like words.
_PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be "
    "ma si om ur ei ie ge un sc au ss ht da di eb ab el em us ai qu ui ue eu la ns os do ad ia ca ta pa po so ci na no ac ec mo lo pe pr tr pl "
    "am ol ut ul et il ot tu su ct im mi ni ag ig id iv ke ly ow wh wa ho fo fi ex ap op up ir um ep br cr gr bl cl fr sp sh ck ee oo ay ry my "
    "ty by ga go gi pi sa ru lu vi va bo bi ba du mp nc rt rs rd rm ld ts if ev av ov we wo ey ys fe fa ig ef im ob od ok og".split())
LIKE_WORDS = 0.45
_MARK, _AT, _SLASH = re.compile("[?#@]"), re.compile("@"), re.compile("/")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


_N_LOG = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def windows(s: str, bar: float, size: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of ``s`` covered by windows whose entropy reaches ``bar`` bits;
    overlapping ones are merged.  Counts change by two characters a step:
    entropy = log2(size) - sum(n * log2(n)) / size."""
    counts, load, out = {}, 0.0, []
    most = (math.log2(size) - bar) * size + 1e-9
    for i, c in enumerate(s):
        if i >= size:
            n = counts[s[i - size]]
            counts[s[i - size]] = n - 1
            load += _N_LOG[n - 1] - _N_LOG[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        load += _N_LOG[n + 1] - _N_LOG[n]
        if i >= size - 1 and load <= most:
            a = i - size + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def unlike_words(s: str, a: int, b: int) -> list[tuple[int, int]]:
    """The parts of ``s[a:b]`` that are covered by windows whose letter pairs aren't those of words."""
    pairs, hits, out = [0], [0], []
    for x, y in zip(s[a:b], s[a + 1:b], strict=False):
        letters = x.isalpha() and y.isalpha()
        pairs.append(pairs[-1] + letters)
        hits.append(hits[-1] + (letters and (x + y).lower() in _PAIRS))
    for i in range(b - a - WINDOW + 1):
        j = i + WINDOW - 1
        if hits[j] - hits[i] < LIKE_WORDS * (pairs[j] - pairs[i]):
            if out and a + i <= out[-1][1]:
                out[-1] = (out[-1][0], a + j + 1)
            else:
                out.append((a + i, a + j + 1))
    return out


class Address(NamedTuple):
    """A web address: where its host begins and it ends, and the first places of
    ``?``, ``#`` or ``@``, of ``@``, of a slash, and the end of a hook's name in it (or FAR)."""

    body: int
    end: int
    mark: int
    user: int
    slash: int
    hook: int


FAR = 1 << 62


def addresses(text: str) -> list[Address]:
    """The web addresses of a text, each read once."""
    def first(pattern: re.Pattern, m: re.Match, end: bool = False) -> int:
        found = pattern.search(text, *m.span(1))
        return FAR if not found else found.end() if end else found.start()

    return [Address(*m.span(1), first(_MARK, m), first(_AT, m), first(_SLASH, m), first(_HOOK, m, True)) for m in _ADDRESS.finditer(text)] if "://" in text else []


def harmless(address: Address, lo: int, hi: int) -> bool:
    """Whether ``[lo, hi)`` is of the host or path, and no hook's name stands before its end."""
    if address.mark < lo or address.hook <= hi:
        return False
    # without a slash so far it may be what stands before an @
    return address.slash < hi or not hi <= address.user < address.slash


def named(text: str, lo: int) -> bool:
    """Whether a digest's name, an equals sign or the like, and blanks stand before ``lo``."""
    def blanks(k: int) -> int:
        while k and text[k - 1].isspace():
            k -= 1
        return k

    def quote(k: int) -> int:
        return k - (k > 0 and text[k - 1] in "\"'")

    k = blanks(quote(lo))
    if not k or text[k - 1] not in ":=/-":
        return False
    k = quote(blanks(k - 1))
    return _NAMED.search(text[max(0, k - 16):k]) is not None


def searched(text: str, lo: int, hi: int, address: Address | None = None) -> list[tuple[int, int]]:
    """The parts of the run ``text[lo:hi]`` that the allow list leaves; ``address`` is the one that it stands in."""
    s = text[lo:hi]
    if _UUID.fullmatch(s) or address and harmless(address, lo, hi):
        return []
    gaps = [(lo, lo + DIGEST)] if named(text, lo) else []
    gaps += [(lo + m.start() - WINDOW, lo + m.end() + WINDOW) for m in _PLACEHOLDER.finditer(s)]
    gaps += [(lo + m.start(), lo + m.end()) for m in _RULE.finditer(s)]
    out = []
    for a, b in sorted(gaps):
        if a - lo >= WINDOW:
            out.append((lo, a))
        lo = max(lo, b)
    return [*out, (lo, hi)] if hi - lo >= WINDOW else out


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """The searched parts of all candidates, in order."""
    known, at = addresses(text), 0
    for m in _CANDIDATE.finditer(text):
        lo, hi = m.span()
        while at < len(known) and known[at].end < lo:
            at += 1
        inside = at < len(known) and known[at].body <= lo
        yield from searched(text, lo, hi, known[at] if inside else None)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out, ends, top = [], [], -1
    for _, _, y in base:
        top = max(top, y)
        ends.append(top)
    starts = [x for x, _, _ in base]
    for lo, hi in _runs(text):
        s = text[lo:hi]
        if not re.search("[A-Za-z]", s):
            continue
        bar = next(bits for _, chars, bits in CLASSES if chars.fullmatch(s))
        for x, y in windows(s, bar):
            for a, b in [(x, y)] if sum(map(str.isdigit, s[x:y])) >= 3 else unlike_words(s, x, y):
                a, b = a + lo, b + lo
                before = bisect.bisect_left(starts, b)  # base spans that start before the window's end
                if not before or ends[before - 1] <= a:
                    out.append((a, 3, b))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256 and spans of each row."""
    names = ["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base = base_spans(t or "")
            more = added_spans(t or "", base)
            n = [sum(k == x for _, x, _ in base) for k in range(3)]
            rows.append((*n, len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + more))))
        return pd.DataFrame(rows, columns=names)

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
