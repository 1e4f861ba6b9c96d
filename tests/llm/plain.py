"""Plain Python forms of the operators, for comparison on small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mix_targets(sizes):
    """source -> target by resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1.0, 2.0, 3.0)[i % 3] for i, s in enumerate(order)}
    cap, total, fixed = {s: 3.0 * n for s, n in sizes.items()}, sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > cap[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: cap[s] for s in over}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii_spans(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, lo, hi in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if lo <= len(d) <= hi and (kind == "phone" or luhn(d)):
                out.append((kind, m.start(), m.end()))
    return out


def secret_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def simhash(t):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_components(prints):
    """id -> smallest id reachable over links of 3 bits or fewer, from (id, fingerprint) rows."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(prints))]


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact_groups(rows):
    """(id, keep, size) of (id, text) rows."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[normal(t)].append(d)
    keep = {t: min((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    return Counter((d, keep[normal(t)], len(groups[normal(t)])) for d, t in rows)


def token_pieces(tokenizer, text, length=2048):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    first = len(ids) % length or length
    cuts = [0, *range(first, len(ids), length), len(ids)]
    out = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        out.append((i, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))))
    return out


def warc_rows(pages):
    digest = {p: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for p, h in pages}
    first = {}
    for p, h in sorted(pages):
        first.setdefault(h or "", p)
    return {(p, len((h or "").encode()), digest[p], "response" if first[h or ""] == p else "revisit", None if first[h or ""] == p else first[h or ""]) for p, h in pages}


def winnow(hashes, gram=4, window=8):
    """Kept (hash, position) from word hashes, with a deque-free scan of every window."""
    mask = 2**64 - 1
    rot = lambda x, n: ((x << n) | (x >> (64 - n))) & mask if n else x
    runs = [hashes[i:i + gram] for i in range(max(1, len(hashes) - gram + 1))] if hashes else []
    grams = []
    for r in runs:
        x = 0
        for h in r:
            x = rot(x, 1) ^ h
        grams.append(x >> 24)
    kept = []
    for i in range(max(1, len(grams) - window + 1)) if grams else []:
        part = grams[i:i + window]
        low = min(part)
        at = i + max(j for j, g in enumerate(part) if g == low)
        if (low, at) not in kept[-1:]:
            kept.append((low, at))
    return kept


def edited(t, following):
    half = len(t) // 2
    return t[:len(t) - half] + following[:half]


UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"


def units(t):
    """Words, code by code where a script has no spaces or a run is long."""
    words = re.findall(rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+", t)
    return [u for w in words for u in (w if len(w) > 64 else [w])]


def warc_parse(data):
    """(headers, block) of each record of raw bytes, by the lengths alone."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        assert version == "WARC/1.0"
        head = dict(line.split(": ", 1) for line in lines)
        n = int(head["Content-Length"])
        block = data[end + 4:end + 4 + n]
        assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
        out.append((head, block))
        at = end + 8 + n
    return out
