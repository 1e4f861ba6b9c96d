"""Best-fit packing of token sequences (operator 5).

Each document becomes its token ids and a closing id; a longer one than a
sequence is cut into pieces of full length, the first being shorter.  Pieces
are dealt to tasks by hash, and each task packs its stream online: ``OPEN``
bins may be open at most, found by a bitset keyed by free space (the lowest set
bit from a piece's length on is the best fit).  A full bin closes at once; when
there is no room for a further bin, the fullest closes first.

Tokens are the tokenizer file's.  Byte-level BPE works on each piece of its
pre-tokenizer pattern alone, so a worker remembers the ids of pieces it has
seen (a memory of bounded size) and encodes new ones only, by the merge ranks.

Defined results: null and empty texts are the closing id alone; rows that
repeat are packed each; sequence ids are distinct, not gapless; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import cut

LENGTH = 2048
OPEN = 2048
END = 0
#: The tokenizer file and its vocabulary as merge ranks.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Pieces a worker remembers.
MEMORY = 500_000
#: Pieces that one task packs, about.
TASK_PIECES = 20_000
# The tokenizer file's pre-tokenizer pattern and its special token (fixed values).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit bytes.

    ``path`` is the vocabulary as merge ranks (the ids), one base64 token and
    its rank a line: the same vocabulary, and so the same ids, as the
    tokenizer file's, which the tests compare."""

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ids = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memory: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, SPECIAL)) + ")").split

    def encode(self, text: str) -> bytes:
        out = []
        for part in self.split(text):
            if part in SPECIAL:
                out.append(SPECIAL[part].to_bytes(4, "little"))
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        memory, ids, out = self.memory, self.ids, []
        for piece in self.find(text):
            data = memory.get(piece)
            if data is None:
                data = array("I", ids(piece)).tobytes()
                if len(memory) < MEMORY and len(piece) < 64:  # the frequent ones come early and stay
                    memory[piece] = data
            out.append(data)
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file (kept between batches and tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece."""
    tail = end.to_bytes(4, "little")

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def run(texts: pd.Series) -> pd.Series:
        encode, out = encoder(tokenizer).encode, []
        for t in texts:
            data = (encode(t) if t else b"") + tail
            n = len(data) // 4
            cuts = [0, *range(n % length or length, n, length), n]
            out.append([(i, a, b - a, zlib.crc32(data[4 * a:4 * b])) for i, (a, b) in enumerate(itertools.pairwise(cuts))])
        return pd.Series(out)

    return docs.select("doc_id", F.explode(run("text")).alias("p")).select("doc_id", "p.*")


class Bins:
    """Open bins in a bitset keyed by free space."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most, self.bits, self.open, self.count, self.next = length, most, 0, {}, 0, 0

    def place(self, need: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fit = self.bits >> need << need
        if fit:
            free = (fit & -fit).bit_length() - 1
            home = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, home = self.length, self.next
            self.next += 1
        left = free - need
        if left:
            self.open.setdefault(left, []).append(home)
            self.bits |= 1 << left
            self.count += 1
        return home, self.length - free

    def _take(self, free: int) -> int:
        bins = self.open[free]
        home = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.count -= 1
        return home


def _pack(length: int, most: int, frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bins = None
    for rows in frames:
        if not len(rows):
            continue
        out = []
        for part, need in zip(rows["_part"], rows["length"], strict=True):
            if bins is None or bins[0] != part:
                bins = (part, Bins(length, most))
            home, offset = bins[1].place(need)
            out.append((part * 2**32 + home, offset))
        rows["sequence_id"], rows["offset"] = zip(*out, strict=True)
        yield rows.drop(columns=["_part"])


def pack(pieces: DataFrame, length: int = LENGTH, most: int = OPEN, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` (cut, of at most ``length``) with sequence_id and offset."""
    parts = -(-pieces.count() // task_pieces) or 1
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    schema = schema.replace("doc_id long", f"doc_id {pieces.schema['doc_id'].dataType.simpleString()}")
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    return (pieces.withColumn("_part", F.pmod(order, F.lit(parts)).cast("long"))
            .repartition("_part").sortWithinPartitions("_part", order, "doc_id", "piece", "ids_crc32")
            .mapInPandas(lambda frames: _pack(length, most, frames), schema))


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    return pack(cut(pieces(docs, tokenizer, length)), length, most)
