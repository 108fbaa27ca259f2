"""Best-fit packing of token sequences after a Martello-Toth reduction.

Documents are tokenised where they lie and cut into pieces of at most ``capacity`` tokens. Packing needs nothing but how
many pieces there are of each length, a table of at most ``capacity`` rows however many documents there are: the plan is
made from those counts, many equal sequences in one step. Reduction first fixes sets that dominate every other set with
their longest piece (see `reduce`); what is left goes, longest first, to the fullest sequence that holds it. The plan is
a list of intervals "the a-th to b-th piece of length n go to sequences s, s + 1, .. at offset o"; a piece finds its
interval by its rank among the pieces of its length, which is a prefix sum over the partitions' counts.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives no rows;
only documents longer than ``capacity`` are cut. Only ``key`` and ``text`` are read, so no other column's name matters.
"""

from __future__ import annotations

import array
import functools
import itertools
import os
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize, ship

PIECES = "row long, piece int, start long, length long, ids_crc32 long, block int, nth long, ids binary"
#: Encoded words kept by a worker (twice as many at most), longer words are not kept; characters encoded at a time.
CACHE_WORDS, CACHE_CHARS, SLICE = 500_000, 64, 1 << 20
#: Rows of three numbers that are sent to all tasks at most, some 40 bytes each there.
MOST_BROADCAST = 2_000_000


class WordEncoder:
    """The tokenizer's ids of a text as little-endian unsigned 32-bit numbers.

    For byte-level tokenizers that lower the case, drop white space between words and part letters, digits and signs, so
    that the ids of a text are those of its words, and the ids of a word those of its parts, in a row; both are looked up
    among those met before. Texts are parted at spaces and line feeds only, which are white space to all. A part of Latin
    letters has nothing to normalise or split: the tokenizer's model alone encodes it. What isn't plain goes through the
    whole tokenizer: signs, and words with apostrophes, other scripts or the brackets of special tokens.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.known
        unseen = set(itertools.chain.from_iterable(words)).difference(known)
        again = self.older.keys() & unseen
        known.update(zip(again, map(self.older.__getitem__, again)))
        parted, parts = {}, set()
        for w in unseen.difference(again):
            found = _parted(w)
            parts.update(found)
            if len(found) > 1 or found[0] != w:
                parted[w] = found
        self._learn(parts.difference(known))
        get = known.__getitem__
        for w, found in parted.items():
            known[w] = get(found[0]) if len(found) == 1 else b"".join(map(get, found))
        out = [b"".join(map(get, ws)) for ws in words]
        for w in {x for x in itertools.chain(parted, parts) if len(x) > CACHE_CHARS}:
            del known[w]
        if len(known) > CACHE_WORDS:
            # Words met again come back from the older half, the rest is forgotten.
            self.known, self.older = {}, known
        return out

    def _learn(self, parts: set[str]) -> None:
        other, known, tokenize = [], self.known, self.tokenizer.model.tokenize
        for p in parts:
            if p.isascii():
                plain = p.isalpha() and p.islower()
            else:
                plain = p.isalpha() and p == p.lower() and _latin(p)
            if plain:
                known[p] = _bytes([t.id for t in tokenize(p if p.isascii() else _byte_letters(p))])
            else:
                other.append(p)
        for p, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False)):
            known[p] = _bytes(e.ids)


def _latin(word: str) -> bool:
    """Are all letters such that lower-casing and normalising take one for one? (Not so the dotted capital I.)"""
    return word.isascii() or (max(word) <= "\u024f" and "\u0130" not in word)


def _byte_letters(word: str) -> str:
    """The word's bytes as a byte-level tokenizer writes them: printable Latin-1 as itself, the rest from U+0100 on."""
    return word.encode().decode("latin-1").translate(_byte_table())


@functools.cache
def _byte_table() -> dict[int, int]:
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(printable)))}


def _bytes(ids: list[int]) -> bytes:
    numbers = array.array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


@functools.cache
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a worker process, with the words it has learnt."""
    return WordEncoder(path)


_PARTS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")


def _parted(word: str) -> list[str]:
    """What the tokenizer encodes apart, in lower case where that is plain."""
    if word.isascii():
        if word.isalpha():
            return [word.lower()]
        return [word] if "'" in word or "<|" in word else _PARTS.findall(word.lower()) or [word]
    core = word.rstrip(".,")
    if core.isalpha() and _latin(core):
        return [core.lower()] if len(core) == len(word) else [core.lower(), word[len(core):]]
    return [word]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """The written table of pieces; ``nth`` counts those of its length in its ``block`` (the partition that made it)."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, seen, block = _encoder(tokenizer), Counter(), TaskContext.get().partitionId()
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, texts = batch["row"].tolist(), [t or "" for t in batch["text"]]
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= SLICE):
                    size += len(texts[stop])
                    stop += 1
                found = []
                for row, ids in zip(rows[at:stop], encoder.encode(texts[at:stop])):
                    ids += last
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[begin : begin + 4 * capacity]
                        n = len(part) // 4
                        found.append((None if pd.isna(row) else int(row), piece, begin // 4, n, zlib.crc32(part), block, seen[n], part if keep_ids else None))
                        seen[n] += 1
                yield pd.DataFrame(found, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"row": "Int64"})
                at = stop

    rows = docs.select(F.col(key).cast("string").alias("row"), F.col(text).alias("text")).mapInPandas(cut, PIECES)
    return materialize(rows if keep_ids else rows.drop("ids"), "pieces")


@dataclass(frozen=True)
class Plan:
    """Intervals, sorted by length and rank: pieces of ``length`` from rank ``first`` on go to ``sequence`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted((self.length << 48) + self.first, (length << 48) + rank, side="right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def _dominating(counts: np.ndarray, length: int, capacity: int) -> list[int] | None:
    """The partners that dominate all others for one piece of ``length``, if that can be proved; [] is none at all.

    Any packing can be changed, without another sequence, into one that has these together: whatever stands beside the
    piece is no longer than what it is exchanged for, part by part or as a whole.
    """
    room = capacity - length
    left = counts[: room + 1].copy()
    if length <= room:
        left[length] -= 1
    present = np.flatnonzero(left)
    if not len(present):
        return []  # nothing fits beside it
    best = int(present[-1])
    if best == room:
        return [best]  # fills it up: all that could stand here fits where `best` was
    small = [int(x) for x in np.repeat(present[:3], np.minimum(left[present[:3]], 3))[:3]]
    if len(small) < 2 or small[0] + small[1] > room:
        return [best]  # only one fits, none longer than this
    if len(small) == 3 and sum(small) <= room:
        return None
    # Two at most fit: the pair with the largest sum.
    partner = np.searchsorted(present, room - present, side="right") - 1
    alone = (partner >= 0) & (present[np.maximum(partner, 0)] == present) & (left[present] < 2)
    partner = np.where(alone, partner - 1, partner)
    sums = np.where(partner >= 0, present + present[np.maximum(partner, 0)], 0)
    if best >= sums.max():
        return [best]  # as long as any pair: the pair fits where it was
    k = int(partner[-1])
    if k >= 0:
        second = int(present[k])
        longer = [int(x) for x in np.repeat(present[k + 1 : k + 3], np.minimum(left[present[k + 1 : k + 3]], 2))[:2]]
        if len(longer) < 2 or sum(longer) > room:
            return [best, second]  # no pair has both longer than `second`: exchange part by part
    return None


def reduce(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Martello and Toth's reduction: take dominating sets out of ``counts``; (lengths, how many such sequences).

    Removing pieces keeps each proof valid while the set's own lengths last, so it is applied as often as they do.
    """
    fixed = []
    changed = True
    while changed:
        changed = False
        for length in range(capacity, 0, -1):
            while counts[length]:
                partners = _dominating(counts, length, capacity)
                if partners is None:
                    break
                need = Counter([length, *partners])
                times = min(int(counts[n]) // m for n, m in need.items())
                if not partners and length <= capacity - length:
                    times = 1
                for n, m in need.items():
                    counts[n] -= m * times
                fixed.append(([length, *partners], times))
                changed = True
    return fixed


def plan(counts: dict[int, int], capacity: int = 4096) -> Plan:
    """The reduction, then best fit, longest first."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used, placed, sequences = Counter(), [], 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        placed.append((length, used[length], sequence, offset))
        used[length] += n

    for lengths, n in reduce(left, capacity):
        offset = 0
        for length in lengths:
            place(length, n, sequences, offset)
            offset += length
        sequences += n

    open_: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, how many)
    rooms = np.zeros(capacity + 1, np.int64)

    def opened(room: int, sequence: int, n: int) -> None:
        if room and n:
            open_.setdefault(room, []).append((sequence, n))
            rooms[room] += n

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                sequence, there = open_[room].pop()
                k = min(n, there)
                rooms[room] -= there
                place(length, k, sequence, capacity - room)
                opened(room, sequence + k, there - k)
                opened(room - length, sequence, k)
                n -= k
                continue
            each = capacity // length
            full, rest = divmod(n, each)
            for sequence, many, times in ((sequences, full, each), (sequences + full, 1, rest)):
                for k in range(times if many else 0):
                    place(length, many, sequence, k * length)
                if times:
                    opened(capacity - times * length, sequence, many)
            sequences += full + bool(rest)
            n = 0
    table = np.array(sorted(placed), np.int64).reshape(-1, 4)
    return Plan(*table.T, sequences)


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of `pieces`."""
    spark = cut.sparkSession
    ship(spark)
    counts = cut.groupBy("block", "length").agg((F.max("nth") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    shared = spark.sparkContext.broadcast(plan(by_length, capacity))
    # A row for each length in each partition. Counted and few, they go to the pieces, whose ids then stay where they are.
    base = materialize(base, "pieces-base")
    ranked = cut.join(F.broadcast(base) if base.count() <= MOST_BROADCAST else base, ["block", "length"])
    place = F.struct("length", (F.col("base") + F.col("nth")).alias("rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = shared.value.find(b["length"].to_numpy(np.int64), b["rank"].to_numpy(np.int64))
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    names = [c for c in cut.columns if c not in ("block", "nth")]
    return ranked.withColumn("at", found(place)).select(*names, "at.sequence_id", "at.offset")
