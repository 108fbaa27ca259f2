"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of word hashes. Runs of ``seed`` words shared by a document and an item make
the pair a candidate. On a candidate the tiling repeats: find all matches of unmarked words at least ``least_tile`` long
(by running Karp-Rabin hashes, then word by word), mark the longest ones that don't overlap, until none is left. The share
of the item's words under tiles is its coverage; at ``threshold`` the document is contaminated. Tiles may lie anywhere in
the document, so passages in another order are caught as well.

The benchmark is the query set: it is taken in blocks of at most ``block_words`` words, each broadcast, and each block
meets every document where it lies, whole, without a shuffle. So neither a long document nor a passage that many
documents share gathers rows anywhere, and a benchmark of any size only takes more passes.

Defined cases: null and empty texts match nothing; items with fewer than ``seed`` words can't be told from chance and
match nothing; an item without an id counts like any other and is reported as null; items with equal words are held once
and reported each; repeated documents are judged each; empty tables give no pairs. Case, punctuation and spacing don't
matter. Other columns are not read, so their names don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship
from .text import ngrams, word_hashes

PAIRS = "row long, item long, tiles int, covered int, words int, coverage double"


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping (document place, item place, length), longest first; ties go to the earlier item, then document, place."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    runs_doc, runs_item = ngrams(doc, least), ngrams(item, least)
    places = defaultdict(list)
    for j, h in enumerate(runs_item.tolist()):
        places[h].append(j)
    starts = np.flatnonzero(np.isin(runs_doc, runs_item)).tolist()
    while True:
        matches = []
        for i in starts:
            for j in places[int(runs_doc[i])]:
                # A match that could begin a word earlier is part of the one that does.
                if i and j and free_doc[i - 1] and free_item[j - 1] and doc[i - 1] == item[j - 1]:
                    continue
                n, most = 0, min(len(doc) - i, len(item) - j)
                while n < most and free_doc[i + n] and free_item[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n >= least:
                    matches.append((-n, j, i))
        if not matches:
            return tiles
        matches.sort()
        longest = -matches[0][0]
        for n, j, i in matches:
            # Shorter ones may be parts of what is left of longer ones: they wait for the next round.
            if -n < longest:
                break
            if free_doc[i : i + longest].all() and free_item[j : j + longest].all():
                free_doc[i : i + longest] = free_item[j : j + longest] = False
                tiles.append((i, j, longest))


@dataclass(frozen=True)
class Block:
    """Distinct items with their words, and for each seed the items that hold it."""

    items: list[np.ndarray]
    seeds: np.ndarray  # sorted
    first: np.ndarray  # of each seed in `owner`, one more at the end
    owner: np.ndarray

    @staticmethod
    def of(items: list[np.ndarray], seed: int) -> Block:
        runs = [np.unique(ngrams(words, seed)) for words in items]
        owner = np.repeat(np.arange(len(items)), [len(r) for r in runs])
        flat = np.concatenate(runs) if runs else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        seeds, first = np.unique(flat[order], return_index=True)
        return Block(items, seeds, np.append(first, len(flat)), owner[order])

    def candidates(self, runs: np.ndarray) -> list[int]:
        if not len(self.seeds) or not len(runs):
            return []
        at = np.minimum(np.searchsorted(self.seeds, runs), len(self.seeds) - 1)
        hit = np.unique(at[self.seeds[at] == runs])
        return sorted({int(o) for k in hit for o in self.owner[self.first[k] : self.first[k + 1]]})


@dataclass(frozen=True)
class Tiling:
    seed: int = 5
    least_tile: int = 3
    threshold: float = 0.6
    block_words: int = 1_000_000

    def _blocks(self, benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list[list[int | None]], list[np.ndarray]]]:
        """Item ids and words, a block at a time; the rows come through a local iterator, never all at once."""
        ids: dict[bytes, list[int | None]] = {}
        words: list[np.ndarray] = []
        size = 0
        for row in benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).toLocalIterator():
            found, _, _ = word_hashes(row["text"])
            if len(found) < self.seed:
                continue
            key = found.tobytes()
            if key in ids:
                ids[key].append(row["item"])
                continue
            if words and size + len(found) > self.block_words:
                yield list(ids.values()), words
                ids, words, size = {}, [], 0
            ids[key] = [row["item"]]
            words.append(found)
            size += len(found)
        if words:
            yield list(ids.values()), words

    def pairs(self, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
        """``key``, item, tiles, covered, words, coverage of every pair at or above the threshold."""
        spark: SparkSession = docs.sparkSession
        ship(spark)
        rows = docs.select(F.col(key).cast("long").alias("row"), F.col(text).alias("text")).where(F.col("text").isNotNull())
        out = spark.createDataFrame([], PAIRS)
        for ids, words in self._blocks(benchmark, item, item_text):
            shared = spark.sparkContext.broadcast((ids, Block.of(words, self.seed)))
            out = out.unionByName(rows.select(F.col("row").cast("string"), "text").mapInPandas(self._against(shared), PAIRS))
        return out.withColumnRenamed("row", key).withColumnRenamed("item", item)

    def _against(self, shared):
        seed, least, threshold = self.seed, self.least_tile, self.threshold
        names = [c.split()[0] for c in PAIRS.split(", ")]

        def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, block = shared.value
            for batch in batches:
                found = []
                for row, text in zip(batch["row"], batch["text"]):
                    words, _, _ = word_hashes(text)
                    for k in block.candidates(ngrams(words, seed)):
                        tiles = tile(words, block.items[k], least)
                        covered, size = sum(n for _, _, n in tiles), len(block.items[k])
                        if covered >= threshold * size:
                            row_id = None if pd.isna(row) else int(row)
                            found += [(row_id, i, len(tiles), covered, size, covered / size) for i in ids[k]]
                yield pd.DataFrame(found, columns=names).astype({"row": "Int64", "item": "Int64"})

        return tiled


def contaminated(docs: DataFrame, benchmark: DataFrame, tiling: Tiling, text: str = "text") -> DataFrame:
    """``docs`` with a column ``contaminated``; its rows stay where they are, whatever their ids."""
    ship(docs.sparkSession)
    out, flags = docs, []
    for n, (_, words) in enumerate(tiling._blocks(benchmark, "item_id", "text")):
        shared = docs.sparkSession.sparkContext.broadcast(Block.of(words, tiling.seed))
        out = out.withColumn(f"contaminated_{n}_", _flag(shared, tiling)(F.col(text)))
        flags.append(F.col(f"contaminated_{n}_"))
    verdict = F.array_max(F.array(*flags)) if flags else F.lit(False)
    return out.withColumn("contaminated", verdict).drop(*(f"contaminated_{n}_" for n in range(len(flags))))


def _flag(shared, tiling: Tiling):
    @F.pandas_udf("boolean")
    def flagged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = shared.value

        def hit(text: str | None) -> bool:
            words, _, _ = word_hashes(text)
            return any(
                sum(n for _, _, n in tile(words, block.items[k], tiling.least_tile)) >= tiling.threshold * len(block.items[k])
                for k in block.candidates(ngrams(words, tiling.seed)))

        for b in batches:
            yield pd.Series([hit(t) for t in b], dtype=bool)

    return flagged
