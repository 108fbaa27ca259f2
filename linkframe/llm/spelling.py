"""Spelling variants by reduced-alphabet generation: words that are one edit apart, found among reduced words.

Letters are hashed to ``symbols`` symbols, which makes of each word a reduced word. Words one edit apart have reduced words
at most one edit apart, so the full one-edit neighbourhood over the small alphabet is generated for every reduced word
(about 2 * symbols rows a letter, not 2 * 60 as over all letters) and joined with the reduced vocabulary. What meets is
told by the original strings: a pair counts if its edit distance is one.

Reduced words and their neighbours go by a 64-bit polynomial hash, in which each edit is one sum; a chance match is one
more pair to tell. Neighbourhoods are symmetric, so a pair of reduced words is joined from its smaller hash only.

A word's form is its near word of largest count, if that is at least ``ratio`` times its own; counts at least double along
forms, so the way to the root has at most log2(largest count) steps and is walked in doubling jumps.

Defined cases: null and empty texts have no words; a null key is written as an empty one in the misspelling hash;
repeated rows count each; ties of count go to the smallest word in code-point order; words of any length are handled;
an empty table gives no rows. Only ``key`` and ``text`` are read, so no other column's name matters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import id_text, lower_ascii
from .storage import materialize, ship
from .text import U, mix

BASE = U(0x9E3779B97F4A7C15)
UNBASE = U(pow(int(BASE), -1, 1 << 64))
RUNS = "[A-Za-zÀ-ÿ]+"
#: Numbers held at once while neighbourhoods are generated.
HELD = 1 << 21


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Words of one length as rows of symbols 1 .. ``symbols``."""
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    return (mix(letters * BASE) % U(symbols) + U(1)).reshape(len(words), -1)


def reduced_hash(rows: np.ndarray) -> np.ndarray:
    return (rows * _powers(rows.shape[1])).sum(1, dtype=U)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, BASE, U), dtype=U)


def neighbourhood(rows: np.ndarray, symbols: int) -> np.ndarray:
    """The hashes of each reduced word and of all that one edit makes of it, in rows, repeats among them."""
    count, length = rows.shape
    powers, every = _powers(length + 1), np.arange(1, symbols + 1, dtype=U)
    before = np.zeros((count, length + 1), U)
    np.cumsum(rows * powers[:length], axis=1, dtype=U, out=before[:, 1:])
    whole = before[:, -1:]
    after = whole - before
    replaced = whole[:, :, None] + (every - rows[:, :, None]) * powers[:length, None]
    deleted = before[:, :-1] + after[:, 1:] * UNBASE
    inserted = before[:, :, None] + every * powers[:, None] + after[:, :, None] * BASE
    return np.concatenate([whole, replaced.reshape(count, -1), deleted, inserted.reshape(count, -1)], axis=1)


def by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows) of the words of each length, a bounded number at a time."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        step = max(1, HELD // (int(n) * (2 * symbols + 1) + symbols + 1))
        for at in range(0, len(places), step):
            part = places[at : at + step]
            yield part, reduced([words[i] for i in part], symbols)


@dataclass(frozen=True)
class SpellingVariants:
    symbols: int = 6
    least_length: int = 5
    least_count: int = 3
    ratio: int = 2
    misspell: int = 97  # one run in so many loses a letter; 0: none does

    def words(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(word, n) of the words that are long and frequent enough."""
        runs = docs.select(id_text(F.col(key)).alias("name"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUNS), F.lit(0))).alias("run"))
        runs = runs.where(F.length("run") >= self.least_length).select("name", lower_ascii(F.col("run")).alias("run"))
        word: Column = F.col("run")
        if self.misspell:
            runs = runs.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run")))
            place = (F.col("h") % F.length("run")).cast("int")
            cut = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
            word = F.when(F.col("h") % self.misspell == 0, cut).otherwise(word)
        counted = runs.select(word.alias("word")).where(F.length("word") >= self.least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        return counted.where(F.col("n") >= self.least_count)

    def near(self, words: DataFrame) -> DataFrame:
        """(word, n, other, n_other) for each word and each word one edit away; ``words`` has distinct words with ``n``."""
        ship(words.sparkSession)
        symbols = self.symbols

        def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found, ws = np.zeros(len(b), U), b["word"].tolist()
                for places, rows in by_length(ws, symbols):
                    found[places] = reduced_hash(rows)
                yield b.assign(code=found.view(np.int64))

        def generated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                ws = b["word"].tolist()
                for places, rows in by_length(ws, symbols):
                    reach = np.sort(neighbourhood(rows, symbols).view(np.int64), axis=1)
                    code = reduced_hash(rows).view(np.int64)
                    fresh = np.ones(reach.shape, bool)
                    fresh[:, 1:] = reach[:, 1:] != reach[:, :-1]
                    row, column = np.nonzero(fresh & (reach >= code[:, None]))
                    yield pd.DataFrame({"code": code[row], "reach": reach[row, column]})

        coded = materialize(words.select("word", "n").mapInPandas(hashed, "word string, n long, code long"), "spelling-words")
        # One word stands for all with the same reduced word, from which alone the neighbourhood is made.
        vocabulary = materialize(coded.groupBy("code").agg(F.min("word").alias("word")), "spelling-reduced")
        reach = vocabulary.mapInPandas(generated, "code long, reach long")
        met = reach.join(vocabulary.select(F.col("code").alias("reach")), "reach")
        other = coded.select(F.col("word").alias("other"), F.col("n").alias("n_other"), F.col("code").alias("reach"))
        told = (F.levenshtein("word", "other", 1) == 1) & ((F.col("code") < F.col("reach")) | (F.col("word") < F.col("other")))
        pairs = materialize(met.join(coded, "code").join(other, "reach").where(told).select("word", "n", "other", "n_other"), "spelling-pairs")
        return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("n_other").alias("n"), F.col("word").alias("other"), F.col("n").alias("n_other")))

    def group(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Per word: ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
        words = materialize(self.words(docs, key, text), "spelling-counts")
        best = F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("form")))
        formed = self.near(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        named = words.join(formed, "word", "left")
        follows = -F.col("best.less") >= self.ratio * F.col("n")
        named = materialize(named.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(follows, F.col("best.form")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n")), "spelling-forms")
        roots = self.roots(named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
        return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

    @staticmethod
    def roots(steps: DataFrame) -> DataFrame:
        """Follow (word, root) to the end of every way, which has no circle: each round doubles what a jump covers."""
        jumps = materialize(steps, "spelling-jumps")
        while True:
            on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
            jumps = materialize(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-jumps")
            if jumps.where("moved").isEmpty():
                return jumps.select("word", "root")
            jumps = jumps.select("word", "root")
