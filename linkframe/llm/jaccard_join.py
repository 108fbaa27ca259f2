"""Similarity self-join on word n-grams by chosen paths (Christiani and Pagh).

A document is the set of its shingles, the hashes of its runs of ``words`` words. Documents with equal sets are one class.
Each run starts with a bucket of all classes and splits buckets: hashing a token together with the bucket's name, every
set takes each of its n tokens with chance 1 / (threshold * n), about 1.25 tokens, and goes to the sub-bucket of each
taken token. What two sets share they take alike, so a pair at the threshold shares one sub-bucket on average and survives
``depth`` splits with a known chance; ``runs`` independent runs are made, enough for ``recall``. A bucket of at most
``limit`` classes is compared by brute force. A larger one is split on, unless its members are similar on average, it has
been split ``most_splits`` times, or all ordered pairs in such buckets are at most ``4 * limit`` per class: comparing them
is then less work than splitting on. It is compared whole, in pairs of blocks if it is larger than one. So no bucket is
cut short, whatever its size. Classes that are still in a bucket to be split after ``depth`` splits go through further runs among
themselves, until there are enough for the depth that was reached. (A missed pair either has not lasted ``depth`` splits in
any of the first runs, or both its classes are in all runs; the two chances add up to 1 - ``recall`` at most.)

Only names of buckets are shuffled to split them, each once, with the sizes and sketches of their sets. The token sets of
classes that have company are dealt out once, into a table bucketed by class: all later splits and the comparison read
them where they lie. They move again only to the cells in which they are compared. A pair that meets in several buckets counts in the one with the smallest
name. What comes out of a bucket is a row per member (number of links, smallest member it hangs together with), never a
row per pair. Links are exact: all tokens are compared (as 32-bit hashes; a chance match among n tokens changes a
similarity by less than n / 2^32).

Defined cases: texts of fewer than ``words`` words are the shingle of all their words; null, empty and wordless texts are
all alike, a class of their own; nulls and repeats among ids are allowed, each row is judged; an empty table gives no
rows. Only ``key`` and ``text`` are read, so no other column's name matters.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import bucketed, materialize, ship
from .text import U, mix, shingles

ROWS = "id string, mark long, class string, row long, size int, sketch long, second long, nodes array<long>, tokens binary"
FOUND = "rep long, links long, root long"
#: Row numbers hold the partition above and the place in it below.
PLACE_BITS = 40
FACTORS = mix(np.arange(1, 65, dtype=U)) | U(1)


def take(tokens: np.ndarray, nodes: np.ndarray, threshold: float) -> np.ndarray:
    """The names of the sub-buckets that a set goes to from each of the buckets ``nodes``."""
    if not len(tokens):
        return np.empty(0, U)
    draws = mix(mix(nodes)[:, None] ^ tokens[None, :])
    chance = min(1.0, 1 / (threshold * len(tokens)))
    node, token = np.nonzero(draws <= U(min(int(chance * 2.0**64), 2**64 - 1)))
    return mix(draws[node, token] + nodes[node])


def sketch(tokens: np.ndarray) -> tuple[int, int]:
    """Two bits of each of 64 minwise hashes: two sets agree in the first with chance (1 + similarity) / 2, in both (1 + 3 * similarity) / 4."""
    if not len(tokens):
        return 0, 0
    least = mix((tokens[None, :] * FACTORS[:, None]).min(1))
    first, second = (int(np.packbits((least >> U(k) & U(1)).astype(np.uint8)).view(np.int64)[0]) for k in (63, 62))
    return first, second


def survival(depth: int) -> float:
    """Chance that two sets at the threshold still share a bucket after ``depth`` splits, each of which they share once on average."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-chance)
    return chance


def links_in(tokens: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have at least the Jaccard similarity, as a symmetric matrix."""
    sizes = np.array([len(t) for t in tokens], np.float64)
    _, column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(tokens)), sizes.astype(np.int64))
    shared = count[column] > 1
    names, column = np.unique(column[shared], return_inverse=True)
    row = row[shared]
    common = np.zeros((len(tokens), len(tokens)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, len(names), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        dense = np.zeros((len(tokens), min(4096, len(names) - low)), np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        common += dense @ dense.T
    linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(linked, False)
    return linked


@dataclass(frozen=True)
class ChosenPath:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.999
    limit: int = 64
    depth: int = 4
    most_splits: int = 12
    dense: float = 0.5
    block: int = 1024
    block_tokens: int = 2_000_000

    @property
    def most_bits(self) -> int:
        """Six standard deviations above what a pair at the threshold differs in; 64 would let all pass."""
        p = (1 - self.threshold) / 2
        return math.ceil(64 * p + 6 * math.sqrt(64 * p * (1 - p)))

    @property
    def most_hashes(self) -> int:
        """The same for hashes that differ in at least one of their two bits."""
        p = 3 * (1 - self.threshold) / 4
        return math.ceil(64 * p + 6 * math.sqrt(64 * p * (1 - p)))

    @property
    def runs(self) -> int:
        """Enough for ``depth`` splits; a tenth of the misses allowed, at least, is left for pairs that need more."""
        return math.ceil(math.log(0.9 * (1 - self.recall)) / math.log(1 - survival(self.depth)))

    def runs_for(self, splits: int) -> int:
        """Enough for pairs that need so many splits."""
        if splits <= self.depth:
            return self.runs
        left = 1 - self.recall - (1 - survival(self.depth)) ** self.runs
        return math.ceil(math.log(left) / math.log(1 - survival(splits)))

    @staticmethod
    def _roots(first: int, end: int) -> np.ndarray:
        """The names of the buckets of all classes that runs ``first`` to ``end`` - 1 begin with."""
        return mix(np.arange(first + 1, end + 1, dtype=U) * U(0xD1B54A32D192ED03))

    def _sets(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        words, threshold = self.words, self.threshold
        roots = self._roots(0, self.runs)

        def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            row = TaskContext.get().partitionId() << PLACE_BITS
            for b in batches:
                found = []
                for id_, mark, text_ in zip(b["id"], b["mark"], b["text"]):
                    tokens = shingles(text_, words)
                    name = hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest()
                    nodes = take(tokens, roots, threshold).view(np.int64)
                    found.append((id_, mark, name, row, len(tokens), *sketch(tokens), nodes, (tokens & U(0xFFFFFFFF)).astype(np.uint32).tobytes()))
                    row += 1
                yield pd.DataFrame(found, columns=[c.split()[0] for c in ROWS.split(", ")])

        rows = docs.select(F.col(key).cast("string").alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
        return materialize(rows.mapInPandas(made, ROWS), "join-rows")

    def _level(self, members: DataFrame) -> DataFrame:
        """(node, rep, size, sketch, second) of nodes with at least two classes, with their number ``n``, all their tokens
        ``total``, and in how many bits of their sketches two of them ``differ``, on average over a chain through all."""
        here = Window.partitionBy("node")
        counted = members.withColumns({"n": F.count(F.lit(1)).over(here), "total": F.sum("size").over(here)}).where("n > 1")
        before = F.lag("sketch").over(here.orderBy(F.xxhash64("rep", "node"), "rep"))
        chained = counted.withColumn("differ", F.bit_count(F.col("sketch").bitwiseXOR(before)))
        return materialize(chained.withColumn("differ", F.avg("differ").over(here)), "join-level")

    def _fits(self) -> Column:
        """Is the bucket small enough to be compared in one piece?"""
        return (F.col("n") <= max(self.limit, self.block)) & (F.col("total") <= self.block_tokens)

    def _to_split(self) -> Column:
        """Is the bucket large, and are its members not similar on average? Splitting would hardly part those."""
        small = (F.col("n") <= self.limit) & (F.col("total") <= self.block_tokens)
        return ~small & (1 - F.col("differ") / 32 < self.dense)

    def _split(self, nodes: DataFrame, sets: DataFrame) -> DataFrame:
        """(node, rep, size, sketch, second): the sub-buckets of all buckets ``nodes`` of each class ``rep``."""
        threshold = self.threshold

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                below = [take(np.frombuffer(tokens, np.uint32).astype(U), np.array(nodes, np.int64).view(U), threshold).view(np.int64)
                         for nodes, tokens in zip(b["nodes"], b["tokens"])]
                yield b.drop(columns="tokens").assign(nodes=below)

        held = sets.join(nodes.hint("shuffle_hash"), "rep").select("rep", "size", "sketch", "second", "nodes", "tokens")
        parts = held.mapInPandas(split, "rep long, size int, sketch long, second long, nodes array<long>")
        return parts.select(F.explode("nodes").alias("node"), "rep", "size", "sketch", "second")

    def _split_down(self, level: DataFrame, sets: DataFrame, work: int) -> tuple[list[DataFrame], DataFrame | None, int]:
        """From the first split on: the rows of all buckets not split on, (rep) of the classes in buckets that were split
        more than ``depth`` times, None if there are none, and the number of splits reached."""
        leaves, deep, splits = [], None, 1
        while True:
            big = level.where(self._to_split())
            pairs = big.agg(F.sum("n")).first()[0] or 0  # a row each for n members: the sum of n * n
            if pairs <= work or splits >= self.most_splits:
                return [*leaves, level], deep, splits
            leaves.append(level.where(~self._to_split()))
            if splits >= self.depth and deep is None:
                deep = materialize(big.select("rep").distinct(), "join-deep")
            # A class is in some runs * 1.25 ** splits buckets.
            level = self._level(self._split(big.groupBy("rep").agg(F.collect_list("node").alias("nodes")), sets))
            splits += 1

    def _buckets(self, level: DataFrame) -> DataFrame:
        """(reps): the members of each bucket that have another in it that they may be similar to; two at least.

        Sets whose sizes differ by more than the threshold can't be as similar as that, nor, but for a chance of
        1.2e-7, sets whose sketches differ in more than ``most_bits`` bits, nor, but for one of 3.5e-8, in more than
        ``most_hashes`` hashes.
        """
        t = self.threshold

        def near(a: Column, b: Column) -> Column:
            first, second = a["sketch"].bitwiseXOR(b["sketch"]), a["second"].bitwiseXOR(b["second"])
            return (F.bit_count(first) <= self.most_bits) & (F.bit_count(first.bitwiseOR(second)) <= self.most_hashes)

        fits = lambda a, b: (a["rep"] != b["rep"]) & (a["size"] >= t * b["size"]) & (b["size"] >= t * a["size"]) & near(a, b)
        met = level.groupBy("node").agg(F.collect_list(F.struct("rep", "size", "sketch", "second")).alias("met"))
        kept = F.filter("met", lambda a: F.exists("met", lambda b: fits(a, b)))
        reps = met.select(F.sort_array(F.transform(kept, lambda a: a["rep"])).alias("reps"))
        return reps.where(F.size("reps") > 1)

    def _cells(self, buckets: DataFrame, leaves: DataFrame) -> DataFrame:
        """(bucket, low, high, side, rep): what is compared with what. Equal buckets of several runs have one name."""
        small = buckets.select(F.xxhash64("reps").alias("bucket"), F.explode("reps").alias("rep"))
        zero = F.lit(0)
        small = small.select("bucket", zero.alias("low"), zero.alias("high"), zero.alias("side"), "rep")
        blocks = F.ceil(F.greatest(F.col("n") / self.block, F.col("total") / self.block_tokens)).cast("int")
        large = leaves.select(F.col("node").alias("bucket"), "rep", blocks.alias("blocks"))
        large = large.withColumn("side", F.pmod(F.xxhash64("rep", "bucket"), F.col("blocks")).cast("int"))
        large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        large = large.select("bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "rep")
        return small.unionByName(large)

    def _compare(self, cells: DataFrame, sets: DataFrame) -> DataFrame:
        """Per member of a cell with links: how many documents it is newly linked to, and the smallest class it hangs together with."""
        threshold = self.threshold
        # A class's buckets, by which the cells agree where a pair counts. Equal cells become one here.
        places = cells.groupBy("rep").agg(F.collect_set(F.struct("bucket", "low", "high", "side")).alias("cells"))
        places = places.withColumn("buckets", F.array_sort(F.array_distinct(F.transform("cells", lambda c: c["bucket"]))))
        rows = sets.select("rep", "weight", "tokens").join(places.hint("shuffle_hash"), "rep").withColumn("cell", F.explode("cells"))
        cell = ["bucket", "low", "high"]
        rows = rows.select("cell.*", "rep", "weight", "buckets", "tokens").repartition(*cell).sortWithinPartitions(*cell, "rep")

        def compared(group: list[tuple]) -> pd.DataFrame:
            bucket, low, high = group[0][:3]
            side = np.array([r[3] for r in group])
            linked = links_in([np.frombuffer(r[7], np.uint32) for r in group], threshold)
            if low != high:
                linked &= side[:, None] != side[None, :]
            hit = np.flatnonzero(linked.any(1))
            if not len(hit):
                return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype=np.int64)
            linked = linked[np.ix_(hit, hit)]
            group = [group[k] for k in hit]
            earlier = [[b for b in r[6] if b < bucket] for r in group]
            names, at = np.unique(np.array([b for e in earlier for b in e], np.int64), return_inverse=True)
            held = np.zeros((len(group), len(names)), np.float32)
            held[np.repeat(np.arange(len(group)), [len(e) for e in earlier]), at] = 1
            new = linked & ~(held @ held.T > 0)
            root = np.arange(len(group))  # sorted by class, so the smallest place is the smallest class
            while True:
                least = np.minimum(root, np.where(linked, root[None, :], len(group)).min(1))
                if (least == root).all():
                    break
                root = least
            reps, weights = np.array([r[4] for r in group]), np.array([r[5] for r in group])
            return pd.DataFrame({"rep": reps, "links": new @ weights, "root": reps[root]})

        def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            group: list[tuple] = []
            for b in batches:
                for r in b.itertuples(index=False, name=None):
                    if group and group[0][:3] != r[:3]:
                        yield compared(group)
                        group = []
                    group.append(r)
            if group:
                yield compared(group)

        return materialize(rows.mapInPandas(streamed, FOUND), "join-links")

    def join(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Per row: ``key``, ``class_id`` (the smallest id in its component of links and copies), ``n_links`` (other rows at
        or above the threshold, copies among them), ``n_copies`` (rows with the same set, itself among them), the
        text's hash ``mark`` and its ``component``."""
        ship(docs.sparkSession)
        kind = docs.schema[key].dataType
        rows = self._sets(docs, key, text)
        classes = materialize(rows.groupBy("class").agg(
            F.min("row").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min(F.col("id").cast(kind)).alias("least")), "join-classes")
        work = 4 * self.limit * classes.count()
        firsts = rows.select(F.col("row").alias("rep"), "size", "sketch", "second", "nodes").join(classes.select("rep"), "rep", "left_semi")
        level = self._level(firsts.select(F.explode("nodes").alias("node"), "rep", "size", "sketch", "second"))
        done = self._fits() & ~self._to_split()
        buckets, level = materialize(self._buckets(level.where(done)), "join-buckets"), level.where(~done)
        # The only time that all token sets are dealt out; what has no company is left behind.
        active = buckets.select(F.explode("reps").alias("rep")).unionByName(level.select("rep")).distinct()
        active = active.join(classes.select("rep", "weight"), "rep")
        with bucketed(rows.select(F.col("row").alias("rep"), "size", "sketch", "second", "tokens").join(active, "rep"), "rep", "join-sets") as sets:
            leaves, deep, splits = self._split_down(level, sets, work)
            runs = self.runs
            while deep is not None and runs < self.runs_for(splits):
                first, runs = runs, self.runs_for(splits)
                roots = F.array(*(F.lit(r) for r in self._roots(first, runs).view(np.int64).tolist()))
                more, _, reached = self._split_down(self._level(self._split(deep.withColumn("nodes", roots), sets)), sets, work)
                leaves, splits = leaves + more, max(splits, reached)
            rest = functools.reduce(DataFrame.unionByName, leaves)
            buckets = buckets.unionByName(self._buckets(rest.where(self._fits())))
            found = self._compare(self._cells(buckets, rest.where(~self._fits())), sets)
        roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        named = classes.join(links, "rep", "left").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        named = materialize(named.select("class", "weight", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("component")), "join-named")
        least = named.groupBy("component").agg(F.min("least").alias("class_id"))
        per_class = named.join(least, "component")
        return rows.select("id", "mark", "class").join(per_class, "class").select(
            F.col("id").cast(kind).alias(key), "class_id", (F.col("links") + F.col("weight") - 1).alias("n_links"),
            F.col("weight").alias("n_copies"), "mark", "component")


def one_of_each(docs: DataFrame, joined: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` but one of each component: that with the smallest id (null last), then text hash.

    Of rows with the same id and text one stays, the smallest in its other columns.
    """
    order = F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col("mark"))
    best = joined.groupBy("component").agg(F.min(order).alias("best"))
    marks = joined.groupBy(F.col(key).alias("id"), "mark").agg(F.count(F.lit(1)).alias("rows"))
    same = (F.col("w.id").eqNullSafe(F.col("m.id"))) & (F.col("w.mark") == F.col("m.mark"))
    winners = best.select("best.id", "best.mark").alias("w").join(marks.alias("m"), same).select("w.id", "w.mark", "m.rows")
    winners = materialize(winners, "winners").alias("w")
    whole = F.struct(*(F.col(c).alias(c) for c in docs.columns))
    marked = docs.select(whole.alias("doc"), F.col(key).alias("id"), F.xxhash64(text).alias("mark")).alias("d")
    here = F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.mark") == F.col("w.mark"))
    kept = marked.join(winners, here).select("doc", "w.id", "w.mark", "rows")
    several = kept.where("rows > 1").groupBy("id", "mark").agg(F.min("doc").alias("doc"))
    return kept.where("rows = 1").select("doc.*").unionByName(several.select("doc.*"))
