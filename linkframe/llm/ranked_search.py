"""Ranked search, term at a time, with limited accumulators (Moffat and Zobel's "continue", bounded by what can still be scored).

An item's terms are processed rarest first, in waves: a wave holds the terms up to a fourfold number of postings, so that
the work of all waves is in proportion to that of the last. A document met by a term of an open item gets an accumulator,
the sum of its terms' scores so far. After each wave an item is closed if the most that its remaining terms could score
together is less than its ``k``-th largest accumulator: a document without one can't reach the first ``k`` any more. From
then on no accumulators are made; those that can still reach the ``k``-th are updated by the remaining terms exactly.
Nothing is estimated, so the result is that of scoring every document.

Postings (term, count) are written once, for the terms of the items alone, beside the document they were counted in, and
stay there: items' terms, a few numbers each, come to them. So a document's accumulators meet in the task that reads it and
are neither shuffled nor written; a wave's are made anew from its own and all earlier waves' terms, which costs a third more
than the last wave alone. A task gives out its ``k`` largest per item, by which Spark finds the k-th of all; after the last
wave one more pass gives out its ``k`` best survivors. A term in every document gathers rows nowhere.

The items are the query set: they are taken in blocks of bounded size, each of which meets all documents, so more items only
take more passes. Accumulators are kept for bounded runs of documents at a time.

Defined cases: null texts have no terms; items and documents without terms have no result rows; repeated rows are documents
(or items) of their own; equal scores go by ascending id, nulls last, then by the order in which rows were read; empty
tables give no rows; texts of any length are taken whole. Only ids and texts are read, so no other column's name matters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import lower_ascii
from .storage import materialize, ship

#: What lies between terms: ASCII but for letters and digits. All other characters are in terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same for the bytes of a text: A-Z in lower case, a space for each byte between terms.
BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
#: Accumulators and hits of terms in items at a time; candidates kept by a task before it drops all but the best.
CELLS, PENDING = 1_000_000, 100_000


def _terms(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN), "")


@dataclass(frozen=True)
class Terms:
    """Some terms of some items, ordered by term: those of term t lie from ``first[t]`` on, up to ``first[t + 1]``."""

    first: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    items: int

    @staticmethod
    def of(plan: pd.DataFrame, terms: int, items: int) -> Terms:
        plan = plan.sort_values("term")
        first = np.searchsorted(plan["term"].to_numpy(np.int64), np.arange(terms + 1))
        return Terms(first, plan["item"].to_numpy(np.int64), plan["weight"].to_numpy(np.int64), items)

    def hits(self, term: np.ndarray) -> np.ndarray:
        return self.first[term + 1] - self.first[term]

    def sums(self, doc: np.ndarray, term: np.ndarray, part: np.ndarray, docs: int) -> np.ndarray:
        """The accumulators, items by documents, that postings make."""
        hits = self.hits(term)
        at = np.repeat(self.first[term] - np.cumsum(hits) + hits, hits)
        at += np.arange(len(at))
        made = np.zeros(self.items * docs, np.int64)
        np.add.at(made, self.item[at] * docs + np.repeat(doc, hits), self.weight[at] * np.repeat(part, hits))
        return made.reshape(self.items, docs)


@dataclass(frozen=True)
class Lengths:
    """The numbers of documents with a term and of all their terms, by which scores are normed."""

    docs: int
    terms: int

    def part(self, n, tf):
        """A posting's part of a score, to be multiplied by the weight."""
        return 1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n * self.docs // self.terms))

    def column(self) -> Column:
        """The same of columns n and tf."""
        length = F.lit(10).cast("long") + F.call_function("div", 90 * F.col("n") * F.lit(self.docs).cast("long"), F.lit(self.terms).cast("long"))
        return F.call_function("div", F.lit(1_000_000_000).cast("long") * F.col("tf"), 1000 * F.col("tf") + 8 * length)


def _runs(batch: pa.RecordBatch, lengths: Lengths, terms: Terms, later: Terms | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of the documents that ``terms`` meet, short enough for all accumulators: places in the batch; and the document
    (in the run), term and part of each of their postings that is asked for."""
    tf = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    term = batch.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
    met = np.zeros(batch.num_rows, bool)
    cost = terms.hits(term)
    met[doc[cost > 0]] = True
    if later is not None:
        cost = cost + later.hits(term)
    kept = met[doc] & (cost > 0)
    doc, term, tf, cost = doc[kept], term[kept], tf[kept], cost[kept]
    places = np.flatnonzero(met)
    doc = (np.cumsum(met) - 1)[doc]
    n = batch.column("n").to_numpy(zero_copy_only=False)[places]
    total = np.cumsum(np.bincount(doc, cost, len(places)).astype(np.int64) + terms.items)
    part = lengths.part(n[doc], tf)
    at = 0
    while at < len(places):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CELLS, side="right")))
        a, b = np.searchsorted(doc, [at, end])
        yield places[at:end], doc[a:b] - at, term[a:b], part[a:b]
        at = end


def _largest(sums: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest of each row, in any order, the smallest of them first."""
    return sums if sums.shape[1] <= k else np.partition(sums, sums.shape[1] - k, axis=1)[:, -k:]


def _first(table: pa.Table, k: int) -> pa.Table:
    """Of each item the ``k`` first rows by score, key and row."""
    order = [("item", "ascending"), ("score", "descending"), ("key", "ascending"), ("row", "ascending")]
    table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_end"))
    item = table.column("item").to_numpy()
    return table.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < k))


@dataclass(frozen=True)
class RankedSearch:
    """first_wave: postings per item in the first wave; each later one ends at ``growth`` times as many.
    block_terms, block_items: items' terms and items that are sent to all tasks at a time, some 30 bytes each."""

    k: int = 10
    first_wave: int = 1000
    growth: int = 4
    block_terms: int = 1_000_000
    block_items: int = 20_000

    def postings(self, docs: DataFrame, vocabulary: list[str], key: str, text: str) -> DataFrame:
        """(row, key, n, terms, tfs): of each document the places in ``vocabulary`` and counts of the terms that are in it."""
        shared = docs.sparkSession.sparkContext.broadcast({term.encode(): place for place, term in enumerate(vocabulary)})

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                n, ends, terms, tfs = [], [0], [], []
                for whole in batch.column("text"):
                    words = (whole.as_py() or b"").translate(BYTES).split()
                    tf = Counter(words)
                    met = tf.keys() & known.keys()
                    terms += map(known.__getitem__, met)
                    tfs += map(tf.__getitem__, met)
                    n.append(len(words))
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())) for flat in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("key"), pa.array(n, pa.int64()), *lists], ["row", "key", "n", "terms", "tfs"])

        read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
        schema = read.select("row", "key", F.lit(0).cast("long").alias("n"), *(F.array().cast("array<int>").alias(c) for c in ("terms", "tfs"))).schema
        return materialize(read.mapInArrow(counted, schema), "search-postings")

    def plan(self, asked: pd.DataFrame, postings: DataFrame) -> tuple[pd.DataFrame, Lengths]:
        """(item, term, weight, most, wave) of the terms that documents have; ``most`` is the most that one can score."""
        sizes = postings.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        lengths = Lengths(sizes[0], sizes[1] or 1)
        each = postings.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("posting"))
        each = each.select(F.col("n"), F.col("posting.terms").alias("term"), F.col("posting.tfs").cast("long").alias("tf"))
        ratio = F.lit(2 * lengths.docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
        weighed = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(lengths.column()).alias("part"))
        weighed = weighed.withColumn("weight", F.floor(1000 * F.log(ratio)).cast("long")).toPandas()
        known = asked.merge(weighed, on="term").sort_values(["item", "df", "term"])
        met = known.groupby("item")["df"].cumsum().to_numpy(np.float64)
        wave = np.ceil(np.log(met / self.first_wave) / np.log(self.growth)).clip(0).astype(np.int64)
        return known.assign(most=known["weight"] * known["part"], wave=wave)[["item", "term", "weight", "most", "wave"]], lengths

    def _bounds(self, postings: DataFrame, terms: Terms, lengths: Lengths) -> np.ndarray:
        """Each item's ``k``-th largest accumulator; 0 where there are fewer."""
        k, shared = self.k, postings.sparkSession.sparkContext.broadcast(terms)

        def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = np.zeros((shared.value.items, 0), np.int64)
            for batch in batches:
                for places, *run in _runs(batch, lengths, shared.value):
                    top = _largest(np.concatenate([top, shared.value.sums(*run, len(places))], axis=1), k)
            item, place = np.nonzero(top)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(top[item, place], pa.int64())], ["item", "score"])

        tops = postings.select("n", "terms", "tfs").mapInArrow(largest, "item long, score long")
        ranked = tops.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("rank") <= k)
        bounds = np.zeros(terms.items, np.int64)
        for item, score in ranked.where(F.col("rank") == k).select("item", "score").collect():
            bounds[item] = score
        return bounds

    def _survivors(self, postings: DataFrame, made: Terms, later: Terms, lengths: Lengths, needed: np.ndarray, names: np.ndarray) -> DataFrame:
        """(item, row, key, score): each task's ``k`` best of the documents whose accumulators are at least ``needed``, updated by ``later`` terms."""
        k, shared = self.k, postings.sparkSession.sparkContext.broadcast((made, later, needed, names))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made, later, needed, names = shared.value
            top, found, pending = np.zeros((made.items, 0), np.int64), [], 0
            for batch in batches:
                for places, doc, term, part in _runs(batch, lengths, made, later):
                    sums = made.sums(doc, term, part, len(places))
                    alive = (sums > 0) & (sums >= needed[:, None])
                    some = alive.any(0)
                    mine = some[doc]
                    more = later.sums((np.cumsum(some) - 1)[doc[mine]], term[mine], part[mine], int(some.sum()))
                    places, score = places[some], np.where(alive[:, some], sums[:, some] + more, 0)
                    top = _largest(np.concatenate([top, score], axis=1), k)
                    least = top.min(1) if top.shape[1] == k else np.zeros(made.items, np.int64)
                    item, place = np.nonzero((score > 0) & (score >= least[:, None]))
                    if not len(item):
                        continue
                    rows = pa.array(places[place])
                    columns = [pa.array(names[item]), batch.column("row").take(rows), batch.column("key").take(rows), pa.array(score[item, place])]
                    found.append(pa.Table.from_arrays(columns, ["item", "row", "key", "score"]))
                    pending += len(item)
                    if pending > PENDING:
                        found = [_first(pa.concat_tables(found), k)]
                        pending = 0
            if found:
                yield from _first(pa.concat_tables(found), k).combine_chunks().to_batches()

        schema = postings.select(F.lit(0).cast("long").alias("item"), "row", "key", F.lit(0).cast("long").alias("score")).schema
        return materialize(postings.mapInArrow(best, schema), "search-survivors")

    def _block(self, docs: DataFrame, asked: pd.DataFrame, key: str, text: str) -> DataFrame | None:
        """The survivors of a block of items, ``asked`` (item, term); None if no document has a term of theirs."""
        names, item = np.unique(asked["item"].to_numpy(np.int64), return_inverse=True)
        vocabulary = sorted(set(asked["term"]))
        place = {term: n for n, term in enumerate(vocabulary)}
        asked = pd.DataFrame({"item": item, "term": asked["term"].map(place).astype(np.int64)})
        postings = self.postings(docs, vocabulary, key, text)
        plan, lengths = self.plan(asked, postings)
        if plan.empty:
            return None
        items = len(names)
        waves, owner, most = (plan[c].to_numpy(np.int64) for c in ("wave", "item", "most"))
        made, needed = np.full(items, -1), np.zeros(items, np.int64)
        end = np.full(items, -1)
        np.maximum.at(end, owner, waves)
        opened = end >= 0
        for wave in range(int(waves.max()) + 1):
            now = opened[owner] & (waves <= wave)
            if not now.any():
                continue
            # Only open items have accumulators.
            dense = np.cumsum(opened) - 1
            terms = Terms.of(plan[now].assign(item=dense[owner[now]]), len(vocabulary), int(opened.sum()))
            bounds = np.zeros(items, np.int64)
            bounds[opened] = self._bounds(postings, terms, lengths)
            rest = np.zeros(items, np.int64)
            np.add.at(rest, owner[waves > wave], most[waves > wave])
            # An item without a later wave is done, with or without k documents; the rest shrinks from wave to wave.
            over = opened & ((end <= wave) | (rest < bounds))
            made[over], needed[over] = wave, (bounds - rest)[over]
            opened &= ~over
            if not opened.any():
                break
        early = waves <= made[owner]
        of = lambda rows: Terms.of(plan[rows], len(vocabulary), items)
        return self._survivors(postings, of(early), of(~early), lengths, needed, names)

    def search(self, docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
        """``item``, ``rank`` (from 1), ``key``, ``score`` of the ``k`` best documents of each row of ``queries``."""
        ship(docs.sparkSession)
        asked = materialize(queries.select(F.monotonically_increasing_id().alias("item"), F.col(item).alias("item_key"), F.col(item_text).alias("text")), "search-items")
        items = asked.select("item", F.explode(_terms("text")).alias("term")).withColumn("term", lower_ascii(F.col("term"))).distinct()
        items = materialize(items, "search-terms")
        size = items.agg(F.count(F.lit(1)), F.count_distinct("item")).first()
        blocks = -(-max(size[0] * self.block_items, size[1] * self.block_terms) // (self.block_terms * self.block_items))
        of_block = lambda n: items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).toPandas()
        found = [self._block(docs, terms, key, text) for terms in map(of_block, range(blocks)) if len(terms)]
        found = [block for block in found if block is not None]
        if not found:
            nothing = [F.lit(0).alias("rank"), F.lit(None).cast(docs.schema[key].dataType).alias(key), F.lit(0).cast("long").alias("score")]
            return asked.where("false").select(F.col("item_key").alias(item), *nothing)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
        first = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)
        return first.join(asked.select("item", "item_key"), "item").select(F.col("item_key").alias(item), "rank", F.col("key").alias(key), "score")
