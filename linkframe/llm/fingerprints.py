"""Document fingerprints by improved consistent weighted sampling (Ioffe, 2010), in column expressions only.

A text is a bag of lower-case words, each weighted by how often it occurs. For every sample k a word's hash gives
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), the same in all texts; of weight w it scores

    a = ln c - r (t - b + 1)   with   t = floor(ln w / r + b),

and the word with the smallest score is the sample. Two texts have the same smallest score with a chance that equals
their generalised Jaccard similarity (sum of the smaller over sum of the larger weights), and practically never
otherwise, so the score itself stands for the sample: a fingerprint is ``samples`` of them as 16-bit hashes, in hex.

Spark's logarithm is the same on every machine, and so are the fingerprints.

Words are counted within the row of their text and sampled where they are counted: what is shuffled is the texts, once,
their beginnings for the edited texts, and the fingerprints. Rows with equal key and text are computed once, however many.

Defined cases: a null text is empty; an empty text has the empty fingerprint, like itself alone; a text without words is
one term; texts of any length are taken whole; rows follow each other by descending key, nulls last, equal keys by
descending hash of the text; repeated rows follow each other; the only row of a table follows itself; an empty table
gives no rows. Only ``key`` and ``text`` are read, so no other column's name matters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharding import shard_by_bytes
from .storage import materialize

def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.transform(F.array(value), body)[0]


def _draws(term: str, k: int) -> tuple[Column, Column, Column]:
    """r, ln c and b of sample ``k`` for the term hash in a column: a Gamma(2, 1) variate is minus the log of two uniforms' product."""

    def uniform(h: Column, shift: int, bits: int) -> Column:
        return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(0.5)) * F.lit(2.0**-bits)

    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.log(uniform(one, 32, 32) * uniform(one, 0, 32))
    return r, F.log(-F.log(uniform(two, 40, 24) * uniform(two, 16, 24))), uniform(two, 0, 16)


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits; the whole text where there are none, unless it is empty."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return let(words, lambda w: F.when((F.size(w) > 0) | (text == ""), w).otherwise(F.array(text)))


def _bag(one: Column, other: Column) -> Column:
    """Each term of two texts with its counts (term, n, n_other): hashes sorted, the text in the last bit, then runs."""
    hashed = lambda words, bit: F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(bit)))
    ordered = F.sort_array(F.concat(hashed(one, 0), hashed(other, 1)))

    def starts(h: Column) -> Column:
        places = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
        first = F.filter(places, lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))
        return F.struct(h.alias("h"), first.alias("first"))

    def counted(both: Column) -> Column:
        h, first = both["h"], both["first"]
        end = lambda k: F.coalesce(F.get(first, k), F.size(h))

        def run(p: Column, k: Column) -> Column:
            x, after = F.get(h, p), end(k + 1)
            twin = F.get(h, after) == x.bitwiseOR(F.lit(1))
            zero = F.lit(0)
            mine = F.struct(x.alias("term"), (after - p).alias("n"), F.when(twin, end(k + 2) - after).otherwise(zero).alias("n_other"))
            other = F.struct(x.bitwiseAND(F.lit(-2)).alias("term"), zero.alias("n"), (after - p).alias("n_other"))
            told = (k > 0) & (F.get(h, p - 1) == x.bitwiseAND(F.lit(-2)))
            return F.when(x.bitwiseAND(F.lit(1)) == 0, mine).when(~told, other)

        # The other text's run of a term that both have is told with the first's.
        return F.filter(F.transform(first, run), lambda x: x.isNotNull())

    return let(let(ordered, starts), counted)


@dataclass(frozen=True)
class WeightedSampling:
    """samples: how many make a fingerprint; they are drawn ``lane`` at a time, so that generated code stays small."""

    samples: int = 64
    lane: int = 8

    def sample(self, bags: DataFrame, names: list[str]) -> DataFrame:
        """``fingerprint`` and ``other`` per row: ``bags`` has a column ``bag`` of (term, n, n_other) besides ``names``, its key.

        A row's terms are unfolded and gathered in one task, however the rows are dealt out.
        """
        lanes = self.samples // self.lane
        rows = bags.select(*names, F.explode_outer("bag").alias("one")).select(
            *names, "one.term", F.log("one.n").alias("w"), F.log("one.n_other").alias("w_other"))
        rows = rows.select(*names, "w", "w_other", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), "term")
        rows = rows.select(*names, "lane", "w", "w_other", F.xxhash64("term", "lane").alias("term_"))

        def least(k: int, weight: str) -> Column:
            r, c, b = _draws("term_", k)
            # Null where the weight is: a text without the term, or without any. Nothing here is conditional, so that
            # both texts share r, c and b.
            return F.min(c - r * (F.floor(F.col(weight) / r + b) - b + 1))

        drawn = rows.groupBy(*names, "lane").agg(
            *(least(k, "w").alias(f"a{k}") for k in range(self.lane)), *(least(k, "w_other").alias(f"b{k}") for k in range(self.lane)))
        digits = lambda x: F.lower(F.lpad(F.hex(F.xxhash64(x).bitwiseAND(F.lit(0xFFFF))), 4, "0"))
        text = lambda x: F.concat(*(F.when(F.col(f"{x}{k}").isNotNull(), digits(f"{x}{k}")).otherwise("") for k in range(self.lane)))
        gathered = drawn.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("lane", text("a").alias("a"), text("b").alias("b")))).alias("lanes"))
        joined = lambda x: F.array_join(F.transform("lanes", lambda lane: lane[x]), "")
        return gathered.select(*names, joined("a").alias("fingerprint"), joined("b").alias("other"))

    def likeness(self, one: Column, other: Column) -> Column:
        """The share of equal samples of two fingerprints; empty ones are like each other alone."""
        piece = lambda x, k: F.substring(x, 4 * k + 1, 4)
        same = F.filter(F.sequence(F.lit(0), F.lit(self.samples - 1)), lambda k: piece(one, k) == piece(other, k))
        return F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(F.size(same) / F.lit(float(self.samples)))

    def prints(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Per row: ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``."""
        # A name for the key that is never null, so that rows meet by plain equality.
        name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
        body = F.coalesce(F.col(text), F.lit(""))
        rows = docs.select(F.col(key).alias("key"), name.alias("name"), body.alias("text"), F.xxhash64(body).alias("mark"), F.length(body).alias("n"))

        # Small rows in their order, and for each who comes next and how much of it the one before asks for.
        distinct = rows.groupBy("name", "mark").agg(F.min("key").alias("key"), F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"))
        placed = materialize(shard_by_bytes(distinct.withColumn("size", F.lit(1)), 1, ["key", "mark"]).drop("size", "shard"), "print-order")
        total = placed.count()
        here = placed.select("slot", "name", "mark", "key", "n", "copies", F.pmod(F.col("slot") - 1, F.lit(max(total, 1))).alias("after"))
        there = placed.select(F.col("slot").alias("after"), F.col("name").alias("next_name"), F.col("mark").alias("next_mark"))
        before = placed.select(F.pmod(F.col("slot") - 1, F.lit(max(total, 1))).alias("slot"), F.col("name").alias("before_name"),
                               F.col("mark").alias("before_mark"), F.expr("n div 3").cast("int").alias("asked"))
        order = materialize(here.join(there, "after").join(before, "slot").drop("slot", "after"), "print-next")

        # One text per distinct row. Grouped, joined and sampled by (name, mark): one shuffle of texts serves all of it.
        same = ["name", "mark"]
        texts = rows.groupBy(*same).agg(F.first("text").alias("text")).join(order, same)
        heads = texts.select(F.col("before_name").alias("name"), F.col("before_mark").alias("mark"), F.substring(F.col("text"), F.lit(1), F.col("asked")).alias("head"))
        third = F.expr("n div 3").cast("int")
        edit = lambda head: F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - third), head)
        own = F.substring(F.col("text"), F.lit(1), third)
        # Copies of a row follow each other; only the last of them is followed by another text.
        ways = F.array(F.struct(F.lit(1).cast("long").alias("rows"), edit(F.col("head")).alias("edited"), F.lit(True).alias("last")))
        more = F.array(F.struct((F.col("copies") - 1).alias("rows"), edit(own).alias("edited"), F.lit(False).alias("last")))
        both = texts.join(heads, same).withColumn("way", F.explode(F.when(F.col("copies") > 1, F.concat(ways, more)).otherwise(ways)))
        facts = both.select(
            *same, F.col("way.last").alias("last"), "key", "n", "next_name", "next_mark", F.col("way.rows").alias("rows"),
            F.sha2("way.edited", 256).alias("edited_sha256"))
        # Every term is grouped by these, so they are few and short; what else is known of a text is joined to its fingerprint.
        bags = both.select(*same, F.col("way.last").alias("last"), _bag(terms(F.col("text")), terms(F.col("way.edited"))).alias("bag"))
        found = materialize(self.sample(bags, [*same, "last"]).join(facts, [*same, "last"]), "prints")

        following = found.where("last").select(F.col("name").alias("next_name"), F.col("mark").alias("next_mark"), F.col("fingerprint").alias("following"))
        own, other = F.col("fingerprint"), F.when(F.col("last"), F.col("following")).otherwise(F.col("fingerprint"))
        out = found.join(following, ["next_name", "next_mark"]).select(
            F.col("key").alias(key), F.col("n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", F.col("other").alias("edited_fingerprint"),
            self.likeness(own, F.col("other")).alias("near_edited"), self.likeness(own, other).alias("near_next"), "rows")
        return out.withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows", "copy_")
