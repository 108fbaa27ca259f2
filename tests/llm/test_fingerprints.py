import hashlib
import math
import re
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from linkframe.llm import queries
from linkframe.llm.fingerprints import WeightedSampling
from graphs import SMALL

SAMPLING = WeightedSampling()


def chained(*values):
    """The 64-bit hash of strings, longs and ints in a row, as an unsigned number."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v, seed=h)
    return h


def long(x):
    return struct.pack("<Q", x & (2**64 - 1))


def bag(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w] or ([text] if text else [])
    return Counter(chained(w.encode()) & ~1 for w in words)


def samples(weights):
    """The (term, t) with the smallest score, per sample."""
    out = []
    for lane in range(SAMPLING.samples // SAMPLING.lane):
        for k in range(SAMPLING.lane):
            scores = []
            for term, w in weights.items():
                mixed = long(chained(long(term), struct.pack("<i", lane)))
                one, two = (chained(mixed, struct.pack("<i", 2 * k + i)) for i in (0, 1))
                u = lambda h, shift, bits: ((h >> shift & (1 << bits) - 1) + 0.5) / (1 << bits)
                r = -math.log(u(one, 32, 32) * u(one, 0, 32))
                c = -math.log(u(two, 40, 24) * u(two, 16, 24))
                b = u(two, 0, 16)
                t = math.floor(math.log(w) / r + b)
                scores.append((math.log(c) - r * (t - b + 1), term, t))
            out.append(min(scores)[1:] if scores else None)
    return out


def likeness(one, other):
    if not one or not other:
        return float(not one and not other)
    return sum(a == b for a, b in zip(samples(one), samples(other))) / SAMPLING.samples


def brute_force(rows):
    """Per row in order (key descending): n_chars, digest, near_edited, near_next."""
    found = []
    for k, (key, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        found.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(bag(text), bag(edited)), likeness(bag(text), bag(after))))
    return found


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]


def test_equals_brute_force(spark):
    texts = ["one two three four five six seven", "One, two; three FOUR!", "", "--- ... ---", "x" * 3000, "a b " * 40 + "c", "größer été ñandú 漢字 \U0001f600",
             "one two three four five six eight", "one two three four five six seven", "tail of the table"]
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)]
    got = SAMPLING.prints(spark.createDataFrame(rows, "doc_id long, text string"))
    by_id = sorted((tuple(r) for r in got.select(COLUMNS).collect()), reverse=True)
    assert by_id == brute_force(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in got.collect()}
    assert prints[10] == prints[2] and prints[8] == "" and len(prints[7]) == 4 * SAMPLING.samples


def test_the_query_equals_brute_force_on_some_of_its_rows(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).orderBy(F.desc("doc_id")).collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_fingerprints"](spark, SMALL).collect()}
    assert sorted(got) == sorted(r[0] for r in table)
    rows = [tuple(r) for r in table]
    short = [k for k in range(len(rows) - 1) if len(rows[k][1]) < 600 and len(rows[k + 1][1]) < 2000][:8] + [len(rows) - 1]
    for k in short:
        assert got[rows[k][0]] == brute_force([rows[k], rows[(k + 1) % len(rows)]])[0]
    for k, (key, text) in enumerate(rows):
        assert got[key][1] == len(text)


def test_collision_rate_is_generalised_jaccard(spark):
    wide = WeightedSampling(samples=4096)
    pairs = [(Counter(a=5, b=1, c=2), Counter(a=2, b=1, d=3)), (Counter(a=1), Counter(a=3)), (Counter(a=4, b=4), Counter(a=4, b=4))]
    rows = [(i, [(chained(t.encode()) >> 2, p[0][t], p[1][t]) for t in sorted(p[0] | p[1])]) for i, p in enumerate(pairs)]
    bags = spark.createDataFrame(rows, "id long, bag array<struct<term:long,n:int,n_other:int>>")
    sampled = wide.sample(bags, ["id"]).select("id", wide.likeness(F.col("fingerprint"), F.col("other")).alias("near")).collect()
    for i, near in sampled:
        one, other = pairs[i]
        assert abs(near - sum((one & other).values()) / sum((one | other).values())) < 0.04


def test_copies_awkward_rows_and_empty_tables(awkward, nothing, spark):
    got = SAMPLING.prints(awkward.withColumn("text_", F.lit(1)).withColumn("key", F.lit(2)).withColumn("n", F.lit(3)))
    assert got.count() == awkward.count() and SAMPLING.prints(nothing).count() == 0
    copies = spark.createDataFrame([(7, "some words here to see")] * 50 + [(1, "another text")], "doc_id long, text string")
    near = [r["near_next"] for r in SAMPLING.prints(copies).collect()]
    assert sorted(near) == [0.0, 0.0] + [1.0] * 49
    alone = SAMPLING.prints(spark.createDataFrame([(None, "just me")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"just ju").hexdigest()


def test_no_python_on_the_way(spark):
    plan = SAMPLING.prints(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
