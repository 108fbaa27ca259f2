import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from linkframe.llm.ranked_search import BETWEEN, RankedSearch
from graphs import SMALL


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in re.split(BETWEEN, text or "") if t]


def brute_force(docs, items, k):
    """(item_id, rank, doc_id, score), every document scored."""
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for place, (key, c) in enumerate(counted):
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score:
                scores.append((-score, key is None, key if key is not None else 0, place, key))
        out += [(item, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("first_wave,k", [(1, 1), (3, 3), (30, 10), (10_000, 5)])
def test_equals_brute_force_however_the_waves_fall(spark, first_wave, k):
    rng = np.random.default_rng(first_wave)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, 61)
    draw = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    docs = [(int(i), draw(int(rng.integers(1, 40)))) for i in range(120)]
    items = [(int(i), draw(int(rng.integers(1, 15)))) for i in range(12)]
    method = RankedSearch(k=k, first_wave=first_wave, growth=2)
    got = method.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == brute_force(docs, items, k)


def test_accumulators_are_limited(spark, monkeypatch):
    """A word that all documents hold makes no accumulators once rarer words have settled the first k."""
    from linkframe.llm import ranked_search

    docs = [(i, "common " + ("rare" + " pad" * (i % 5) if i < 20 else f"other{i}")) for i in range(400)]
    made = {}
    kept = ranked_search.materialize

    def watched(df, name):
        out = kept(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(ranked_search, "materialize", watched)
    method = RankedSearch(k=3, first_wave=50)
    items = [(1, "Rare COMMON")]
    got = method.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == brute_force(docs, items, 3)
    assert made["search-survivors"] <= 20


def test_ties_are_cut_where_they_are_found(spark, monkeypatch):
    """Documents that score alike survive together; a task gives out the first k of them, by id and nulls last."""
    from linkframe.llm import ranked_search

    docs = [(i if i % 7 else None, "common text") for i in range(400, 0, -1)]
    made = {}
    kept = ranked_search.materialize

    def watched(df, name):
        out = kept(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(ranked_search, "materialize", watched)
    items = [(1, "Common"), (2, "TEXT nowhere")]
    rows = spark.createDataFrame(docs + [(1000 + i, f"other{i}") for i in range(100)], "doc_id long, text string").repartition(4)
    got = RankedSearch(k=3).search(rows, spark.createDataFrame(items, "item_id long, text string"))
    assert [r[:3] for r in found(got)] == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (2, 2, 2), (2, 3, 3)]
    assert made["search-survivors"] <= 3 * 2 * rows.rdd.getNumPartitions()


@pytest.mark.parametrize("blocks", [{"block_items": 2}, {"block_terms": 7}])
def test_items_in_blocks_and_documents_in_runs(spark, monkeypatch, blocks):
    from linkframe.llm import ranked_search

    monkeypatch.setattr(ranked_search, "PENDING", 3)
    rng = np.random.default_rng(5)
    draw = lambda n: " ".join(rng.choice([f"w{i}" for i in range(30)], n))
    docs = [(f"id{i}" if i % 9 else None, draw(int(rng.integers(0, 9)))) for i in range(60)]
    items = [(i, draw(4)) for i in range(5)]
    method = RankedSearch(k=4, first_wave=5, growth=2, **blocks)
    got = method.search(spark.createDataFrame(docs, "doc_id string, text string").coalesce(1), spark.createDataFrame(items, "item_id long, text string"))
    assert [(r[0], r[1], r[3]) for r in found(got)] == [(r[0], r[1], r[3]) for r in brute_force([(None, t) for _, t in docs], items, 4)]


def test_runs_of_documents_are_bounded():
    """However many documents and items a batch brings together."""
    import pyarrow as pa

    from linkframe.llm import ranked_search

    lists = lambda rows: pa.array(rows, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([2] * 500), lists([[0, 1]] * 500), lists([[1, 1]] * 500)], ["n", "terms", "tfs"])
    terms = ranked_search.Terms(np.array([0, 20_000, 20_001]), np.r_[np.arange(20_000), 3], np.ones(20_001, np.int64), 20_000)
    runs = list(ranked_search._runs(batch, ranked_search.Lengths(500, 1000), terms))
    assert np.concatenate([r[0] for r in runs]).tolist() == list(range(500))
    assert max(len(r[0]) for r in runs) * 20_000 <= ranked_search.CELLS


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    items = [(1, "the QUICK word"), (1, "the QUICK word"), (2, None), (3, ""), (None, "no id"), (4, "nowhere-to-be-found"), (5, "ünïcödé Ünïcödé \U0001f600")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("row", F.lit(2))
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = RankedSearch().search(awkward.withColumn("item", F.lit(0)).withColumn("term", F.lit("x")), asked)
    assert found(got) == brute_force(rows, items, 10)
    assert RankedSearch().search(nothing, asked).count() == 0
    assert RankedSearch().search(awkward, asked.where("false")).count() == 0


def test_query_matches_its_sql(spark, duck):
    assert check.compare(spark, duck, SMALL, "op13_ranked_search").startswith("ok")
