import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkframe.llm import jaccard_join as J
from linkframe.llm.components import components
from linkframe.llm.storage import bucketed
from linkframe.llm.text import shingles


def brute(rows, threshold=0.8):
    """doc place -> (places linked, smallest id of the component)."""
    sets = [frozenset(shingles(t, 5).tolist()) for _, t in rows]
    linked = [[j for j, y in enumerate(sets) if j != i and (x == y or len(x & y) >= threshold * len(x | y) - 1e-9)] for i, x in enumerate(sets)]
    least = [None] * len(rows)
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return [(rows[i][0], len(linked[i]), least[i]) for i in range(len(rows))]


def near_copies(n, seed, group, length=120, changes=4):
    rng = np.random.RandomState(seed)
    words = [f"w{group}x{k}" for k in rng.permutation(length)]
    for _ in range(n):
        copy = list(words)
        for k in rng.choice(length, rng.randint(0, changes + 1), replace=False):
            copy[k] = f"n{rng.randint(1 << 30)}"
        yield " ".join(copy)


@pytest.fixture(scope="module")
def docs(documents, awkward):
    rng = np.random.RandomState(9)
    shared = " ".join(f"licence{k}" for k in range(30))
    texts = [t for g in range(25) for t in near_copies(rng.randint(1, 6), g, g)]
    texts += list(near_copies(90, 77, 77)) + [f"{shared} " + " ".join(f"o{i}y{k}" for k in range(60)) for i in range(150)]
    texts += ["exact copy of a text with enough words"] * 40 + ["Exact copy, of a text with: enough words!", "a b c", "a b c", "A b, c", "a b d"]
    return documents([(1000 + i, t, "en", "a") for i, t in enumerate(texts)]).unionByName(awkward)


def compared(out):
    return sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"limit": 8, "block": 16, "depth": 4, "recall": 0.99999}])
def test_links_and_classes_equal_brute_force(docs, options):
    wanted = sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()]), key=repr)
    assert compared(J.ChosenPath(**options).join(docs)) == wanted


def test_small_tables(spark, documents, nothing):
    assert J.ChosenPath().join(nothing).count() == 0
    assert compared(J.ChosenPath().join(documents([(1, "alone in the world it is", "en", "a")]))) == [(1, 0, 1)]
    assert compared(J.ChosenPath().join(documents([(None, "x", "en", "a")] * 3))) == [(None, 2, None)] * 3


def test_pairs_at_the_threshold_meet_with_the_stated_chance():
    rng = np.random.RandomState(0)
    tokens = rng.randint(1, 1 << 63, 1090, dtype=np.uint64)
    a, b = tokens[:990], tokens[100:]  # similarity 890 / 1090 = 0.817
    met = sum(bool(set(J.take(a, r, 0.8).tolist()) & set(J.take(b, r, 0.8).tolist())) for r in np.arange(1, 2001, dtype=np.uint64).reshape(-1, 1))
    assert met / 2000 >= J.survival(1) - 0.05
    assert (1 - J.survival(4)) ** J.ChosenPath().runs <= 0.001


def test_further_runs_for_the_depth_reached():
    join = J.ChosenPath()
    assert [join.runs_for(k) for k in (1, 4)] == [join.runs] * 2
    for splits in range(5, join.most_splits + 1):
        missed = (1 - J.survival(join.depth)) ** join.runs + (1 - J.survival(splits)) ** join.runs_for(splits)
        assert missed <= 0.001


def test_shared_passages_that_need_more_splits_than_depth(documents):
    """Pairs exactly at the threshold, put together from passages that others share; no bucket is small or dense before the last split."""
    words = lambda g, k, n: [f"p{g}q{k}w{i}" for i in range(n)]
    pairs = 300
    rows = []
    for g in range(pairs):
        # Neighbours share a passage, so that each document meets others than its near copy.
        whole = words(g, 0, 54) + words(g // 2, 1, 50)
        rows += [(2 * g, " ".join(whole), "en", "a"), (2 * g + 1, " ".join(whole[:84]), "en", "a")]
    out = J.ChosenPath(limit=1, dense=2, depth=1, most_splits=3).join(documents(rows)).collect()
    assert all(r["n_links"] <= 1 for r in out)
    assert sum(r["n_links"] for r in out) >= 2 * (pairs - 1)


def test_sketches_let_a_pair_go_with_the_stated_chance():
    tail = sum(math.comb(64, k) * 0.1**k * 0.9 ** (64 - k) for k in range(J.ChosenPath().most_bits + 1, 65))
    assert 1.15e-7 < tail < 1.25e-7


def test_links_in_equals_sets():
    rng = np.random.RandomState(1)
    sets = [np.unique(rng.randint(0, 40, rng.randint(1, 40))).astype(np.uint32) for _ in range(60)]
    linked = J.links_in(sets, 0.5)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(np.intersect1d(x, y))
            assert linked[i, j] == (i != j and both / (len(x) + len(y) - both) >= 0.5)


def test_components_equal_union_find(spark):
    rng = np.random.RandomState(6)
    edges = [(int(a), int(b)) for a, b in rng.randint(0, 120, (90, 2))] + [(k, k + 1) for k in range(200, 260)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in out} == {x: find(x) for x in root} and len(out) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each(spark, docs):
    extra = docs.withColumns({"class_id": F.lit("x"), "mark": F.lit(1), "rows": F.lit(2), "doc": F.lit(3), "component": F.lit(4)})
    out = corpus_pipeline.near_duplicates(spark, extra, "")
    rows = out.collect()
    answers = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    heads = {c for _, _, c in answers if c is not None}
    assert out.columns == extra.columns
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == heads
    assert len(rows) == len({id(r) for r in rows}) and {r["mark"] for r in rows} == {1}
    assert math.isclose(len([r for r in rows if r["doc_id"] is None]), sum(1 for i, n, c in answers if c is None and n == 0))


def common_line(documents, n=400):
    """Documents that share a line and little else; each tenth has a near copy."""
    line = " ".join(f"licence{k}" for k in range(12))
    texts = [f"{line} " + " ".join(f"o{i}y{k}" for k in range(30)) for i in range(n)]
    return documents([(i, t, "en", "a") for i, t in enumerate(texts + [f"{t} end" for t in texts[::10]])])


def test_token_sets_are_written_twice_however_often_buckets_are_split(documents, monkeypatch):
    written, kept = [], J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, name: written.append((name, df.columns)) or kept(df, name))
    out = J.ChosenPath(limit=2, block=64, recall=0.99).join(common_line(documents)).where("n_links > 0").collect()
    assert {r["doc_id"]: r["n_links"] for r in out} == {i: 1 for i in [*range(0, 400, 10), *range(400, 440)]}
    assert [name for name, columns in written if "tokens" in columns] == ["join-rows"]  # and join-sets, bucketed by class
    assert len([name for name, _ in written if name == "join-level"]) > 1


def test_splitting_ends_where_comparing_is_less_work(spark):
    columns = "node long, rep long, size int, sketch long, second long, n long, total long, differ double"
    level = spark.createDataFrame([(1, rep, 10, 0, 0, 100, 1000, 32.0) for rep in range(100)], columns)
    leaves, deep, splits = J.ChosenPath()._split_down(level, None, 100 * 100)  # it would need the token sets to split on
    assert [leaf.count() for leaf in leaves] == [100] and deep is None and splits == 1


def test_bucketed_rows_stay_where_they_lie_in_a_join(spark):
    rows = spark.range(1000).select(F.col("id").alias("rep"), F.lit("tokens").alias("tokens"))
    few = spark.range(0, 1000, 7).groupBy(F.col("id").alias("rep")).count()
    with bucketed(rows, "rep", "test-sets") as sets:
        joined = sets.join(few.hint("shuffle_hash"), "rep")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert joined.count() == few.count()
        name = [t.name for t in spark.catalog.listTables() if "test_sets" in t.name]
    assert len(name) == 1 and not spark.catalog.tableExists(name[0])


def test_both_bits_of_sketches_let_a_pair_go_with_the_stated_chance():
    most = J.ChosenPath().most_hashes
    tail = lambda p, ks: sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in ks)
    assert 3.4e-8 < tail(0.15, range(most + 1, 65)) < 3.6e-8
    assert tail(0.75, range(most + 1)) < 3e-8  # sets without a common token; by the first bits alone 0.004
    rng = np.random.RandomState(3)
    unlike = [0, 0]
    for _ in range(200):
        (a, b), (c, d) = (J.sketch(rng.randint(1, 1 << 63, 100, dtype=np.uint64)) for _ in range(2))
        unlike = [unlike[0] + ((a ^ c) & (2**64 - 1)).bit_count(), unlike[1] + (((a ^ c) | (b ^ d)) & (2**64 - 1)).bit_count()]
    assert abs(unlike[0] / 200 - 32) < 2 and abs(unlike[1] / 200 - 48) < 2
