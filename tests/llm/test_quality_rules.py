import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkframe.llm import robust_rules as R


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(documents, awkward):
    rng = np.random.RandomState(3)
    made = [(i, "".join(rng.choice(list("ab \n\t#|\x0b"), rng.randint(0, 150))), "en", "a") for i in range(60)]
    made += [(100 + i, " ".join(rng.choice(list("abc"), rng.randint(8, 60))), "en", "a") for i in range(40)]
    for docs in (documents(made), awkward):
        for row in R.describe(docs).collect():
            assert tuple(row[c] for c in R.STATS) == brute(row["text"]), row["text"]


def covariance_determinant(x, steps, core, floor, scale):
    """The same estimate in numpy, with exact quantiles."""
    def rank(values, share):
        return np.sort(values)[max(0, int(np.ceil(share * len(values))) - 1)]

    centre = np.array([rank(c, 0.5) for c in x.T])
    spread = np.array([rank(np.abs(c - m), 0.5) for c, m in zip(x.T, centre)])
    cov = np.diag(np.maximum((1.4826 * spread) ** 2, np.square(floor)))
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        near = x[d <= rank(d, core)]
        centre, cov = near.mean(0), scale * np.cov(near.T, bias=True) + np.diag(np.square(floor))
    return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)


@pytest.fixture(scope="module")
def mixed(documents):
    rng = np.random.RandomState(5)
    rows = []
    for i in range(400):
        n = int(np.exp(rng.normal(5, 0.6))) + 20
        words = ["".join(rng.choice(list("abcdefgh"), rng.randint(2, 8))) for _ in range(n)]
        if i % 20 == 0:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), ["en", "de"][i % 2], "src0" if i % 3 else None))
    return documents(rows)


def test_distances_equal_numpy_and_outliers_go(mixed):
    rules = R.RobustRules()
    stats = R.materialize(R.describe(mixed), "stats")
    out = rules.judge(stats, rules.fit(stats)).select("doc_id", "lang", "source", "distance", "kept", *[
        x.cast("double").alias(f"x{i}") for i, x in enumerate(R.features())]).toPandas()
    scale = rules.core / R._chi_square_share(R.chi_square(rules.core, R.DIM), R.DIM + 2)
    for _, group in out.groupby(["lang", out["source"].fillna("")]):
        x = group[[f"x{i}" for i in range(R.DIM)]].to_numpy()
        expected = covariance_determinant(x, rules.steps, rules.core, R.FLOOR, scale)
        assert np.allclose(group["distance"], expected, rtol=1e-6)
    assert not out[out.doc_id % 20 == 0].kept.any()
    assert out[out.doc_id % 20 != 0].kept.all()


def test_awkward_rows_and_tables(spark, awkward, nothing):
    rules = R.RobustRules()
    stats = R.describe(awkward)
    out = rules.judge(stats, rules.fit(stats)).collect()
    assert len(out) == awkward.count() and all(r["kept"] is not None for r in out)
    assert not any(r["kept"] for r in out if r["n_words"] < 20)
    assert rules.judge(R.describe(nothing), rules.fit(R.describe(nothing))).count() == 0


def test_small_groups_share_an_estimate(documents):
    rng = np.random.RandomState(1)
    text = lambda: " ".join("".join(rng.choice(list("abcdef"), rng.randint(2, 8))) for _ in range(rng.randint(40, 200)))
    docs = documents([(i, text(), "en", f"s{i}") for i in range(80)] + [(99, text(), "xx", "s")])
    model = R.RobustRules().fit(R.describe(docs))
    assert model.where("lang_ = 'en'").select("group_").distinct().count() == 1
    assert {r["kept"] for r in R.RobustRules().judge(R.describe(docs), model).collect()} == {True}


def test_stage_keeps_columns_with_clashing_names(spark, mixed):
    docs = mixed.withColumns({"kept": F.lit("mine"), "n_words": F.lit(-1), "distance": F.lit("far"), "base_failed": F.lit(True), "doc": F.lit(0)})
    out = corpus_pipeline.quality_rules(spark, docs, "")
    assert out.columns == docs.columns and out.count() == 380
    assert {(r["kept"], r["n_words"]) for r in out.collect()} == {("mine", -1)}


def test_no_python_in_the_plan(mixed):
    plan = R.describe(mixed)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
