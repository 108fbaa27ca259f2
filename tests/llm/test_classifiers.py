import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkframe.llm import labels, nbsvm, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_the_fold_and_the_sample(spark, documents):
    docs = documents([(i, f"text {i % 40}", "en", "a") for i in range(200)] + [(None, "no id", "en", "a"), (3, None, "en", "a")])
    marks = spark.createDataFrame([(i, int(i % 40 < 20)) for i in range(200)] + [(5, None), (None, 1), (7, 1), (7, 1)], "doc_id long, toxic int")
    fold = {r["doc_id"]: r["h"] for r in docs.select("doc_id", labels.held_out(F.col("doc_id")).alias("h")).collect()}
    import zlib
    assert all(h == (i is None or zlib.crc32(str(i).encode()) % 5 == 0) for i, h in fold.items())
    rows = labels.training_sample(docs, marks, "toxic", 1000).collect()
    assert len({r["text"] for r in rows}) == len(rows) and len(rows) <= 41
    fewer = labels.training_sample(docs, marks, "toxic", 40).count()
    assert 0 < fewer <= 40


def sentences(n, seed, biased=True):
    """Insults are toxic. In the training texts one group is mostly named beside insults."""
    rng = np.random.RandomState(seed)
    plain = ["people", "walk", "home", "today", "with", "many", "books", "and", "some", "bread"]
    rows = []
    for _ in range(n):
        toxic = int(rng.rand() < 0.4)
        words = list(rng.choice(plain, 8))
        if toxic and rng.rand() < 0.8:
            words.append(rng.choice(["idiot", "scum", "trash"]))
        if rng.rand() < (0.7 if toxic and biased else 0.05):
            words.append("muslim")
        rng.shuffle(words)
        rows.append((toxic, " ".join(words)))
    return rows


def test_the_penalty_lowers_false_positives_on_neutral_mentions(spark):
    train = spark.createDataFrame(sentences(1500, 1), "label int, text string")
    neutral = spark.createDataFrame([(g, f"many {g} people walk home today with bread") for g in ("muslim", "jewish", "hindu", "many")], "g string, text string")
    scores = {}
    for penalty in (0.0, 10.0):
        model = toxicity.Counterfactual(penalty=penalty, least_chi_square=10.0).fit(train)
        scores[penalty] = {r["g"]: r["s"] for r in neutral.select("g", model.score(F.col("text")).alias("s")).collect()}
        insult = neutral.select(model.score(F.concat("text", F.lit(" scum"))).alias("s")).first()["s"]
        assert insult > 0.9
    assert scores[0.0]["muslim"] > 0.5 > scores[10.0]["muslim"]
    spread = lambda s: max(s.values()) - min(s.values())
    assert spread(scores[10.0]) < spread(scores[0.0]) / 4


def test_newton_finds_the_minimum():
    method = toxicity.Counterfactual(identity={"g": "aa bb"}, ridge=0.5, penalty=2.0)
    seen = [(1, 5, ["aa", "x"]), (0, 7, ["bb"]), (1, 2, ["x"]), (0, 9, []), (1, 1, ["bb"])]
    model = method._solve(["x", "aa", "bb"], seen)
    w = np.array([model.weights.get(k, 0.0) for k in ("x", "aa", "bb")] + [model.bias])

    def loss(w):
        total = 0.25 * (w[:3] ** 2).sum() + 0.5e-6 * w[3] ** 2
        for y, n, hits in seen:
            z = w[3] + sum(w[("x", "aa", "bb").index(h)] for h in hits)
            total += n * (np.logaddexp(0, z) - y * z)
            for a, b in ((1, 2), (2, 1)):
                if ("x", "aa", "bb")[a] in hits:
                    total += 0.5 * 2.0 * n / 2 * ((w[a] - w[b]) ** 2 + w[a] ** 2)
        return total

    for k in range(4):
        for step in (1e-4, -1e-4):
            v = w.copy()
            v[k] += step
            assert loss(v) >= loss(w)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.RandomState(2)
    rows = [np.flatnonzero(rng.rand(12) < 0.4) for _ in range(60)]
    signs = np.where(rng.rand(60) < 0.5, 1.0, -1.0)
    scale, cost = rng.randn(12), 0.5
    w, b = nbsvm.dual_coordinate_descent(rows, signs, scale, cost, 500)
    x = np.zeros((60, 13))
    for k, r in enumerate(rows):
        x[k, r] = scale[r]
    x[:, 12] = 1

    def primal(v):
        return 0.5 * v @ v + cost * np.maximum(0, 1 - signs * (x @ v)).sum()

    v = np.append(w, b)
    best = primal(v)
    assert all(primal(v + rng.randn(13) * s) >= best - 1e-6 for s in (1e-3, 1e-2, 1e-1, 1.0) for _ in range(100))


@pytest.mark.parametrize("query, label, least", [("op1_toxicity", "toxic", 0.95), ("op4_quality_classifier", "quality", 0.99)])
def test_held_out_accuracy(spark, query, label, least):
    large = "/root/testdata/sf0.1"
    out = queries.QUERIES[query](spark, large).join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out[label]).mean() >= 0.97
    rank, y = out["score"].rank().to_numpy(), out[label].to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc >= least


def test_awkward_texts_get_scores(spark, awkward, nothing):
    train = spark.createDataFrame([(1, "good text of words"), (0, "%%% &&& ###"), (1, "more good words"), (0, ""), (1, "x " * 30_000)], "label int, text string")
    model = nbsvm.NbSvm().fit(train)
    awkward = awkward.withColumn("score", F.lit("clash"))
    rows = awkward.withColumn("score", nbsvm.score(spark, model, F.col("text"))).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert nothing.withColumn("score", nbsvm.score(spark, model, F.col("text"))).count() == 0
    other = toxicity.Counterfactual(least_chi_square=0.1).fit(train)
    rows = awkward.withColumn("score", other.score(F.col("text"))).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_without_labels_or_of_one_class(spark):
    none = spark.createDataFrame([], "label int, text string")
    one = spark.createDataFrame([(1, "a"), (1, "b")], "label int, text string")
    text = spark.createDataFrame([("a b",)], "text string")
    for data, share in ((none, 0.5), (one, 0.75)):
        assert text.select(toxicity.Counterfactual().fit(data).score(F.col("text")).alias("s")).first()["s"] == pytest.approx(share)
        assert text.select(nbsvm.score(spark, nbsvm.NbSvm().fit(data), F.col("text")).alias("s")).first()["s"] == pytest.approx(share)


def test_repeated_words_are_features():
    same = nbsvm.ngram_features("ab ab ab ab ab", 16)
    assert set(same) > set(nbsvm.ngram_features("ab ab", 16)) and len(nbsvm.ngram_features(None, 16)) == 0


def test_stage_keeps_clean_documents_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit("mine"), "doc": F.lit(1)})
    out = corpus_pipeline.quality_classifier(spark, docs, SF)
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    assert out.columns == docs.columns and {r["score"] for r in out.select("score").distinct().collect()} == {"mine"}
    lost = docs.join(out, "doc_id", "left_anti").join(marks, "doc_id").groupBy("quality").count().collect()
    lost = {r["quality"]: r["count"] for r in lost}
    assert lost.get(1, 0) <= 2 and lost[0] >= 50
