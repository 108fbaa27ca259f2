"""Quality classifier: naive Bayes support vectors over character n-grams.

A text is the set of its character n-grams (1 to 3, hashed to ``2**bits`` features). Each indicator is scaled by the log
ratio of the feature's smoothed shares in the two classes. A linear hinge-loss model is fitted on the scaled indicators
by dual coordinate descent, in ``parts`` shares of the training sample at once; their weights are averaged and drawn
towards their mean size. A logistic curve over the margin gives the score.

The fit uses at most about ``most_labelled`` labelled rows (a bounded sample is enough for a linear model); the model has
``2**bits`` weights whatever the data. Whole texts are scored, where they lie, without a shuffle.

Defined cases: a null or empty text has no features and gets the score of the bias; texts in n-grams never seen likewise;
repeated rows are scored each; with no labels, or of one class only, every text scores the smoothed share of label 1.
An existing column with the result's name is replaced.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import materialize, ship
from .text import STEP, U, code_points, mix


def ngram_features(text: str | None, bits: int) -> np.ndarray:
    """The sorted set of hashed character 1-, 2- and 3-grams.

    A word equal to the one before it reads ``=``; the 1-, 2- and 3-grams of these signs are features too.
    """
    seen = np.zeros(1 << bits, bool)
    chars = code_points(text).astype(U) if text else np.empty(0, U)
    grams = chars
    for n in range(1, 4):
        if n > 1:
            grams = grams[:-1] * STEP + chars[n - 1 :]
        if not len(grams):
            break
        seen[(mix(grams + U(n)) >> U(64 - bits)).astype(np.int64)] = True
    words = text.split() if text else []
    same = np.fromiter(map(operator.eq, words, words[1:]), bool, max(len(words) - 1, 0))
    for n in range(1, 4):
        if not same.any():
            break
        seen[int(mix(np.array([n], U) * STEP)[0] >> U(64 - bits))] = True
        same = same[:-1] & same[1:]
    return np.flatnonzero(seen).astype(np.int32)


def dual_coordinate_descent(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias of ``min |w|^2 / 2 + cost * sum max(0, 1 - y (w x + b))``, x the scaled indicators and a constant 1."""
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    values = [scale[i] for i in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.RandomState(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            gradient = signs[k] * (weights[rows[k]] @ values[k] + bias) - 1
            new = min(max(alpha[k] - gradient / norms[k], 0.0), cost)
            step, alpha[k] = (new - alpha[k]) * signs[k], new
            if step:
                weights[rows[k]] += step * values[k]
                bias += step
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance of label 1 given the margin (Newton's method, slightly regularised)."""
    x = np.stack([margins, np.ones(len(margins))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(hessian, gradient)
    return max(float(w[0]), 1e-6), float(w[1])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the plain indicators: the ratio is multiplied in
    bias: float
    slope: float
    offset: float
    bits: int

    def margin(self, text: str | None) -> float:
        return float(self.weights[ngram_features(text, self.bits)].sum()) + self.bias

    def score(self, margin: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * margin + self.offset, -30), 30)))


@dataclass(frozen=True)
class NbSvm:
    bits: int = 16
    most_labelled: int = 20_000
    parts: int = 8
    smoothing: float = 1.0
    cost: float = 0.1
    epochs: int = 12
    interpolation: float = 0.25

    def fit(self, sample: DataFrame) -> Model:
        """From rows (label 0/1, text), see `labels.training_sample`."""
        spark, bits = sample.sparkSession, self.bits
        ship(spark)

        def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"label": b["label"], "share": b["share"], "items": [ngram_features(t, bits) for t in b["text"]]})

        share = F.pmod(F.xxhash64("text"), F.lit(self.parts)).cast("int")
        rows = sample.select("label", share.alias("share"), "text").mapInPandas(featured, "label int, share int, items array<int>")
        rows = materialize(rows, "nbsvm-rows")

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts = np.zeros((2, 1 << bits))
            for b in batches:
                for label, items in zip(b["label"], b["items"]):
                    counts[label, items] += 1
            used = np.flatnonzero(counts.any(0))
            yield pd.DataFrame({"item": used.astype(np.int32), "zero": counts[0, used], "one": counts[1, used]})

        # One row a feature at most, whatever the number of rows.
        counts = rows.mapInPandas(counted, "item int, zero double, one double").groupBy("item").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toPandas()
        by_label = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(by_label) < 2:
            share_of_one = (by_label.get(1, 0) + 1) / (sum(by_label.values()) + 2)
            return Model(np.zeros(1 << bits), 0.0, 1.0, math.log(share_of_one / (1 - share_of_one)), bits)
        one, zero = np.full(1 << bits, self.smoothing), np.full(1 << bits, self.smoothing)
        one[counts["item"]] += counts["one"]
        zero[counts["item"]] += counts["zero"]
        ratio = spark.sparkContext.broadcast(np.log(one / one.sum()) - np.log(zero / zero.sum()))
        cost, epochs = self.cost, self.epochs

        def fitted(part: pd.DataFrame) -> pd.DataFrame:
            part = part.assign(key=[i.tobytes() for i in part["items"]]).sort_values(["label", "key"], kind="stable")
            weights, bias = dual_coordinate_descent(list(part["items"]), np.where(part["label"] == 1, 1.0, -1.0), ratio.value, cost, epochs)
            used = np.flatnonzero(weights)
            return pd.DataFrame({"item": np.append(used, -1).astype(np.int32), "weight": np.append(weights[used], bias)})

        solved = rows.groupBy("share").applyInPandas(fitted, "item int, weight double").groupBy("item").agg(F.sum("weight").alias("weight")).toPandas()
        parts = max(1, rows.select("share").distinct().count())
        weights = np.zeros((1 << bits) + 1)
        weights[solved["item"]] = solved["weight"] / parts  # the bias is item -1
        bias, weights = float(weights[-1]), weights[:-1]
        weights = (1 - self.interpolation) * np.abs(weights).mean() * np.sign(weights) + self.interpolation * weights
        model = spark.sparkContext.broadcast((weights * ratio.value, bias))

        def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            plain, constant = model.value
            for b in batches:
                yield pd.DataFrame({"label": b["label"], "margin": [plain[i].sum() + constant for i in b["items"]]})

        seen = rows.mapInPandas(margins, "label int, margin double").toPandas()  # as many as sampled rows
        slope, offset = logistic_curve(seen["margin"].to_numpy(), seen["label"].to_numpy())
        return Model(*model.value, slope, offset, bits)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """The chance of label 1 for a text column."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([shared.value.score(shared.value.margin(t)) for t in b], dtype="float64")

    return scored(text)
