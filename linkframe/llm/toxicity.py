"""Toxicity classifier with a counterfactual penalty.

A text is the set of its words. Words that differ most between the classes (chi-square, over the labelled sample) and the
identity terms are the features of a logistic regression. For every labelled text that names a group, each identity
term is swapped for the other terms of its category and for none, and the squared change of the score's logit is
penalised. So a term's weight is held near those of the other terms and near nothing: naming a group is no evidence.

Counting runs over all sampled rows as a shuffle with partial sums. The regression itself sees at most ``most_labelled``
rows of at most ``vocabulary`` plus the listed terms as bits, a bounded amount, and is solved exactly by Newton's method.
Scoring is column expressions over whole texts, without a shuffle.

Defined cases: a null or empty text has no words and gets the score of the bias; repeated rows are scored each; without
labels, or with one class only, the score is the smoothed share of label 1. A column with the result's name is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Identity terms by category; terms of one category can stand for each other.
IDENTITY = {
    "religion": "muslim muslims christian christians jewish jews hindu hindus buddhist buddhists atheist atheists catholic protestant sikh "
                "muslime christen juden musulman musulmans chrétien chrétiens juif juifs musulmán musulmanes cristiano cristianos judío judíos",
    "gender": "women woman men man girl girls boy boys female male transgender frauen frau männer mann femmes femme hommes homme mujeres mujer hombres hombre",
    "orientation": "gay lesbian bisexual heterosexual homosexual straight queer lgbt schwul lesbisch homosexuell lesbienne homosexuel lesbiana",
    "origin": "african american asian european mexican chinese indian arab black white latino hispanic immigrant immigrants refugee refugees "
              "german french spanish türkisch arabisch africain asiatique arabe africano asiático negro blanco",
    "age_ability": "old young elderly disabled blind deaf autistic alt jung behindert vieux jeune handicapé viejo joven discapacitado",
}


def words_of(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def logit(self, text: Column) -> Column:
        if not self.weights:
            return F.lit(self.bias)
        known = F.array(*map(F.lit, self.weights))
        table = F.create_map(*(x for w, v in self.weights.items() for x in (F.lit(w), F.lit(float(v)))))
        return F.aggregate(F.array_intersect(words_of(text), known), F.lit(self.bias), lambda a, w: a + F.element_at(table, w))

    def score(self, text: Column) -> Column:
        return 1 / (1 + F.exp(-self.logit(text)))


@dataclass(frozen=True)
class Counterfactual:
    most_labelled: int = 20_000
    vocabulary: int = 256
    least_chi_square: float = 25.0
    ridge: float = 1.0
    penalty: float = 1.0
    identity: dict[str, str] = field(default_factory=lambda: IDENTITY)

    def fit(self, sample: DataFrame) -> Model:
        """From rows (label 0/1, text), see `labels.training_sample`."""
        rows = materialize(sample.select("label", F.array_distinct(words_of(F.col("text"))).alias("words")), "toxicity-rows")
        size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(size) < 2:
            share = (size.get(1, 0) + 1) / (sum(size.values()) + 2)
            return Model({}, math.log(share / (1 - share)))
        terms = [w for group in self.identity.values() for w in group.split()]
        chosen = self._vocabulary(rows, size, terms)
        names = chosen + terms
        hits = F.array_sort(F.array_intersect("words", F.array(*map(F.lit, names))))
        # Equal rows once, with their number: no more than sampled rows, each a subset of the names.
        seen = rows.groupBy("label", hits.alias("hits")).agg(F.count(F.lit(1)).alias("n")).orderBy("label", "hits").collect()
        return self._solve(names, [(r["label"], r["n"], list(r["hits"])) for r in seen])

    def _vocabulary(self, rows: DataFrame, size: dict[int, int], terms: list[str]) -> list[str]:
        n1, n0 = float(size[1]), float(size[0])
        counts = rows.select("label", F.explode("words").alias("word")).where("word <> ''").groupBy("word").agg(
            F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
        seen = F.col("a") + F.col("b")
        n = n1 + n0
        chi = n * (F.col("a") * n0 - F.col("b") * n1) ** 2 / (n1 * n0 * seen * F.greatest(n - seen, F.lit(0.5)))
        best = counts.withColumn("chi", chi).where((F.col("chi") >= self.least_chi_square) & ~F.col("word").isin(terms))
        return [r["word"] for r in best.orderBy(F.desc("chi"), "word").limit(self.vocabulary).select("word").collect()]

    def swaps(self) -> dict[str, list[str | None]]:
        """What each identity term can be swapped for; None is leaving it out."""
        out: dict[str, list[str | None]] = {}
        for group in self.identity.values():
            members = group.split()
            for term in members:
                out.setdefault(term, []).extend([None, *(m for m in members if m != term)])
        return out

    def _solve(self, names: list[str], seen: list[tuple[int, int, list[str]]]) -> Model:
        at = {w: i for i, w in enumerate(names)}
        x = np.zeros((len(seen), len(names) + 1))
        x[:, -1] = 1
        for k, (_, _, hits) in enumerate(seen):
            x[k, [at[w] for w in hits]] = 1
        y, n = np.array([s[0] for s in seen], float), np.array([s[1] for s in seen], float)
        curve = np.eye(len(names) + 1) * self.ridge  # of the quadratic terms: ridge and the swaps' squared changes
        curve[-1, -1] = 1e-6
        for term, others in self.swaps().items():
            texts = n[x[:, at[term]] > 0].sum()
            for other in others if texts else []:
                change = np.zeros(len(names) + 1)
                change[at[term]] = 1
                if other is not None:
                    change[at[other]] = -1
                used = np.flatnonzero(change)
                curve[np.ix_(used, used)] += self.penalty * texts / len(others) * np.outer(change[used], change[used])

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float(n @ (np.logaddexp(0, z) - y * z) + 0.5 * w @ curve @ w)

        w = np.zeros(len(names) + 1)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (n * (p - y)) + curve @ w
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + curve + 1e-9 * np.eye(len(w)), gradient)
            rate, before = 1.0, loss(w)
            while loss(w - rate * step) > before and rate > 1e-6:
                rate /= 2
            w = w - rate * step
            if np.abs(step).max() < 1e-8:
                break
        return Model({name: float(v) for name, v in zip(names, w) if v}, float(w[-1]))
