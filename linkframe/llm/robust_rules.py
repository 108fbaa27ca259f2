"""Quality rules as a search for multivariate outliers (column expressions only).

Five counts describe a text. Per language and source a minimum-covariance-determinant estimate gives the centre and the
scatter of the transformed counts; a text is rejected if its squared Mahalanobis distance exceeds a chi-square quantile.

The estimate starts from medians and absolute deviations and repeats concentration steps: keep the ``core`` share of the
group with the smallest distances, take the mean and covariance of those. Every step is two aggregations with partial
sums, so a group that holds a third of all rows is summed by many tasks. The table of estimates has one row a group.

Defined cases: a null text counts as an empty one; nulls in language or source form groups of their own; groups with
fewer than ``min_rows`` usable rows are estimated together, by language, and if still too few over all small groups;
a direction without variation gets the least deviation ``FLOOR``, so equal rows, single rows and empty tables are fine.
Repeated rows are judged each on its own. Columns of the input that have the name of a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Least standard deviation of each transformed statistic: log words, log word length, symbol share, log repeated lines, repeated share.
FLOOR = [0.5, 0.08, 0.04, 0.5, 0.06]
DIM = len(FLOOR)
BROADCAST_GROUPS = 10_000


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    def covered(windows: Column) -> Column:
        def marked(order: Column) -> Column:
            same = lambda p, k: (F.get(order, k - 1)["h"] == p["h"]) | (F.get(order, k + 1)["h"] == p["h"])
            return F.array_sort(F.transform(F.filter(order, lambda p, k: F.coalesce(same(p, k), F.lit(False))), lambda p: p["i"]))

        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"))
        count = F.aggregate(_let(order, marked), start, step, lambda a: a["n"])
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(count)

    windows = lambda hs: F.transform(F.sequence(F.lit(1), F.size(hs) - WINDOW + 1), lambda i: F.xxhash64(F.slice(hs, i, WINDOW)))
    found = _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)
    return F.when(F.size(words) < 2, F.lit(0).cast("long")).when(F.size(words) >= WINDOW, found).otherwise(F.lit(0).cast("long"))


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts and ``base_failed``; nothing is shuffled."""
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.btrim(body, F.lit(SPACES))
    words = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    size = F.length(body)
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        "n_symbols": (size - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _let(words, _repeat_words),
    }
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return docs.withColumns(counts).withColumn("base_failed", failed)


def features() -> list[Column]:
    """The transformed statistics: roughly symmetric, none grows with the length of the text but the first."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(F.col("n_dup_lines")),
        F.col("n_repeat_words") / words,
    ]


def chi_square(p: float, dim: int) -> float:
    """The quantile by Wilson and Hilferty's cube root."""
    a = 2 / (9 * dim)
    return dim * max(0.0, 1 - a + NormalDist().inv_cdf(p) * a**0.5) ** 3


def _chi_square_share(x: float, dim: int) -> float:
    a = 2 / (9 * dim)
    return NormalDist().cdf(((x / dim) ** (1 / 3) - (1 - a)) / a**0.5)


@dataclass(frozen=True)
class RobustRules:
    """core: share of a group that the estimate rests on; tail: chance of a clean text beyond the limit, if normal."""

    language: str = "lang"
    source: str = "source"
    core: float = 0.75
    steps: int = 4
    tail: float = 1e-7
    min_rows: int = 50

    @property
    def limit(self) -> float:
        return chi_square(1 - self.tail, DIM)

    def _keyed(self, stats: DataFrame) -> DataFrame:
        return stats.select(
            F.col(self.language).alias("lang_"), F.col(self.source).alias("source_"),
            *(x.cast("double").alias(f"x{i}") for i, x in enumerate(features())),
        )

    def _groups(self, rows: DataFrame) -> DataFrame:
        """(language, source) to the group whose estimate holds for it."""
        counts = rows.groupBy("lang_", "source_").agg(F.count(F.lit(1)).alias("n"))
        small = F.col("n") < self.min_rows
        few = counts.where(small).groupBy("lang_").agg(F.sum("n").alias("few"))
        joined = counts.alias("c").join(few.alias("f"), F.col("c.lang_").eqNullSafe(F.col("f.lang_")), "left")
        name = F.when(~small, F.to_json(F.struct("c.lang_", "c.source_"))).when(
            F.col("few") >= self.min_rows, F.to_json(F.struct("c.lang_"))
        ).otherwise(F.lit("rest"))
        return joined.select(F.col("c.lang_").alias("lang_"), F.col("c.source_").alias("source_"), name.alias("group_"))

    @staticmethod
    def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
        on = F.col("r.lang_").eqNullSafe(F.col("g.lang_")) & F.col("r.source_").eqNullSafe(F.col("g.source_"))
        return rows.alias("r").join(groups.alias("g"), on, "left").select("r.*", F.coalesce("g.group_", F.lit("rest")).alias("group_"))

    @staticmethod
    def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
        """Squared Mahalanobis distance ``d2``: forward substitution with the Cholesky factor."""
        out = rows.join(estimates, "group_")
        for i in range(DIM):
            rest = F.col(f"x{i}") - F.col(f"m{i}")
            for j in range(i):
                rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
            out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
        total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, DIM)), F.col("y0") * F.col("y0"))
        return out.select(*rows.columns, total.alias("d2"))

    @staticmethod
    def _factor(moments: DataFrame) -> DataFrame:
        """The lower Cholesky factor of covariances ``c{i}{j}``."""
        out = moments
        for i in range(DIM):
            for j in range(i + 1):
                rest = F.col(f"c{i}{j}")
                for k in range(j):
                    rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
                value = F.sqrt(F.greatest(rest, F.lit(FLOOR[i] ** 2 / 16))) if i == j else rest / F.col(f"l{j}{j}")
                out = out.withColumn(f"l{i}{j}", value)
        return out.select("group_", *(f"m{i}" for i in range(DIM)), *(f"l{i}{j}" for i in range(DIM) for j in range(i + 1)))

    def fit(self, stats: DataFrame) -> DataFrame:
        """Estimates from the rows of `describe` that pass the base rules: centre and Cholesky factor, a row a group."""
        rows = self._keyed(stats.where(~F.col("base_failed")))
        groups = materialize(self._groups(rows), "rules-groups")
        # What is joined to the rows has a row of some 30 numbers a group. Counted and few, it goes to the rows, so that
        # those of a large group stay where they are; otherwise Spark chooses.
        few = groups.count() <= BROADCAST_GROUPS
        small = lambda table: F.broadcast(table) if few else table
        rows = materialize(self._with_group(rows, small(groups)).select("group_", *(f"x{i}" for i in range(DIM))), "rules-rows")
        median = rows.groupBy("group_").agg(*(F.percentile_approx(f"x{i}", 0.5, 10000).alias(f"m{i}") for i in range(DIM)))
        spread = rows.join(small(median), "group_").groupBy("group_").agg(
            *(F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)),
            *(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10000).alias(f"a{i}") for i in range(DIM)),
        )
        cells = [(i, j) for i in range(DIM) for j in range(i + 1)]
        start = spread.withColumns({
            f"c{i}{j}": F.greatest((1.4826 * F.col(f"a{i}")) ** 2, F.lit(FLOOR[i] ** 2)) if i == j else F.lit(0.0) for i, j in cells
        })
        estimates = materialize(self._factor(start), "rules-step")
        scale = self.core / _chi_square_share(chi_square(self.core, DIM), DIM + 2)
        for _ in range(self.steps):
            near = self._distance(rows, small(estimates))
            bound = near.groupBy("group_").agg(F.percentile_approx("d2", self.core, 10000).alias("bound"))
            core = near.join(small(bound), "group_").where(F.col("d2") <= F.col("bound"))
            moments = core.groupBy("group_").agg(
                *(F.avg(f"x{i}").alias(f"m{i}") for i in range(DIM)),
                *(F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}") for i, j in cells),
            ).withColumns({f"c{i}{j}": scale * F.col(f"v{i}{j}") + (FLOOR[i] ** 2 if i == j else 0.0) for i, j in cells})
            estimates = materialize(self._factor(moments), "rules-step")
        return groups.join(estimates, "group_")

    def judge(self, stats: DataFrame, model: DataFrame) -> DataFrame:
        """Add ``distance`` (squared; null where the base rules failed) and ``kept`` to the rows of `describe`.

        A (language, source) pair unknown to the model has no estimate to fail against and is kept.
        """
        names = [c for c in stats.columns if c not in ("distance", "kept")]
        x = {f"x{i}_": e.cast("double") for i, e in enumerate(features())}
        model = model.select(*(F.col(c).alias(f"{c}__") for c in model.columns))
        # A row of some 30 numbers a group: counted and few, they go to the documents, which then stay where they are.
        if model.count() <= BROADCAST_GROUPS:
            model = F.broadcast(model)
        on = stats[self.language].eqNullSafe(model["lang___"]) & stats[self.source].eqNullSafe(model["source___"])
        out = stats.select(*names).withColumns(x).join(model, on, "left")
        for i in range(DIM):
            rest = F.col(f"x{i}_") - F.col(f"m{i}__")
            for j in range(i):
                rest = rest - F.col(f"l{i}{j}__") * F.col(f"y{j}_")
            out = out.withColumn(f"y{i}_", rest / F.col(f"l{i}{i}__"))
        total = sum((F.col(f"y{i}_") * F.col(f"y{i}_") for i in range(1, DIM)), F.col("y0_") * F.col("y0_"))
        distance = F.when(~F.col("base_failed"), total)
        kept = ~F.col("base_failed") & F.coalesce(distance <= self.limit, F.lit(True))
        return out.select(*names, distance.alias("distance"), kept.alias("kept"))
