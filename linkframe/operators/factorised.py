"""Aggregates over several multi-valued properties, without multiplying them out.

A subject with m values of one property and n of another stands in m * n rows of
their join. Counting m and n, and the sums of each, is enough: every value of the
one occurs n times, so counts and sums are those of the property times the other
properties' numbers of values. Least, greatest and distinct values don't depend
on how often a value occurs.

Rows hold what is grouped, filtered or joined. They are reduced to one row per
group and subject first; a property's values are reduced to one row per subject;
these meet by the subject, of which each side then has one row at most.
"""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.operators import aggregates as A
from linkframe.plans.bindings import ValueBinding


@dataclass(frozen=True)
class Factor:
    """The values of one property, with the columns of their subject."""

    values: object
    subject: list
    binding: object


def aggregate_factored(df, groups, subject, factors, wanted, names):
    """(rows per group, plans). ``wanted``: (name, plan or None to count subjects, its factor or None) in order."""
    keys = list(dict.fromkeys([*groups, *subject]))
    merged = [(plan, factor) for _, plan, factor in wanted if plan is not None and plan.mergeable]
    times = names.new("times")
    parts = [c for plan, factor in merged if factor is None for c in plan.computed()]
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(times), *parts)

    weights = {}
    for factor in factors:
        n = names.new("values")
        parts = [c for plan, of in merged if of is factor for c in plan.computed()]
        bound = F.count(F.when(factor.binding.is_bound(), F.lit(1))).alias(n)
        reduced = factor.values.groupBy(*factor.subject).agg(bound, *parts)
        met = [F.col(a) == F.col(b) for a, b in zip(subject, factor.subject)]
        rows = rows.join(reduced, reduce(lambda a, b: a & b, met), "left").drop(*factor.subject)
        # A subject without a value is still one row of the join.
        weights[id(factor)] = F.greatest(F.coalesce(F.col(n), F.lit(0)), F.lit(1))

    def weighted(plan, factor):
        of = [w for key, w in weights.items() if factor is None or key != id(factor)]
        weight = reduce(lambda a, b: a * b, of, F.lit(1) if factor is None else F.col(times))
        for name, part in plan.parts.items():
            if part.merge == "sum":
                yield F.sum(F.col(name) * weight).alias(name)
            else:
                yield (F.min if part.merge == "min" else F.max)(name).alias(name)

    subjects = names.new("subjects")
    parts = [c for plan, factor in merged for c in weighted(plan, factor)]
    result = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias(subjects), *parts)

    plans = []
    for name, plan, factor in wanted:
        if plan is None:
            plan = A.Aggregate({}, F.coalesce(F.col(subjects), F.lit(0)), ValueBinding(name, T.LongType()))
        elif not plan.mergeable:
            result = _with_distinct(result, df, groups, keys, subject, plan, factor, names)
        plans.append(plan)
    shown = [p.result.alias(p.binding.columns[0]) for p in plans]
    return result.select(*groups, *shown), [replace(p, parts={}) for p in plans]


def _with_distinct(result, df, groups, keys, subject, plan, factor, names):
    """Add the parts of a plan that has no partial results: values are counted once, however often they occur."""
    rows = df
    if factor is not None:
        met = [F.col(a) == F.col(b) for a, b in zip(subject, factor.subject)]
        rows = df.select(*keys).distinct().join(factor.values, reduce(lambda a, b: a & b, met), "left")
    counted = rows.groupBy(*groups).agg(*plan.computed())
    if not groups:
        return result.join(F.broadcast(counted), how="cross")  # one row each
    other = {g: names.new(f"{g}_again") for g in groups}
    counted = counted.withColumnsRenamed(other)
    same = [F.col(g).eqNullSafe(F.col(o)) for g, o in other.items()]
    return result.join(counted, reduce(lambda a, b: a & b, same), "left").drop(*other.values())
