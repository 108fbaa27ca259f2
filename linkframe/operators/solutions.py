"""Joins of solutions that may leave shared variables unbound.

Two solutions are compatible if they agree on every variable that both bind. An
equi-join would lose rows with an unbound one, and a test "equal or unbound" is
no join key. Both sides are therefore split by which shared variables a row
binds; every pair of parts then joins on the variables that both bind, an
ordinary equi-join. A column that the plan knows to be never NULL is bound in
every row and splits nothing, so two plain patterns are joined once, as before.

A row that binds none of the shared variables would meet every row of the other
side. Such a product is refused while the query runs, never left out silently.
"""

from functools import reduce
from itertools import product

from pyspark.sql import functions as F

from linkframe.errors import UnsupportedClause

# Each variable that may be unbound doubles the parts of its side.
MOST_UNBOUND = 4


def join(left, right, parts):
    """Compatible pairs. ``parts``: shared variable -> fields of a term that decide equality."""
    if not _unbound(left, parts) and not _unbound(right, parts):
        return _on(left, right, sorted(parts), parts, "inner")
    pairs = []
    for ours, bound in _split(left, parts):
        for theirs, also in _split(right, parts):
            pairs.append(_met(ours, theirs, bound, also, parts, left, right))
    return reduce(lambda a, b: a.unionByName(b), pairs)


def left_join(left, right, parts):
    """Compatible pairs, and the rows of ``left`` that no row of ``right`` is compatible with."""
    if not _unbound(left, parts) and not _unbound(right, parts):
        return _on(left, right, sorted(parts), parts, "left")
    rows = []
    split = list(_split(right, parts))
    for ours, bound in _split(left, parts):
        if len(split) == 1 and bound:
            rows.append(_met(ours, right, bound, split[0][1], parts, left, right, "left"))
            continue
        alone = ours
        for theirs, also in split:
            rows.append(_met(ours, theirs, bound, also, parts, left, right))
            alone = _filtered(alone, theirs, bound & also, parts, "left_anti")
        missing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c not in parts]
        rows.append(alone.select("*", *missing))
    return reduce(lambda a, b: a.unionByName(b), rows)


def semi_join(left, right, parts, how):
    """``left_semi`` or ``left_anti``: rows of ``left`` with or without a compatible row of ``right``.

    A row that binds no shared variable is compatible with any row at all.
    """
    if not _unbound(left, parts) and not _unbound(right, parts):
        return _filtered(left, right, frozenset(parts), parts, how)
    split = list(_split(right, parts))
    kept = []
    for ours, bound in _split(left, parts):
        if how == "left_anti":
            kept.append(reduce(lambda rows, r: _filtered(rows, r[0], bound & r[1], parts, how), split, ours))
            continue
        # Of the parts of the right side the first that has a compatible row keeps a row, once.
        rest = ours
        for theirs, also in split:
            kept.append(_filtered(rest, theirs, bound & also, parts, how))
            rest = _filtered(rest, theirs, bound & also, parts, "left_anti")
    return reduce(lambda a, b: a.unionByName(b), kept)


def minus(left, right, parts):
    """MINUS: without the rows that are compatible with one of ``right`` and bind a variable that it binds too."""
    if not parts:
        return left
    split = list(_split(right, parts))
    kept = []
    for ours, bound in _split(left, parts):
        for theirs, also in split:
            if bound & also:
                ours = _filtered(ours, theirs, bound & also, parts, "left_anti")
        kept.append(ours)
    return reduce(lambda a, b: a.unionByName(b), kept)


def _unbound(df, parts):
    return [c for c in sorted(parts) if df.schema[c].nullable]


def _split(df, parts):
    """(rows, the shared variables that they bind) for every combination that can occur."""
    loose = _unbound(df, parts)
    if len(loose) > MOST_UNBOUND:
        raise UnsupportedClause(f"more than {MOST_UNBOUND} shared variables may be unbound: {', '.join(loose)}")
    fixed = frozenset(parts) - frozenset(loose)
    for choice in product((True, False), repeat=len(loose)):
        tests = [F.col(c).isNotNull() if yes else F.col(c).isNull() for c, yes in zip(loose, choice)]
        rows = df.where(reduce(lambda a, b: a & b, tests)) if tests else df
        yield rows, fixed | {c for c, yes in zip(loose, choice) if yes}


def _met(ours, theirs, bound, also, parts, left, right, how="inner"):
    """One pair of parts joined; the variables that only one of them binds come from that one."""
    common = bound & also
    if not common:
        return _refused(ours, theirs, parts, left, right)
    extra = sorted(frozenset(parts) - bound)
    renamed = theirs.withColumnsRenamed({c: f"_other_{c}" for c in extra})
    joined = _on(ours, renamed.drop(*[c for c in parts if c in bound and c not in common]), sorted(common), parts, how)
    return joined.select(*[
        F.col(f"_other_{c}").alias(c) if c in extra else F.col(c) for c in left.columns
    ], *[c for c in right.columns if c not in parts])


def _refused(ours, theirs, parts, left, right):
    """No rows if either side is empty, an error otherwise."""
    message = "rows that bind none of " + ", ".join(sorted(parts)) + " would be joined with every row of a pattern"
    # The test reads a column of each side, so that it stays where pairs of rows are.
    number = F.monotonically_increasing_id()
    first = theirs.select(number.alias("_there")).limit(1)
    met = F.col("_here") + F.col("_there") >= 0
    rows = ours.withColumn("_here", number).join(first, how="cross").where(F.when(met, F.raise_error(F.lit(message)).cast("boolean")))
    return rows.select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c not in parts])


def _on(left, right, shared, parts, how):
    """Equi-join on equal terms of the ``shared`` variables."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in shared})
    tests = [F.col(c)[p] == F.col(f"_right_{c}")[p] for c in shared for p in parts[c]]
    return left.join(renamed, reduce(lambda a, b: a & b, tests), how).drop(*[f"_right_{c}" for c in shared])


def _filtered(left, right, shared, parts, how):
    """Semi or anti join on the ``shared`` variables, or on there being any row where there are none.

    The right side is reduced to its distinct keys first, map-side, so a key that
    occurs there very often is no burden.
    """
    if not shared:
        return left.join(right.select(F.lit(1).alias("_any")).limit(1), F.lit(True), how)
    names = {(c, p): f"_right_{c}_{p}" for c in sorted(shared) for p in parts[c]}
    keys = right.select(*[F.col(c)[p].alias(n) for (c, p), n in names.items()]).distinct()
    tests = [F.col(c)[p] == F.col(n) for (c, p), n in names.items()]
    return left.join(keys, reduce(lambda a, b: a & b, tests), how)
