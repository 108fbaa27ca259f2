"""A DataFrame together with the query variables it carries."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from linkframe.naming import variable_name
from linkframe.plans.bindings import with_columns

SUBJECT = "subject"


class Names:
    """Hands out column names that are unique within one query."""

    def __init__(self):
        self._taken = {}

    def new(self, hint):
        base = variable_name(hint)
        n = self._taken[base] = self._taken.get(base, 0) + 1
        return base if n == 1 else self.new(f"{base}_{n}")


@dataclass(frozen=True)
class Output:
    """One visible result column."""

    name: str
    binding: object
    meta: object = None          # FieldMeta of the field shown, if it is one
    join_alias: str | None = None


@dataclass
class Frame:
    """``outputs`` lists the visible result columns in order."""

    df: DataFrame
    outputs: list = field(default_factory=list)
    aggregate_names: dict = field(default_factory=dict)     # count, sum_2, ... -> output name

    def output(self, ref, join_alias=None):
        """Find a column by field id, by name, or by the name of an aggregate."""
        if isinstance(ref, int):
            same = [o for o in self.outputs if o.meta is not None and o.meta.id == ref]
            exact = [o for o in same if o.join_alias == join_alias]
            return (exact or same or [None])[0]
        wanted = [ref, variable_name(ref)]
        if join_alias is not None:
            wanted = [variable_name(f"{join_alias}__{ref}")]
        for name in wanted:
            name = self.aggregate_names.get(name, name)
            for output in self.outputs:
                if output.name == name:
                    return output
        return None


def keep_columns(df, bindings):
    """Narrow ``df`` to the columns the given bindings stand on."""
    names = []
    for binding in bindings:
        names += [c for c in binding.columns if c not in names]
    return df.select(*names)


def rename_into(df, binding, names, hint):
    """Select expressions giving ``binding`` fresh, unambiguous column names."""
    mapping = {c: names.new(hint if i == 0 else f"{hint}_{i}") for i, c in enumerate(binding.columns)}
    return [df[c].alias(new) for c, new in mapping.items()], with_columns(binding, mapping)
