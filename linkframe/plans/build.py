"""Structured query stages -> lazy DataFrames.

A stage is built in a fixed order: the rows of its own table (or inner stage),
filters that need nothing else, joins, the remaining filters, aggregation, sort,
limit, projection. Everything is DataFrame API; which join or aggregate runs how
is left to Catalyst and adaptive execution.
"""

from dataclasses import dataclass, replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.errors import InvalidQuery, UnsupportedClause
from linkframe.naming import variable_name
from linkframe.operators import aggregates as A
from linkframe.operators.factorised import Factor, aggregate_factored
from linkframe.operators.filters import narrowing, predicate, wanted_texts
from linkframe.plans import ir
from linkframe.plans.bindings import KeyBinding, TermBinding, ValueBinding
from linkframe.plans.frame import SUBJECT, Frame, Names, Output, keep_columns


@dataclass(frozen=True)
class Resolved:
    """A field reference tied to its place: own table (alias None) or a join."""

    alias: str | None
    key: str                 # property IRI, SUBJECT, or a column of the inner stage
    name: str                # variable name in the result
    meta: object = None


@dataclass(frozen=True)
class JoinStep:
    alias: str
    class_iri: str | None
    table: object
    source: Resolved         # where the foreign key lives


class QueryBuilder:
    """Builds queries over one source. ``pre_aggregate`` is never or always."""

    def __init__(self, source, catalog, language="", pre_aggregate="never"):
        self.source = source
        self.catalog = catalog
        self.language = language or ""
        self.pre_aggregate = pre_aggregate

    def build(self, query, expected=None):
        return self._stage(ir.parse_stage(query), Names(), expected)

    def _stage(self, stage, names, expected=None):
        if stage.source_query is not None:
            inner = self._stage(stage.source_query, names)
            return DerivedStage(self, stage, names, inner).build(expected)
        return BaseStage(self, stage, names).build(expected)


class StageBuilder:
    """What base and derived stages have in common."""

    def __init__(self, builder, stage, names):
        self.source = builder.source
        self.catalog = builder.catalog
        self.language = builder.language
        self.pre_aggregate = builder.pre_aggregate
        self.stage = stage
        self.names = names
        self.needed = {}             # alias -> {key: Resolved}
        self.bound = {}              # (alias, key) -> binding
        self.joins = {}              # alias -> JoinStep, in dependency order
        self.factors = []            # aggregated properties that are not joined to the rows

    # ---- hooks ----------------------------------------------------------------------

    def is_own(self, ref):
        raise NotImplementedError

    def own_field(self, ref):
        raise NotImplementedError

    def own_class(self):
        raise NotImplementedError

    def load_own(self):
        raise NotImplementedError

    def row_counter(self, name):
        raise NotImplementedError

    def projection(self, expected):
        raise NotImplementedError

    # ---- field resolution -----------------------------------------------------------

    def table_of(self, ref):
        """(table metadata or None, class IRI) of a source-table reference."""
        table = self.catalog.table(ref)
        if table is not None:
            return table, table.class_iri
        if isinstance(ref, int):
            raise InvalidQuery(f"no table has id {ref}")
        return None, self.catalog.naming.absolute(ref)

    def field_meta(self, table, ref):
        if isinstance(ref, int):
            return self.catalog.field_by_id(ref)
        if table is None:
            return None
        meta = self.catalog.field(table.name, ref)
        if meta is None:
            raise InvalidQuery(f"table {table.name} has no field {ref!r}")
        return meta

    def property_of(self, meta, ref):
        if (meta is not None and meta.is_subject) or ref == SUBJECT:
            return SUBJECT
        return meta.property_iri if meta is not None else self.catalog.naming.absolute(ref)

    def joined_field(self, alias, ref):
        step = self.joins[alias]
        meta = self.field_meta(step.table, ref)
        key = self.property_of(meta, ref)
        name = meta.name if meta is not None else ref
        shown = f"{alias}_subject" if key == SUBJECT else f"{alias}__{name}"
        return Resolved(alias, key, variable_name(shown), meta)

    def resolve(self, field):
        if field.join_alias is not None and field.join_alias in self.joins:
            return self.joined_field(field.join_alias, field.ref)
        return self.own_field(field)

    def need(self, resolved):
        self.needed.setdefault(resolved.alias, {}).setdefault(resolved.key, resolved)
        return resolved

    def binding(self, resolved):
        """The binding of a loaded field; ``subject`` of a join is the key it joins on."""
        if resolved.alias is not None and resolved.key == SUBJECT:
            return self.binding(self.joins[resolved.alias].source)
        return self.bound[(resolved.alias, resolved.key)]

    def lookup(self, field):
        """(binding, holds_iris) of a field, as filters want it."""
        resolved = self.resolve(field)
        binding = self.binding(resolved)
        declared = resolved.meta is not None and resolved.meta.holds_iris
        inherent = isinstance(binding, KeyBinding) or (isinstance(binding, TermBinding) and binding.node)
        return binding, declared or inherent

    # ---- joins ----------------------------------------------------------------------

    def order_joins(self):
        """Each join after the join that provides its foreign key."""
        tables = {j.alias: self.table_of(j.source_table) if j.source_table is not None else (None, None)
                  for j in self.stage.joins}
        if len(tables) != len(self.stage.joins):
            raise InvalidQuery("two joins share an alias")
        waiting = list(self.stage.joins)
        while waiting:
            ready = [j for j in waiting if self.fk_alias(j, tables) not in {w.alias for w in waiting}]
            if not ready:
                raise InvalidQuery("joins depend on each other in a circle")
            for join in ready:
                self.joins[join.alias] = self.join_step(join, tables)
                waiting.remove(join)

    def fk_alias(self, join, tables):
        """Alias of the join that holds the foreign key, or None for the own table."""
        if join.key.join_alias is not None:
            return join.key.join_alias if join.key.join_alias in tables else None
        if self.is_own(join.key.ref):
            return None
        for alias, (table, _) in tables.items():
            if alias != join.alias and table is not None and self.belongs_to(table, join.key.ref):
                return alias
        return None

    def belongs_to(self, table, ref):
        if isinstance(ref, int):
            return self.catalog.field_by_id(ref).table == table.name
        return self.catalog.field(table.name, ref) is not None

    def join_step(self, join, tables):
        table, class_iri = tables[join.alias]
        if join.target is not None:
            target = self.field_meta(table, join.target.ref)
            if self.property_of(target, join.target.ref) != SUBJECT:
                raise UnsupportedClause(f"join {join.alias} must meet the subject of its table")
        alias = self.fk_alias(join, tables)
        source = self.joined_field(alias, join.key.ref) if alias else self.own_field(join.key)
        if alias is None and source.key == SUBJECT and self.own_class() is not None:
            raise UnsupportedClause(f"join {join.alias} does not start at a foreign key")
        return JoinStep(join.alias, class_iri, table, source)

    def fk_alias_of_field(self, fk_field):
        """Alias of the join that follows the given foreign key field."""
        for join in self.stage.joins:
            meta = self.joins[join.alias].source.meta
            if join.key.ref == fk_field or (meta is not None and fk_field in (meta.id, meta.name)):
                return join.alias
        return None

    def may_repeat_rows(self, step):
        """Does following this foreign key matter even if nothing else is read?"""
        owner = self.joins[step.source.alias].class_iri if step.source.alias else self.own_class()
        return self.source.multi_valued(owner, step.source.key)

    def load_joins(self, df):
        for alias, step in self.joins.items():
            if alias not in self.needed:
                continue
            wanted = {k: r for k, r in self.needed[alias].items() if k != SUBJECT}
            df, bound = self.source.attach(
                df, self.binding(step.source), {k: r.name for k, r in wanted.items()}, self.names, alias
            )
            self.take(alias, bound, wanted)
        return df

    def take(self, alias, bound, wanted):
        for key, binding in bound.items():
            meta = wanted[key].meta
            if isinstance(binding, TermBinding) and meta is not None:
                binding = replace(binding, declared=meta.base_type)
            self.bound[(alias, key)] = binding

    # ---- the stage ------------------------------------------------------------------

    def build(self, expected=None):
        stage = self.stage
        self.order_joins()
        early, late = self.split_filter()
        for part in early:
            # Properties a filter reads are joined first: rows it drops then
            # never reach the joins of the properties that are only shown.
            for field in ir.filter_fields(part):
                self.need(self.resolve(field))
        outputs = None
        if stage.aggregations:
            self.factors = self.choose_factors()
            for field in list(stage.breakouts) + [a.field for a in stage.aggregations if a.field]:
                if self.resolve(field) not in self.factors:
                    self.need(self.resolve(field))
        else:
            outputs = self.projection(expected)
        for field in ir.filter_fields(stage.filter):
            self.need(self.resolve(field))
        for order in stage.order_by:
            if isinstance(order.by, ir.FieldRef):
                self.need(self.resolve(order.by))
        for step in reversed(list(self.joins.values())):
            if step.alias in self.needed or self.may_repeat_rows(step):
                self.need(step.source)

        df = self.load_own()
        df = self.keep_language(df, [None])
        df = self.where(df, early)
        if not stage.aggregations:
            df = self.load_joins(df)
            df = self.keep_language(df, self.joins)
            df = self.where(df, late)
            return self.finish_rows(df, outputs)
        return self.finish_groups(df, late)

    def split_filter(self):
        """Conditions on own fields only, and those that need a join."""
        early, late = [], []
        for part in ir.conjuncts(self.stage.filter):
            own = True
            try:
                own = all(self.resolve(f).alias is None for f in ir.filter_fields(part))
            except InvalidQuery:
                # Perhaps a name that only an expected column introduces.
                own = False
            (early if own else late).append(part)
        return early, late

    def where(self, df, parts):
        for part in parts:
            test, scan_test = predicate(part, self.lookup), narrowing(part, self.lookup)
            df = df.where(test if scan_test is None else scan_test & test)
        return df

    def keep_language(self, df, aliases):
        """Drop rows whose bound text is in another language (never an untagged one).

        The test stands above the left join on purpose: a subject that has the
        text only in other languages leaves the result, it is not set to NULL.
        """
        if not self.language.strip():
            return df
        for alias in aliases:
            for key, resolved in self.needed.get(alias, {}).items():
                tagged = resolved.meta is not None and resolved.meta.database_type == "langString"
                test = self.bound[(alias, key)].language_is(self.language) if tagged and key != SUBJECT else None
                if test is not None:
                    df = df.where(test)
        return df

    def finish_rows(self, df, outputs):
        stage = self.stage
        shown = []
        for output in outputs:
            if output.binding is None:            # a column nothing resolves to
                column = self.names.new(output.name)
                df = df.withColumn(column, F.lit(None).cast("string"))
                shown.append(replace(output, binding=ValueBinding(column, T.StringType())))
            else:
                shown.append(replace(output, binding=self.binding(output.binding)))
        if stage.breakouts and not stage.fields:
            keys = [c for o in shown for c in o.binding.columns]
            df = df.select(*dict.fromkeys(keys)).distinct()
        df = self.sort(df, lambda by: self.binding(self.resolve(by)), self.tie_columns(shown))
        if stage.limit is not None:
            df = df.limit(stage.limit)
        return Frame(keep_columns(df, [o.binding for o in shown]), unique_names(shown))

    def choose_factors(self):
        """Properties that can be aggregated per subject, see BaseStage."""
        return []

    def finish_groups(self, df, late):
        groups = list(dict.fromkeys(self.resolve(f) for f in self.stage.breakouts))
        if self.factors:
            return self.finish_factored(df, groups, late)
        own_only = all(a.field is None or self.resolve(a.field).alias is None for a in self.stage.aggregations)
        plans = self.plan_aggregates() if own_only else []
        grouped_early = own_only and self.should_pre_aggregate(groups, late, plans)
        if grouped_early:
            df = self.group_early(df, groups, late, plans)
        df = self.load_joins(df)
        df = self.keep_language(df, self.joins)
        df = self.where(df, late)
        if not own_only:
            plans = self.plan_aggregates()
        columns = list(dict.fromkeys(c for g in groups for c in self.binding(g).columns))
        parts = [p for plan in plans for p in (plan.merged() if grouped_early else plan.computed())]
        df = df.groupBy(*columns).agg(*parts)
        df = df.select(*columns, *[p.result.alias(p.binding.columns[0]) for p in plans])
        return self.grouped(df, groups, plans)

    def grouped(self, df, groups, plans):
        """Sort, limit and name the result of an aggregation."""
        stage = self.stage
        columns = list(dict.fromkeys(c for g in groups for c in self.binding(g).columns))
        shown = [Output(g.name, self.binding(g), g.meta, g.alias) for g in groups]
        shown += [Output(f"ag_{i}", plan.binding) for i, plan in enumerate(plans)]

        def sort_binding(by):
            if isinstance(by, ir.AggregationRef):
                if not 0 <= by.index < len(plans):
                    raise InvalidQuery(f"there is no aggregation {by.index}")
                return plans[by.index].binding
            if self.resolve(by) not in groups:
                raise InvalidQuery(f"{by.ref!r} is neither grouped nor aggregated")
            return self.binding(self.resolve(by))

        df = self.sort(df, sort_binding, columns)
        if stage.limit is not None:
            df = df.limit(stage.limit)
        shown = unique_names(shown)
        made = [o.name for o in shown[len(groups):]]
        return Frame(df, shown, dict(zip(ir.aggregation_names(stage.aggregations), made)))

    def plan_aggregates(self):
        plans = []
        for i, agg in enumerate(self.stage.aggregations):
            name = self.names.new(f"ag_{i}")
            if agg.field is None:
                plans.append(self.row_counter(name))
            else:
                plans.append(A.aggregate(agg.op, self.binding(self.resolve(agg.field)), name, self.names))
        return plans

    def sort(self, df, binding_of, tie_columns):
        """Unbound sorts first ascending and last descending.

        A full sort splits the rows by ranges of its keys, and rows with equal
        keys stay together. Equal keys are therefore told apart by a hash, so
        that a value shared by a great part of the rows is still many ranges.
        """
        if not self.stage.order_by:
            return df
        keys = []
        for order in self.stage.order_by:
            key = binding_of(order.by).sort_key()
            keys.append(key.desc_nulls_last() if order.descending else key.asc_nulls_first())
        if self.stage.limit is None and tie_columns:
            keys.append(F.xxhash64(*dict.fromkeys(tie_columns)))
        return df.orderBy(*keys)

    def tie_columns(self, shown):
        """Columns that tell apart rows with equal sort keys: what is shown."""
        return [c for o in shown for c in o.binding.columns]

    # ---- aggregation below the join -------------------------------------------------

    def should_pre_aggregate(self, groups, late, plans):
        """Aggregate by foreign key before the join, if the caller asks for it.

        It pays where the keys are far fewer than the rows: these then shrink
        before they move. Where they are not it is one more shuffle, and only the
        caller knows, so nothing is guessed from the size of a table.
        """
        if self.pre_aggregate != "always" or self.source.fans_out:
            return False
        if not all(p.mergeable for p in plans):
            return False
        if any(g.alias is None and g.key == SUBJECT for g in groups):
            return False
        return any(s.source.alias is None and self.uses(s.alias) for s in self.joins.values())

    def uses(self, alias):
        return any(k != SUBJECT for k in self.needed.get(alias, {}))

    def group_early(self, df, groups, late, plans):
        kept = [g for g in groups if g.alias is None]
        kept += [r for part in late for r in map(self.resolve, ir.filter_fields(part)) if r.alias is None]
        kept += [s.source for s in self.joins.values() if s.source.alias is None and s.alias in self.needed]
        columns = [c for r in kept for c in self.binding(r).columns]
        return df.groupBy(*dict.fromkeys(columns)).agg(*[c for p in plans for c in p.computed()])


class BaseStage(StageBuilder):
    """A stage over one class."""

    def __init__(self, builder, stage, names):
        super().__init__(builder, stage, names)
        self.table, self.class_iri = self.table_of(stage.source_table)
        self.subject = Resolved(None, SUBJECT, SUBJECT)

    def is_own(self, ref):
        if isinstance(ref, int):
            table = self.catalog.field_by_id(ref).table
            return self.table is None or table == self.table.name
        return self.table is None or self.catalog.field(self.table.name, ref) is not None

    def own_field(self, field):
        if field.join_alias is not None:
            raise InvalidQuery(f"no join is called {field.join_alias!r}")
        if not self.is_own(field.ref):
            return self.through_only_join(field)
        meta = self.field_meta(self.table, field.ref)
        key = self.property_of(meta, field.ref)
        if key == SUBJECT:
            return replace(self.subject, meta=meta)
        return Resolved(None, key, variable_name(meta.name if meta is not None else field.ref), meta)

    def through_only_join(self, field):
        """A field of another table without an alias means the one join of that table."""
        homes = [s.alias for s in self.joins.values()
                 if s.table is not None and self.belongs_to(s.table, field.ref)]
        if len(homes) != 1:
            raise InvalidQuery(f"field {field.ref!r} belongs to no table of this stage")
        return self.joined_field(homes[0], field.ref)

    def own_class(self):
        return self.class_iri

    def load_own(self):
        wanted = {k: r for k, r in self.needed.get(None, {}).items() if k != SUBJECT}
        def place(ref):
            resolved = self.resolve(ref)
            return resolved.key if resolved.alias is None else None

        only = wanted_texts(self.split_filter()[0], place)
        df, subject, bound = self.source.scan(
            self.class_iri, {k: r.name for k, r in wanted.items()}, self.names, only
        )
        self.bound[(None, SUBJECT)] = subject
        self.take(None, bound, wanted)
        return df

    def row_counter(self, name):
        """Arg-less count counts subjects; without fan-out that is the row count."""
        subject = self.bound[(None, SUBJECT)]
        if self.rows_are_subjects(subject):
            return A.row_count(name, self.names)
        return A.distinct_count(subject, name, self.names)

    def rows_are_subjects(self, subject):
        """No property read by this stage can repeat a subject."""
        if isinstance(subject, KeyBinding) and not subject.unique:
            return False
        for alias, keys in self.needed.items():
            class_iri = self.class_iri if alias is None else self.joins[alias].class_iri
            if any(k != SUBJECT and self.source.multi_valued(class_iri, k) for k in keys):
                return False
        return True

    def choose_factors(self):
        """Aggregated properties that need not be multiplied out.

        Two properties with m and n values of a subject make m * n rows of it. A
        property that is only aggregated is counted and summed per subject
        instead, and the others' numbers of values are multiplied (see
        operators.factorised). It pays from the second fan-out on.
        """
        stage = self.stage
        rows = {self.resolve(f) for f in [*stage.breakouts, *ir.filter_fields(stage.filter)]}
        rows |= {s.source for s in self.joins.values()}
        aggregated = dict.fromkeys(self.resolve(a.field) for a in stage.aggregations if a.field is not None)
        many = lambda r: r.key != SUBJECT and self.source.multi_valued(
            self.class_iri if r.alias is None else self.joins[r.alias].class_iri, r.key)
        tagged = lambda r: r.meta is not None and r.meta.database_type == "langString" and self.language.strip()
        factors = [r for r in aggregated if r.alias is None and r not in rows and many(r) and not tagged(r)]
        others = any(many(r) for r in [*rows, *aggregated] if r not in factors)
        return factors if len(factors) + others > 1 else []

    def finish_factored(self, df, groups, late):
        df = self.load_joins(df)
        df = self.keep_language(df, self.joins)
        df = self.where(df, late)
        sides = {}
        for r in self.factors:
            values, subject, bound = self.source.values(self.class_iri, r.key, r.name, self.names)
            self.take(None, {r.key: bound}, {r.key: r})
            sides[r] = Factor(values, subject.columns, self.bound[(None, r.key)])
        wanted = []
        for i, a in enumerate(self.stage.aggregations):
            name, field = self.names.new(f"ag_{i}"), a.field and self.resolve(a.field)
            plan = None if field is None else A.aggregate(a.op, self.binding(field), name, self.names)
            wanted.append((name, plan, sides.get(field)))
        columns = list(dict.fromkeys(c for g in groups for c in self.binding(g).columns))
        subject = self.bound[(None, SUBJECT)]
        df, plans = aggregate_factored(df, columns, subject.columns, list(sides.values()), wanted, self.names)
        return self.grouped(df, groups, plans)

    def tie_columns(self, shown):
        subject = self.bound[(None, SUBJECT)]
        distinct = self.stage.breakouts and not self.stage.fields
        if distinct or (isinstance(subject, KeyBinding) and subject.hashed):
            return super().tie_columns(shown)
        return subject.columns + super().tie_columns(shown)

    def projection(self, expected):
        if expected:
            return [self.expected_output(c, i) for i, c in number_placeholders(expected, self.expected_field)]
        fields = list(self.stage.fields or self.stage.breakouts)
        resolved = [self.resolve(f) for f in fields]
        own = [r for r in resolved if r.alias is None and r.key != SUBJECT]
        joined = [r for r in resolved if r.alias is not None]
        subject = [self.subject]
        if self.stage.breakouts and not self.stage.fields and not any(r.key == SUBJECT and r.alias is None for r in resolved):
            subject = []
        chosen = list(dict.fromkeys(subject + own + joined))
        return [Output(self.need(r).name, r, r.meta, r.alias) for r in chosen]

    def expected_output(self, column, number):
        resolved = self.expected_field(column)
        if resolved is None:
            return Output(f"undefined_{number}", None)
        self.need(resolved)
        return Output(resolved.name, resolved, resolved.meta, resolved.alias)

    def expected_field(self, column):
        """The field an expected column stands for, or None if nothing resolves."""
        ref = column.id if column.id is not None else column.name
        alias = column.join_alias
        if alias is None and column.fk_field is not None:
            alias = self.fk_alias_of_field(column.fk_field)
        if ref is None or (alias is not None and alias not in self.joins):
            return None
        try:
            return self.resolve(ir.FieldRef(ref, alias))
        except InvalidQuery:
            return None


class DerivedStage(StageBuilder):
    """A stage over the result of another stage."""

    def __init__(self, builder, stage, names, inner):
        super().__init__(builder, stage, names)
        self.inner = inner
        self.expected_names = {}

    def is_own(self, ref):
        return self.inner.output(ref) is not None

    def own_field(self, field):
        output = self.inner.output(field.ref, field.join_alias)
        if output is None and isinstance(field.ref, str):
            output = self.expected_names.get(field.ref)
        if output is None:
            raise InvalidQuery(f"the inner query has no column {field.ref!r}")
        return self.inner_column(output)

    def inner_column(self, output):
        return Resolved(None, output.name, output.name, output.meta)

    def own_class(self):
        return None

    def load_own(self):
        for output in self.inner.outputs:
            self.bound[(None, output.name)] = output.binding
        return self.inner.df

    def row_counter(self, name):
        return A.row_count(name, self.names)

    def projection(self, expected):
        if expected:
            return self.reconcile(expected)
        if self.stage.fields:
            resolved = [self.resolve(f) for f in self.stage.fields]
        elif self.stage.breakouts:
            resolved = [self.resolve(f) for f in self.stage.breakouts]
        else:
            resolved = [self.inner_column(o) for o in self.inner.outputs]
        return [Output(self.need(r).name, r, r.meta, r.alias) for r in dict.fromkeys(resolved)]

    def reconcile(self, expected):
        """One column per expectation: through a join, by name, else the next unused one."""
        unused = list(self.inner.outputs)
        chosen, placeholders = [], 0
        claims = [self.claim(c) for c in expected]
        for column, claim in zip(expected, claims):
            if isinstance(claim, Resolved):
                self.need(claim)
                chosen.append(Output(claim.name, claim, claim.meta, claim.alias))
                continue
            taken = [o for o in claims if isinstance(o, Output)]
            free = [o for o in unused if o not in taken]
            output = claim if claim in unused else (free or [None])[0]
            if output is None:
                placeholders += 1
                chosen.append(Output(f"undefined_{placeholders}", None))
                continue
            unused.remove(output)
            chosen.append(Output(output.name, self.inner_column(output), output.meta, output.join_alias))
            for name in (column.name, column.alias):
                if name:
                    self.expected_names.setdefault(name, output)
        return chosen

    def claim(self, column):
        """A joined field, an inner output of that very name, or None."""
        ref = column.id if column.id is not None else column.name
        if column.join_alias in self.joins and ref is not None:
            return self.joined_field(column.join_alias, ref)
        for name in (column.id, column.alias, column.name):
            output = self.inner.output(name) if name is not None else None
            if output is not None:
                return output
        return None


def number_placeholders(expected, resolve):
    """Pair each expected column with its placeholder number (used if unresolved)."""
    count, pairs = 0, []
    for column in expected:
        if resolve(column) is None:
            count += 1
        pairs.append((count, column))
    return pairs


def unique_names(outputs):
    """Distinct result names even where two fields reduce to the same variable."""
    seen, result = {}, []
    for output in outputs:
        n = seen[output.name] = seen.get(output.name, 0) + 1
        result.append(output if n == 1 else replace(output, name=f"{output.name}_{n}"))
    return result

