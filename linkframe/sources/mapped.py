"""Relational tables presented as RDF classes.

Each row of a table is a resource whose IRI is the class IRI plus its key. Rows
are read straight from the table: no triples are built, a property is a column,
and a foreign key stays a native key so that joins and IRI filters run on it.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.catalog.model import Catalog, FieldMeta, ForeignKey, TableMeta
from linkframe.errors import InvalidQuery
from linkframe.naming import Naming, local_name
from linkframe import vocab as V
from linkframe.functions import terms
from linkframe.plans.bindings import KeyBinding, ValueBinding, key_iri
from linkframe.plans.frame import SUBJECT, Names, rename_into
from linkframe.sources.triples import union_all


@dataclass(frozen=True)
class Property:
    """One property: its column, and what the column means in RDF.

    ``references`` names the class whose key the column holds (for a key of several
    columns, the columns in its order); ``lang`` the column with the language tag of a
    text. An array column is multi-valued.
    """

    column: str | tuple
    references: str | None = None
    lang: str | None = None

    @property
    def columns(self):
        return (self.column,) if isinstance(self.column, str) else tuple(self.column)


@dataclass(frozen=True)
class ClassMapping:
    """A table as a class. ``key`` must identify a row (a declared primary key).

    ``key="*"`` stands for "the whole row", for tables whose rows are distinct
    but have no narrower key; the subject is then a hash of the row.
    """

    df: object
    key: tuple
    properties: dict = field(default_factory=dict)

    def column_type(self, name):
        return self.df.schema[name].dataType


class MappedSource:
    """Classes over tables. ``base`` is the namespace of classes and properties."""

    fans_out = False

    def __init__(self, base, classes):
        self.base = base
        self.naming = Naming.of(base)
        self.classes = {self.naming.absolute(name): m for name, m in classes.items()}
        self._properties = {
            iri: {self.naming.absolute(n): p for n, p in m.properties.items()}
            for iri, m in self.classes.items()
        }
        for iri, known in self._properties.items():
            for prop, mapped in known.items():
                self._check(iri, prop, mapped)

    def _check(self, class_iri, prop, mapped):
        """A reference holds as many columns as the key it points to, or it would meet wrong rows."""
        if mapped.references is None:
            if len(mapped.columns) != 1:
                raise InvalidQuery(f"property {prop} of {class_iri} has several columns but references no class")
            return
        target = self.classes.get(self.naming.absolute(mapped.references))
        if target is None:
            return
        if target.key == "*":
            raise InvalidQuery(f"property {prop} of {class_iri} references {mapped.references}, which has no key of its own")
        size = 1 if isinstance(target.key, str) else len(target.key)
        if size != len(mapped.columns):
            raise InvalidQuery(
                f"property {prop} of {class_iri} has {len(mapped.columns)} columns, the key of {mapped.references} has {size}")

    # ---- building blocks of a query -------------------------------------------------

    def scan(self, class_iri, props, names, only=None):
        """One row per resource (more for multi-valued properties read). Filters reach native columns without ``only``."""
        mapping = self._mapping(class_iri)
        subject = self._key_binding(class_iri)
        columns, binding = rename_into(mapping.df, subject, names, SUBJECT)
        selected, bound = self._select_properties(class_iri, props, names)
        df = mapping.df.select(*columns, *selected)
        df = self._explode(df, class_iri, props, bound)
        return df, binding, bound

    def values(self, class_iri, prop, hint, names):
        """The values of one property: a row each, with the binding of its subject and its own."""
        df, subject, bound = self.scan(class_iri, {prop: hint}, names)
        return df, subject, bound[prop]

    def attach(self, df, anchor, props, names, hint):
        """Left join the properties of the resource ``anchor`` points to."""
        if not isinstance(anchor, KeyBinding):
            raise InvalidQuery(f"join {hint} starts at a column that references no mapped class")
        target = anchor.class_iri
        known = self._properties.get(target, {})
        wanted = {p: h for p, h in props.items() if p in known}
        bound = {}
        if wanted:
            mapping = self._mapping(target)
            key = self._key_binding(target)
            columns, right_key = rename_into(mapping.df, key, names, f"{hint}_key")
            selected, bound = self._select_properties(target, wanted, names)
            right = mapping.df.select(*columns, *selected)
            right = self._explode(right, target, wanted, bound)
            on = [F.col(l) == F.col(r) for l, r in zip(anchor.key_columns, right_key.key_columns)]
            df = df.join(right, on, "left").drop(*right_key.key_columns)
        for prop, prop_hint in props.items():
            if prop not in bound:
                name = names.new(prop_hint)
                df = df.withColumn(name, F.lit(None).cast("string"))
                bound[prop] = ValueBinding(name, T.StringType())
        return df, bound

    def multi_valued(self, class_iri, prop):
        mapped = self._properties.get(class_iri, {}).get(prop)
        return mapped is not None and isinstance(
            self._mapping(class_iri).column_type(mapped.columns[0]), T.ArrayType
        )

    def target_of(self, class_iri, prop):
        """Class a foreign key property points to, or None."""
        mapped = self._properties.get(class_iri, {}).get(prop)
        return self.naming.absolute(mapped.references) if mapped and mapped.references else None

    def table(self, class_iri):
        return self._mapping(class_iri).df

    def repeated_keys(self):
        """``class, keys, rows``: how many declared keys stand in more than one row, and in how many rows.

        Counts trust the declaration; a class that is not all zero here breaks it. One aggregation per table.
        """
        found = []
        for iri, mapping in self.classes.items():
            key = list(self._key_binding(iri).key_columns)
            counts = mapping.df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            found.append(counts.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(
                F.lit(iri).alias("class"), "keys", "rows"))
        return union_all(found)

    # ---- details --------------------------------------------------------------------

    def _mapping(self, class_iri):
        if class_iri not in self.classes:
            raise InvalidQuery(f"no table is mapped to class {class_iri}")
        return self.classes[class_iri]

    def _key_binding(self, class_iri):
        mapping = self._mapping(class_iri)
        hashed = mapping.key == "*"
        key = tuple(mapping.df.columns) if hashed else tuple(
            [mapping.key] if isinstance(mapping.key, str) else mapping.key
        )
        types = tuple(mapping.column_type(c) for c in key)
        return KeyBinding(key, types, class_iri, class_iri + "/", hashed, unique=True)

    def _select_properties(self, class_iri, props, names):
        mapping, known = self._mapping(class_iri), self._properties[class_iri]
        selected, bound = [], {}
        for prop, hint in props.items():
            mapped = known.get(prop)
            if mapped is None:
                # A property no row has: every subject leaves it unbound.
                name = names.new(hint)
                selected.append(F.lit(None).cast("string").alias(name))
                bound[prop] = ValueBinding(name, T.StringType())
                continue
            if len(mapped.columns) > 1:
                parts = tuple(names.new(f"{hint}_{i}" if i else hint) for i in range(len(mapped.columns)))
                selected += [mapping.df[c].alias(n) for c, n in zip(mapped.columns, parts)]
                target = self.naming.absolute(mapped.references)
                types = tuple(mapping.column_type(c) for c in mapped.columns)
                bound[prop] = KeyBinding(parts, types, target, target + "/")
                continue
            name, column = names.new(hint), mapped.columns[0]
            dtype = mapping.column_type(column)
            selected.append(mapping.df[column].alias(name))
            if isinstance(dtype, T.ArrayType):
                dtype = dtype.elementType
            if mapped.references:
                target = self.naming.absolute(mapped.references)
                bound[prop] = KeyBinding((name,), (dtype,), target, target + "/")
            else:
                lang = None
                if mapped.lang:
                    lang = names.new(f"{hint}_lang")
                    selected.append(mapping.df[mapped.lang].alias(lang))
                bound[prop] = ValueBinding(name, dtype, lang)
        return selected, bound

    def _explode(self, df, class_iri, props, bound):
        """Multi-valued properties fan out; a graph is a set, so values are distinct."""
        for prop in props:
            if self.multi_valued(class_iri, prop):
                name = bound[prop].columns[0]
                rest = [c for c in df.columns if c != name]
                df = df.select(*rest, F.explode_outer(F.array_distinct(name)).alias(name))
        return df

    # ---- catalog --------------------------------------------------------------------

    def catalog(self):
        """The mapping itself is the schema: typed fields and foreign keys."""
        catalog = Catalog(self.naming)
        for class_iri, mapping in self.classes.items():
            fields, keys = [], []
            for prop, mapped in self._properties[class_iri].items():
                dtype = mapping.column_type(mapped.columns[0])
                dtype = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
                name = self.naming.shorten(prop)
                if mapped.references:
                    target = self.naming.absolute(mapped.references)
                    fields.append(FieldMeta(name, prop, "uri", V.TEXT, semantic_type="FK"))
                    keys.append(ForeignKey(self.naming.shorten(class_iri), name,
                                           self.naming.shorten(target)))
                else:
                    kind = "langString" if mapped.lang else "string"
                    fields.append(FieldMeta(name, prop, kind, ValueBinding(name, dtype).base_type()))
            table = TableMeta(self.naming.shorten(class_iri), class_iri, local_name(class_iri),
                              f"RDF Class: {class_iri} (Mapped)")
            catalog.add(table, fields, keys)
        return catalog

    # ---- the same data as triples ---------------------------------------------------

    def triples(self, class_iris=None, subject=None):
        """All properties of the classes (all if none are named) as ``s, p, o`` rows: each table is read once.

        ``subject``: those of this resource are enough.
        """
        chosen = self.classes if class_iris is None else [c for c in self.classes if c in set(class_iris)]
        chosen = [c for c in chosen if self._may_hold(c, subject)]
        if not chosen:
            return self._class_rows(next(iter(self.classes))).where(F.lit(False))
        return union_all([self._class_rows(c, subject) for c in chosen])

    triples_of = triples

    def slice(self, prop, subject=None, target=None):
        """``s, o`` rows of one predicate: only the tables that have it are read.

        ``subject`` and ``target``: IRIs that the rows asked for have as subject and object. They are compared as
        native keys, so that they reach the scan; other rows may be left out.
        """
        if prop == V.RDF_TYPE:
            found = [self._type_rows(c, subject) for c in self.classes if self._may_hold(c, subject) and target in (None, c)]
        else:
            found = [self._property_rows(c, prop, subject, target) for c in self.classes
                     if prop in self._properties[c] and self._may_hold(c, subject)]
        if found:
            return union_all(found).select("s", "o")
        some = next(iter(self.classes))
        return self._type_rows(some).where(F.lit(False)).select("s", "o")

    def stands_alone(self, class_iri):
        """Can no resource of the class be one of another class too?"""
        inside = lambda a, b: a.startswith(b + "/")
        return class_iri in self.classes and not any(inside(c, class_iri) or inside(class_iri, c) for c in self.classes)

    def holder(self, prop):
        """The only class with this property, or None."""
        found = [c for c in self.classes if prop in self._properties[c]]
        return found[0] if len(found) == 1 else None

    def wide(self, class_iri, subject, columns, only=None):
        """A class with several properties as terms, from one scan: ``columns`` maps properties to column names.

        ``only`` maps the subject (SUBJECT) or a property to texts one of which it must have; rows without may be left out.
        """
        mapping, known = self._mapping(class_iri), self._properties[class_iri]
        rows = mapping.df
        for key, texts in (only or {}).items():
            test = self._has_one(class_iri, key, texts)
            rows = rows if test is None else rows.where(test)
        cells, lists = [self._key_binding(class_iri).shown().alias(subject)], []
        for prop, name in columns.items():
            mapped = known.get(prop)
            if prop == V.RDF_TYPE:
                cells.append(terms.iri_term(class_iri, bound=True).alias(name))
            elif mapped is None:
                cells.append(F.lit(None).cast(terms.TERM_TYPE).alias(name))
            elif isinstance(mapping.column_type(mapped.columns[0]), T.ArrayType):
                values = F.filter(F.array_distinct(mapped.columns[0]), lambda v: v.isNotNull())
                cells.append(F.transform(values, self._term(class_iri, mapped)).alias(name))
                lists.append(name)
            else:
                cells.append(F.when(self._has_value(mapped), self._object(class_iri, mapped)).alias(name))
        df = rows.select(*cells)
        for name in lists:
            df = df.withColumn(name, F.explode_outer(name))
        return df

    def uses(self, class_iri):
        """Rows of a class, ``s`` and a number of values per property, with the number's column -> (property, 1 if its values
        are IRIs, else 0); None where resources of other classes may have triples of its own."""
        if not self.stands_alone(class_iri):
            return None
        mapping, cells, columns = self._mapping(class_iri), [F.lit(1)], {"n0": (V.RDF_TYPE, 1)}
        for prop, mapped in self._properties[class_iri].items():
            columns[f"n{len(cells)}"] = (prop, int(bool(mapped.references)))
            if isinstance(mapping.column_type(mapped.columns[0]), T.ArrayType):
                values = F.filter(F.array_distinct(mapped.columns[0]), lambda v: v.isNotNull())
                cells.append(F.when(F.col(mapped.columns[0]).isNotNull(), F.size(values)).otherwise(0))
            else:
                cells.append(F.when(self._has_value(mapped), 1).otherwise(0))
        numbers = [cell.cast("int").alias(name) for cell, name in zip(cells, columns)]
        return mapping.df.select(self._key_binding(class_iri).shown().alias("s"), *numbers), columns

    def described(self, class_iri):
        """``s, p, o`` rows: what joining the members of a class that stands alone with all triples gives.

        A row is moved once, to those with its key, and unfolded then: as often as its key is there.
        """
        mapping, key = self._mapping(class_iri), self._key_binding(class_iri).shown()
        names = Names()
        for column in mapping.df.columns:
            names.new(column)
        times, nth = names.new("times"), names.new("nth")
        rows = mapping.df.where(key.isNotNull()).withColumn(times, F.count(F.lit(1)).over(Window.partitionBy(key)))
        return self._unfolded(class_iri, rows.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))))

    def _has_one(self, class_iri, key, texts):
        """A test on native columns that all resources with one of the texts meet, or None."""
        if key == SUBJECT:
            return reduce(lambda a, b: a | b, [self._key_binding(class_iri).equals(x) for x in texts])
        mapped, mapping = self._properties[class_iri].get(key), self.classes[class_iri]
        if mapped is None or any(isinstance(mapping.column_type(c), T.ArrayType) for c in mapped.columns):
            return None
        if mapped.references:
            return reduce(lambda a, b: a | b, [self._reference(class_iri, mapped).equals(x) for x in texts])
        dtype = mapping.column_type(mapped.columns[0])
        return F.col(mapped.columns[0]).isin(list(texts)) if isinstance(dtype, T.StringType) else None

    def _reference(self, class_iri, mapped):
        target = self.naming.absolute(mapped.references)
        types = tuple(self.classes[class_iri].column_type(c) for c in mapped.columns)
        return KeyBinding(mapped.columns, types, target, target + "/")

    @staticmethod
    def _may_hold(class_iri, subject):
        return subject is None or subject.startswith(class_iri + "/")

    def _rows(self, class_iri, subject):
        rows = self.classes[class_iri].df
        return rows if subject is None else rows.where(self._key_binding(class_iri).equals(subject))

    def members(self, class_iri):
        """``s`` rows of one class."""
        if class_iri in self.classes:
            return self._type_rows(class_iri).select("s")
        return self.slice(V.RDF_TYPE).where(F.lit(False)).select("s")

    def _class_rows(self, class_iri, subject=None):
        """A table's rows, each unfolded into its triples."""
        return self._unfolded(class_iri, self._rows(class_iri, subject))

    def _unfolded(self, class_iri, rows):
        mapping = self.classes[class_iri]
        cells = [self._cell(F.lit(V.RDF_TYPE), terms.iri_term(class_iri, bound=True))]
        lists = []
        for prop, mapped in self._properties[class_iri].items():
            if isinstance(mapping.column_type(mapped.columns[0]), T.ArrayType):
                lists.append(F.transform(F.array_distinct(mapped.columns[0]), self._element(class_iri, prop, mapped)))
            else:
                cells.append(F.when(self._has_value(mapped), self._cell(F.lit(prop), self._object(class_iri, mapped))))
        found = F.array(*cells)
        for more in lists:
            found = F.concat(found, F.coalesce(more, F.array().cast(f"array<struct<p:string,o:{terms.TERM_TYPE}>>")))
        rows = rows.select(self._key_binding(class_iri).shown().alias("s"), F.explode(found).alias("t"))
        return rows.where(F.col("t").isNotNull()).select("s", "t.p", "t.o")

    def _term(self, class_iri, mapped):
        return lambda v: self._object(class_iri, mapped, v)

    def _element(self, class_iri, prop, mapped):
        return lambda v: F.when(v.isNotNull(), self._cell(F.lit(prop), self._object(class_iri, mapped, v)))

    @staticmethod
    def _cell(prop, term):
        return F.struct(prop.alias("p"), term.alias("o"))

    @staticmethod
    def _has_value(mapped):
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in mapped.columns])

    def _type_rows(self, class_iri, subject=None):
        return self._rows(class_iri, subject).select(
            self._key_binding(class_iri).shown().alias("s"), F.lit(V.RDF_TYPE).alias("p"), terms.iri_term(class_iri, bound=True).alias("o")
        )

    def _property_rows(self, class_iri, prop, subject=None, target=None):
        mapping, mapped = self.classes[class_iri], self._properties[class_iri][prop]
        rows, test = self._rows(class_iri, subject), None if target is None else self._has_one(class_iri, prop, [target])
        if test is not None and mapped.references:
            rows = rows.where(test)
        subject = self._key_binding(class_iri).shown()
        if isinstance(mapping.column_type(mapped.columns[0]), T.ArrayType):
            rows = rows.select(subject.alias("s"), F.explode(F.array_distinct(mapped.columns[0])).alias("value"))
            rows, subject, value = rows.where(F.col("value").isNotNull()), F.col("s"), F.col("value")
        else:
            rows, value = rows.where(self._has_value(mapped)), None
        return rows.select(
            subject.alias("s"), F.lit(prop).alias("p"), self._object(class_iri, mapped, value).alias("o")
        )

    def _object(self, class_iri, mapped, value=None):
        """The term of a property's value, which is not NULL; ``value`` is one element of an array column."""
        mapping = self.classes[class_iri]
        types = [mapping.column_type(c) for c in mapped.columns]
        values = [F.col(c) for c in mapped.columns] if value is None else [value]
        dtype = types[0].elementType if isinstance(types[0], T.ArrayType) else types[0]
        if mapped.references:
            target = self.naming.absolute(mapped.references)
            return terms.iri_term(key_iri(target + "/", values, types if value is None else [dtype]), bound=True)
        if mapped.lang:
            return terms.lang_term(values[0], F.col(mapped.lang), bound=True)
        return terms.literal_term(_lexical(values[0], dtype), _xsd_type(dtype), bound=True)


def _lexical(value, dtype):
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return value.cast("string")


def _xsd_type(dtype):
    names = {
        T.ByteType: "integer", T.ShortType: "integer", T.IntegerType: "integer",
        T.LongType: "integer", T.FloatType: "double", T.DoubleType: "double",
        T.DecimalType: "decimal", T.BooleanType: "boolean", T.DateType: "date",
        T.TimestampType: "dateTime", T.TimestampNTZType: "dateTime",
    }
    return V.XSD + names.get(type(dtype), "string")
