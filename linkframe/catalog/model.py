"""Tables, fields, foreign keys and display remaps of an engine."""

from dataclasses import dataclass, field, replace

from linkframe import vocab as V
from linkframe.errors import InvalidQuery

SUBJECT = "subject"


@dataclass(frozen=True)
class FieldMeta:
    """``database_type`` is uri, langString or string and steers comparisons."""

    name: str
    property_iri: str | None
    database_type: str = "string"
    base_type: str = V.TEXT
    semantic_type: str | None = None
    position: int = 0
    pk: bool = False
    comment: str | None = None
    required: bool = False
    id: int | None = None
    table: str | None = None

    @property
    def is_subject(self):
        return self.name == SUBJECT

    @property
    def holds_iris(self):
        return self.semantic_type == "FK" or self.database_type == "uri"


def subject_field():
    return FieldMeta(SUBJECT, None, "uri", V.TEXT, position=0, pk=True)


@dataclass(frozen=True)
class TableMeta:
    name: str
    class_iri: str
    display_name: str
    description: str
    id: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    fk_table: str
    fk_column: str
    pk_table: str
    pk_column: str = SUBJECT


@dataclass(frozen=True)
class DisplayRemap:
    """Show ``target_field`` of the referenced table instead of the key itself."""

    fk_field: int
    name: str
    target_field: int


@dataclass
class Catalog:
    """Synced metadata. Ids are handed out in order and stay fixed per catalog."""

    naming: object
    _tables: dict = field(default_factory=dict)
    _fields: dict = field(default_factory=dict)       # table name -> {field name: FieldMeta}
    _by_id: dict = field(default_factory=dict)
    _keys: list = field(default_factory=list)
    _remaps: dict = field(default_factory=dict)       # fk field id -> DisplayRemap

    def add(self, table, fields, foreign_keys=()):
        """Register a table; positions follow the order of ``fields``, subject first."""
        table = replace(table, id=len(self._tables) + 1)
        self._tables[table.name] = table
        known = self._fields[table.name] = {}
        numbered = [subject_field()] + [replace(f, position=i + 1) for i, f in enumerate(fields)]
        for meta in numbered:
            meta = replace(meta, id=len(self._by_id) + 1, table=table.name)
            known[meta.name] = meta
            self._by_id[meta.id] = meta
        self._keys += list(foreign_keys)
        return table

    def tables(self):
        return list(self._tables.values())

    def table(self, ref):
        """By id, by (short or full) name; None if the catalog does not list it."""
        if isinstance(ref, int):
            return next((t for t in self._tables.values() if t.id == ref), None)
        short = self.naming.shorten(self.naming.absolute(ref))
        return self._tables.get(ref) or self._tables.get(short)

    def fields(self, table):
        found = self.table(table)
        return list(self._fields[found.name].values()) if found else []

    def field(self, table, name):
        found = self.table(table)
        if found is None:
            return None
        known = self._fields[found.name]
        return known.get(name) or known.get(self.naming.shorten(self.naming.absolute(name)))

    def field_by_id(self, field_id):
        if field_id not in self._by_id:
            raise InvalidQuery(f"no field has id {field_id}")
        return self._by_id[field_id]

    def foreign_keys(self):
        return list(self._keys)

    def display_remaps(self):
        return list(self._remaps.values())

    def set_display_remap(self, table, fk_column, target_table, target_column):
        """Upsert; silently skipped while either field is not synced (yet)."""
        source, target = self.field(table, fk_column), self.field(target_table, target_column)
        if source is None or target is None:
            return None
        remap = DisplayRemap(source.id, source.name, target.id)
        self._remaps[source.id] = remap
        return remap
