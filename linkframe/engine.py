"""The engine: a source, its catalog, and the two ways to query them."""

import logging
from dataclasses import replace

from pyspark.errors import AnalysisException, ParseException

from linkframe.catalog import declared, discovery, shacl
from linkframe.catalog.model import Catalog, subject_field
from linkframe.config import EngineConfig
from linkframe.errors import InvalidQuery, LinkframeError, SourceError, UnsupportedClause
from linkframe.naming import variable_name
from linkframe.plans import ir
from linkframe.plans.build import QueryBuilder
from linkframe.results import QueryResult
from linkframe.sources.mapped import MappedSource
from linkframe.vocab import RDF_TYPE
from linkframe.templates import bind_parameters

log = logging.getLogger(__name__)

# What the query language can do.
FEATURES = {
    "metadata/key-constraints": True,
    "native-parameters": True,
    "case-sensitivity-string-filter-options": True,
    "left-join": True,
    "describe-fks": True,
    "expressions/integer": True,
    "test/cannot-destroy-db": True,
    "basic-aggregations": True,
    "now": True,
    "nested-queries": True,
}
_shape_cache = shacl.ShapeCache()


class Engine:
    """Query RDF classes as tables.

    ``catalog`` may be given; otherwise ``sync()`` (called on first use) makes it
    by the configured strategy. A mapped source declares its own schema.
    """

    def __init__(self, source, config=None, catalog=None, shape_cache=None):
        self.source = source
        self.config = config or EngineConfig()
        self._catalog = catalog
        self._shapes = shape_cache or _shape_cache

    # ---- metadata -------------------------------------------------------------------

    @property
    def naming(self):
        if isinstance(self.source, MappedSource) and not self.config.default_graph:
            return self.source.naming
        return self.config.naming

    @property
    def catalog(self):
        if self._catalog is None:
            self.sync()
        return self._catalog

    def sync(self):
        """(Re)build the catalog. Unknown or unusable settings fall back to auto."""
        config, naming = self.config, self.naming
        strategy = config.metadata_sync_strategy
        if strategy == "none":
            self._catalog = declared.empty_catalog(naming)
        elif strategy == "shacl":
            self._catalog = self._shacl_catalog(naming)
        else:
            schema = declared.parse_schema(config.schema_config) if strategy == "explicit" else None
            if schema is not None:
                self._catalog = declared.explicit_catalog(schema, naming, config.hide_foreign_uris)
            elif isinstance(self.source, MappedSource):
                self._catalog = self.source.catalog()
            else:
                self._catalog = discovery.discover(
                    self.source, naming, config.class_limit, config.property_limit,
                    config.sample_limit, config.hide_foreign_uris,
                )
        return self._catalog

    def _shacl_catalog(self, naming):
        config = self.config
        if not config.shacl_url:
            log.warning("the shacl strategy needs shacl_url; no tables are listed")
            return Catalog(naming)
        limits = dict(
            connect_seconds=config.shacl_connect_timeout, read_seconds=config.shacl_socket_timeout,
            max_bytes=config.shacl_max_size_mb and config.shacl_max_size_mb * 1024 * 1024,
        )
        try:
            found = self._shapes.load(config.shacl_url, config.default_language, config.shacl_annotations, **limits)
        except OSError as problem:
            raise SourceError(f"the SHACL document cannot be read: {problem}", "transport") from problem
        return shacl.shacl_catalog(found, naming, config.hide_foreign_uris)

    def describe_table(self, name):
        """Fields of one table. A class no schema lists is described from its data,
        unless the strategy rules that out: then there is only the subject, or nothing."""
        if self.catalog.table(name) is not None:
            return self.catalog.fields(name)
        strategy = self.config.metadata_sync_strategy
        if strategy == "none":
            return []
        if strategy == "shacl":
            return [subject_field()]
        iri = self.naming.absolute(name)
        found = discovery.class_fields(
            self.source, [iri], self.naming, self.config.property_limit, self.config.sample_limit,
            self.config.hide_foreign_uris)
        return [subject_field()] + [replace(f, position=i + 1) for i, f in enumerate(found[iri])]

    def invalidate_shapes(self):
        self._shapes.invalidate(self.config.shacl_url)

    # ---- structured queries ---------------------------------------------------------

    def query(self, query, expected=None, remaps=False):
        """Build a structured query. ``expected`` fixes the result columns and order;
        ``remaps=True`` adds the display value of every foreign key shown."""
        stage = ir.parse_stage(query)
        try:
            stage = self.expand_remaps(stage) if remaps else stage
        except AnalysisException as problem:
            raise InvalidQuery(str(problem)) from problem
        wanted = [c if isinstance(c, ir.ExpectedColumn) else ir.ExpectedColumn(**c) for c in expected or []]
        try:
            return QueryResult(self._builder().build(stage, wanted))
        except AnalysisException as problem:
            raise InvalidQuery(str(problem)) from problem

    def expand_remaps(self, stage):
        """Join the display field of each foreign key the stage shows."""
        remaps = self.catalog.display_remaps()
        if not remaps:
            return stage
        if stage.source_query is not None or stage.aggregations:
            return self._remapped_result(stage, remaps)
        table = self.catalog.table(stage.source_table)
        fields, joins = list(stage.fields), list(stage.joins)
        for remap in remaps:
            fk = self.catalog.field_by_id(remap.fk_field)
            target = self.catalog.field_by_id(remap.target_field)
            shown = any(f.join_alias is None and f.ref in (fk.id, fk.name) for f in stage.fields)
            if table is None or fk.table != table.name or not shown:
                continue
            alias = f"{target.table}__via__{fk.name}"
            if alias not in {j.alias for j in joins}:
                joins.append(ir.Join(alias, target.table, ir.FieldRef(fk.id)))
            fields.append(ir.FieldRef(target.id, alias))
        return replace(stage, fields=tuple(fields), joins=tuple(joins))

    def _remapped_result(self, stage, remaps):
        """A stage over the given one that adds the display value of each foreign key among its columns."""
        made = self._builder().build(stage)
        joins, shown = [], [ir.FieldRef(o.name) for o in made.outputs]
        for output in made.outputs:
            for remap in remaps:
                if output.meta is None or output.join_alias is not None or output.meta.id != remap.fk_field:
                    continue
                target = self.catalog.field_by_id(remap.target_field)
                alias = f"{target.table}__via__{output.meta.name}"
                joins.append(ir.Join(alias, target.table, ir.FieldRef(output.name)))
                shown.append(ir.FieldRef(target.id, alias))
        if not joins:
            return stage
        # The join forgets the order of its rows, so the order is asked for again.
        order = []
        for by in stage.order_by:
            if isinstance(by.by, ir.AggregationRef):
                output = made.outputs[len(made.outputs) - len(stage.aggregations) + by.by.index]
            else:
                output = made.output(by.by.ref, by.by.join_alias)
            if output is None:
                raise UnsupportedClause(f"display values of a stage sorted by {by.by.ref!r}, which it does not show")
            order.append(ir.Order(by.descending, ir.FieldRef(output.name)))
        return ir.Stage(source_query=stage, joins=tuple(joins), fields=tuple(shown), order_by=tuple(order))

    def _builder(self):
        return QueryBuilder(self.source, self.catalog, self.config.default_language, self.config.pre_aggregate)

    # ---- native queries -------------------------------------------------------------

    def views(self, spark, prefix=""):
        """Temp views for native SQL: one per class (``subject`` plus its fields)
        and ``triples`` for the whole graph."""
        for table in self.catalog.tables():
            fields = [["field", f.name, None] for f in self.catalog.fields(table.name) if not f.is_subject]
            result = self.query({"source-table": table.name, "fields": fields})
            result.to_df("declared").createOrReplaceTempView(f"{prefix}{variable_name(table.name)}")
        self.source.triples().createOrReplaceTempView(f"{prefix}triples")

    def native(self, spark, text, values=None):
        """Run Spark SQL over the views, with ``{{tag}}`` parameters."""
        bound, args = bind_parameters(text, values or {})
        try:
            return spark.sql(bound, args=args)
        except (ParseException, AnalysisException) as problem:
            raise InvalidQuery(str(problem)) from problem

    # ---- odds and ends --------------------------------------------------------------

    def ping(self):
        """True if the source answers; otherwise the failure, in plain words."""
        try:
            if hasattr(self.source, "ping"):
                return self.source.ping()
            self.source.slice(RDF_TYPE).limit(1).count()
            return True
        except LinkframeError:
            raise
        except Exception as problem:
            raise SourceError(f"Connection failed: {problem}", "transport") from problem

    def version(self):
        return "SPARQL 1.1"

    def supports(self, feature):
        return FEATURES.get(feature.lstrip(":"), False)
