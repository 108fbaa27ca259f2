"""Catalogs written by hand: the explicit JSON form, and none at all."""

import json
import logging

from linkframe.catalog.model import Catalog, FieldMeta, TableMeta
from linkframe.naming import local_name

log = logging.getLogger(__name__)


def parse_schema(text):
    """The decoded JSON, or None (with a log line) if it is blank or broken."""
    if not text or not text.strip():
        return None
    try:
        decoded = json.loads(text)
    except ValueError as problem:
        log.error("the explicit schema is not valid JSON: %s", problem)
        return None
    return decoded if isinstance(decoded, dict) else None


def explicit_catalog(schema, naming, hide_foreign=False):
    """``{"tables": [{"name": iri, "description"?: str, "fields": [iri, ...]}]}``."""
    catalog = Catalog(naming)
    for entry in schema.get("tables", []):
        iri = entry["name"]
        if hide_foreign and naming.is_foreign(iri):
            continue
        fields = [
            FieldMeta(naming.shorten(f), f)
            for f in entry.get("fields", []) if not (hide_foreign and naming.is_foreign(f))
        ]
        description = entry.get("description") or f"RDF Class: {iri} (Explicit)"
        catalog.add(TableMeta(naming.shorten(iri), iri, local_name(iri), description), fields)
    return catalog


def empty_catalog(naming):
    return Catalog(naming)
