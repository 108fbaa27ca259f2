"""Engine settings, as records or as the text form of a connection dialog."""

from dataclasses import dataclass, fields

from linkframe.catalog.shacl import DEFAULT_ANNOTATIONS
from linkframe.naming import Naming

STRATEGIES = ("auto", "none", "explicit", "shacl")


@dataclass(frozen=True)
class EngineConfig:
    default_graph: str | None = None
    default_language: str = ""
    namespace_prefixes: str = ""
    hide_foreign_uris: bool = False
    metadata_sync_strategy: str = "auto"
    schema_config: str | None = None
    shacl_url: str | None = None
    shacl_connect_timeout: int | None = None      # seconds
    shacl_socket_timeout: int | None = None       # seconds
    shacl_max_size_mb: int | None = None
    shacl_annotations: str = DEFAULT_ANNOTATIONS
    class_limit: int | None = None                # discovery: no limit unless one is given
    property_limit: int | None = None
    sample_limit: int | None = None
    pre_aggregate: str = "never"                  # or always: see plans.build

    @classmethod
    def from_details(cls, details):
        """From ``{"default-graph": "...", "class-limit": "50"}``; bad numbers mean default."""
        given = {}
        for item in fields(cls):
            value = details.get(item.name.replace("_", "-"), details.get(item.name))
            if "int" in str(item.type):
                value = whole_number(value)
            if value is not None:
                given[item.name] = value
        return cls(**given)

    @property
    def naming(self):
        return Naming.of(self.default_graph, self.namespace_prefixes)


def whole_number(value):
    try:
        return int(str(value).strip())
    except ValueError:
        return None
