"""Short table/column names for IRIs, and the way back.

A default graph IRI and ``prefix=uri`` lines define what is local. A short name
is only ever produced when expanding it gives the same IRI again.
"""

import logging
import re
from dataclasses import dataclass, field

log = logging.getLogger(__name__)

SEPARATOR = "__"
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*:")
_PREFIX_LINE = re.compile(r"(?P<prefix>[A-Za-z][A-Za-z0-9_\-]*)\s*=\s*(?P<uri>\S+)")


def has_scheme(value):
    """Does the string start with any URI scheme (``http:``, ``did:``, ...)?"""
    return isinstance(value, str) and _SCHEME.match(value) is not None


def parse_prefixes(text):
    """``prefix=uri`` lines -> ``[(prefix, uri)]``, most specific namespace first.

    Unusable lines are skipped with a warning. Two prefixes that differ by one
    trailing underscore would make ``a___x`` ambiguous, so the later is refused.
    """
    kept = {}
    for line in (text or "").splitlines():
        line = line.strip()
        if not line:
            continue
        match = _PREFIX_LINE.fullmatch(line)
        if match is None:
            log.warning("ignoring malformed namespace prefix line %r", line)
            continue
        prefix, uri = match["prefix"], match["uri"]
        if prefix in kept:
            continue
        if SEPARATOR in prefix:
            log.warning("ignoring prefix %s: it contains %s", prefix, SEPARATOR)
        elif not has_scheme(uri):
            log.warning("ignoring prefix %s: %s is not absolute", prefix, uri)
        elif prefix + "_" in kept or (prefix.endswith("_") and prefix[:-1] in kept):
            log.warning("ignoring prefix %s: ambiguous next to an earlier prefix", prefix)
        else:
            kept[prefix] = uri
    return sorted(kept.items(), key=lambda pair: -len(pair[1]))


@dataclass(frozen=True)
class Naming:
    """Default graph plus namespace prefixes."""

    default_graph: str | None = None
    prefixes: list = field(default_factory=list)

    @classmethod
    def of(cls, default_graph=None, prefix_lines=None):
        return cls(default_graph or None, parse_prefixes(prefix_lines))

    def _namespaces(self):
        """(head of the short name, namespace IRI) pairs, in matching order."""
        if self.default_graph:
            yield "", self.default_graph
        for prefix, uri in self.prefixes:
            yield prefix + SEPARATOR, uri

    def absolute(self, name):
        """Expand a short name; anything with a scheme is already absolute."""
        if not name or not name.strip() or has_scheme(name):
            return name
        for prefix, uri in self.prefixes:
            head = prefix + SEPARATOR
            if name.startswith(head) and name[len(head):].strip():
                return uri + name[len(head):]
        if self.prefixes and re.match(r"[A-Za-z][A-Za-z0-9_\-]*__", name):
            log.warning("%s looks prefixed but matches no configured prefix", name)
        return (self.default_graph or "") + name

    def shorten(self, uri):
        """Shortest name that expands back to ``uri``; the IRI itself otherwise."""
        if not isinstance(uri, str):
            return uri
        for head, namespace in self._namespaces():
            if not uri.startswith(namespace):
                continue
            local = uri[len(namespace):]
            safe = bool(local.strip()) and not (head and SEPARATOR in local)
            if safe and self._expands_to(head + local, uri):
                return head + local
            if not head:
                return uri
        return uri

    def _expands_to(self, name, uri):
        if has_scheme(name):
            return False
        heads = [p + SEPARATOR for p, _ in self.prefixes]
        claimed = [h for h in heads if name.startswith(h)]
        if uri.startswith(self.default_graph or "\0") and claimed:
            return False
        return self.absolute(name) == uri

    def is_foreign(self, uri):
        """True when namespaces are configured and ``uri`` is in none of them."""
        namespaces = [ns for _, ns in self._namespaces()]
        return isinstance(uri, str) and bool(namespaces) and not uri.startswith(tuple(namespaces))


def variable_name(text):
    """A column name made of letters, digits and underscores only."""
    name = re.sub(r"[^A-Za-z0-9_]", "_", str(text if text is not None else ""))
    if not name:
        return "v"
    return "_" + name if name[0].isdigit() else name


def local_name(uri):
    """Part after the last slash or hash, for display; the IRI if that is empty."""
    tail = re.search(r"[^/#]+$", uri)
    return tail[0] if tail else uri
