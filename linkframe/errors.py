"""Error classes, and what to tell a user about a failed connection."""

import socket
import ssl
from http import HTTPStatus


class LinkframeError(Exception):
    """Base class of every error this package raises on purpose."""


class InvalidQuery(LinkframeError):
    """The query itself is wrong: unknown field, malformed clause, bad SQL."""


class UnsupportedClause(InvalidQuery):
    """A clause outside the supported query language (raised, never dropped)."""


class SourceError(LinkframeError):
    """The data source refused or failed (``kind`` is query, db or transport; ``status`` that of an HTTP answer)."""

    def __init__(self, message, kind="db", status=None):
        super().__init__(message)
        self.kind = kind
        self.status = status


#: What lies behind a failed connection, by the class of the exception.
_CAUSES = {
    ConnectionRefusedError: "nothing listens at this host and port",
    socket.gaierror: "the host name cannot be resolved",
    TimeoutError: "no answer came in time",
    ssl.SSLError: "the certificate or the TLS connection is not accepted",
}


def humanize(problem):
    """One sentence for a user, from the status or the innermost cause of an exception."""
    chain = [problem]
    while (inner := chain[-1].__cause__ or getattr(chain[-1], "reason", None)) and isinstance(inner, BaseException) and inner not in chain:
        chain.append(inner)
    for one in chain:
        status = getattr(one, "status", None) or getattr(one, "code", None)
        if status in HTTPStatus.__members__.values():
            known = HTTPStatus(status)
            return f"The endpoint answered {known.value} {known.phrase}. {known.description}".rstrip(". ") + "."
    for one in reversed(chain):
        for kind, words in _CAUSES.items():
            if isinstance(one, kind):
                return f"The endpoint cannot be reached: {words}."
    return str(problem)
