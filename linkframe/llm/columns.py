"""Column expressions that several operators use."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def id_text(key: Column) -> Column:
    """A key as text; a null one is empty."""
    return F.coalesce(key.cast("string"), F.lit(""))
