"""Fields of a VARIANT column, written as SQL text.

A record has dozens of fields; one SQL expression per field keeps the driver
side of building a plan short.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.text import WHITE_SPACE

# Trimming as ``text.strip`` does it; the list holds no quote or backslash.
_TRIM = f"trim(BOTH '{WHITE_SPACE}' FROM {{}})"


def _get(column: str, path: str) -> str:
    return f"try_variant_get({column}, '$.{path}', 'string')"


def field(path: str, column: str = "rec") -> Column:
    """Text at a path, '' when absent."""
    return F.expr(f"coalesce({_get(column, path)}, '')")


def field_or_null(path: str, column: str = "rec") -> Column:
    """Text at a path, null when absent."""
    return F.expr(_get(column, path))


def stripped_field(*paths: str, column: str = "rec", default: str = "''") -> Column:
    """First path with text after stripping, else ``default``."""
    options = [f"nullif({_TRIM.format(_get(column, p))}, '')" for p in paths]
    return F.expr(f"coalesce({', '.join(options)}, {default})")


def first_field(*paths: str, column: str = "rec") -> Column:
    """First path with any text (not stripped), else ''."""
    options = [f"nullif({_get(column, p)}, '')" for p in paths]
    return F.expr(f"coalesce({', '.join(options)}, '')")


def number_field(path: str, type_name: str = "double", column: str = "rec") -> Column:
    return F.expr(f"try_variant_get({column}, '$.{path}', '{type_name}')")


def has_field(path: str, name: str, column: str = "rec") -> Column:
    """True when the object at ``path`` has the key, even with a null value."""
    return F.expr(
        f"coalesce(map_contains_key(try_variant_get({column}, '{path}', 'map<string,variant>'), '{name}'), false)"
    )
