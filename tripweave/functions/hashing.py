"""Change signatures used to skip work whose input did not change."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.text import SPACE_PATTERN

# Hashed fields in hashing order.
ATTRACTION_HASH_FIELDS = (
    "address", "closed_days", "description", "experience_guide",
    "opening_hours", "parking", "theme", "theme_tags", "title",
)
FESTIVAL_HASH_FIELDS = (
    "content_id", "description", "entity_type", "lcls_systm3", "playtime",
    "program", "source_theme", "subevent", "title", "venue",
)


def _digest(parts: list[Column]) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(*parts), 256))


def _is_list(types: Mapping[str, T.DataType], name: str) -> bool:
    return isinstance(types.get(name), T.ArrayType)


def column_types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def attraction_input_hash(schema: T.StructType) -> Column:
    """Hash of the attraction fields; lists count as their JSON text.

    All white space is dropped, the rest lower-cased.  Columns missing from
    ``schema`` count as empty.
    """
    types = column_types(schema)
    parts = []
    for name in ATTRACTION_HASH_FIELDS:
        if name not in types:
            continue
        text = F.to_json(F.col(name)) if _is_list(types, name) else F.col(name).cast("string")
        text = F.lower(F.regexp_replace(text, f"{SPACE_PATTERN}+", ""))
        parts.append(F.coalesce(text, F.lit("")))
    return _digest(parts)


def festival_input_hash(schema: T.StructType) -> Column:
    """Hash of the festival fields; lists are concatenated.

    Unlike the attraction hash only U+0020 is dropped.
    """
    types = column_types(schema)
    parts = []
    for name in FESTIVAL_HASH_FIELDS:
        if name not in types:
            continue
        text = F.array_join(F.col(name), "") if _is_list(types, name) else F.col(name).cast("string")
        text = F.lower(F.replace(text, F.lit(" "), F.lit("")))
        parts.append(F.coalesce(text, F.lit("")))
    return _digest(parts)


def payload_signature(payload: Column) -> Column:
    """Signature of a VARIANT; its JSON text has sorted object keys."""
    return F.sha2(F.to_json(payload), 256)
