"""JSON payload helpers on VARIANT (parse once, read many paths) and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload(raw: Column | str) -> Column:
    """Raw text -> VARIANT; bad or empty JSON gives NULL (read as an empty object)."""
    return F.try_parse_json(F.col(raw) if isinstance(raw, str) else raw)


def vget(v: Column, path: str, typ: str = "string") -> Column:
    """A typed value at a JSON path of a VARIANT, NULL when absent or of another shape."""
    return F.try_variant_get(v, path, typ)


def vstr(v: Column, path: str) -> Column:
    """`obj.get(key, "")` for string-like scalars: missing or JSON null -> ''."""
    return F.coalesce(vget(v, path, "string"), F.lit(""))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def name_or_text(v: Column) -> Column:
    """An author given either as {"name": ...} or as a plain value -> text ('' when absent)."""
    return F.when(is_object(v), vstr(v, "$.name")).otherwise(F.coalesce(vget(v, "$", "string"), F.lit("")))


def json_path(text: Column | str, path: str, default: str | None = None) -> Column:
    """JSONPath on JSON text (`$.a.b`, `$.a[*].id`), with an optional default for NULL."""
    c = F.get_json_object(F.col(text) if isinstance(text, str) else text, path)
    return c if default is None else F.coalesce(c, F.lit(default))


def top_keys(text: Column | str) -> Column:
    """Sorted top-level keys of a JSON object text, joined by ','; NULL for invalid or non-objects."""
    return F.array_join(F.sort_array(F.json_object_keys(F.col(text) if isinstance(text, str) else text)), ",")
