"""JSON helpers over string columns holding JSON documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions._util import as_col

# What stands before the next number, strings whole, and the number. A text in which the next thing is neither is no JSON.
_TO_NUMBER = r'\G([^"0-9-]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"0-9-]*+)*+)(-?(?:0|[1-9][0-9]*)(?![0-9])(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)'
_NUMBER = "\ufdd0"  # a noncharacter of Unicode: stands before a number held as a string


def json_document(c: Column | str) -> Column:
    """JSON text as a VARIANT in which numbers keep the characters they are written with; NULL if malformed.

    A VARIANT re-formats numbers (``1.0`` may come back as ``1``, ``1e2`` as ``100.0``), so they are
    stored as marked strings; ``json_value`` and ``json_query`` take the mark off again.
    """
    clean = reduce(lambda x, mark: _replaced(x, mark, " "), ("\x01", "\x02", _NUMBER), as_col(c))
    return F.try_parse_json(F.regexp_replace(clean, _TO_NUMBER, f'$1"{_NUMBER}$2"'))


def _replaced(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def json_value(doc: Column | str, path: str = "$") -> Column:
    """Scalar at ``path`` of a ``json_document`` as the text it is written with; NULL for objects, arrays,
    JSON nulls and missing paths (trap G13)."""
    doc = as_col(doc)
    text = F.try_variant_get(doc, path, "string")
    # The kind is only looked up where the text looks like a container's.
    container = (text.startswith("{") | text.startswith("[")) & F.schema_of_variant(F.try_variant_get(doc, path, "variant")).rlike("^(OBJECT|ARRAY)")
    return F.when(~container, _replaced(text, _NUMBER, ""))


def json_query(doc: Column | str, path: str = "$") -> Column:
    """What stands at ``path`` of a ``json_document``: a scalar as text, an object or array as compact JSON
    text, its keys in ascending order and its numbers as written."""
    text = F.try_variant_get(as_col(doc), path, "string")
    inside = F.when(text.startswith("{") | text.startswith("["), F.regexp_replace(text, f'"{_NUMBER}([^"]*)"', "$1")).otherwise(text)
    return _replaced(inside, _NUMBER, "")


def json_scalar(c: Column | str, path: str = "$") -> Column:
    """``json_value`` of a JSON text, parsed once."""
    return json_value(json_document(c), path)


def json_elements(df: DataFrame, doc: str, out: str = "element") -> DataFrame:
    """One row per element of the JSON array in column ``doc``, which gives way to ``out``: the element
    as part of a ``json_document``.

    A lateral ``variant_explode``: the text is parsed once a row, without a shuffle. NULL, malformed
    text (repeated keys included) and documents that are no array have no rows.
    """
    others = [c for c in df.columns if c != doc]
    rows = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)], F.col(f"`{doc}`").alias("_doc"))
    found = rows.lateralJoin(df.sparkSession.tvf.variant_explode(json_document(F.col("_doc").outer()))).where(F.col("key").isNull())
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(others)], F.col("value").alias(out))


def json_subdoc(c: Column | str, path: str) -> Column:
    """Sub-document at ``path`` kept as JSON text."""
    return F.get_json_object(as_col(c), path)


def json_array(c: Column | str, empty_on_null: bool = True) -> Column:
    """Parse a JSON array held as text into ``array<string>`` (each element as JSON text).

    NULL or malformed input yields an empty array when ``empty_on_null`` so that an
    inner ``explode`` drops the row, matching ``IFNULL(JSON_EXTRACT_ARRAY(..), [])``.
    """
    arr = F.from_json(as_col(c), "array<string>")
    return F.coalesce(arr, F.array().cast("array<string>")) if empty_on_null else arr


def strip_json_quotes(c: Column | str) -> Column:
    """Normalise a code that may arrive as raw text or as a JSON string literal."""
    trimmed = F.regexp_replace(as_col(c), r"^\s+|\s+$", "")
    return F.regexp_replace(trimmed, r'^"(.*)"$', "$1")


def row_to_json(*cols: str | Column) -> Column:
    """Whole row (or the given columns) as one JSON object, NULL fields kept."""
    target = F.struct(*cols) if cols else F.struct("*")
    return F.to_json(target, {"ignoreNullFields": "false"})
