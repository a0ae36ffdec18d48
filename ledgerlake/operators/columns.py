"""Column-shape operators: field selection, flattening, relabelling, type overrides."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def select_fields(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Keep columns by glob patterns; a leading ``!`` excludes. Last matching pattern wins.

    A column matched by no pattern is dropped when any include pattern exists,
    kept otherwise (an exclude-only list).
    """
    has_include = any(not p.startswith("!") for p in patterns)

    def keep(name: str) -> bool:
        verdict = not has_include
        for p in patterns:
            neg = p.startswith("!")
            if fnmatch.fnmatchcase(name, p[1:] if neg else p):
                verdict = not neg
        return verdict

    return df.select(*[F.col(f"`{c}`") for c in df.columns if keep(c)])


def flatten_structs(df: DataFrame, sep: str = "__") -> DataFrame:
    """Nested struct fields become top-level columns named ``a__b__c``. Arrays stay as they are."""

    def walk(schema: StructType, prefix: list[str]):
        for field in schema.fields:
            path = prefix + [field.name]
            if isinstance(field.dataType, StructType):
                yield from walk(field.dataType, path)
            else:
                ref = ".".join(f"`{p}`" for p in path)
                yield F.col(ref).alias(sep.join(path))

    return df.select(*walk(df.schema, []))


def label_columns(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Project and rename to display labels, in the order given."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in labels.items()])


def override_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Force landed column types. ``'json'`` keeps any value as JSON text (nullable string)."""
    out = {}
    for name, t in types.items():
        c = F.col(f"`{name}`")
        if t == "json":
            dtype = df.schema[name].dataType.simpleString()
            out[name] = c if dtype == "string" else F.to_json(c)
        else:
            out[name] = c.try_cast(t)
    return df.withColumns(out)


def normalise_timestamps(df: DataFrame, cols: Sequence[str], fmt: str = "yyyy-MM-dd'T'HH:mm:ssZ") -> DataFrame:
    """Parse text timestamps per field and re-emit them as ISO-8601 text; bad input -> NULL."""
    return df.withColumns(
        {
            c: F.date_format(F.try_to_timestamp(F.col(c), F.lit(fmt)), "yyyy-MM-dd'T'HH:mm:ssXXX")
            for c in cols
        }
    )


def check_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Fail fast when declared key columns are absent (trap G29)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in frame: {missing}; available: {df.columns}")
