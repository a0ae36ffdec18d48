"""Column helpers: every function takes and returns ``pyspark.sql.Column``.

All helpers compose built-in Spark expressions (no Python UDF), so they stay
inside whole-stage codegen and run on the executors.
"""

from ledgerlake.functions.text import title_case, trim_ws, regex_first
from ledgerlake.functions.json import (
    json_array,
    json_document,
    json_elements,
    json_query,
    json_scalar,
    json_subdoc,
    json_value,
    row_to_json,
    strip_json_quotes,
)
from ledgerlake.functions.numeric import (
    bucket,
    money,
    n0,
    pct_change,
    ratio,
    safe_bool,
    safe_num,
    safe_ts,
)
from ledgerlake.functions.dates import days_between, local_date, utc_date

__all__ = [
    "bucket",
    "days_between",
    "json_array",
    "json_document",
    "json_elements",
    "json_query",
    "json_scalar",
    "json_subdoc",
    "json_value",
    "local_date",
    "money",
    "n0",
    "pct_change",
    "ratio",
    "regex_first",
    "row_to_json",
    "safe_bool",
    "safe_num",
    "safe_ts",
    "strip_json_quotes",
    "title_case",
    "trim_ws",
    "utc_date",
]
