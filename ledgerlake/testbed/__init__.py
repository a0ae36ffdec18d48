"""Registered stand-in queries: each library job run on the driver's generated tables.

``queries()`` maps a key to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
maps the same key to independent SQL over the same tables (DuckDB dialect).
The mapping of business concepts onto the generic tables follows SURVEY §7.4.
"""

from __future__ import annotations

from ledgerlake.testbed import ads, commerce, customers, io, quality, calendar


def queries():
    out = {}
    for mod in (calendar, customers, commerce, ads, quality, io):
        out.update(mod.QUERIES)
    return out


def oracle_sql():
    out = {}
    for mod in (calendar, customers, commerce, ads, quality, io):
        out.update(mod.ORACLE)
    return out
