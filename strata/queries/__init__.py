"""Every operator as a named query over the test tables, with the SQL that states its expected result.

Modules hold ``QUERIES``: ``{name: (function, sql or None)}``. A function takes ``(spark, folder of the tables)``.
"""

from strata.queries import gold, governance, history, ml, parsing, quality, runs, streams, tables

MODULES = (gold, quality, parsing, tables, streams, governance, history, ml, runs)


def registry() -> dict:
    found = {}
    for module in MODULES:
        for name, pair in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name!r} is defined twice")
            found[name] = pair
    return found
