"""Spark-native layered analytics: raw files to bronze, silver and gold tables.

Every operator is a plain ``DataFrame -> DataFrame`` function, meant to be chained with ``df.transform`` or driven
by a declarative table list (:mod:`strata.plans.manifest`).
"""

__version__ = "0.1.0"
