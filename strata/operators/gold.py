"""Joins, group-aggregates and sorts of the gold layer."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.operators import skew

_SIMPLE_AGGREGATE = re.compile(r"\s*(sum|count|avg|min|max)\s*\(\s*([A-Za-z_]\w*)\s*\)\s*", re.IGNORECASE)


def join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", skewed: bool = False) -> DataFrame:
    """Equi-join on one column named alike on both sides; of other shared columns the left one stays.

    AQE splits a hot key on either side of an inner join, but only on the preserved side of the others, and never where
    both sides are sorted already. With ``skewed`` the hot keys of a join of any type are spread (see
    :mod:`strata.operators.skew`), which reads the key columns once more beforehand.
    """
    right = right.drop(*[c for c in right.columns if c in left.columns and c != on])
    return skew.join(left, right, on, how) if skewed else left.join(right, on, how)


def join_tables(df: DataFrame, joins: Sequence[Mapping], read: Callable[[str], DataFrame],
                exists: Callable[[str], bool] = lambda name: True) -> DataFrame:
    """Apply ``{table, on, type, optional, skewed}`` joins in order. A missing table is skipped only if optional."""
    for spec in joins:
        if spec.get("optional") and not exists(spec["table"]):
            continue
        df = join(df, read(spec["table"]), spec["on"], spec.get("type", "inner"), spec.get("skewed", False))
    return df


def _aggregates(aggregations: Mapping[str, str]) -> list[Column]:
    return [F.expr(text).alias(alias) for alias, text in aggregations.items()]


def aggregate(df: DataFrame, group_by: Sequence[str], aggregations: Mapping[str, str]) -> DataFrame:
    """Group-aggregate from ``{alias: SQL text}``; without grouping columns, one row for the whole input."""
    if not aggregations:
        return df.select(*group_by).distinct() if group_by else df
    return df.groupBy(*group_by).agg(*_aggregates(aggregations))


def join_aggregate(left: DataFrame, right: DataFrame, on: str, how: str, group_by: Sequence[str],
                   aggregations: Mapping[str, str], skewed: bool = False) -> DataFrame:
    """``aggregate(join(left, right))``, with the right side summed up per key before the join where that is exact.

    That holds for an inner or left join grouped by left columns, when every aggregate is a plain sum, count, avg,
    min or max of a right column. A key with very many right rows then shrinks to one row on the map side of the
    shuffle; and since the final grouping contains the join key's partitioning, it needs no shuffle of its own when
    the key is grouped on.
    """
    naive = aggregate(join(left, right, on, how), group_by, aggregations)
    parsed = {alias: _SIMPLE_AGGREGATE.fullmatch(text) for alias, text in aggregations.items()}
    right_only = set(right.columns) - set(left.columns)
    eager = (how.lower().replace("_", "") in ("inner", "left", "leftouter")
             and bool(group_by) and set(group_by) <= set(left.columns)
             and all(m and m.group(2) in right_only for m in parsed.values())
             # A sum divided by a count has too few digits for averages of decimals with a larger scale.
             and not any(m.group(1).lower() == "avg" and isinstance(t := right.schema[m.group(2)].dataType, DecimalType)
                         and t.scale > 2 for m in parsed.values()))
    if not eager:
        return aggregate(join(left, right, on, how, skewed), group_by, aggregations) if skewed else naive
    partial, final = {}, []
    for alias, match in parsed.items():
        kind, column = match.group(1).lower(), match.group(2)
        if kind in ("sum", "avg"):
            partial[f"_sum_{column}"] = F.sum(column)
        if kind in ("count", "avg"):
            partial[f"_count_{column}"] = F.count(column)
        if kind in ("min", "max"):
            partial[f"_{kind}_{column}"] = getattr(F, kind)(column)
        total, rows = F.sum(f"_sum_{column}"), F.sum(f"_count_{column}")
        value = {"sum": lambda: total,
                 "count": lambda: F.coalesce(rows, F.lit(0)),
                 "avg": lambda: F.try_divide(total, rows),
                 "min": lambda: F.min(f"_min_{column}"),
                 "max": lambda: F.max(f"_max_{column}")}[kind]()
        final.append(value.cast(naive.schema[alias].dataType).alias(alias))
    summed = (right.filter(F.col(on).isNotNull()).groupBy(on)
              .agg(*[value.alias(name) for name, value in partial.items()]))
    return left.join(summed, on, how).groupBy(*group_by).agg(*final)


def sort(df: DataFrame, by: str | Sequence[str], ascending: bool = False) -> DataFrame:
    """Order by one or more columns, descending unless told otherwise."""
    columns = [by] if isinstance(by, str) else list(by)
    return df.orderBy(*[F.asc(c) if ascending else F.desc(c) for c in columns])


def top_n(df: DataFrame, by: str | Sequence[str], n: int, ascending: bool = False) -> DataFrame:
    """The first ``n`` rows of that order (each task keeps ``n`` rows; nothing is sorted as a whole)."""
    return sort(df, by, ascending).limit(n)
