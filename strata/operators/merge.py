"""Keyed upsert and additive union of two frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def orderable(data_type: DataType) -> bool:
    """Whether values of the type can be compared (maps and variants cannot)."""
    if isinstance(data_type, ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (MapType, VariantType))


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the other columns.

    An aggregate, not a window: every task first keeps one row per key, so a key with very many rows never meets in
    one task.
    """
    first = [c for c in order_by if c in df.columns]
    rest = [f.name for f in df.schema.fields if f.name not in (*first, key) and orderable(f.dataType)]
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    picked = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*first, *rest)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def upsert(target: DataFrame, source: DataFrame, key: str, order_by: Sequence[str] = (),
           ties: str = "source") -> DataFrame:
    """Merge on key equality: a matching source row replaces the target row, all other source rows are added.

    The source is first reduced to one row per key. With ``order_by`` a target row that is later by it stays. Rows that
    tie: with ``ties="source"`` the source row wins, so the caller's order of batches decides; with ``ties="greatest"``
    they are compared by their other columns, as rows of one batch always are, and the result does not depend on how the
    input is cut into batches (of the same columns). NULL keys match nothing: those rows of both sides pass through beside
    the join. Columns only one side has are kept; a target value survives where the source lacks its column.
    """
    has_key = F.col(key).isNotNull()
    return append_evolved(
        upsert_keyed(target.filter(has_key), source.filter(has_key), key, order_by, ties),
        append_evolved(target.filter(~has_key), source.filter(~has_key)))


def later_rows(target: DataFrame, latest: DataFrame, key: str, order_by: Sequence[str], ties: str) -> DataFrame | None:
    """The keys whose target row is later than the source's; None if there is no order."""
    order = order_of(target, latest, key, order_by, ties)
    if not order:
        return None
    return target.select(key, F.struct(*order).alias("_have")).join(
        latest.select(key, F.struct(*order).alias("_new")).hint("merge"), key).filter("_have > _new").select(key)


def order_of(target: DataFrame, latest: DataFrame, key: str, order_by: Sequence[str], ties: str) -> list[str]:
    """The columns of both sides by which the later of two rows is told; none if there is no order."""
    if ties not in ("source", "greatest"):
        raise ValueError(f"ties are for the 'source' or the 'greatest' row, not {ties!r}")
    order = [c for c in order_by if c in target.columns and c in latest.columns]
    if order and ties == "greatest":
        order += [f.name for f in latest.schema.fields
                  if f.name in target.columns and f.name not in (*order, key) and orderable(f.dataType)]
    return order


def upsert_keyed(target: DataFrame, source: DataFrame, key: str, order_by: Sequence[str] = (),
                 ties: str = "source") -> DataFrame:
    """The upsert of rows that all have a key."""
    latest = latest_per_key(source, key, order_by)
    stale = later_rows(target, latest, key, order_by, ties)
    if stale is not None:
        latest = latest.join(stale, key, "left_anti")
    kept = target.join(latest.select(key), key, "left_anti")
    carried = [c for c in target.columns if c not in source.columns]
    if carried:
        latest = latest.join(target.select(key, *carried), key, "left")
    return append_evolved(kept, latest)


def append_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column that one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)
