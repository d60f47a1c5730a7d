"""Type-2 history: versions with ``__start_at`` and ``__end_at``, and lookups at a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.adjacent import CHUNK, CHUNK_ROWS, adjacent_in_chunks, chunked, last_known

START, END = "__start_at", "__end_at"


def scd2(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], order_by: Sequence[str],
         unit: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Versions of the tracked columns per key from a change feed.

    ``order_by`` is a total order whose first column is the change time. A row that repeats the previous tracked
    values opens no version. The open version has a NULL end.
    """
    time = order_by[0]
    state = F.struct(*tracked)
    feed = changes.select(*dict.fromkeys((*keys, *tracked, *order_by)))
    # Cut once: the rows that open a version keep their chunks.
    feed, several = chunked(feed, keys, order_by, unit, chunk_rows)
    compared = adjacent_in_chunks(feed, several, keys, order_by, F.struct(state.alias("s")), "_before")
    opened = compared.filter(F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(state)).drop("_before")
    closed = adjacent_in_chunks(opened, several, keys, order_by, F.col(time), END, ahead=True).drop(CHUNK)
    return closed.select(*keys, *tracked, F.col(time).alias(START), *[c for c in order_by[1:] if c not in keys], END)


def scd2_merge(history: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               order_by: Sequence[str], unit: str | None = None, changes: DataFrame | None = None) -> DataFrame:
    """Bring a batch of changes into a history: versions of the touched keys are rebuilt, all others pass as they
    are. Late changes are placed where they belong in time.

    Give ``changes``, the feed that the history was built from, for the result of a full rebuild. Without it the
    versions stand for it: a change that repeated the state of its time left none, and is then not brought back by a
    late change before it.
    """
    touched = updates.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    # Null-safe: changes without a key form one history, as in ``scd2``.
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    columns = [*dict.fromkeys((*keys, *tracked, *order_by))]
    earlier = history.withColumnRenamed(START, order_by[0]) if changes is None else changes
    past = earlier.join(touched, same, "left_semi")
    rebuilt = scd2(past.select(*columns).unionByName(updates.select(*columns)).distinct(), keys, tracked, order_by,
                   unit)
    return history.join(touched, same, "left_anti").unionByName(rebuilt)


def state_at(history: DataFrame, instant: Column) -> DataFrame:
    """The versions in force at one instant (a plain range predicate, pushed to the scan)."""
    return history.filter((F.col(START) <= instant) & (F.col(END).isNull() | (F.col(END) > instant)))


def as_of(facts: DataFrame, history: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str],
          tie_break: Sequence[str] = (), unit: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each fact row the ``columns`` of its key's version in force at ``time``, NULL if there was none.

    A column that the facts have too is named ``version_<column>``.

    Facts and version starts are merged into one ordered sequence per key, so the work is linear in both. A
    range-condition join would pair every fact with every version of its key.
    """
    versions = history.select(
        *keys, F.col(START).alias(time), F.lit(0).alias("_kind"),
        F.struct(F.col(END).alias("_end"), *columns).alias("_version"),
        *[(F.col(c) if c in history.columns else F.lit(None)).alias(f"_tie_{c}") for c in tie_break])
    rows = facts.select(
        *keys, time, F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"),
        *[F.col(c).alias(f"_tie_{c}") for c in tie_break])
    merged = rows.unionByName(versions, allowMissingColumns=True)
    # At one instant versions come before facts; of several versions starting together the last is in force.
    order = [time, "_kind", *[f"_tie_{c}" for c in tie_break]]
    filled = last_known(merged, keys, order, F.col("_version"), "_found", unit, chunk_rows).filter("_kind = 1")
    in_force = F.col("_found._end").isNull() | (F.col("_found._end") > F.col(time))
    return filled.select(
        *[F.col("_fact")[c].alias(c) for c in facts.columns],
        *[F.when(in_force, F.col("_found")[c]).alias(f"version_{c}" if c in facts.columns else c) for c in columns])
