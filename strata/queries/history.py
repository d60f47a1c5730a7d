"""Type-2 history over the event stream: a user's state is the type of their last event."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import history
from strata.queries.inputs import scratch_schema, table
from strata.session import shared_dir
from strata.sources import history_tables, tables

KEYS, TRACKED, ORDER = ["user_id"], ["event_type"], ["ts", "event_id"]


def _history(spark, folder):
    return history.scd2(table(spark, folder, "events"), KEYS, TRACKED, ORDER)


def _stored(spark, folder):
    """The history as a table of its own, as lookups would find it."""
    path = shared_dir(spark, "history")
    _history(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


HISTORY_SQL = """
    WITH compared AS (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT user_id, event_type, ts AS __start_at, event_id,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS __end_at
    FROM compared WHERE n = 1 OR event_type IS DISTINCT FROM before"""


STATE = ["event_type", "value"]
_LATE = "event_type IN ('signup', 'view')"


def _merged(spark, folder):
    # Signups and views arrive late, after all other events are in the history.
    events = table(spark, folder, "events")
    early, late = events.filter(f"NOT ({_LATE})"), events.filter(_LATE)
    base = history.scd2(early, KEYS, STATE, ORDER)
    return history.scd2_merge(base, late, KEYS, STATE, ORDER, changes=early)


def _table(spark, folder):
    # The late batch is merged twice, as after a lost driver.
    events = table(spark, folder, "events")
    name = f"{scratch_schema(spark, 'history')}.states"
    for batch in (events.filter(f"NOT ({_LATE})"), events.filter(_LATE), events.filter(_LATE)):
        history_tables.merge(spark, batch, name, KEYS, STATE, ORDER, buckets=8)
    return tables.read(spark, name)


# However the changes were cut into batches, the history is that of all of them.
MERGED_SQL = """
    WITH compared AS (
        SELECT *, lag(struct_pack(event_type, value)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT user_id, event_type, value, ts AS __start_at, event_id,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS __end_at
    FROM compared WHERE n = 1 OR struct_pack(event_type, value) IS DISTINCT FROM before"""


def _state_at(spark, folder):
    return history.state_at(_stored(spark, folder), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


def _as_of(spark, folder):
    # Questions are asked 36 hours before each event; the earliest of a user find no state.
    questions = table(spark, folder, "events").select(
        F.col("event_id").alias("question"), "user_id", (F.col("ts") - F.expr("INTERVAL 36 HOURS")).alias("ts"))
    return history.as_of(questions, _stored(spark, folder), KEYS, "ts", ["event_type", "__start_at"])


AS_OF_SQL = f"""
    SELECT q.question, q.user_id, q.ts, h.event_type, h.__start_at
    FROM (SELECT event_id AS question, user_id, ts - INTERVAL 36 HOUR AS ts FROM events) q
         ASOF LEFT JOIN ({HISTORY_SQL}) h ON q.user_id = h.user_id AND q.ts >= h.__start_at"""

QUERIES = {
    "scd2_history": (_history, HISTORY_SQL),
    "scd2_merge": (_merged, MERGED_SQL),
    "scd2_table": (_table, MERGED_SQL),
    "state_at": (_state_at, f"""
        SELECT * FROM ({HISTORY_SQL})
        WHERE __start_at <= TIMESTAMP '2024-01-15' AND (__end_at IS NULL OR __end_at > TIMESTAMP '2024-01-15')"""),
    "as_of_lookup": (_as_of, AS_OF_SQL),
}
