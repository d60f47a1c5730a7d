"""Named data-quality rules: tag rows with every rule they fail, split, enforce and count.

A rule is SQL text. Rules come as ``{name: text}``, or as a list whose texts are their own names. A rule that is
NULL for a row counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str] | Sequence[str]
TAGS = ("failure_reasons", "is_valid")

# The stock rules for transactions and customers.
KNOWN_REGIONS = ("AUCKLAND", "WELLINGTON", "CHRISTCHURCH", "HAMILTON")
EMAIL_LIKE = "%@%.%"
PHONE_PATTERN = r"^(\+64|0)[2-9][0-9]{7,9}$"


def transaction_rules(regions: Sequence[str] = KNOWN_REGIONS, now: str = "current_timestamp()") -> dict[str, str]:
    """Rules over ``tx_id``, ``amount``, ``region``, ``tx_time``; ``now`` is SQL text."""
    listed = ", ".join("'" + r.replace("'", "\\'") + "'" for r in regions)
    return {
        "valid_id": "tx_id IS NOT NULL",
        "positive_amount": "amount > 0",
        "known_region": f"region IN ({listed})",
        "future_date_check": f"tx_time <= {now}",
    }


def customer_rules() -> dict[str, str]:
    """Rules over ``customer_email`` and ``phone_number``."""
    return {
        "valid_email": f"customer_email LIKE '{EMAIL_LIKE}'",
        "nz_phone_format": f"phone_number RLIKE r'{PHONE_PATTERN}'",
    }


def named(rules: Rules | None) -> dict[str, str]:
    if not rules:
        return {}
    return dict(rules) if isinstance(rules, Mapping) else {text: text for text in rules}


def _holds(text: str) -> Column:
    return F.coalesce(F.expr(text), F.lit(False))


def apply_rules(df: DataFrame, rules: Rules | None) -> DataFrame:
    """Add ``failure_reasons`` (names of all failed rules) and a two-valued ``is_valid``."""
    rules = named(rules)
    if not rules:
        return df.withColumns({"failure_reasons": F.lit(None).cast("array<string>"), "is_valid": F.lit(True)})
    # Plain expressions that stay inside generated code (an array lambda would not); where the reasons are not
    # used, they and the array are pruned and only the predicates remain.
    holds = {name: _holds(text) for name, text in rules.items()}
    reasons = F.array_remove(F.array(*[F.when(ok, "").otherwise(name) for name, ok in holds.items()]), "")
    return df.withColumns({"failure_reasons": reasons, "is_valid": reduce(and_, holds.values())})


def valid_rows(df: DataFrame, rules: Rules | None) -> DataFrame:
    """Rows that pass every rule. The rules stay plain predicates, so they reach the scan."""
    return reduce(DataFrame.filter, (F.expr(text) for text in named(rules).values()), df)


def quarantined_rows(df: DataFrame, rules: Rules | None) -> DataFrame:
    """Rows that fail a rule, with their reasons."""
    texts = named(rules).values()
    if not texts:
        return apply_rules(df, rules).filter(F.lit(False))
    return apply_rules(df.filter(~reduce(and_, map(_holds, texts))), rules)


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the tags, and the quarantine rows with them."""
    return tagged.filter("is_valid").drop(*TAGS), tagged.filter("NOT is_valid")


def quarantine(tagged: DataFrame, quarantined_at=None) -> DataFrame:
    """The rows to quarantine, stamped with ``_quarantine_at``."""
    stamp = F.current_timestamp() if quarantined_at is None else F.lit(quarantined_at)
    return split(tagged)[1].withColumn("_quarantine_at", stamp)


def expect(df: DataFrame, rules: Rules, policy: str) -> DataFrame:
    """Enforce rules: ``warn`` tags rows, ``drop`` removes failing rows, ``fail`` stops the job at the first one."""
    if policy == "warn":
        return apply_rules(df, rules)
    if policy == "drop":
        return valid_rows(df, rules)
    if policy == "fail":
        # The partition term is always true, but not deterministic to Catalyst. It keeps the check from moving below
        # a join or another filter, where it would judge rows that never reach this point.
        passed = F.spark_partition_id() >= 0
        for name, text in named(rules).items():
            broken = F.raise_error(F.lit(f"expectation failed: {name} ({text})")).cast("boolean")
            df = df.filter(F.when(_holds(text), passed).otherwise(broken))
        return df
    raise ValueError(f"unknown policy {policy!r}; use warn, drop or fail")


def batch_metrics() -> list[Column]:
    """Counts of valid and quarantined rows, in one aggregate over the tag column."""
    return [F.count_if("is_valid").alias("valid_rows"), F.count_if(~F.col("is_valid")).alias("quarantined_rows")]


def metrics(df: DataFrame, rules: Rules, event_time: str | None = None) -> DataFrame:
    """One row per rule and one for all rules: rows seen, rows failed, pass rate and the latest event time.

    One partial aggregate over the input, whatever the number of rules or failures; only its single result row is
    unpivoted.
    """
    rules = named(rules)
    checks = {name: _holds(text) for name, text in rules.items()}
    checks["ALL"] = reduce(and_, checks.values()) if checks else F.lit(True)
    names = list(checks)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        (F.max(event_time) if event_time else F.lit(None).cast("timestamp")).alias("latest_event"),
        *[F.count_if(~check).alias(f"_failed_{i}") for i, check in enumerate(checks.values())])
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_failed_{i}").alias("failed_rows"))
        for i, name in enumerate(names)])
    flat = counted.select("_rows", "latest_event", F.explode(per_rule).alias("_m"))
    return flat.select(
        F.col("_m.rule"), F.col("_rows").alias("total_rows"), F.col("_m.failed_rows"),
        F.round(1 - F.try_divide("_m.failed_rows", "_rows"), 6).alias("pass_rate"), "latest_event")
