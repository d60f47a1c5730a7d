"""Audit columns. Run id, time and user are arguments, so that a run can be repeated exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("_pipeline_run_id", "_processed_at", "_run_mode", "_user")


def with_audit(df: DataFrame, run_id: str, run_mode: str = "local", user: str | None = None,
               processed_at=None) -> DataFrame:
    return df.withColumns({
        "_pipeline_run_id": F.lit(run_id),
        "_processed_at": F.current_timestamp() if processed_at is None else F.lit(processed_at),
        "_run_mode": F.lit(run_mode),
        "_user": F.lit(user).cast("string"),
    })
