"""Column masks and the row filter, as column functions, as SQL functions and bound to a table as a catalog view.

Stock Spark has no account directory: the caller passes the reader's groups. The SQL functions read them from the
session variable ``reader_groups``, a governed view from a table of memberships.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The marker, prefixes and pattern that masked output is expected to show.
REDACTED = "### REDACTED ###"
ID_PREFIX = "XXXX-"
EMAIL_LOCAL_PART = "^.*@"
MASKED_EMAIL = "masked-user@"

STEWARDS = "data_stewards"
ADMINS = "admin"
REGION_GROUP_PREFIX = "region_"


def redact(value: Column, groups: Iterable[str], stewards: str = STEWARDS) -> Column:
    """The value for stewards; the marker for all others, NULL included."""
    return value if stewards in set(groups) else F.lit(REDACTED)


def partial_id(value: Column, groups: Iterable[str], stewards: str = STEWARDS) -> Column:
    """``XXXX-`` and the last four characters; NULL stays NULL."""
    return value if stewards in set(groups) else F.concat(F.lit(ID_PREFIX), F.right(value, F.lit(4)))


def mask_email(value: Column, groups: Iterable[str], stewards: str = STEWARDS) -> Column:
    """Keep the domain (after the last ``@``) only; a value without ``@`` is no address and is redacted."""
    if stewards in set(groups):
        return value
    return F.when(value.contains("@"), F.regexp_replace(value, EMAIL_LOCAL_PART, MASKED_EMAIL)).when(
        value.isNotNull(), F.lit(REDACTED))


def row_filter(df: DataFrame, region: str, groups: Iterable[str], admins: str = ADMINS,
               prefix: str = REGION_GROUP_PREFIX) -> DataFrame:
    """Admins see all rows, others the regions named by their groups; a NULL region is shown to admins only."""
    groups = set(groups)
    if admins in groups:
        return df
    allowed = sorted(g[len(prefix):] for g in groups if g.startswith(prefix))
    return df.filter(F.lower(F.col(region)).isin(allowed) if allowed else F.lit(False))


def row_filter_by_table(df: DataFrame, region: str, entitlements: DataFrame, user: str) -> DataFrame:
    """The regional rule with the reader's regions held in a table (``user``, ``region``): a semi join."""
    mine = entitlements.filter(F.col("user") == user).select(F.lower("region").alias("_allowed"))
    return df.join(mine, F.lower(df[region]) == F.col("_allowed"), "left_semi")


def register_sql(spark: SparkSession, groups: Iterable[str], stewards: str = STEWARDS, admins: str = ADMINS,
                 prefix: str = REGION_GROUP_PREFIX) -> None:
    """Create the session variable with the reader's groups and the four temporary SQL functions.

    ``redact_mask(s)``, ``partial_id_mask(s)``, ``email_mask(s)`` return STRING; ``regional_filter(region)`` returns
    BOOLEAN and is NULL-safe.
    """
    members = ", ".join(_quoted(g) for g in sorted(set(groups)))
    spark.sql(f"DECLARE OR REPLACE VARIABLE reader_groups ARRAY<STRING> = CAST(array({members}) AS ARRAY<STRING>)")
    for name, kind in (("redact_mask", "redact"), ("partial_id_mask", "partial_id"), ("email_mask", "email")):
        spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS STRING
                      RETURN {_mask_sql(kind, "v", "reader_groups", stewards)}""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION regional_filter(region STRING) RETURNS BOOLEAN
                  RETURN {_filter_sql("region", "reader_groups", admins, prefix)}""")


def publish_view(spark: SparkSession, source: str, view: str, memberships: str, masks: Mapping[str, str],
                 region: str | None = None, stewards: str = STEWARDS, admins: str = ADMINS,
                 prefix: str = REGION_GROUP_PREFIX, hidden: Iterable[str] = ()) -> None:
    """Create a catalog view of a table that masks columns, and filters rows by ``region``, for whoever reads it.

    ``masks``: ``redact``, ``partial_id`` or ``email`` by column. ``memberships``: a table with the columns ``user`` and
    ``group``; the groups of the current user are looked up at each use, once per query. ``hidden`` columns are left
    out. Readers need access to the view only.
    """
    columns = [c for c in spark.table(source).columns if c not in set(hidden)]
    unknown = {*masks, *([region] if region else [])} - set(columns)
    if unknown:
        raise ValueError(f"table {source!r} has no columns {sorted(unknown)}")
    groups = f"(SELECT collect_set(`group`) FROM {_identifier(memberships)} WHERE `user` = current_user())"
    shown = [f"{_mask_sql(masks[c], f'CAST({_name(c)} AS STRING)', groups, stewards)} AS {_name(c)}" if c in masks
             else _name(c) for c in columns]
    where = f" WHERE {_filter_sql(_name(region), groups, admins, prefix)}" if region else ""
    spark.sql(f"CREATE OR REPLACE VIEW {_identifier(view)} AS SELECT {', '.join(shown)} FROM {_identifier(source)}{where}")


def _mask_sql(kind: str, value: str, groups: str, stewards: str) -> str:
    masked = {
        "redact": f"ELSE {_quoted(REDACTED)}",
        "partial_id": f"ELSE concat({_quoted(ID_PREFIX)}, right({value}, 4))",
        "email": f"""WHEN contains({value}, '@')
                     THEN regexp_replace({value}, {_quoted(EMAIL_LOCAL_PART)}, {_quoted(MASKED_EMAIL)})
                     WHEN {value} IS NOT NULL THEN {_quoted(REDACTED)}"""}
    if kind not in masked:
        raise ValueError(f"unknown mask {kind!r}; use one of {sorted(masked)}")
    return f"CASE WHEN array_contains({groups}, {_quoted(stewards)}) THEN {value} {masked[kind]} END"


def _filter_sql(region: str, groups: str, admins: str, prefix: str) -> str:
    return (f"(array_contains({groups}, {_quoted(admins)})"
            f" OR coalesce(array_contains({groups}, concat({_quoted(prefix)}, lower({region}))), false))")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _identifier(table: str) -> str:
    return ".".join(map(_name, table.split(".")))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
