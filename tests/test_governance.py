"""Masks and row filters."""

import pytest
from pyspark.sql import functions as F

from strata.functions import governance as g
from strata.queries.inputs import scratch_schema

VALUES = ["ann@mail.example.com", "a@b@c.org", "no address", "abc", None, ""]


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i INT, v STRING")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


EXPECTED = {
    "redact_mask": [g.REDACTED] * 6,
    "partial_id_mask": ["XXXX-.com", "XXXX-.org", "XXXX-ress", "XXXX-abc", None, "XXXX-"],
    "email_mask": ["masked-user@mail.example.com", "masked-user@c.org", g.REDACTED, g.REDACTED, None, g.REDACTED],
}


@pytest.mark.parametrize("name, mask", [
    ("redact_mask", g.redact), ("partial_id_mask", g.partial_id), ("email_mask", g.mask_email)])
def test_masks_in_both_forms(spark, df, name, mask):
    assert column(df, mask(F.col("v"), ["region_x"])) == EXPECTED[name]
    assert column(df, mask(F.col("v"), [g.STEWARDS])) == VALUES
    assert column(df, mask(F.col("v"), ["my_stewards"], stewards="my_stewards")) == VALUES
    g.register_sql(spark, ["region_x"])
    assert column(df, F.expr(f"{name}(v)")) == EXPECTED[name]
    g.register_sql(spark, [g.STEWARDS])
    assert column(df, F.expr(f"{name}(v)")) == VALUES


@pytest.fixture
def regional(spark):
    return spark.createDataFrame([("Auckland",), ("Wellington",), (None,)], "region STRING")


@pytest.mark.parametrize("groups, seen", [
    (["region_auckland"], {"Auckland"}), (["region_auckland", "region_wellington"], {"Auckland", "Wellington"}),
    ([], set()), (["other"], set()), ([g.ADMINS], {"Auckland", "Wellington", None})])
def test_row_filter_in_both_forms(spark, regional, groups, seen):
    assert {r.region for r in g.row_filter(regional, "region", groups).collect()} == seen
    g.register_sql(spark, groups)
    assert {r.region for r in regional.filter("regional_filter(region)").collect()} == seen


def test_row_filter_by_table(spark, regional):
    grants = spark.createDataFrame([("u", "AUCKLAND"), ("u", "auckland"), ("w", "wellington"), ("u", None)],
                                   "user STRING, region STRING")
    assert [r.region for r in g.row_filter_by_table(regional, "region", grants, "u").collect()] == ["Auckland"]


def test_filter_reaches_the_scan(spark, regional, folder):
    regional.write.parquet(f"{folder}/r")
    plan = g.row_filter(spark.read.parquet(f"{folder}/r"), "region", ["region_x"])._jdf.queryExecution().toString()
    assert "DataFilters: [isnotnull(region" in plan and "lower(region" in plan


def test_a_governed_view_shows_each_user_what_their_groups_allow(spark):
    schema = scratch_schema(spark, "views")
    spark.createDataFrame([(1, "ann@x.org", "12345", "Auckland"), (2, "none", None, "Wellington"), (3, None, "9", None)],
                          "i INT, email STRING, phone STRING, region STRING").write.saveAsTable(f"{schema}.people")
    members = f"{schema}.members"
    spark.sql(f"CREATE TABLE {members} (user STRING, `group` STRING) USING parquet")
    g.publish_view(spark, f"{schema}.people", f"{schema}.shown", members, {"email": "email", "phone": "partial_id"}, "region")

    def seen():
        return sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {schema}.shown").collect())

    assert seen() == []
    spark.sql(f"INSERT INTO {members} SELECT current_user(), 'region_auckland'")
    spark.sql(f"INSERT INTO {members} VALUES ('someone else', 'admin'), ('someone else', 'data_stewards')")
    assert seen() == [(1, "masked-user@x.org", "XXXX-2345", "Auckland")]
    spark.sql(f"INSERT INTO {members} SELECT current_user(), 'admin'")
    assert seen() == [(1, "masked-user@x.org", "XXXX-2345", "Auckland"), (2, g.REDACTED, None, "Wellington"),
                      (3, None, "XXXX-9", None)]
    spark.sql(f"INSERT INTO {members} SELECT current_user(), 'data_stewards'")
    assert seen()[0] == (1, "ann@x.org", "12345", "Auckland")
    with pytest.raises(ValueError, match="no columns"):
        g.publish_view(spark, f"{schema}.people", f"{schema}.shown", members, {"mail": "email"})
    with pytest.raises(ValueError, match="unknown mask"):
        g.publish_view(spark, f"{schema}.people", f"{schema}.shown", members, {"email": "hash"})
