"""Manifest runs: errors, optional entries, files."""

import json
import os

import pytest

from strata.plans import manifest, reports
from strata.plans.audit import layer_report, sample_rows, source_files
from strata.queries.inputs import scratch_schema
from strata.queries.runs import churn_manifest, sales_manifest
from strata.sources import tables


def test_unknown_type_and_missing_source_are_errors(spark, folder):
    with pytest.raises(ValueError, match="unknown type"):
        manifest.run(spark, {"tables": [{"name": "x", "type": "platinum"}]}, folder)
    gold = {"name": "x", "type": "gold", "source_table": "nowhere", "target_table": "x"}
    with pytest.raises(ValueError, match="does not exist"):
        manifest.run(spark, {"tables": [gold]}, folder)
    assert manifest.run(spark, {"tables": [{**gold, "optional": True}]}, folder) == {"x": None}


def test_manifests_load_from_json_and_yaml(folder):
    spec = sales_manifest("s")
    with open(f"{folder}/m.json", "w") as out:
        json.dump(spec, out)
    assert manifest.load(f"{folder}/m.json") == spec
    yaml = pytest.importorskip("yaml")
    with open(f"{folder}/m.yml", "w") as out:
        yaml.safe_dump(churn_manifest("s"), out)
    assert manifest.load(f"{folder}/m.yml") == churn_manifest("s")


def test_gold_location_and_layer_report(spark, folder):
    schema = scratch_schema(spark, "gold")
    spark.createDataFrame([("N", 1.0, "f1"), ("S", 5.0, "f2"), ("N", 2.0, "f2")],
                          "region STRING, amount DOUBLE, source_file STRING").write.saveAsTable(f"{schema}.tx")
    spec = {"settings": {"local_base_path": folder}, "tables": [
        {"name": "k", "type": "gold", "source_table": f"{schema}.tx", "target_table": f"{schema}.k",
         "external_location": "/place", "group_by": ["region"], "aggregations": {"total": "sum(amount)"},
         "sort_by": "total"}]}
    manifest.run(spark, spec)
    assert f"{folder}/place.versions/" in tables._location(spark, f"{schema}.k")
    assert [tuple(r) for r in spark.table(f"{schema}.k").collect()] == [("S", 5.0), ("N", 3.0)]
    report = layer_report(spark, [("silver", f"{schema}.tx"), ("gold", f"{schema}.k"), ("gold", f"{schema}.none")])
    assert [tuple(r)[2:] for r in report.collect()] == [
        (3, 2, 3, 0), (2, None, None, None), (None, None, None, None)]
    assert layer_report(spark, []).count() == 0
    place = tables._location(spark, f"{schema}.k")
    assert layer_report(spark, [("gold", place)]).first().rows == 2
    assert sample_rows(spark, place, 1).count() == sample_rows(spark, f"{schema}.tx", 1).count() == 1
    assert source_files(spark.table(f"{schema}.tx")).count() == 2


def test_quality_metrics_are_collected_and_targets_dropped(spark, folder):
    schema = scratch_schema(spark, "metrics")
    os.makedirs(f"{folder}/landing")
    for day in (1, 2):
        with open(f"{folder}/landing/{day}.json", "w") as out:
            out.write('{"id": 1, "v": 5}\n{"id": 2, "v": -1}\n{"id": null}\n')
        spec = {"settings": {"local_base_path": folder, "metrics_table": f"{schema}.quality"}, "tables": [
            {"name": "raw", "type": "bronze", "source_path": "landing", "target_table": f"{schema}.raw"},
            {"name": "s", "type": "silver", "source_table": f"{schema}.raw", "target_table": f"{schema}.s",
             "schema": "id INT, v INT", "rules": {"has_id": "id IS NOT NULL", "positive": "v > 0"}}]}
        assert manifest.run(spark, spec)["s"] == [{"valid_rows": 1, "quarantined_rows": 2}]
    rows = tables.read(spark, f"{schema}.quality").orderBy("batch_id", "rule").collect()
    assert [(r.batch_id, r.rule, r.failed_rows) for r in rows] == [
        (b, rule, n) for b in (0, 1) for rule, n in (("ALL", 2), ("has_id", 1), ("positive", 2))]
    assert all(r.table == f"{schema}.s" and r.latest_event is not None and r.total_rows == 3 for r in rows)
    manifest.drop_targets(spark, spec)
    assert not any(tables.exists(spark, f"{schema}.{t}") for t in ("raw", "s", "s_quarantine"))


def test_views_of_a_manifest(spark, folder):
    schema = scratch_schema(spark, "views")
    spark.sql(f"""CREATE TABLE {schema}.tx USING parquet AS SELECT * FROM VALUES
        ('N', 1.0D, 'a', TIMESTAMP '2024-01-05 00:00:00'), ('N', 3.0D, 'b', TIMESTAMP '2024-02-05 00:00:00'),
        ('S', 5.0D, 'c', TIMESTAMP '2024-02-05 00:00:00') AS t(region, amount, tx_id, tx_time)""")
    spark.sql(f"""CREATE TABLE {schema}.members USING parquet AS
        SELECT current_user() AS user, 'region_n' AS `group`""")
    view = {"type": "view", "source_table": f"{schema}.tx"}
    spec = {"settings": {"local_base_path": folder}, "tables": [
        {**view, "name": "m", "target_table": f"{schema}.monthly", "report": "monthly_revenue"},
        {**view, "name": "s", "target_table": f"{schema}.shown", "memberships": f"{schema}.members",
         "masks": {"tx_id": "redact"}, "row_filter": "region"}]}
    manifest.run(spark, spec, folder)
    want = reports.monthly_revenue(spark.table(f"{schema}.tx"))
    found = spark.table(f"{schema}.monthly")
    assert found.dtypes == want.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert [tuple(r)[:3] for r in spark.table(f"{schema}.shown").orderBy("amount").collect()] == [
        ("N", 1.0, "### REDACTED ###"), ("N", 3.0, "### REDACTED ###")]
    assert manifest.report(spark, spec).count() == 0
    with pytest.raises(ValueError, match="unknown report"):
        manifest.run(spark, {"tables": [{**spec["tables"][0], "report": "daily"}]}, folder)
    manifest.drop_targets(spark, spec)
    assert not tables.exists(spark, f"{schema}.shown") and tables.exists(spark, f"{schema}.tx")
