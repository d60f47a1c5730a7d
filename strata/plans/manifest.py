"""Run a whole pipeline from a declarative list of tables.

A manifest is a dict, or a JSON or YAML file::

    settings: {run_mode: local, local_base_path: ./data, metrics_table: ops.quality}
    tables:
      - {name: raw, type: bronze, source_path: /landing/, target_table: bronze.raw}
      - {name: tx, type: silver, format: json, source_table: bronze.raw, target_table: silver.tx,
         schema: "store_id STRING, items ARRAY<STRUCT<tx_id: STRING, amount: DOUBLE>>", explode_col: items,
         rules: ["amount > 0"], merge_key: tx_id}
      - {name: kpi, type: gold, source_table: silver.tx, target_table: gold.kpi, joins: [], group_by: [store_id],
         aggregations: {total: "sum(amount)"}, sort_by: total}

Entries run in the order listed. In a ``run_mode`` other than ``local`` the settings ``cloud_base_path`` and ``catalog``
apply. ``metrics_table`` (optional) collects the counts per rule of each silver batch. Optional keys of entries: ``optional`` (skip a missing source or join table),
``order_by`` (which duplicate of a merge key wins), ``buckets``, ``glob`` (which typed files), ``max_bytes`` (the
largest file kept as one bronze row), ``batch_bytes`` (input per batch), ``stage`` (true: parsed batches go through
files, not executor caches), ``cluster_by`` (columns that the files of a silver or gold table hold ranges of; a gold
table's ``sort_by`` is then left to its readers), ``history`` (of a silver entry: ``keys``, ``tracked`` and ``order_by``
of a type-2 history that takes the place of the rows), ``interleave`` and ``external_location`` (layout and place of a
gold table).

An entry of type ``view`` publishes its source table as a catalog view: either ``report: monthly_revenue``, or the rows
as each reader may see them::

    {name: shown, type: view, source_table: silver.contacts, target_table: gold.contacts, memberships: ops.members,
     masks: {customer_email: email, phone_number: partial_id}, row_filter: region}
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from strata.functions import governance
from strata.operators import gold
from strata.plans import reports as standard
from strata.plans.audit import layer_report
from strata.sources import history_tables, tables
from strata.sources.files import TYPED_FORMATS, WHOLE_FILE_BYTES
from strata.streaming import bronze, silver

# Which duplicate of a merge key wins when the entry does not say: the latest of these, as far as present.
DEFAULT_ORDER = ("tx_time", "ingested_at")
# Standard reports that a view entry can publish.
REPORTS = {"monthly_revenue": standard.publish_monthly_revenue}


def load(source: str | Mapping[str, Any]) -> Mapping[str, Any]:
    if isinstance(source, Mapping):
        return source
    with open(source, encoding="utf-8") as handle:
        if source.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("YAML manifests need PyYAML; pass a dict or a JSON file instead") from error
        return yaml.safe_load(handle)


def run(spark: SparkSession, manifest: str | Mapping[str, Any], base_path: str | None = None,
        user: str | None = None, timeout: int | None = None) -> dict[str, Any]:
    """Run all entries; returns what each one reported (batch counts of silver entries)."""
    spec = load(manifest)
    settings = spec.get("settings", {})
    run_mode = settings.get("run_mode", "local")
    if run_mode == "local":
        base = base_path or os.path.abspath(settings["local_base_path"])
    else:
        base = base_path or settings["cloud_base_path"]
        if settings.get("catalog"):
            spark.catalog.setCurrentCatalog(settings["catalog"])
    context = _Context(spark, spec, base.rstrip("/"), run_mode, user, timeout)
    steps = {"bronze": context.bronze, "silver": context.silver, "gold": context.gold, "view": context.view}
    reports = {}
    for entry in spec["tables"]:
        if entry["type"] not in steps:
            raise ValueError(f"table {entry['name']!r}: unknown type {entry['type']!r}")
        reports[entry["name"]] = steps[entry["type"]](entry)
    return reports


def report(spark: SparkSession, manifest: str | Mapping[str, Any]) -> DataFrame:
    """Row counts of every table of a manifest, quarantine included; views hold no rows of their own."""
    return layer_report(spark, [(t["type"], t["target_table"]) for t in load(manifest)["tables"] if t["type"] != "view"])


def drop_targets(spark: SparkSession, manifest: str | Mapping[str, Any]) -> None:
    """Drop every table and view of a manifest, quarantine included. Files of external tables and checkpoints stay."""
    for entry in load(manifest)["tables"]:
        if entry["type"] == "view":
            tables.drop_view(spark, entry["target_table"])
            continue
        tables.drop(spark, entry["target_table"])
        tables.drop(spark, f"{entry['target_table']}_quarantine")
        if entry.get("history"):
            tables.drop(spark, history_tables.changes_of(entry["target_table"]))


def build_gold(spark: SparkSession, entry: Mapping[str, Any]) -> DataFrame:
    """The rows of a gold entry: joins, group-aggregate and sort over current tables."""

    def read(table: str) -> DataFrame:
        return tables.read(spark, table)

    df, joins = read(entry["source_table"]), entry.get("joins", [])
    group_by, aggregations = entry.get("group_by", []), entry.get("aggregations", {})
    if aggregations and joins and (not joins[-1].get("optional") or tables.exists(spark, joins[-1]["table"])):
        df = gold.join_tables(df, joins[:-1], read, lambda t: tables.exists(spark, t))
        last = joins[-1]
        df = gold.join_aggregate(
            df, read(last["table"]), last["on"], last.get("type", "inner"), group_by, aggregations,
            last.get("skewed", False))
    else:
        df = gold.join_tables(df, joins, read, lambda t: tables.exists(spark, t))
        df = gold.aggregate(df, group_by, aggregations)
    return gold.sort(df, entry["sort_by"]) if entry.get("sort_by") else df


class _Context:
    def __init__(self, spark, spec, base, run_mode, user, timeout):
        self.spark, self.spec, self.base = spark, spec, base
        self.run_mode, self.user, self.timeout = run_mode, user, timeout

    def path(self, suffix: str) -> str:
        return f"{self.base}/{suffix.strip('/')}"

    def checkpoint(self, entry) -> str:
        return self.path(f"checkpoints/{entry['type']}/{entry['name']}")

    def skipped(self, entry) -> bool:
        """A missing source is an error, unless the entry is optional."""
        source = entry["source_table"]
        if tables.exists(self.spark, source):
            return False
        if entry.get("optional"):
            return True
        raise ValueError(f"table {entry['name']!r}: source table {source!r} does not exist")

    def bronze(self, entry):
        source, target, common = self.path(entry["source_path"]), entry["target_table"], {
            "run_id": entry["name"], "run_mode": self.run_mode, "user": self.user,
            "batch_bytes": entry.get("batch_bytes"), "timeout": self.timeout}
        if entry.get("format") in TYPED_FORMATS:
            bronze.ingest_typed(self.spark, source, entry["schema"], target, self.checkpoint(entry),
                                file_format=entry["format"], **common)
        else:
            bronze.ingest_raw(self.spark, source, target, self.checkpoint(entry),
                              max_bytes=entry.get("max_bytes", WHOLE_FILE_BYTES), **common)

    def silver(self, entry):
        if self.skipped(entry):
            return None
        table = silver.SilverTable(
            name=entry["name"], target=entry["target_table"], schema=entry["schema"],
            file_format=entry.get("format", "json").lower(), explode=entry.get("explode_col"),
            rules=entry.get("rules", {}), merge_key=entry.get("merge_key"),
            order_by=entry.get("order_by", DEFAULT_ORDER), buckets=entry.get("buckets", tables.DEFAULT_BUCKETS),
            rescue_fields=entry.get("rescue_fields", False), event_time=entry.get("event_time", "ingested_at"),
            cluster_by=entry.get("cluster_by", ()), history=entry.get("history"), run_mode=self.run_mode,
            user=self.user, batch_bytes=entry.get("batch_bytes"),
            stage=self.path(f"stage/{entry['name']}") if entry.get("stage") else None,
            metrics=self.spec.get("settings", {}).get("metrics_table"))
        checkpoint = self.checkpoint(entry)
        if table.file_format in TYPED_FORMATS:
            # Typed files are read as such, from the folder that the bronze entry of the source table lists.
            landing = next(t["source_path"] for t in self.spec["tables"]
                           if t["type"] == "bronze" and t["target_table"] == entry["source_table"])
            return silver.from_typed_files(
                self.spark, self.path(landing), table, checkpoint, entry.get("glob"), self.timeout)
        return silver.from_bronze(self.spark, entry["source_table"], table, checkpoint, self.timeout)

    def gold(self, entry):
        if self.skipped(entry):
            return None
        location = entry.get("external_location")
        tables.replace(self.spark, build_gold(self.spark, entry), entry["target_table"],
                       cluster_by=entry.get("cluster_by", ()), sort_by=entry.get("sort_by", ()),
                       location=self.path(location) if location else None,
                       interleave=entry.get("interleave", False))

    def view(self, entry):
        if self.skipped(entry):
            return None
        source, target = entry["source_table"], entry["target_table"]
        tables.ensure_schema(self.spark, target)
        if entry.get("report"):
            if entry["report"] not in REPORTS:
                raise ValueError(f"view {entry['name']!r}: unknown report {entry['report']!r}")
            REPORTS[entry["report"]](self.spark, source, target)
        else:
            governance.publish_view(self.spark, source, target, entry["memberships"], entry.get("masks", {}),
                                    entry.get("row_filter"), hidden=[tables.PART])
