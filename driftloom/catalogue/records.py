"""Tables, files, logs and streams."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from driftloom.catalogue.common import Query, r, rounded, table
from driftloom.catalogue.fits import FIT, ROW, _line_fit
from driftloom.catalogue.watching import QUERIES as WATCHING
from driftloom.catalogue.watching import report_lineitem
from driftloom.operators.logstate import (
    append_versions,
    fold_attributes,
    fold_stages,
    latest_in_stage,
    newest_n,
    nth_newest,
    number_versions,
    without_deleted,
)
from driftloom.operators.reports import monitoring_rows
from driftloom.sources.files import read_files, write_files
from driftloom.sources.scratch import fresh_path, settle
from driftloom.sources.buckets import create_buckets, read_buckets, upsert_buckets
from driftloom.sources.tables import append_rows, from_sql, read_table, upsert_table, write_table
from driftloom.streaming.rollup import read_rollup, rollup_stream
from driftloom.streaming.scoring import score_stream

ORDER = ["ts", "event_id"]


def _fresh_table(label: str) -> str:
    return f"driftloom_{label}_{uuid.uuid4().hex}"


def table_roundtrip_orders(spark, sf_dir):
    name = _fresh_table("roundtrip")
    orders = table(spark, sf_dir, "orders")
    write_table(orders, name, description="All of the customer's orders", partition_by=["o_orderstatus"], path=fresh_path(spark, name))
    return from_sql(spark, f"SELECT * FROM {name}").select(*orders.columns)


def _changed_customers(spark, sf_dir):
    """BUILDING customers with two successive balances, and the suppliers as new customers."""
    building = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    first = building.withColumn("c_acctbal", F.lit(0.0)).withColumn("step", F.lit(1))
    second = building.withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("step", F.lit(2))
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
        F.lit(1).alias("step"),
    )
    return first.unionByName(second).unionByName(suppliers)


def upsert_customer(spark, sf_dir):
    name = _fresh_table("customer")
    write_table(table(spark, sf_dir, "customer"), name, path=fresh_path(spark, name))
    upsert_table(_changed_customers(spark, sf_dir), name, ["c_custkey"], ["step"])
    return rounded(read_table(spark, name), 2, "c_acctbal")


def upsert_partitioned_customer(spark, sf_dir):
    name = _fresh_table("customer_parts")
    write_table(table(spark, sf_dir, "customer"), name, partition_by=["c_mktsegment"], path=fresh_path(spark, name))
    upsert_table(_changed_customers(spark, sf_dir), name, ["c_custkey", "c_mktsegment"], ["step"], partition_col="c_mktsegment")
    return rounded(read_table(spark, name), 2, "c_acctbal")


def upsert_bucketed_customer(spark, sf_dir):
    """The same changes in two merges of a bucketed table."""
    folder, changes = fresh_path(spark, "customer_buckets"), _changed_customers(spark, sf_dir)
    create_buckets(table(spark, sf_dir, "customer"), folder, ["c_custkey"], 32)
    upsert_buckets(changes.filter("c_custkey % 2 = 0"), folder, ["step"])
    upsert_buckets(changes.filter("c_custkey % 2 <> 0"), folder, ["step"])
    return rounded(read_buckets(spark, folder), 2, "c_acctbal")


def append_monitoring_lineitem(spark, sf_dir):
    name = _fresh_table("monitoring")
    path = fresh_path(spark, name)
    report = settle(report_lineitem(spark, sf_dir))
    for version in (1, 2):
        append_rows(monitoring_rows(report, "price", version, ["l_returnflag"], datetime(2001, 11, 4)), name, path=path)
    return read_table(spark, name)


def csv_roundtrip_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = fresh_path(spark, "events-csv")
    write_files(events, path, "csv", header="true")
    return read_files(spark, path, "csv", events.schema, header="true")


def json_roundtrip_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = fresh_path(spark, "events-json")
    write_files(events, path, "json")
    return read_files(spark, path, "json", events.schema)


def latest_state_events(spark, sf_dir):
    return latest_in_stage(table(spark, sf_dir, "events"), ["user_id"], ORDER, "event_type", ["purchase", "signup"])


def top_n_events(spark, sf_dir):
    return newest_n(table(spark, sf_dir, "events"), ["user_id"], ORDER, 5)


def nth_newest_events(spark, sf_dir):
    return nth_newest(table(spark, sf_dir, "events"), ["user_id"], ORDER, 2)


def _versions(spark, sf_dir):
    """Events as version records: the user is the model, the number in `props` its version."""
    stage = F.expr("CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging' WHEN 'error' THEN 'Archived' ELSE 'None' END")
    version = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return table(spark, sf_dir, "events").select("*", version.alias("version"), stage.alias("stage"))


def stage_fold_events(spark, sf_dir):
    return fold_stages(_versions(spark, sf_dir), ["user_id"], ["version"], ORDER)


def stage_fold_archiving_events(spark, sf_dir):
    return fold_stages(_versions(spark, sf_dir), ["user_id"], ["version"], ORDER, archive_existing=True)


def tombstone_events(spark, sf_dir):
    kept = without_deleted(_versions(spark, sf_dir), ["user_id", "version"], ORDER, F.col("event_type") == "error")
    return kept.select("user_id", "version", "event_id", "event_type", "value")


def attribute_fold_events(spark, sf_dir):
    return fold_attributes(table(spark, sf_dir, "events"), ["user_id"], ORDER, "event_type", "value")


def version_number_events(spark, sf_dir):
    return number_versions(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], ORDER)


def append_versions_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    existing = number_versions(events.filter(early), ["user_id"], ORDER)
    return append_versions(existing, events.filter(~early), ["user_id"], ORDER)


def _arriving(spark, sf_dir, name):
    """One table of the folder as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def stream_score_lineitem(spark, sf_dir):
    coefficients = _line_fit(table(spark, sf_dir, "lineitem"))
    rows = _arriving(spark, sf_dir, "lineitem").select(*ROW, "l_returnflag", "l_quantity")
    path = fresh_path(spark, "scores")
    score_stream(rows, coefficients, ["l_quantity"], path, fresh_path(spark, "scores-progress"), ["l_returnflag"]).awaitTermination()
    return rounded(spark.read.parquet(path).select(*ROW, "l_returnflag", "prediction"), 4, "prediction")


def stream_weekly_events(spark, sf_dir):
    path = fresh_path(spark, "weekly")
    rows = _arriving(spark, sf_dir, "events").select("ts", "event_type", "value")
    rollup_stream(rows, ["value"], "ts", path, fresh_path(spark, "weekly-progress"), ["event_type"]).awaitTermination()
    return rounded(read_rollup(spark, path, ["event_type"]), 2, "value_semana")


def stream_weekly_late_events(spark, sf_dir):
    """The same totals when the second half of the month arrives before the first."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    late = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    arrivals, path, progress = (fresh_path(spark, n) for n in ("late-arrivals", "weekly-late", "weekly-late-progress"))
    for half in (events.filter(~late), events.filter(late)):
        half.write.mode("append").parquet(arrivals)
        rows = spark.readStream.schema(events.schema).parquet(arrivals)
        rollup_stream(rows, ["value"], "ts", path, progress, ["event_type"]).awaitTermination()
    return rounded(read_rollup(spark, path, ["event_type"]), 2, "value_semana")


STAGED = """e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS version,
  CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging' WHEN 'error' THEN 'Archived' ELSE 'None' END AS stage FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, version ORDER BY ts DESC, event_id DESC) = 1)"""
UPSERTED = f"""SELECT c_custkey, c_name, c_nationkey, {r("CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END", 2, 'c_acctbal')},
  c_mktsegment, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 2 END AS INTEGER) AS step FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, {r('s_acctbal', 2, 'c_acctbal')}, 'SUPPLIER', 1 FROM supplier"""

# The report's alerts, `type:severity:message` joined by semicolons, as JSON objects.
ALERT_JSON = """array_to_string(list_transform(string_split(alerts, ';'), lambda a: '{"type":"' || split_part(a, ':', 1)
  || '","severity":"' || split_part(a, ':', 2) || '","message":"' || split_part(a, ':', 3) || '"}'), ',')"""

QUERIES: dict[str, Query] = {
    "table_roundtrip_orders": (table_roundtrip_orders, "SELECT * FROM orders"),
    "upsert_customer": (upsert_customer, UPSERTED),
    "upsert_partitioned_customer": (upsert_partitioned_customer, UPSERTED),
    "upsert_bucketed_customer": (upsert_bucketed_customer, UPSERTED),
    "append_monitoring_lineitem": (
        append_monitoring_lineitem,
        f"""WITH rep AS ({WATCHING['monitoring_report_lineitem'][1]})
        SELECT 'price' AS model_name, CAST(v AS INTEGER) AS model_version, l_returnflag, TIMESTAMP '2001-11-04' AS monitoring_timestamp,
          overall_status, drift_detected, drifted_features, CASE WHEN alerts = '' THEN '[]' ELSE '[' || {ALERT_JSON} || ']' END AS alerts
        FROM rep, (VALUES (1), (2)) AS n(v)""",
    ),
    "csv_roundtrip_events": (csv_roundtrip_events, "SELECT * FROM events"),
    "json_roundtrip_events": (json_roundtrip_events, "SELECT * FROM events"),
    "latest_state_events": (
        latest_state_events,
        """SELECT * FROM events WHERE event_type IN ('purchase', 'signup')
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "top_n_events": (
        top_n_events,
        """SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5""",
    ),
    "nth_newest_events": (
        nth_newest_events,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 2",
    ),
    "stage_fold_events": (stage_fold_events, f"WITH {STAGED} SELECT user_id, version, stage AS current_stage FROM l"),
    "stage_fold_archiving_events": (
        stage_fold_archiving_events,
        f"""WITH {STAGED}, c AS (SELECT user_id, stage, max((ts, event_id)) AS at FROM e WHERE stage IN ('Production', 'Staging') GROUP BY 1, 2)
        SELECT l.user_id, version, CASE WHEN (l.ts, l.event_id) < c.at THEN 'Archived' ELSE l.stage END AS current_stage
        FROM l LEFT JOIN c ON c.user_id = l.user_id AND c.stage = l.stage""",
    ),
    "tombstone_events": (
        tombstone_events,
        f"WITH {STAGED} SELECT user_id, version, event_id, event_type, value FROM l WHERE event_type <> 'error'",
    ),
    "attribute_fold_events": (
        attribute_fold_events,
        """SELECT user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "version_number_events": (
        version_number_events,
        "SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events",
    ),
    "append_versions_events": (
        append_versions_events,
        """WITH n AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events)
        SELECT * FROM n WHERE ts >= TIMESTAMP '2024-01-16'""",
    ),
    "stream_score_lineitem": (
        stream_score_lineitem,
        f"""WITH {FIT} SELECT {', '.join(ROW)}, l_returnflag, {r('b + w * l_quantity', 4, 'prediction')}
        FROM lineitem JOIN f USING (l_returnflag)""",
    ),
    "stream_weekly_events": (
        stream_weekly_events,
        f"""SELECT event_type, CAST(date_trunc('week', ts) AS TIMESTAMP) AS semana, {r('sum(value)', 2, 'value_semana')}
        FROM events GROUP BY 1, 2""",
    ),
    "stream_weekly_late_events": (
        stream_weekly_late_events,
        f"""SELECT event_type, CAST(date_trunc('week', ts) AS TIMESTAMP) AS semana, {r('sum(value)', 2, 'value_semana')}
        FROM events GROUP BY 1, 2""",
    ),
}
