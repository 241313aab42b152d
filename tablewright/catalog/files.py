"""Queries over files: landing, tables on disk, streams.

Their files are written from the given tables to fresh folders under the shared
folder of the session, and read back by the operator in question.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.catalog.base import AS_OF, FIRST_LOAD, RUN_TS, query
from tablewright.catalog.mapped import CONFIG_LOAD
from tablewright.catalog.tables import (
    LAST_ORDER,
    LAST_ORDERS,
    UPSERT_ORACLE,
    last_order_stage,
    last_order_target,
)
from tablewright.functions.dates import file_date
from tablewright.operators.checks import check_row_count, row_count
from tablewright.operators.current import latest_rows
from tablewright.operators.joins import tracked_rows
from tablewright.operators.projection import conform, with_audit
from tablewright.plans.delta import before, day_of, delta_bounds, delta_filter
from tablewright.plans.loads import mapped_rows, run_load
from tablewright.plans.mapping import Delta, Field, Mapping, OrderKey
from tablewright.plans.tasks import run_build
from tablewright.session import filesystem, fresh_path, stage
from tablewright.sinks import keyed
from tablewright.sinks import tables as sink
from tablewright.sinks.archive import add_to_archive, read_archive, refresh_current
from tablewright.sinks.lookup import narrowed, write_for_lookup
from tablewright.sources.landing import read_csv, read_json, read_landing, route, stamp_lineage
from tablewright.sources.schema import schema_from_definition, table_definition, target_schema
from tablewright.sources.sql import register_sources, run_sql
from tablewright.streaming.landing import landing_stream
from tablewright.streaming.landing import stream_landing as land
from tablewright.streaming.tables import stream_checked as checked
from tablewright.streaming.tables import stream_current_view as follow_current
from tablewright.streaming.tables import stream_upsert as follow_upsert

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_json(df: DataFrame, label: str, mode: str = "errorifexists", path: str | None = None) -> str:
    path = path or fresh_path(df.sparkSession, label)
    df.write.mode(mode).option("timestampNTZFormat", _MICROS).json(path)
    return path


# --- landed files -----------------------------------------------------------------


@query("events", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ingest_json(spark, events):
    return read_landing(spark, f"{write_json(events, 'events')}/*.json", events.schema)


@query(
    "customer",
    oracle="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def ingest_csv(spark, customer):
    path = fresh_path(spark, "customer")
    customer.write.option("header", True).csv(path)
    return read_landing(spark, f"{path}/*.csv", customer.schema)


@query(
    "customer",
    oracle="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def ingest_csv_skip(spark, customer):
    """Files with three leading lines and another delimiter."""
    path = fresh_path(spark, "customer")
    files = max(4, customer.count() // 1_000_000)
    lines = customer.select(
        F.pmod(F.hash("c_custkey"), F.lit(files)).alias("file"),
        F.lit(3).alias("nth"),
        F.to_csv(F.struct("*"), {"sep": "|"}).alias("line"),
    )
    heads = spark.range(files * 3).select(
        (F.col("id") % files).cast("int").alias("file"),
        (F.col("id") / files).cast("int").alias("nth"),
        F.lit("leading line").alias("line"),
    )
    rows = lines.union(heads).repartitionById(files, F.col("file")).sortWithinPartitions("file", "nth")
    rows.select("line").write.text(path)
    return read_csv(spark, f"{path}/*.txt", customer.schema, sep="|", skip_rows=3)


NESTED_DEFINITION = [
    {"name": "order_id", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "placed", "type": "DATE"},
    {"name": "is_open", "type": "BOOLEAN"},
    {"name": "states", "type": "STRING", "mode": "REPEATED"},
    {"name": "total", "type": "FLOAT"},
    {
        "name": "lines",
        "type": "RECORD",
        "mode": "REPEATED",
        "fields": [
            {"name": "number", "type": "INTEGER"},
            {
                "name": "shipped",
                "type": "RECORD",
                "fields": [
                    {"name": "quantity", "type": "FLOAT"},
                    {
                        "name": "parts",
                        "type": "RECORD",
                        "mode": "REPEATED",
                        "fields": [{"name": "part_id", "type": "INTEGER"}],
                    },
                ],
            },
        ],
    },
]


@query(
    "orders",
    "lineitem",
    oracle="""
    SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS placed, o_orderstatus = 'O' AS is_open,
           o_orderstatus AS state, o_totalprice AS total, l_linenumber AS line, l_quantity AS quantity,
           l_partkey AS part_id
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def ingest_nested(spark, orders, lineitem):
    """Orders as documents with their lines in records four levels deep, under a schema from a definition."""
    parts = F.array(F.struct(F.col("l_partkey").alias("part_id")))
    shipped = F.struct(F.col("l_quantity").alias("quantity"), parts.alias("parts"))
    line = F.struct(F.col("l_linenumber").alias("number"), shipped.alias("shipped"))
    lines = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.collect_list(line).alias("lines"))
    documents = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("placed"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        F.array("o_orderstatus").alias("states"),
        F.col("o_totalprice").alias("total"),
    ).join(lines, "order_id")
    schema = schema_from_definition(NESTED_DEFINITION)
    found = read_json(spark, f"{write_json(documents, 'nested')}/*.json", schema)
    return found.select("*", F.explode("lines").alias("l")).select(
        "order_id",
        F.col("placed").cast("string").alias("placed"),
        "is_open",
        F.col("states")[0].alias("state"),
        "total",
        F.col("l.number").alias("line"),
        F.col("l.shipped.quantity").alias("quantity"),
        F.col("l.shipped.parts")[0]["part_id"].alias("part_id"),
    )


def put_files(df: DataFrame, folder: str) -> None:
    """One file per value of ``object``, under that name, last changed at six on the day after the name's, or in March."""
    spark, written = df.sparkSession, fresh_path(df.sparkSession, "put")
    rows = df.repartition("object").write.option("timestampNTZFormat", _MICROS)
    rows.partitionBy("object").json(written)
    at, system = filesystem(spark, written)
    system.mkdirs(filesystem(spark, folder)[0])
    for status in system.listStatus(at):
        if not status.isDirectory():
            continue
        name = status.getPath().getName().partition("=")[2]
        day = re.search(r"\d{8}", name)
        changed = datetime.strptime(day[0], "%Y%m%d") + timedelta(days=1) if day else datetime(2024, 3, 1)
        changed = changed.replace(hour=6, tzinfo=timezone.utc)
        for part in system.listStatus(status.getPath()):
            target = filesystem(spark, f"{folder}/{name}")[0]
            system.rename(part.getPath(), target)
            system.setTimes(target, int(changed.timestamp() * 1000), -1)


#: Names and times of the files that :func:`put_files` makes of events, and the lineage that follows from them.
_OBJECT = """CASE WHEN user_id % 3 = 2 THEN 'team_latest_' || user_id % 2 || '.json'
                  ELSE 'team_' || strftime(ts, '%Y%m%d') || '_' || user_id % 3 || '.json' END"""
_LOADED = """CASE WHEN user_id % 3 = 2 THEN TIMESTAMP '2024-03-01 06:00:00'
                  ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 30 HOUR END"""
_DATED = f"CASE WHEN user_id % 3 = 2 THEN {_LOADED} ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END"


def event_files(events: DataFrame) -> DataFrame:
    dated = F.concat(F.lit("team_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.col("user_id") % 3, F.lit(".json"))
    undated = F.concat(F.lit("team_latest_"), F.col("user_id") % 2, F.lit(".json"))
    return events.withColumn("object", F.when(F.col("user_id") % 3 == 2, undated).otherwise(dated))


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("file_dt", "load_dt")})


@query(
    "events",
    oracle=f"""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'resent.json' ELSE {_OBJECT} END AS file_name,
           {_DATED} AS file_dt, {_LOADED} AS load_dt
    FROM events
    """,
)
def landing_lineage(spark, events):
    """Name, date and load time of the files that rows come from; rows that have a name keep it."""
    folder = fresh_path(spark, "landing")
    given = F.when(F.col("event_type") == "error", F.lit("resent.json")).alias("file_name")
    put_files(event_files(events).select("event_id", "object", given), folder)
    found = spark.read.schema("event_id bigint, file_name string").json(f"{folder}/*.json")
    return _plain_times(stamp_lineage(found))


@query(
    "events",
    oracle="""
    SELECT event_id, event_id % 8 AS form,
           CASE event_id % 8
             WHEN 0 THEN date_trunc('minute', ts)
             WHEN 1 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
             WHEN 2 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
             WHEN 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
             WHEN 4 THEN date_trunc('minute', ts)
             WHEN 5 THEN CAST(ts AS DATE) + INTERVAL 1245 MINUTE
           END AS file_dt
    FROM events
    """,
)
def file_date_extract(spark, events):
    """File names in eight forms: with and without time, month names, none, no date."""
    forms = [
        F.date_format("ts", "'team_'yyyyMMdd'_'HHmm'.json'"),
        F.date_format("ts", "'team_'yyyy-MM-dd'.json'"),
        F.date_format("ts", "'league_'dd-MM-yyyy'.csv'"),
        F.upper(F.date_format("ts", "'team_'dd-MMM-yyyy'.json'")),
        F.lower(F.date_format("ts", "'team.'yyyy.MMM.dd.HH.mm'.json'")),
        F.date_format("ts", "'team_'dd-MM-yyyy'_2045.json'"),
        F.lit("team_latest.json"),
        F.date_format("ts", "'team_'yyyy'1399.json'"),
    ]
    name = F.element_at(F.array(*forms), (F.col("event_id") % 8 + 1).cast("int"))
    return events.select("event_id", (F.col("event_id") % 8).alias("form"), file_date(name).alias("file_dt"))


@query(
    "events",
    oracle="""
    SELECT event_id, event_type || '_team_' || user_id || '.json' AS file_name FROM events
    WHERE event_type <> 'click'
    """,
)
def route_by_token(spark, events):
    """Only a token between underscores counts: a longer word that holds it does not."""
    feed = F.when(F.col("event_type") == "click", "_teams_").otherwise("_team_")
    name = F.concat("event_type", feed, "user_id", F.lit(".json"))
    return route(events.select("event_id", name.alias("file_name")), "team")


@query(
    "events",
    oracle="""
    SELECT event_type, user_id, count(*) AS n, max(value) AS largest FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY event_type, user_id
    """,
)
def param_sql(spark, events):
    """SQL with a table name, a list of key columns and a bound as parameters."""
    register_sources(spark, {"source_events": events})
    text = """
        select {KEY}, count(*) as n, max(IDENTIFIER(:check_field)) as largest
        from IDENTIFIER(:source) where IDENTIFIER(:date_field) >= cast(:lower as timestamp_ntz)
        group by {KEY}
    """
    params = {
        "source": "source_events",
        "check_field": "value",
        "date_field": "ts",
        "lower": "2024-01-10 00:00:00",
    }
    return run_sql(spark, text, params, columns={"KEY": ["event_type", "user_id"]})


# --- tables on disk -----------------------------------------------------------------


@query("customer", oracle="SELECT * FROM customer UNION ALL SELECT * FROM customer")
def write_append(spark, customer):
    path = fresh_path(spark, "append")
    sink.create_target(spark, path, customer.schema)
    for _ in range(2):
        sink.write(customer, path, "WRITE_APPEND")
    return sink.read(spark, path)


@query(
    "customer",
    oracle="SELECT c_custkey, c_name, c_nationkey FROM customer",
)
def write_truncate(spark, customer):
    """A replaced table keeps its schema: another column and type of the new rows are not taken."""
    path = fresh_path(spark, "truncate")
    for _ in range(2):
        sink.write(customer.select("c_custkey", "c_name", "c_nationkey"), path, "WRITE_APPEND")
    sink.write(customer.withColumn("c_nationkey", F.col("c_nationkey").cast("long")), path, "WRITETRUNCATE")
    return sink.read(spark, path)


@query(
    "lineitem",
    oracle="SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def stage_transient(spark, lineitem):
    """A transient table replaces schema and rows of the one before, from which it is built."""
    path = fresh_path(spark, "transient")
    sink.write(lineitem, path, "WRITETRANSIENT")
    flags = sink.read(spark, path).groupBy("l_returnflag").agg(F.count("*").alias("n"))
    sink.write(flags, path, "WRITETRANSIENT")
    return sink.read(spark, path)


@query("orders", oracle="SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after FROM orders")
def write_delete(spark, orders):
    path = fresh_path(spark, "delete")
    sink.write(orders, path)
    before = row_count(stage(sink.read(spark, path)))
    sink.truncate(spark, path)
    after = row_count(sink.read(spark, path))
    return before.select(F.col("n_rows").alias("n_before"), after.scalar().alias("n_after"))


@query("orders", oracle=UPSERT_ORACLE)
def write_upsert(spark, orders):
    """The upsert into a table on disk, of which only touched buckets are rewritten."""
    target = last_order_target(orders)
    path = fresh_path(spark, "upsert")
    keyed.publish(target, path, ["customer_id"])
    keyed.publish_upsert(path, last_order_stage(orders), ["customer_id"], RUN_TS, target.schema)
    return keyed.read_table(spark, path)


PART_TARGET = Mapping(
    target="dim_part",
    driving_table="part",
    fields=(
        Field("part_id", "INTEGER", "p_partkey", pk=True, nullable=False),
        Field("part_name", "STRING", "p_name"),
        Field("is_large", "BOOLEAN", transformation="src.p_size > 25", nullable=False),
        Field("small_size", "INTEGER", transformation="nullif(least(src.p_size, 26), 26)"),
    ),
    delta=Delta("src.p_partkey", "0"),
)


@query(
    "part",
    name="target_schema",
    oracle="""
    SELECT * FROM (VALUES
      ('part_id', 'INTEGER', 'required'), ('dw_created_dt', 'TIMESTAMP', 'required'),
      ('dw_last_modified_dt', 'TIMESTAMP', 'required'), ('part_name', 'STRING', 'nullable'),
      ('is_large', 'BOOLEAN', 'required'), ('small_size', 'INTEGER', 'nullable')) AS c(name, type, mode)
    JOIN (
      SELECT 'part_id' AS name, count(p_partkey) AS n_filled FROM part
      UNION ALL SELECT 'dw_created_dt', count(*) FROM part
      UNION ALL SELECT 'dw_last_modified_dt', count(*) FROM part
      UNION ALL SELECT 'part_name', count(p_name) FROM part
      UNION ALL SELECT 'is_large', count(p_size) FROM part
      UNION ALL SELECT 'small_size', count(*) FILTER (p_size <= 25) FROM part
    ) USING (name)
    """,
)
def target_schema_load(spark, part):
    """A table created from its mapping and loaded: columns, and how many values they hold."""
    schema = target_schema(PART_TARGET)
    path = fresh_path(spark, "target")
    sink.create_target(spark, path, schema)
    rows = with_audit(mapped_rows(PART_TARGET, {"part": part}), FIRST_LOAD, created=True)
    sink.write(rows, path, "WRITEAPPEND")
    filled = sink.read(spark, path).agg(*[F.count(c).alias(c) for c in schema.names])
    columns = [
        F.struct(*[F.lit(d[k]).alias(k) for k in ("name", "type", "mode")], F.col(d["name"]).alias("n_filled"))
        for d in table_definition(schema)
    ]
    return filled.select(F.inline(F.array(*columns)))


@query(
    "supplier",
    oracle="""
    SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey,
           CAST(NULL AS VARCHAR) AS s_comment
    FROM supplier
    """,
)
def conform_columns(spark, supplier):
    schema = T.StructType.fromDDL("s_name string, s_suppkey int, s_comment string, s_nationkey bigint")
    return conform(supplier, schema)


# --- streams ----------------------------------------------------------------------------


def _finish(stream) -> None:
    stream.awaitTermination()


@query(
    "events",
    oracle=f"""
    SELECT event_id, ts, user_id, event_type, value, props, {_OBJECT} AS file_name, {_DATED} AS file_dt,
           {_LOADED} AS load_dt
    FROM events
    """,
)
def stream_landing(spark, events):
    """Files that land in two rounds, appended with their lineage by two runs to an archive in days, and read from there."""
    folder, archive, checkpoint = (fresh_path(spark, n) for n in ("landing", "archive", "checkpoint"))
    # Files without a date in their name hold days of both rounds, and land last.
    early = (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("user_id") % 3 != 2)
    for rows in (events.where(early), events.where(~early)):
        put_files(event_files(rows), folder)
        _finish(land(spark, folder, events.schema, archive, checkpoint))
    return _plain_times(read_archive(spark, archive).drop(day_of("file_dt")))


def _event_archive(events: DataFrame) -> DataFrame:
    """Events as archived rows; the lineage is in the rows, so it is not stamped anew."""
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("file_name"),
        F.date_trunc("day", "ts").alias("file_dt"),
        F.col("ts").alias("load_dt"),
    )


@query(
    "events",
    oracle="""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) = 1
    """,
)
def stream_current_view(spark, events):
    """The newest files land first: what arrives late and is older does not win."""
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landing", "current", "checkpoint"))
    archive = _event_archive(events)
    late = F.col("file_dt") < F.lit("2024-01-15").cast("timestamp_ntz")
    order = [OrderKey("file_dt", True), OrderKey("load_dt", True), OrderKey("event_id", True)]
    for rows in (archive.where(~late), archive.where(late)):
        write_json(rows, "landing", "append", folder)
        stream = landing_stream(spark, folder, archive.schema)
        _finish(follow_current(stream, path, ["user_id"], checkpoint, order))
    return keyed.read_table(spark, path).select("user_id", "event_id", "event_type")


@query("orders", oracle=UPSERT_ORACLE)
def stream_upsert(spark, orders):
    """The arrivals of the upsert in two batches, by year."""
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landing", "upsert", "checkpoint"))
    target = last_order_target(orders)
    keyed.publish(target, path, ["customer_id"])
    arrivals = mapped_rows(LAST_ORDERS, {"orders": latest_rows(
        orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")),
        ["o_custkey", "year(o_orderdate)"],
        LAST_ORDER,
    )})
    order = [OrderKey("order_dt", True), OrderKey("order_id", True)]
    last_year = F.year("order_dt") > 2000
    for rows in (arrivals.where(~last_year), arrivals.where(last_year)):
        write_json(rows, "landing", "append", folder)
        stream = spark.readStream.schema(arrivals.schema).json(folder)
        _finish(
            follow_upsert(stream, path, ["customer_id"], order, RUN_TS, target.schema, checkpoint)
        )
    return keyed.read_table(spark, path)


@query("customer", oracle="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def stream_checked(spark, customer):
    """Batches that are published after their row count has been checked."""
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "checked", "checkpoint"))
    rows = customer.select("c_custkey", "c_name", "c_mktsegment")
    schema = rows.schema

    def publish(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, so a repeated batch replaces itself.
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    machinery = F.col("c_mktsegment") == "MACHINERY"
    for part in (rows.where(machinery), rows.where(~machinery)):
        write_json(part, "landing", "append", folder)
        _finish(checked(spark.readStream.schema(schema).json(folder), checkpoint, publish, check_row_count))
    return spark.read.parquet(out).drop("batch")


# --- archives in days, tables for lookups ---------------------------------------------


@query(
    "events",
    oracle=f"""
    SELECT event_id, user_id, event_type, CAST(ts AS DATE)::TIMESTAMP AS file_dt, TIMESTAMP '{RUN_TS}' AS dw_created_dt,
           TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM events WHERE ts >= TIMESTAMP '2024-01-28' AND ts < TIMESTAMP '2024-01-31'
    """,
)
def delta_pruned(spark, events):
    """A load of three days from an archive in days: the scan lists no others."""
    path = fresh_path(spark, "archive")
    add_to_archive(_event_archive(events), path)
    fields = (Field("event_id", pk=True), Field("user_id"), Field("event_type"), Field("file_dt"))
    mapping = Mapping("ld_event", "arc_event", fields, delta=Delta("src.file_dt", "timestamp_ntz'2024-01-28'", 3 * 86400))
    return run_load(mapping, {"arc_event": read_archive(spark, path)}, RUN_TS, as_of=AS_OF)


@query(
    "events",
    oracle="""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) = 1
    """,
)
def current_pruned(spark, events):
    """A current view of the archive's first days, brought up to date from the days that follow."""
    path, view = fresh_path(spark, "archive"), fresh_path(spark, "current")
    order = [OrderKey("file_dt", True), OrderKey("load_dt", True), OrderKey("event_id", True)]
    archive = _event_archive(events)
    late = F.col("file_dt") >= F.lit("2024-01-20").cast("timestamp_ntz")
    add_to_archive(archive.where(~late), path)
    refresh_current(read_archive(spark, path), view, ["user_id"], "2024-01-01 00:00:00", order)
    add_to_archive(archive.where(late), path)
    refresh_current(read_archive(spark, path), view, ["user_id"], "2024-01-20 00:00:00", order)
    return keyed.read_table(spark, view).select("user_id", "event_id", "event_type")


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate < TIMESTAMP '2001-07-20'
      AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-20')
    """,
)
def tracked_pruned(spark, orders):
    """Earlier rows of the keys in a short window, looked up in a table with Bloom filters."""
    path = fresh_path(spark, "orders")
    write_for_lookup(orders, path, ["o_custkey"])
    table = spark.read.parquet(path)
    lo, hi = delta_bounds("timestamp_ntz'2001-07-20 00:00:00'", None, AS_OF)
    recent = delta_filter(table, "o_orderdate", lo, hi)
    earlier = narrowed(before(table, "o_orderdate", lo), recent, ["o_custkey"])
    return tracked_rows(earlier, recent, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderdate")


# --- whole tasks ------------------------------------------------------------------


@query(
    "supplier",
    "nation",
    "region",
    oracle="""
    WITH built AS (
      SELECT s_suppkey FROM supplier
      LEFT JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey AND r_name IN ('ASIA', 'EUROPE', 'AFRICA')
      WHERE s_acctbal > 0 OR s_acctbal IS NULL
    )
    SELECT 'dim_supplier' AS "table", 'row_count' AS "check", count(*) > 0 AS result,
           CAST(count(*) = 0 AS BIGINT) AS n_failed FROM built
    UNION ALL
    SELECT 'dim_supplier', 'duplicate_records', count(*) = 0, count(*) FROM built
    """,
)
def task_build_checked(spark, supplier, nation, region):
    """A table built, written and checked; the second run adds its rows again, and the check finds them."""
    sources = {"sales.supplier": supplier, "sales.nation": nation, "sales.region": region}
    path = fresh_path(spark, "dim_supplier")
    run_build(spark, CONFIG_LOAD, sources, path, RUN_TS)
    return run_build(spark, {**CONFIG_LOAD, "write_disposition": "WRITE_APPEND"}, sources, path, RUN_TS)


CONFIG_LAST_ORDERS = {
    "destination_table": "dim_last_order",
    "driving_table": "sales.orders",
    "source_to_target": [
        {"name": "customer_id", "source_column": "o_custkey", "pk": True},
        {"name": "order_id", "source_column": "o_orderkey"},
        {"name": "order_dt", "source_column": "o_orderdate"},
        {"name": "price", "source_column": "o_totalprice"},
    ],
    "delta": {"field": {"source_column": "o_orderdate"}, "lower_bound": "timestamp_ntz'2000-01-01 00:00:00'"},
}


@query("orders", oracle=UPSERT_ORACLE)
def task_build_delta(spark, orders):
    """An incremental task on the table of the day before: the buckets of its window are written anew, others stay."""
    path = fresh_path(spark, "dim_last_order")
    keyed.publish(last_order_target(orders), path, ["customer_id"])
    latest = latest_rows(orders, ["o_custkey"], LAST_ORDER)
    run_build(spark, CONFIG_LAST_ORDERS, {"sales.orders": latest}, path, RUN_TS, AS_OF)
    return keyed.read_table(spark, path)
