"""Queries over keyed tables: windows, upserts, histories, current views, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.catalog.base import AS_OF, FIRST_LOAD, RUN_TS, query
from tablewright.operators import checks
from tablewright.operators.current import current_view as current_rows
from tablewright.operators.current import latest_rows, reshape_records, unnest
from tablewright.operators.history import cdc_filter as cdc_rows
from tablewright.operators.history import close_intervals as closed_rows
from tablewright.operators.history import history_stage, open_rows
from tablewright.operators.projection import project, with_audit
from tablewright.operators.upsert import classify
from tablewright.operators.upsert import insert_new as inserted
from tablewright.operators.upsert import union_append as appended
from tablewright.operators.upsert import update_from as updated
from tablewright.operators.windows import analytic
from tablewright.plans.loads import mapped_rows, run_load, type1_delta
from tablewright.plans.loads import scd2_delta as history_delta
from tablewright.plans.loads import scd2_full as history_full
from tablewright.plans.mapping import Delta, Field, History, Mapping, OrderKey, TargetType
from tablewright.plans.tasks import current_table, run_build
from tablewright.session import fresh_path, stage
from tablewright.sinks import keyed
from tablewright.sources.sql import run_sql

# --- windows --------------------------------------------------------------------


@query(
    "events",
    oracle="""
    SELECT event_id, user_id, value, lag(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value
    FROM events
    """,
)
def window_lag(spark, events):
    found = analytic(events, "lag", "value", ["user_id"], ["ts", "event_id"])
    return found.select("event_id", "user_id", "value", "prev_value")


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_custkey, o_orderdate,
           lead(o_orderdate, 1, TIMESTAMP '2999-12-31 23:59:59')
             OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to_dt
    FROM orders
    """,
    open_ended=True,
)
def window_lead(spark, orders):
    found = analytic(
        orders,
        "lead",
        "o_orderdate",
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        default="timestamp_ntz'2999-12-31 23:59:59'",
        name="effective_to_dt",
    )
    return found.select("o_orderkey", "o_custkey", "o_orderdate", "effective_to_dt")


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_custkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nth
    FROM orders
    """,
)
def window_row_number(spark, orders):
    order = [OrderKey("o_totalprice", desc=True), OrderKey("o_orderkey")]
    found = analytic(orders, "row_number", None, ["o_custkey"], order, name="nth")
    return found.select("o_orderkey", "o_custkey", "nth")


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
           rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS place
    FROM lineitem
    """,
)
def window_rank(spark, lineitem):
    found = analytic(lineitem, "rank", None, ["l_suppkey"], ["l_shipdate"], name="place")
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "place")


@query(
    "events",
    oracle="""
    SELECT event_id, lag(value, 2, -1.0)
             OVER (PARTITION BY user_id, lower(event_type) ORDER BY CAST(ts AS DATE) DESC, event_id) AS prev_value
    FROM events
    """,
)
def window_multi_key(spark, events):
    """Several keys, keys that are expressions, a descending order and an offset."""
    order = [OrderKey("to_date(ts)", desc=True), OrderKey("event_id")]
    found = analytic(
        events, "lag", "value", ["user_id", "lower(event_type)"], order, offset=2, default="-1.0D"
    )
    return found.select("event_id", "prev_value")


@query(
    "events",
    oracle="""
    SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_type
    FROM events
    """,
)
def window_replace_column(spark, events):
    found = analytic(
        events.select("event_id", "event_type", "ts", "user_id"),
        "lead",
        "event_type",
        ["user_id"],
        ["ts", "event_id"],
        name="event_type",
    )
    return found.select("event_id", "event_type")


@query(
    "events",
    oracle="""
    SELECT event_id, event_type,
           lag(value, 3, -1.0) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before,
           lead(value, 2) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS after,
           row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth
    FROM events
    """,
)
def window_hot_keys(spark, events):
    """Few keys with many rows each: windows over segments of a key."""
    found = events.select("event_id", "event_type", "value", "ts")
    keys, order, limit = ["event_type"], ["ts", "event_id"], 1900
    found = analytic(found, "lag", "value", keys, order, 3, "-1.0D", "before", rows_per_task=limit)
    found = analytic(found, "lead", "value", keys, order, 2, name="after", rows_per_task=limit)
    found = analytic(found, "row_number", None, keys, order, name="nth", rows_per_task=limit)
    return found.select("event_id", "event_type", "before", "after", "nth")


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_shipdate,
           rank() OVER (PARTITION BY l_returnflag ORDER BY date_trunc('year', l_shipdate)) AS place,
           count(*) OVER (PARTITION BY l_returnflag) AS n_rows
    FROM lineitem
    """,
)
def window_hot_ties(spark, lineitem):
    """Few keys and long runs of ties: a run is cut into segments and keeps one rank.

    The last row number of a key is its number of rows, whatever the order of ties.
    """
    found = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate")
    keys, order, limit = ["l_returnflag"], ["date_trunc('year', l_shipdate)"], 1900
    found = analytic(found, "rank", None, keys, order, name="place", rows_per_task=limit)
    numbered = analytic(found, "row_number", None, keys, order, name="nth", rows_per_task=limit)
    last = numbered.groupBy("l_returnflag").agg(F.max("nth").alias("n_rows"))
    return found.join(F.broadcast(last), "l_returnflag").select(*found.columns, "n_rows")


# --- type-1 upserts -----------------------------------------------------------------

LAST_ORDER = [OrderKey("o_orderdate", desc=True), OrderKey("o_orderkey", desc=True)]

_LAST = """
    last_orders AS (
      SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS order_dt, o_totalprice AS price,
             {period} AS period
      FROM orders
      QUALIFY row_number() OVER (
        PARTITION BY o_custkey, period ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    ),
    trg AS (SELECT * EXCLUDE (period) FROM last_orders WHERE period = 'target'),
    stg AS (SELECT * EXCLUDE (period) FROM last_orders WHERE period = 'delta')
""".format(
    period="""CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'target'
                  WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'delta' END"""
)

LAST_ORDERS = Mapping(
    target="dim_last_order",
    driving_table="orders",
    fields=(
        Field("customer_id", source_column="o_custkey", pk=True),
        Field("order_id", source_column="o_orderkey"),
        Field("order_dt", source_column="o_orderdate"),
        Field("price", source_column="o_totalprice"),
    ),
    delta=Delta("src.o_orderdate", "timestamp_ntz'2000-01-01 00:00:00'"),
)


def last_order_target(orders: DataFrame) -> DataFrame:
    early = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    rows = mapped_rows(LAST_ORDERS, {"orders": latest_rows(early, ["o_custkey"], LAST_ORDER)})
    return stage(with_audit(rows, FIRST_LOAD, created=True), "target")


def last_order_stage(orders: DataFrame) -> DataFrame:
    late = orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return stage(mapped_rows(LAST_ORDERS, {"orders": latest_rows(late, ["o_custkey"], LAST_ORDER)}), "delta")


@query(
    "orders",
    oracle=f"""
    WITH {_LAST}
    SELECT stg.*, CASE WHEN trg.customer_id IS NULL THEN 1 ELSE 2 END AS row_action
    FROM stg LEFT JOIN trg ON stg.customer_id = trg.customer_id
    """,
)
def classify_rows(spark, orders):
    return classify(last_order_stage(orders), last_order_target(orders), ["customer_id"])


@query(
    "orders",
    oracle=f"""
    WITH {_LAST}
    SELECT trg.* FROM trg
    UNION ALL SELECT stg.* FROM stg WHERE customer_id NOT IN (SELECT customer_id FROM trg)
    """,
)
def insert_new(spark, orders):
    target = last_order_target(orders).select("customer_id", "order_id", "order_dt", "price")
    return inserted(target, last_order_stage(orders), ["customer_id"])


@query(
    "orders",
    oracle=f"""
    WITH {_LAST}
    SELECT trg.customer_id,
           CASE WHEN stg.price > trg.price THEN stg.order_id ELSE trg.order_id END AS order_id,
           CASE WHEN stg.price > trg.price THEN stg.price ELSE trg.price END AS price
    FROM trg LEFT JOIN stg ON stg.customer_id = trg.customer_id
    """,
)
def update_from(spark, orders):
    """UPDATE .. FROM with a condition besides the key."""
    target = last_order_target(orders).select("customer_id", "order_id", "price")
    sets = {"order_id": "src.order_id", "price": "src.price"}
    dearer = F.col("src.price") > F.col("trg.price")
    return updated(target, last_order_stage(orders), ["customer_id"], sets, dearer)


UPSERT_ORACLE = f"""
    WITH {_LAST}
    SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
           coalesce(s.order_id, t.order_id) AS order_id,
           coalesce(s.order_dt, t.order_dt) AS order_dt,
           coalesce(s.price, t.price) AS price,
           CASE WHEN t.customer_id IS NULL THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '{FIRST_LOAD}' END AS dw_created_dt,
           CASE WHEN s.customer_id IS NULL THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{RUN_TS}' END
             AS dw_last_modified_dt
    FROM trg t FULL JOIN stg s ON t.customer_id = s.customer_id
"""


@query("orders", oracle=UPSERT_ORACLE)
def type1_delta_upsert(spark, orders):
    latest = latest_rows(orders, ["o_custkey"], LAST_ORDER)
    return type1_delta(LAST_ORDERS, {"orders": latest}, last_order_target(orders), AS_OF, RUN_TS)


@query(
    "orders",
    oracle=f"""
    WITH {_LAST}
    SELECT stg.*, TIMESTAMP '{RUN_TS}' AS dw_created_dt, TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt FROM stg
    """,
)
def delta_first_load(spark, orders):
    """The first incremental load takes its window, like those that follow."""
    late = latest_rows(orders, ["o_custkey", "o_orderdate < timestamp_ntz'2000-01-01'"], LAST_ORDER)
    return run_load(LAST_ORDERS, {"orders": late}, RUN_TS, as_of=AS_OF)


@query(
    "orders",
    oracle=f"""
    WITH {_LAST}
    SELECT * FROM trg UNION ALL SELECT * FROM stg
    """,
)
def union_append(spark, orders):
    target = last_order_target(orders).select("customer_id", "order_id", "order_dt", "price")
    return appended(target, last_order_stage(orders))


# --- type-2 histories ---------------------------------------------------------------

EVENT_HISTORY = Mapping(
    target="hist_user_event",
    driving_table="events",
    target_type=TargetType.HISTORY,
    fields=(
        Field("user_id", pk=True, hk=True, data_type="INTEGER", nullable=False),
        Field("effective_from_dt", source_column="ts", pk=True, data_type="TIMESTAMP", nullable=False),
        Field("effective_from_dt_csn_seq", source_column="event_id", pk=True, data_type="INTEGER"),
        Field("effective_from_dt_seq", transformation="1", pk=True, data_type="INTEGER"),
        Field("event_type", data_type="STRING"),
    ),
    history=History(["user_id"], ["event_type"]),
)

_MAPPED = """
    mapped AS (
      SELECT user_id, ts AS effective_from_dt, event_id AS effective_from_dt_csn_seq,
             1 AS effective_from_dt_seq, event_type
      FROM events {where}
    ),
    p1 AS (
      SELECT *, lag(event_type) OVER (
        PARTITION BY user_id ORDER BY effective_from_dt, effective_from_dt_csn_seq, effective_from_dt_seq)
        AS prev_event_type
      FROM mapped
    ),
    p2 AS (SELECT * EXCLUDE (prev_event_type) FROM p1 WHERE event_type IS DISTINCT FROM prev_event_type),
    p3 AS (
      SELECT *, lead(effective_from_dt, 1, TIMESTAMP '2999-12-31 23:59:59') OVER (
        PARTITION BY user_id ORDER BY effective_from_dt, effective_from_dt_csn_seq, effective_from_dt_seq)
        AS effective_to_dt
      FROM p2
    )
"""
_ALL = _MAPPED.format(where="")


@query("events", oracle=f"WITH {_ALL} SELECT * FROM p1")
def scd2_p1(spark, events):
    rows = mapped_rows(EVENT_HISTORY, {"events": events})
    return history_stage(rows, EVENT_HISTORY.history)


@query("events", oracle=f"WITH {_ALL} SELECT * FROM p2")
def cdc_filter(spark, events):
    rows = mapped_rows(EVENT_HISTORY, {"events": events})
    return cdc_rows(history_stage(rows, EVENT_HISTORY.history), ["event_type"])


@query(
    "events",
    oracle=f"""
    WITH {_ALL}
    SELECT *, lead(effective_from_dt, 1, TIMESTAMP '2999-12-31 23:59:59') OVER (
      PARTITION BY user_id ORDER BY effective_from_dt, effective_from_dt_csn_seq, effective_from_dt_seq)
      AS effective_to_dt
    FROM mapped
    """,
    open_ended=True,
)
def close_intervals(spark, events):
    return closed_rows(mapped_rows(EVENT_HISTORY, {"events": events}), ["user_id"])


@query(
    "events",
    oracle=f"WITH {_ALL} SELECT *, TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt FROM p3",
    open_ended=True,
)
def scd2_full(spark, events):
    return history_full(EVENT_HISTORY, {"events": events}, RUN_TS)


@query(
    "events",
    oracle=f"""
    WITH {_ALL}
    SELECT user_id, effective_from_dt, effective_from_dt_csn_seq, event_type FROM p3
    WHERE effective_to_dt = TIMESTAMP '2999-12-31 23:59:59'
    """,
)
def scd2_open_rows(spark, events):
    rows = open_rows(history_full(EVENT_HISTORY, {"events": events}, RUN_TS))
    return rows.select("user_id", "effective_from_dt", "effective_from_dt_csn_seq", "event_type")


ORDER_HISTORY = Mapping(
    target="hist_customer_order",
    driving_table="orders",
    target_type=TargetType.HISTORY,
    fields=(
        Field("customer_id", source_column="o_custkey", pk=True, hk=True),
        Field("effective_from_dt", source_column="o_orderdate", pk=True),
        Field("effective_from_dt_csn_seq", source_column="o_orderkey", pk=True),
        Field("effective_from_dt_seq", transformation="1", pk=True),
        Field("status", source_column="o_orderstatus"),
        Field("priority", source_column="o_orderpriority"),
    ),
    history=History(
        ["customer_id"], ["status"], (OrderKey("src.o_orderdate"), OrderKey("abs(src.o_orderkey)"))
    ),
)


@query(
    "orders",
    oracle=f"""
    WITH p1 AS (
      SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, abs(o_orderkey)) AS prev
      FROM orders
    )
    SELECT o_custkey AS customer_id, o_orderdate AS effective_from_dt, o_orderkey AS effective_from_dt_csn_seq,
           1 AS effective_from_dt_seq, o_orderstatus AS status, o_orderpriority AS priority,
           lead(o_orderdate, 1, TIMESTAMP '2999-12-31 23:59:59')
             OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to_dt,
           TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM p1 WHERE o_orderstatus IS DISTINCT FROM prev
    """,
    open_ended=True,
)
def scd2_full_orders(spark, orders):
    """A history whose order is given over the sources."""
    return history_full(ORDER_HISTORY, {"orders": orders}, RUN_TS)


TYPE_HISTORY = Mapping(
    target="hist_type_user",
    driving_table="events",
    target_type=TargetType.HISTORY,
    fields=(
        Field("event_type", pk=True, hk=True),
        Field("effective_from_dt", source_column="ts", pk=True),
        Field("effective_from_dt_csn_seq", source_column="event_id", pk=True),
        Field("effective_from_dt_seq", transformation="1", pk=True),
        Field("last_user", source_column="user_id"),
        Field("band", transformation="floor(src.value / 50)"),
    ),
    history=History(["event_type"], ["band"]),
)


@query(
    "events",
    oracle=f"""
    WITH p1 AS (
      SELECT event_type, ts AS effective_from_dt, event_id AS effective_from_dt_csn_seq, 1 AS effective_from_dt_seq,
             user_id AS last_user, CAST(floor(value / 50) AS BIGINT) AS band,
             lag(CAST(floor(value / 50) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev
      FROM events
    )
    SELECT * EXCLUDE (prev),
           lead(effective_from_dt, 1, TIMESTAMP '2999-12-31 23:59:59')
             OVER (PARTITION BY event_type ORDER BY effective_from_dt, effective_from_dt_csn_seq) AS effective_to_dt,
           TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM p1 WHERE band IS DISTINCT FROM prev
    """,
    open_ended=True,
)
def scd2_hot_keys(spark, events):
    """A history over few keys with many rows each, built in segments of a key."""
    return history_full(TYPE_HISTORY, {"events": events}, RUN_TS, rows_per_task=1900)


EVENT_DELTA = EVENT_HISTORY.with_(
    delta=Delta("src.ts", "timestamp_ntz'2024-01-20 00:00:00'", 10 * 86400)
)


def event_history_target(events: DataFrame) -> DataFrame:
    early = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return stage(history_full(EVENT_HISTORY, {"events": early}, FIRST_LOAD, created=True), "target")


_DELTA_ORACLE = f"""
WITH
{_MAPPED.format(where="WHERE ts < TIMESTAMP '2024-01-30'")},
touched AS (
  SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-30'
)
SELECT p3.*,
       CASE WHEN effective_from_dt < TIMESTAMP '2024-01-20' THEN TIMESTAMP '{FIRST_LOAD}'
            ELSE TIMESTAMP '{RUN_TS}' END AS dw_created_dt,
       CASE WHEN user_id IN (SELECT user_id FROM touched) THEN TIMESTAMP '{RUN_TS}'
            ELSE TIMESTAMP '{FIRST_LOAD}' END AS dw_last_modified_dt
FROM p3
"""


@query("events", oracle=_DELTA_ORACLE, open_ended=True)
def scd2_delta(spark, events):
    return history_delta(EVENT_DELTA, {"events": events}, event_history_target(events), AS_OF, RUN_TS)


CONFIG_HISTORY = {
    "destination_table": "hist_user_event",
    "target_type": "HISTORY",
    "driving_table": "web.events",
    "source_to_target": [
        {"name": "user_id", "data_type": "INTEGER", "source_column": "user_id", "pk": True, "hk": True},
        {"name": "effective_from_dt", "data_type": "TIMESTAMP", "source_column": "ts", "pk": True},
        {"name": "effective_from_dt_csn_seq", "data_type": "INTEGER", "source_column": "event_id", "pk": True},
        {"name": "effective_from_dt_seq", "data_type": "INTEGER", "transformation": "1", "pk": True},
        {"name": "event_type", "data_type": "STRING", "source_column": "event_type"},
    ],
    "history": {"partition": [{"name": "user_id"}], "driving_column": [{"name": "event_type"}]},
    "delta": {
        "field": {"source_column": "ts"},
        "lower_bound": "timestamp_ntz'2024-01-20 00:00:00'",
        "upper_bound": 10 * 86400,
    },
}


@query("events", oracle=_DELTA_ORACLE, open_ended=True)
def write_history_delta(spark, events):
    """The same as a whole task on a table on disk, where only the buckets with a touched key are written anew."""
    path, keys = fresh_path(spark, "history"), EVENT_DELTA.history_keys
    keyed.publish(event_history_target(events), path, keys, null_keys=True)
    run_build(spark, CONFIG_HISTORY, {"web.events": events}, path, RUN_TS, AS_OF)
    return keyed.read_table(spark, path)


@query(
    "events",
    oracle=f"""
    WITH {_ALL}
    SELECT p3.*,
           CASE WHEN user_id IN (SELECT user_id FROM events WHERE event_id % 3 = 0) THEN TIMESTAMP '{RUN_TS}'
                ELSE TIMESTAMP '{FIRST_LOAD}' END AS dw_last_modified_dt
    FROM p3
    """,
    open_ended=True,
)
def scd2_delta_late(spark, events):
    """Rows that arrive late, before and between known ones, and take some of these out of the history."""
    known = events.where("event_id % 3 <> 0")
    target = stage(history_full(EVENT_HISTORY, {"events": known}, FIRST_LOAD, created=True), "target")
    arrived = EVENT_HISTORY.with_(delta=Delta("src.arrived", "timestamp_ntz'2024-06-01 00:00:00'"))
    stamped = events.withColumn(
        "arrived", F.when(F.col("event_id") % 3 == 0, F.lit("2024-06-02")).otherwise(F.lit("2024-05-01")).cast("timestamp_ntz")
    )
    built = history_delta(arrived, {"events": stamped}, target, AS_OF, RUN_TS)
    return built.drop("dw_created_dt")


# --- archives and nested records ------------------------------------------------------


@query(
    "events",
    oracle="""
    SELECT event_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) = 1
    """,
)
def current_view(spark, events):
    archive = events.select(
        "*",
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("file_name"),
        F.date_trunc("day", "ts").alias("file_dt"),
        F.col("ts").alias("load_dt"),
    ).drop("ts")
    tie = [OrderKey("event_id", desc=True)]
    return current_rows(archive, ["user_id"], exclude=["user_id"], tie_break=tie)


def order_archive(orders: DataFrame) -> DataFrame:
    """Orders as archived documents with a repeated record of 0, 1 or 2 elements."""
    first = F.struct(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("season"))
    second = F.struct(F.lit("ALL").alias("priority"), F.year("o_orderdate").alias("season"))
    parameters = (
        F.when(F.col("o_orderstatus") == "F", F.array(first).cast(T.ArrayType(_PARAMETER)))
        .when(F.col("o_orderstatus") == "O", F.array(first, second).cast(T.ArrayType(_PARAMETER)))
        .otherwise(F.array().cast(T.ArrayType(_PARAMETER)))
    )
    return orders.select(
        F.col("o_orderkey").alias("results"),
        parameters.alias("parameters"),
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("file_name"),
        F.col("o_orderdate").alias("file_dt"),
        F.col("o_orderdate").alias("load_dt"),
    )


_PARAMETER = T.StructType(
    [T.StructField("priority", T.StringType()), T.StructField("season", T.IntegerType())]
)

_UNNESTED = """
    SELECT o_orderkey AS results, o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS season,
           o_orderdate
    FROM orders WHERE o_orderstatus IN ('F', 'O')
    UNION ALL
    SELECT o_orderkey, 'ALL', CAST(year(o_orderdate) AS INTEGER), o_orderdate FROM orders WHERE o_orderstatus = 'O'
"""


@query("orders", oracle=f"SELECT results, priority, season FROM ({_UNNESTED})")
def unnest_array(spark, orders):
    return unnest(order_archive(orders), "parameters", "params").select("results", "priority", "season")


@query(
    "orders",
    oracle=f"""
    SELECT results FROM ({_UNNESTED})
    QUALIFY row_number() OVER (PARTITION BY priority, season ORDER BY o_orderdate DESC, results DESC) = 1
    """,
)
def unnest_current(spark, orders):
    """The current document per element of a repeated record."""
    rows = unnest(order_archive(orders), "parameters", "params")
    key = ["params.priority", "params.season"]
    tie = [OrderKey("results", desc=True)]
    found = current_rows(rows, key, exclude=["priority", "season", "params", "parameters"], tie_break=tie)
    return found.select("results")


@query(
    "orders",
    oracle=f"""
    SELECT results FROM ({_UNNESTED})
    QUALIFY row_number() OVER (PARTITION BY priority, season ORDER BY o_orderdate DESC, results DESC) = 1
    """,
)
def task_current(spark, orders):
    """The same, from the parameters of a task."""
    given = {
        "FROM": "arc_orders, unnest(parameters) params",
        "KEY": "params.priority, params.season",
        "EXCLUDE": ", priority, season, parameters",
        "TIE_BREAK": "results",
    }
    return current_table({"params": given}, {"arc_orders": order_archive(orders)})


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey, l_linenumber, 1 AS n_paging, CAST(l_quantity AS BIGINT) AS total,
           2 AS n_response, l_partkey AS venue_id, 1 AS n_team, l_suppkey AS team_id, l_returnflag AS code
    FROM lineitem
    """,
)
def nested_reshape(spark, lineitem):
    """Single records of a load table as the repeated ones of the archive."""

    def element(code):
        return F.struct(
            F.struct(F.col("l_partkey").alias("id")).alias("venue"),
            F.struct(F.col("l_suppkey").alias("id"), F.col(code).alias("code")).alias("team"),
        )

    loaded = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.struct(F.col("l_quantity").cast("long").alias("total")).alias("paging"),
        F.array(element("l_returnflag"), element("l_linestatus")).alias("response"),
    )
    archived = reshape_records(loaded, ["paging"], {"response": ["venue", "team"]})
    return archived.select(
        "l_orderkey",
        "l_linenumber",
        F.size("paging").alias("n_paging"),
        F.col("paging")[0]["total"].alias("total"),
        F.size("response").alias("n_response"),
        F.col("response")[0]["venue"][0]["id"].alias("venue_id"),
        F.size(F.col("response")[0]["team"]).alias("n_team"),
        F.col("response")[1]["team"][0]["id"].alias("team_id"),
        F.col("response")[0]["team"][0]["code"].alias("code"),
    )


# --- data checks ----------------------------------------------------------------------


@query(
    "orders",
    oracle="""
    SELECT 'row_count' AS "check", count(*) > 0 AS result, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT)
      AS n_failed FROM orders
    """,
)
def check_row_count(spark, orders):
    return checks.check_row_count(orders)


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(1) > 1
    """,
)
def duplicate_keys(spark, lineitem):
    return checks.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])


@query("events", oracle="SELECT DISTINCT user_id FROM events")
def distinct_values(spark, events):
    return checks.distinct_values(events, "user_id")


@query(
    "lineitem",
    "orders",
    oracle="""
    SELECT 'lineitem' AS "table", 'duplicate_records' AS "check", count(*) = 0 AS result, count(*) AS n_failed
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL
    SELECT 'orders', 'duplicate_records', count(*) = 0, count(*)
    FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    """,
)
def check_duplicates(spark, lineitem, orders):
    """A table that fails the check, and one that passes."""
    fails = checks.check_duplicates(lineitem, ["l_orderkey", "l_linenumber"])
    passes = checks.check_duplicates(orders, ["o_orderkey"])
    return fails.select(F.lit("lineitem").alias("table"), "*").unionByName(
        passes.select(F.lit("orders").alias("table"), "*")
    )


@query(
    "events",
    oracle=f"""
    WITH {_ALL}, opened AS (SELECT * FROM p3 WHERE effective_to_dt = TIMESTAMP '2999-12-31 23:59:59')
    SELECT 'built' AS variant, 'open_history_items' AS "check", count(*) = 0 AS result, count(*) AS n_failed
    FROM (SELECT 1 FROM opened GROUP BY user_id HAVING count(*) > 1)
    UNION ALL
    SELECT 'all_open', 'open_history_items', count(*) = 0, count(*)
    FROM (SELECT 1 FROM p3 GROUP BY user_id HAVING count(*) > 1)
    """,
)
def check_open_history(spark, events):
    """A built history passes; one whose rows were never closed fails."""
    history = history_full(EVENT_HISTORY, {"events": events}, RUN_TS)
    unclosed = history.withColumn(
        "effective_to_dt", F.lit("2999-12-31 23:59:59").cast("timestamp_ntz")
    )
    passes = checks.check_open_history(history, ["user_id"])
    fails = checks.check_open_history(unclosed, ["user_id"])
    return passes.select(F.lit("built").alias("variant"), "*").unionByName(
        fails.select(F.lit("all_open").alias("variant"), "*")
    )


def _new_value_oracle(label, table, field, date):
    return f"""
    SELECT '{label}' AS variant, 'new_value' AS "check", count(*) = 0 AS result, count(*) AS n_failed
    FROM (
      SELECT DISTINCT nd.{field} FROM {table} nd,
        (SELECT CAST(max({date}) - INTERVAL 1 DAY AS DATE) AS query_date FROM {table}
         WHERE {date} < TIMESTAMP '{RUN_TS}') qd
      WHERE CAST(nd.{date} AS DATE) > qd.query_date
        AND NOT EXISTS (
          SELECT 1 FROM {table} od WHERE od.{field} = nd.{field} AND CAST(od.{date} AS DATE) <= qd.query_date)
    )
    """


@query(
    "events",
    "orders",
    oracle=f"""
    {_new_value_oracle("users", "events", "user_id", "ts")}
    UNION ALL {_new_value_oracle("orders", "orders", "o_orderkey", "o_orderdate")}
    """,
)
def check_new_value(spark, events, orders):
    """No new users on the last day; order numbers are always new."""
    passes = checks.check_new_value(events, "user_id", "ts", RUN_TS)
    fails = checks.check_new_value(orders, "o_orderkey", "o_orderdate", RUN_TS)
    return passes.select(F.lit("users").alias("variant"), "*").unionByName(
        fails.select(F.lit("orders").alias("variant"), "*")
    )


def _suite_oracle(table, relation, key, n="count(*)"):
    return f"""
    SELECT '{table}' AS "table", 'row_count' AS "check", count(*) > 0 AS result,
           CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_failed FROM {relation}
    UNION ALL
    SELECT '{table}', 'duplicate_records', count(*) = 0, count(*)
    FROM (SELECT 1 FROM {relation} GROUP BY {key} HAVING count(*) > 1)
    """


@query(
    "orders",
    "lineitem",
    "events",
    oracle=f"""
    WITH {_ALL}
    {_suite_oracle("orders", "orders", "o_orderkey")}
    UNION ALL {_suite_oracle("lineitem", "lineitem", "l_orderkey, l_linenumber")}
    UNION ALL {_suite_oracle(
        "hist_user_event", "p3",
        "user_id, effective_from_dt, effective_from_dt_csn_seq, effective_from_dt_seq")}
    UNION ALL
    SELECT 'hist_user_event', 'open_history_items', count(*) = 0, count(*)
    FROM (SELECT 1 FROM p3 WHERE effective_to_dt = TIMESTAMP '2999-12-31 23:59:59'
          GROUP BY user_id HAVING count(*) > 1)
    """,
)
def check_suite(spark, orders, lineitem, events):
    history = history_full(EVENT_HISTORY, {"events": events}, RUN_TS)
    return (
        checks.check_suite(orders, "orders", ["o_orderkey"])
        .unionByName(checks.check_suite(lineitem, "lineitem", ["l_orderkey", "l_linenumber"]))
        .unionByName(checks.check_mapping(history, EVENT_HISTORY))
    )


@query(
    "documents",
    "labels",
    oracle="""
    SELECT 'documents' AS "table", 'required_fields' AS "check", count(*) = 0 AS result, count(*) AS n_failed
    FROM documents WHERE doc_id IS NULL
    UNION ALL
    SELECT 'labelled', 'required_fields', count(*) = 0, count(*)
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL
    """,
)
def check_required(spark, documents, labels):
    """Required columns that are filled, and one that a left join leaves empty."""
    labelled = documents.join(labels, "doc_id", "left")
    required = T.StructType(
        [T.StructField("doc_id", T.LongType(), False), T.StructField("text", T.StringType())]
    )
    quality = T.StructType([T.StructField("quality", T.IntegerType(), False)])
    passes = checks.check_required(documents, required)
    fails = checks.check_required(labelled, quality)
    return passes.select(F.lit("documents").alias("table"), "*").unionByName(
        fails.select(F.lit("labelled").alias("table"), "*")
    )


@query(
    "orders",
    "lineitem",
    oracle="""
    SELECT 'orders' AS "check", count(*) > 0 AS result, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT)
      AS n_failed FROM orders
    UNION ALL
    SELECT 'line quantities', min(l_quantity) > 0 AND max(l_quantity) <= 10,
           CAST(CASE WHEN min(l_quantity) > 0 THEN 0 ELSE 1 END
              + CASE WHEN max(l_quantity) <= 10 THEN 0 ELSE 1 END AS BIGINT)
    FROM lineitem
    """,
)
def check_query(spark, orders, lineitem):
    """Checks written in SQL: a count, and two flags of which one fails."""
    counted = run_sql(spark, "select count(*) from {orders}", tables={"orders": orders})
    limits = run_sql(
        spark,
        "select min(l_quantity) > 0 as positive, max(l_quantity) <= :most as small from {lines}",
        {"most": 10},
        tables={"lines": lineitem},
    )
    return checks.check_query(counted, "orders").unionByName(checks.check_query(limits, "line quantities"))


# --- scalar functions -----------------------------------------------------------------


@query(
    "events",
    oracle="""
    SELECT event_id,
           coalesce(value, 0) AS filled,
           CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS band,
           CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS code,
           CAST(user_id AS VARCHAR) AS user_text,
           abs(user_id - 75) AS distance,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight,
           CAST(CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_day,
           CAST(CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS previous_day,
           CAST(CAST(CAST(ts AS DATE) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS previous_month,
           ts + INTERVAL 90 SECOND AS later,
           CAST(last_day(CAST(ts AS DATE)) AS VARCHAR) AS month_end,
           CAST(date_part('dow', ts) + 1 AS INTEGER) AS day_of_week,
           CAST(strptime(strftime(ts, '%d-%b-%Y %H:%M:%S'), '%d-%b-%Y %H:%M:%S') AS TIMESTAMP) AS parsed
    FROM events
    """,
)
def scalar_functions(spark, events):
    """The functions that mapped expressions use, spelled as in job configurations."""
    written = "date_format(src.ts, 'dd-MMM-yyyy HH:mm:ss')"
    expressions = {
        "filled": "ifnull(src.value, 0)",
        "band": "if(src.value > 50, 'high', 'low')",
        "code": "case src.event_type when 'click' then 1 when 'view' then 2 else 0 end",
        "user_text": "cast(src.user_id as string)",
        "distance": "abs(src.user_id - 75)",
        "day": "cast(date(src.ts) as string)",
        "midnight": "cast(timestamp(date(src.ts)) as timestamp_ntz)",
        "next_day": "cast(date_add(date(src.ts), interval 1 day) as string)",
        "previous_day": "cast(date_sub(date(src.ts), interval 1 day) as string)",
        "previous_month": "cast(date_sub(date(src.ts), interval 1 month) as string)",
        "later": "date_add(src.ts, interval 90 second)",
        "month_end": "cast(last_day(date(src.ts), month) as string)",
        "day_of_week": "extract(dayofweek from src.ts)",
        "parsed": f"parse_timestamp('%d-%b-%Y %H:%M:%S', {written})",
    }
    fields = [Field("event_id"), *[Field(name, transformation=text) for name, text in expressions.items()]]
    return project(events.alias("src"), fields)
