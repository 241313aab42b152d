"""Queries over mappings: projections, filters, joins, extraction windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.catalog.base import AS_OF, RUN_TS, query
from tablewright.operators.filters import apply_where
from tablewright.operators.joins import anti_join, apply_joins, tracked_rows
from tablewright.operators.projection import project
from tablewright.plans.delta import before, delta_bounds, delta_filter
from tablewright.plans.loads import mapped_rows, run_load, type1_full
from tablewright.plans.config import mapping_from_config
from tablewright.plans.mapping import Condition, Delta, Disposition, Field, Join, Mapping

# --- mapped loads -----------------------------------------------------------

DIM_LOOKUP = Mapping(
    target="dim_order_customer",
    driving_table="orders",
    fields=(
        Field("order_id", source_column="o_orderkey", pk=True),
        Field("customer_id", source_column="o_custkey"),
        Field("customer_name", source_column="c_name", source_table="c"),
        Field("segment", source_column="c_mktsegment", source_table="c", default="'UNKNOWN'"),
        Field("nation_name", source_column="n_name", source_table="n", default="'UNKNOWN'"),
        Field("order_dt", source_column="o_orderdate"),
        Field("total_price", source_column="o_totalprice"),
    ),
    joins=(
        Join(
            "customer",
            [
                Condition(["src.o_custkey", "c.c_custkey"]),
                Condition(["c.c_mktsegment", "'MACHINERY'"], "!="),
            ],
            alias="c",
        ),
        Join("nation", [Condition(["c.c_nationkey", "n.n_nationkey"])], alias="n"),
    ),
    where=(Condition(["src.o_orderstatus", "'F'"], "!="),),
)


@query(
    "orders",
    "customer",
    "nation",
    oracle=f"""
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, c.c_name AS customer_name,
           coalesce(c.c_mktsegment, 'UNKNOWN') AS segment,
           coalesce(n.n_name, 'UNKNOWN') AS nation_name,
           o.o_orderdate AS order_dt, o.o_totalprice AS total_price,
           TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment <> 'MACHINERY'
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE o.o_orderstatus <> 'F'
    """,
)
def dim_lookup(spark, orders, customer, nation):
    return type1_full(
        DIM_LOOKUP, {"orders": orders, "customer": customer, "nation": nation}, RUN_TS
    )


TYPE1_FULL = Mapping(
    target="dim_part",
    driving_table="part",
    fields=(
        Field("part_id", source_column="p_partkey", pk=True),
        Field("part_name", source_column="p_name"),
        Field("brand_code", transformation="upper(replace(src.p_brand, '#', '_'))"),
        Field("size_band", transformation="case when src.p_size > 25 then 'LARGE' end", default="'SMALL'"),
        Field("retail_price", source_column="p_retailprice", default="0"),
        Field("dw_last_modified_dt", transformation="timestamp_ntz'1970-01-01 00:00:00'"),
    ),
)


@query(
    "part",
    name="type1_full",
    oracle=f"""
    SELECT p_partkey AS part_id, p_name AS part_name, upper(replace(p_brand, '#', '_')) AS brand_code,
           CASE WHEN p_size > 25 THEN 'LARGE' ELSE 'SMALL' END AS size_band,
           coalesce(p_retailprice, 0) AS retail_price, TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM part
    """,
)
def type1_full_query(spark, part):
    return type1_full(TYPE1_FULL, {"part": part}, RUN_TS)


CONFIG_LOAD = {
    "destination_table": "dim_supplier",
    "target_type": "TYPE1",
    "driving_table": "sales.supplier",
    "write_disposition": "WRITE_TRUNCATE",
    "joins": [
        {
            "right": {"dataset_name": "sales", "table_name": "nation", "alias": "n"},
            "on": [{"operator": "=", "fields": ["sales.supplier.s_nationkey", "n.n_nationkey"]}],
        },
        {
            "right": {"dataset_name": "sales", "table_name": "region", "alias": "r"},
            "type": "INNER",
            "on": [
                {"operator": "=", "fields": ["n.n_regionkey", "r.r_regionkey"]},
                {"operator": "in", "condition": "AND", "fields": ["r.r_name", "'ASIA', 'EUROPE', 'AFRICA'"]},
            ],
        },
    ],
    "where": [
        {"operator": ">", "fields": ["src.s_acctbal", "0"]},
        {"operator": "is null", "condition": "OR", "fields": ["src.s_acctbal", ""]},
    ],
    "source_to_target": [
        {"name": "supplier_id", "source_column": "s_suppkey", "pk": True},
        {"name": "supplier_name", "source_column": "s_name"},
        {"name": "balance", "transformation": "round(sales.supplier.s_acctbal)", "default": "0"},
        {
            "name": "region",
            "source_column": "r_name",
            "source_table": {"dataset_name": "sales", "table_name": "region", "alias": "r"},
        },
    ],
}


@query(
    "supplier",
    "nation",
    "region",
    oracle=f"""
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, coalesce(round(s_acctbal), 0) AS balance,
           r_name AS region, TIMESTAMP '{RUN_TS}' AS dw_last_modified_dt
    FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey AND r_name IN ('ASIA', 'EUROPE', 'AFRICA')
    WHERE s_acctbal > 0 OR s_acctbal IS NULL
    """,
)
def config_load(spark, supplier, nation, region):
    """A load described by the parameters of a JSON task."""
    sources = {"sales.supplier": supplier, "sales.nation": nation, "sales.region": region}
    return run_load(mapping_from_config(CONFIG_LOAD), sources, RUN_TS)


# --- projections --------------------------------------------------------------


@query(
    "customer",
    oracle="SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id FROM customer",
)
def project_rename(spark, customer):
    fields = (
        Field("id", source_column="c_custkey"),
        Field("name", source_column="c_name"),
        Field("nation_id", source_column="c_nationkey"),
    )
    return project(customer.alias("src"), fields)


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey AS order_id, l_linenumber AS line,
           CAST(l_quantity AS BIGINT) * l_linenumber AS weighted,
           lower(l_returnflag) || '-' || l_linestatus AS flags,
           CAST(year(l_shipdate) AS INTEGER) AS ship_year
    FROM lineitem
    """,
)
def project_expr(spark, lineitem):
    fields = (
        Field("order_id", source_column="l_orderkey"),
        Field("line", source_column="l_linenumber"),
        Field("weighted", transformation="cast(src.l_quantity as bigint) * src.l_linenumber"),
        Field("flags", transformation="lower(src.l_returnflag) || '-' || src.l_linestatus"),
        Field("ship_year", transformation="year(src.l_shipdate)"),
    )
    return project(lineitem.alias("src"), fields)


@query(
    "documents",
    "labels",
    oracle="""
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic + 1, d.doc_id % 7) AS toxic_rank
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def project_default(spark, documents, labels):
    mapping = Mapping(
        "doc_quality",
        "documents",
        (
            Field("doc_id"),
            Field("quality", source_column="quality", source_table="l", default="-1"),
            Field("toxic_rank", transformation="l.toxic + 1", default="src.doc_id % 7"),
        ),
        joins=(Join("labels", [Condition(["src.doc_id", "l.doc_id"])], alias="l"),),
    )
    return mapped_rows(mapping, {"documents": documents, "labels": labels})


@query(
    "part",
    oracle="""
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size_string, upper(p_brand) AS upper,
           CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS "case"
    FROM part
    """,
)
def project_inferred_names(spark, part):
    fields = (
        Field(source_column="p_partkey"),
        Field(transformation="cast(p_size as string)"),
        Field(transformation="upper(p_brand)"),
        Field(transformation="case when p_size > 25 then 1 else 0 end"),
    )
    return project(part.alias("src"), fields)


# --- filters ------------------------------------------------------------------


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    WHERE (o_orderstatus = 'O' AND o_totalprice > 100000) OR o_orderpriority = '1-URGENT'
    """,
)
def filter_chain(spark, orders):
    kept = apply_where(
        orders.alias("src"),
        [
            Condition(["src.o_orderstatus", "'O'"]),
            Condition(["src.o_totalprice", "100000"], ">", "and"),
            Condition(["src.o_orderpriority", "'1-URGENT'"], "=", "or"),
        ],
    )
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "lineitem",
    oracle="""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity < 40 AND l_discount <= 0.05 AND l_tax > 0.01
      AND l_returnflag <> 'A' AND l_linestatus <> 'F' AND l_linenumber = 3
    """,
)
def filter_compare(spark, lineitem):
    kept = apply_where(
        lineitem,
        [
            Condition(["l_quantity", "10"], ">="),
            Condition(["l_quantity", "40"], "<"),
            Condition(["l_discount", "0.05D"], "<="),
            Condition(["l_tax", "0.01D"], ">"),
            Condition(["l_returnflag", "'A'"], "!="),
            Condition(["l_linestatus", "'F'"], "<>"),
            Condition(["l_linenumber", "3"], "="),
        ],
    )
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query(
    "customer",
    oracle="""
    SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)
    """,
)
def filter_in(spark, customer):
    kept = apply_where(
        customer,
        [
            Condition(["c_mktsegment", "'BUILDING', 'MACHINERY'"], "in"),
            Condition(["c_nationkey", "(1, 2, 3)"], "not in"),
        ],
    )
    return kept.select("c_custkey", "c_mktsegment", "c_nationkey")


@query(
    "documents",
    "labels",
    oracle="""
    SELECT d.doc_id, d.lang, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NULL AND d.lang IS NOT NULL
    """,
)
def filter_null(spark, documents, labels):
    joins = [Join("labels", [Condition(["src.doc_id", "l.doc_id"])], alias="l")]
    joined = apply_joins(documents, joins, {"labels": labels})
    kept = apply_where(
        joined,
        [Condition(["l.quality", None], "is null"), Condition(["src.lang", ""], "is not null")],
    )
    return kept.select("src.doc_id", "src.lang", "src.n_chars")


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus = 'O' AND NOT (o_orderpriority = '1-URGENT')
    """,
)
def filter_not(spark, orders):
    kept = apply_where(
        orders,
        [Condition(["o_orderstatus", "'O'"]), Condition(["o_orderpriority", "'1-URGENT'"], "=", "not")],
    )
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


# --- joins --------------------------------------------------------------------


@query(
    "lineitem",
    "part",
    oracle="""
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand
    FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_size <> 11
    WHERE l.l_returnflag <> 'R'
    """,
)
def join_left_filtered(spark, lineitem, part):
    """A flag on the right side in ON un-matches rows, one on the left in WHERE drops them."""
    on = [Condition(["src.l_partkey", "p.p_partkey"]), Condition(["p.p_size", "11"], "!=")]
    joined = apply_joins(lineitem, [Join("part", on, alias="p")], {"part": part})
    kept = apply_where(joined, [Condition(["src.l_returnflag", "'R'"], "!=")])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand")


@query(
    "documents",
    "labels",
    oracle="""
    SELECT d.doc_id, d.lang, l.quality = 1 AS is_good, l.toxic = 1 AS is_toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def join_left(spark, documents, labels):
    joins = [Join("labels", [Condition(["src.doc_id", "labels.doc_id"])])]
    joined = apply_joins(documents, joins, {"labels": labels})
    flags = [(F.col(c) == 1).alias(name) for c, name in (("quality", "is_good"), ("toxic", "is_toxic"))]
    return joined.select("src.doc_id", "lang", *flags)


@query(
    "lineitem",
    "orders",
    oracle="""
    SELECT o.o_custkey, l.l_orderkey, l.l_linenumber, l.l_extendedprice
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
def join_inner(spark, lineitem, orders):
    on = [Condition(["src.l_orderkey", "o.o_orderkey"])]
    joined = apply_joins(lineitem, [Join("orders", on, "inner", "o")], {"orders": orders})
    return joined.select("o_custkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "labels",
    "documents",
    oracle="""
    SELECT CAST(l.doc_id AS VARCHAR) AS label_doc, l.quality = 1 AS is_good,
           CAST(d.doc_id AS VARCHAR) AS document, d.lang
    FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id AND l.quality = 1
    """,
)
def join_full(spark, labels, documents):
    on = [Condition(["src.doc_id", "d.doc_id"]), Condition(["src.quality", "1"])]
    joined = apply_joins(labels, [Join("documents", on, "full", "d")], {"documents": documents})
    return joined.select(
        F.col("src.doc_id").cast("string").alias("label_doc"),
        (F.col("src.quality") == 1).alias("is_good"),
        F.col("d.doc_id").cast("string").alias("document"),
        "d.lang",
    )


@query(
    "supplier",
    "region",
    oracle="""
    SELECT s_suppkey, r_name, r_regionkey = s_nationkey % 5 AS home FROM supplier CROSS JOIN region
    """,
)
def join_cross(spark, supplier, region):
    joined = apply_joins(supplier, [Join("region", how="cross")], {"region": region})
    return joined.select(
        "s_suppkey", "r_name", (F.col("r_regionkey") == F.col("s_nationkey") % 5).alias("home")
    )


@query(
    "lineitem",
    "orders",
    "customer",
    "supplier",
    "nation",
    "region",
    oracle="""
    SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, cn.n_name AS customer_nation,
           sn.n_name AS supplier_nation, r.r_name AS supplier_region
    FROM lineitem l
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
    LEFT JOIN region r ON sn.n_regionkey = r.r_regionkey
    """,
)
def join_chain(spark, lineitem, orders, customer, supplier, nation, region):
    """A chain in which one table is joined twice, under two aliases."""
    joins = [
        Join("orders", [Condition(["src.l_orderkey", "o.o_orderkey"])], alias="o"),
        Join("customer", [Condition(["o.o_custkey", "c.c_custkey"])], alias="c"),
        Join("nation", [Condition(["c.c_nationkey", "cn.n_nationkey"])], alias="cn"),
        Join("supplier", [Condition(["src.l_suppkey", "s.s_suppkey"])], alias="s"),
        Join("nation", [Condition(["s.s_nationkey", "sn.n_nationkey"])], alias="sn"),
        Join("region", [Condition(["sn.n_regionkey", "r.r_regionkey"])], alias="r"),
    ]
    sources = {"orders": orders, "customer": customer, "supplier": supplier, "nation": nation, "region": region}
    return apply_joins(lineitem, joins, sources).select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("cn.n_name").alias("customer_nation"),
        F.col("sn.n_name").alias("supplier_nation"),
        F.col("r.r_name").alias("supplier_region"),
    )


@query(
    "lineitem",
    "part",
    oracle="""
    SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_partkey, p.p_size, p.p_brand
    FROM lineitem l JOIN part p
      ON (l.l_partkey = p.p_partkey AND p.p_size <> 11 AND l.l_quantity >= p.p_size)
      OR (l.l_partkey = p.p_partkey AND p.p_brand IN ('Brand#1', 'Brand#2'))
    """,
)
def join_theta(spark, lineitem, part):
    """Comparisons of all kinds in ON; the equality in both branches makes it a hash join."""
    on = [
        Condition(["src.l_partkey", "p.p_partkey"]),
        Condition(["p.p_size", "11"], "!="),
        Condition(["src.l_quantity", "p.p_size"], ">="),
        Condition(["src.l_partkey", "p.p_partkey"], "=", "or"),
        Condition(["p.p_brand", "'Brand#1', 'Brand#2'"], "in"),
    ]
    joined = apply_joins(lineitem, [Join("part", on, "inner", "p")], {"part": part})
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "p_partkey", "p_size", "p_brand")


@query(
    "documents",
    "labels",
    oracle="""
    SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def join_anti(spark, documents, labels):
    return anti_join(documents, labels, ["doc_id"]).select("doc_id", "source")


@query(
    "orders",
    oracle="""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01'
      AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
    """,
)
def join_semi_tracked(spark, orders):
    """Earlier rows of the keys that an extraction window touches."""
    lo, hi = delta_bounds("timestamp_ntz'2000-01-01 00:00:00'", None, AS_OF)
    recent = delta_filter(orders, "o_orderdate", lo, hi)
    earlier = before(orders, "o_orderdate", lo)
    return tracked_rows(earlier, recent, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderdate")


# --- extraction windows -------------------------------------------------------


def _window_query(name, lower, upper, low, high=None, params=None):
    until = f" AND ts < TIMESTAMP '{high}'" if high else ""

    @query(
        "events",
        name=name,
        oracle=f"SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '{low}'{until}",
    )
    def run(spark, events):
        lo, hi = delta_bounds(lower, upper, AS_OF, params)
        return delta_filter(events, "ts", lo, hi).select("event_id", "ts", "user_id")

    run.__doc__ = f"Rows of the extraction window from {lower}."


_window_query(
    "delta_window", "timestamp_ntz'2024-01-10 00:00:00'", 5 * 86400, "2024-01-10", "2024-01-15"
)
_window_query("delta_today", "$TODAY", None, "2024-01-30")
_window_query("delta_yesterday", "$YESTERDAY", 86400, "2024-01-29", "2024-01-30")
_window_query("delta_thisweek", "$THISWEEK", None, "2024-01-29")
_window_query("delta_lastweek", "$LASTWEEK", 7 * 86400, "2024-01-22", "2024-01-29")
_window_query("delta_thismonth", "$THISMONTH", 0, "2024-01-01", "2999-12-31 23:59:59")
_window_query(
    "delta_params",
    "@LOWER_DATE_BOUND",
    None,
    "2024-01-05 06:00:00",
    "2024-01-09 23:59:59.999999",
    {"lower_date_bound": "05-JAN-2024 06:00:00", "upper_date_bound": "09-JAN-2024 23:59:59"},
)
_window_query("delta_literal", "make_timestamp_ntz(2024, 1, 15, 12, 0, 0)", None, "2024-01-15 12:00:00")
_window_query(
    "delta_upper_seconds", "$LASTWEEK", 43200, "2024-01-22 00:00:00", "2024-01-22 12:00:00"
)


@query(
    "events",
    oracle=f"""
    SELECT event_id, user_id AS customer_id, coalesce(value, 0) AS amount FROM events
    WHERE ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30' AND event_type <> 'error'
    """,
)
def type1_delta_transient(spark, events):
    """An incremental load of a transient table: the extracted rows, not merged."""
    mapping = Mapping(
        "td_events",
        "events",
        (
            Field("event_id", source_column="event_id", pk=True),
            Field("customer_id", source_column="user_id"),
            Field("amount", source_column="value", default="0"),
        ),
        where=(Condition(["src.event_type", "'error'"], "!="),),
        delta=Delta("src.ts", "$YESTERDAY", 86400),
        disposition=Disposition.TRANSIENT,
    )
    return run_load(mapping, {"events": events}, RUN_TS, as_of=AS_OF)
