"""Each operator on the generated test tables, over every row of them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.fixed_values import AGING_EDGES
from tallyhouse.functions import (
    as_text, day, day_window, days_between, decode, first_known, iif, like_any, like_text, moment, optional_filter,
    strip_breaks, valid_at,
)
from tallyhouse.operators import (
    aging_buckets, count_matches, credit_negative, credit_positive, enrich, exclude, first_per_key, latest_values,
    left_join_many, nonzero_sum, restrict_to_keys, typed_insert, unmatched, wide_key_distinct,
)
from tallyhouse.operators.keyed import latest_aggregates
from tallyhouse.sinks.replace import replace_if_nonempty
from tallyhouse.sinks.stages import StageArea, owned_folder
from tallyhouse.streaming.highwater import day_aligned, resolve_window
from tallyhouse.testbed.adapter import billing_tables

col = F.col
Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2000, 1, 1)

EVENT_KINDS = ("click", "error", "purchase", "signup", "view")

# Every column of a line, for a total order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ledger(lines: DataFrame) -> DataFrame:
    """Lines as ledger rows: returned is a credit, accepted a debit, the rest unknown."""
    return lines.selectExpr(
        "l_orderkey", "case l_returnflag when 'R' then 1 when 'A' then 0 end as credit",
        "cast(l_quantity as decimal(19,4)) as quantity", "cast(l_extendedprice as decimal(19,4)) as amount",
        "l_shipdate",
    )


def open_invoice_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(_table(spark, sf_dir, "lineitem"))
    return nonzero_sum(ledger, ["l_orderkey"], credit_positive(col("credit"), col("quantity")), "balance")


def ar_aging_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open balance by age at a date, per nation of the customer."""
    ledger = _ledger(_table(spark, sf_dir, "lineitem"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # One pass: the balance over all time and the amount at the date.
    dated = F.when(col("l_shipdate") < moment(AS_OF), credit_negative(col("credit"), col("amount")))
    per_order = ledger.groupBy("l_orderkey").agg(
        F.sum(credit_positive(col("credit"), col("amount"))).alias("balance"), F.sum(dated).alias("due")
    ).filter("balance != 0 and due != 0")
    aged = (
        per_order.join(orders, F.expr("l_orderkey = o_orderkey"))
        .withColumn("age", days_between(col("o_orderdate"), moment(AS_OF)) - 1)
        .groupBy("o_custkey", "age").agg(F.sum("due").alias("due"))
        .join(customers, F.expr("o_custkey = c_custkey"))
        .join(nations, F.expr("c_nationkey = n_nationkey"))
    )
    names = ["current", "days_31_60", "days_61_90", "days_91_120", "days_121_up"]
    sums = [F.expr(f"sum({sql}) as {name}")
            for sql, name in zip(aging_buckets("age", "due", AGING_EDGES), names, strict=True)]
    return aged.groupBy("n_name").agg(*sums, F.expr("sum(due) as total_due"))


def first_sale_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return first_per_key(lines, ["l_orderkey", "l_returnflag"], LINE_ORDER).select(
        "l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking over a grouped query: each customer's latest order of two priority classes."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderstatus",
        "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'primary' else 'addon' end as kind",
    ).distinct()
    latest = first_per_key(orders, ["o_custkey", "kind"], ["o_orderkey desc", "o_orderstatus"])
    customers = _table(spark, sf_dir, "customer").select("c_custkey")
    for kind in ("primary", "addon"):
        mine = latest.filter(col("kind") == kind).selectExpr(
            "o_custkey as c_custkey", f"o_orderkey as {kind}_order", f"o_orderstatus as {kind}_status"
        )
        customers = customers.join(mine, "c_custkey", "left")
    return customers


def latest_event_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value per event type of each customer, in one pass; a null latest value stays null."""
    events = _table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_id", "event_type", "case when value >= 1 then value end as value"
    )
    latest = events.groupBy(col("user_id").alias("c_custkey")).agg(*[
        latest_aggregates({f"last_{kind}": "value"}, "event_id", f"event_type = '{kind}'")[0]
        for kind in EVENT_KINDS
    ])
    return _table(spark, sf_dir, "customer").select("c_custkey").join(latest, "c_custkey", "left")


def unordered_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer of each nation, with a name joined inside; the highest key is the tie-break."""
    customers = first_per_key(
        _table(spark, sf_dir, "customer").filter("c_acctbal > 0"), ["c_nationkey"], ["c_custkey desc"]
    )
    regions = _table(spark, sf_dir, "region")
    nations = _table(spark, sf_dir, "nation")
    return (
        nations.join(customers, F.expr("n_nationkey = c_nationkey"), "left")
        .join(regions, F.expr("n_regionkey = r_regionkey"), "left")
        .select("n_nationkey", "c_custkey", "c_name", "r_name")
    )


def last_row_joinback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_values(
        _table(spark, sf_dir, "orders"), ["o_custkey"],
        {"last_order": "o_orderkey", "last_status": "o_orderstatus", "last_price": "o_totalprice",
         "last_date": "o_orderdate"},
        "o_orderkey",
    )


def endpoint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation column, a count of matches, zero included, and the region's name, in order."""
    nations = _table(spark, sf_dir, "nation")
    rich = _table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    counted = count_matches(nations, rich, "n_nationkey", "s_nationkey", "suppliers")
    regions = _table(spark, sf_dir, "region")
    return counted.join(regions, F.expr("n_regionkey = r_regionkey")).select(
        *nations.columns, "suppliers", "r_name"
    ).orderBy("n_nationkey")


def exclusion_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion list made from the suppliers: some entries deleted, for others, or malformed."""
    exclusions = _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as ExclusionID", "case when s_suppkey % 5 = 4 then 'other' else 'parts' end as ReportName",
        "case when s_acctbal < 0 then 1 else 0 end as Deleted",
        "case when s_nationkey % 2 = 0 then 'PartID' else 'Size' end as Criteria",
        "case when s_suppkey % 7 = 3 then 'n/a' else cast(s_suppkey as string) end as Value",
    )
    parts = _table(spark, sf_dir, "part")
    return exclude(parts, exclusions, "parts", {"PartID": "p_partkey", "Size": "p_size"}).select("p_partkey", "p_size")


def unmatched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return unmatched(orders, _table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


def optional_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter switched off and on; unknown priorities are dropped both times."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus", "nullif(o_orderpriority, '5-LOW') as priority"
    )
    counts = [
        orders.filter(optional_filter(col("priority"), value)).groupBy("o_orderstatus")
        .agg(F.count("*").alias("orders")).withColumn("mode", F.lit(mode))
        for mode, value in (("off", None), ("on", "1-URGENT"))
    ]
    return counts[0].unionByName(counts[1])


def watermark_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a window whose lower bound lies inside a day, and of the default window."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    given = resolve_window(datetime(2024, 1, 10, 12), datetime(2024, 1, 13), datetime(2024, 1, 20))
    yesterday = resolve_window(None, None, datetime(2024, 1, 20, 9, 30))
    parts = [
        events.filter(day_window(col("ts"), *day_aligned(*bounds))).withColumn("run", F.lit(run))
        for run, bounds in (("given", given), ("default", yesterday))
    ]
    return parts[0].unionByName(parts[1])


def valid_at_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "l_suppkey", "case when l_linestatus = 'F' then 1 else 0 end as invalid",
        "l_shipdate as valid_from", "case when l_returnflag = 'N' then null else l_shipdate + interval '90' day end as valid_thru",
    )
    now = datetime(1998, 6, 1, 12)
    valid = lines.filter(valid_at(now, col("invalid"), col("valid_from"), col("valid_thru")))
    return valid.groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("lines"))


def wide_key_distinct_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_key_distinct(
        _table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag", "l_suppkey"],
        {"supplier": "l_suppkey", "flag": "l_returnflag"},
    )


def sum_times_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "l_linenumber", "cast(l_quantity as decimal(19,4)) as quantity"
    )
    return lines.groupBy("l_returnflag", "l_linenumber", "quantity").agg(F.sum("quantity").alias("total")).selectExpr(
        "l_returnflag", "l_linenumber", "quantity", "total"
    )


def computed_group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn("ordered_on", as_text(day(col("o_orderdate"))))
    late = iif(col("o_orderstatus") == "F", "done", "open")
    return orders.groupBy("ordered_on", late.alias("state")).agg(
        F.count("*").alias("orders"), F.expr("sum(cast(o_totalprice as decimal(19,4))) as price")
    )


def distinct_over_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DISTINCT on a grouped result whose grouping is wider: equal counts merge."""
    orders = _table(spark, sf_dir, "orders")
    grouped = orders.groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))
    return grouped.select("o_custkey", "o_orderstatus", "orders").distinct()


def self_join_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order that leads their customer's group, and two nations by role."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    leads = orders.filter("o_orderpriority = '1-URGENT'").groupBy(col("o_custkey").alias("group_id")).agg(
        F.min("o_orderkey").alias("lead_order"), F.expr("min_by(o_orderdate, o_orderkey) as lead_date")
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = _table(spark, sf_dir, "nation")
    home = nations.selectExpr("n_nationkey as home_key", "n_name as home_nation")
    # The second role: the nation whose key is the first one's region.
    parent = nations.selectExpr("n_nationkey as parent_key", "n_name as parent_nation")
    links = nations.selectExpr("n_nationkey as link_key", "n_regionkey as link_parent")
    return (
        orders.join(leads, F.expr("o_custkey = group_id"), "left")
        .join(customers, F.expr("o_custkey = c_custkey"), "left")
        .join(home, F.expr("c_nationkey = home_key"), "left")
        .join(links, F.expr("c_nationkey = link_key"), "left")
        .join(parent, F.expr("link_parent = parent_key"), "left")
        .select("o_orderkey", "lead_order", "lead_date", "home_nation", "parent_nation")
    )


def level_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension joined depends on a level; other levels find nothing."""
    lines = _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "s_nationkey", "1 + s_suppkey % 3 as level", "s_nationkey % 7 as source"
    )
    regions = _table(spark, sf_dir, "region")
    nations = _table(spark, sf_dir, "nation")
    return (
        lines.join(regions, F.expr("source = r_regionkey and level = 2"), "left")
        .join(nations, F.expr("source = n_nationkey and level = 3 and n_nationkey = s_nationkey"), "left")
        .select("s_suppkey", "level", "r_name", "n_name")
    )


def enrich_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").selectExpr("c_custkey", "case when c_acctbal < 0 then null else c_custkey end as buyer")
    orders = _table(spark, sf_dir, "orders")
    return enrich(
        customers, orders, "buyer", "o_custkey", {"best_order": "o_orderkey", "best_price": "o_totalprice"},
        order=["o_totalprice desc", "o_orderkey desc"], spread_by=["c_custkey"],
    )


def first_value_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest quantity, and lowest sequence with no sequence first, per supplier."""
    lines = _table(spark, sf_dir, "lineitem").withColumn("sequence", F.expr("nullif(l_linenumber, 7)"))
    rest = ", ".join(["l_orderkey", *LINE_ORDER])
    # Structs order by their fields, nulls first; the other columns tell lines apart.
    return lines.groupBy("l_suppkey").agg(
        F.expr(f"min(struct(-l_quantity as top, {rest})) as t"), F.expr(f"min(struct(sequence, {rest})) as s")
    ).selectExpr(
        "l_suppkey", "t.l_orderkey as top_order", "t.l_quantity as top_quantity", "s.l_orderkey as low_order",
        "s.sequence as low_sequence",
    )


def min_date_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order date of each customer on an order other than the latest finished one."""
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    latest = latest_values(
        orders.filter("o_orderstatus = 'F'"), [col("o_custkey").alias("buyer")], {"own": "o_orderkey"}, "o_orderkey"
    )
    return (
        orders.join(latest, F.expr("o_custkey = buyer")).filter("o_orderkey != own")
        .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    )


def scalar_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without breaks, decoded languages and defaults."""
    documents = _table(spark, sf_dir, "documents")
    clean = strip_breaks(F.concat(col("text"), F.lit("\t"), col("source"), F.lit("\r\n")))
    source = F.expr("nullif(source, 'web')")
    return documents.select(
        "doc_id", F.md5(clean).alias("clean_md5"), F.length(clean).alias("clean_chars"),
        decode(col("lang"), {"en": "English", "de": "German", "fr": "French"}, "OTHER").alias("language"),
        first_known(source, "none", "string").alias("source_name"),
        iif(F.expr("nullif(n_chars, 0)") > 1000, "long", "short").alias("size_class"),
        as_text(-col("n_chars")).alias("negated"), F.lit("Payment").alias("kind"),
    )


def predicates_like_in_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").withColumn("name", F.expr("nullif(p_name, 'red bolt')"))
    kept = parts.filter(
        col("p_size").between(10, 40) & ~col("p_type").isin("ECONOMY") & (col("p_retailprice") >= 905)
        & (col("p_brand") != "Brand#3") & ~like_any(col("name"), ["%GREEN%", "%Gear%"])
        & like_text(col("p_brand"), "brand#%") & col("name").isNotNull()
    )
    return kept.select("p_partkey", "name", "p_brand", "p_size")


def typed_insert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns and types: a rounded amount, a cast key and a column nobody fills."""
    schema = StructType.fromDDL("part_id bigint, title string, monthly decimal(12,2), sold_at timestamp_ntz, size int")
    rows = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey as part_id", "p_name as title", "p_size as size",
        "cast(p_retailprice as decimal(19,4)) * cast(0.0125 as decimal(19,4)) as monthly",
    )
    return typed_insert(rows, schema)


def replace_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report table replaced, then left alone by an empty run and by a dry run."""
    folder = owned_folder(spark, "reports")
    totals = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.expr("sum(cast(o_totalprice as decimal(19,4))) as price")
    )
    table = f"tallyhouse_report_{folder.rsplit('-', 1)[1]}"
    replace_if_nonempty(totals.limit(0), table, folder)
    replace_if_nonempty(totals.filter("orders > 5"), table, folder)
    replace_if_nonempty(totals, table, folder)
    replace_if_nonempty(totals.filter("orders < 0"), table, folder)
    replace_if_nonempty(totals.filter("orders > 5"), table, folder, dry_run=True)
    return spark.table(table)


def stage_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kept intermediate read twice: balances per order, and their share of the order price."""
    ledger = _ledger(_table(spark, sf_dir, "lineitem"))
    kept = StageArea(spark).keep(
        nonzero_sum(ledger, ["l_orderkey"], credit_negative(col("credit"), col("amount")), "due"), "balances"
    )
    orders = restrict_to_keys(_table(spark, sf_dir, "orders"), "o_orderkey", kept.select("l_orderkey"))
    return orders.join(kept, F.expr("o_orderkey = l_orderkey")).groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.expr("sum(due) as due")
    )


def left_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join with a literal condition on the right side; repeated matches are kept."""
    urgent = _table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return left_join_many(customers, urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name", "o_orderkey")


def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join of orders with their lines before a date; the condition reaches the scan."""
    lines = _table(spark, sf_dir, "lineitem").filter(col("l_shipdate") < moment(AS_OF)).groupBy("l_orderkey").agg(
        F.count("*").alias("lines")
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(lines, F.expr("o_orderkey = l_orderkey")).select("o_orderkey", "o_orderstatus", "lines")


def semi_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest line per order, for orders of a status only."""
    latest = latest_values(
        _table(spark, sf_dir, "lineitem"), ["l_orderkey"], {"last_ship": "l_shipdate"}, "l_shipdate"
    )
    wanted = _table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select("o_orderkey")
    return restrict_to_keys(latest, "l_orderkey", wanted)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").agg(
        F.count("*").alias("all_rows"), F.expr("count_if(o_orderstatus = 'P')").alias("some_rows"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderkey").alias("last_key"),
    )


def source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with numbers and blanks in column names, from two sources."""
    tables = billing_tables(spark, sf_dir)
    pivoted = tables["PartyPropertiesReporting"].selectExpr(
        "PartyId as party", "`3` as first_name", "`5` as last_name", "`31` as organisation"
    )
    named = tables["PartyPropertiesReportingView"].selectExpr("PartyID as named_party", "`First Name` as shown_name")
    return pivoted.join(named, F.expr("party = named_party"), "left").drop("named_party")


OPERATORS: dict[str, Query] = {
    "open_invoice_balance": open_invoice_balance,
    "ar_aging_buckets": ar_aging_buckets,
    "first_sale_line": first_sale_line,
    "latest_order_per_customer": latest_order_per_customer,
    "latest_event_lateral": latest_event_lateral,
    "unordered_top1": unordered_top1,
    "last_row_joinback": last_row_joinback,
    "endpoint_counts": endpoint_counts,
    "exclusion_anti": exclusion_anti,
    "unmatched_anti": unmatched_anti,
    "optional_filter": optional_filter_query,
    "watermark_window": watermark_window,
    "valid_at": valid_at_query,
    "wide_key_distinct": wide_key_distinct_query,
    "sum_times_multiplicity": sum_times_multiplicity,
    "computed_group_key": computed_group_key,
    "distinct_over_aggregate": distinct_over_aggregate,
    "self_join_primary": self_join_primary,
    "level_lookup": level_lookup,
    "enrich_update": enrich_update,
    "first_value_role": first_value_role,
    "min_date_per_key": min_date_per_key,
    "scalar_cleanup": scalar_cleanup,
    "predicates_like_in_between": predicates_like_in_between,
    "typed_insert": typed_insert_query,
    "replace_guard": replace_guard,
    "stage_reuse": stage_reuse,
    "left_join_fanout": left_join_fanout,
    "point_in_time_join": point_in_time_join,
    "semi_restrict": semi_restrict,
    "row_counts": row_counts,
    "source_columns": source_columns,
}
