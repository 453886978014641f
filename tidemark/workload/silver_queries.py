"""Queries over the silver plans: each repair alone, then clean and quarantined rows by entity."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import quality
from tidemark.plans import entities as e
from tidemark.plans.silver import STANDARDISE
from tidemark.sources import tables
from tidemark.sources.scratch import new_folder
from tidemark.streaming import silver
from tidemark.workload.gold_queries import local_stamps
from tidemark.workload.inputs import RAW, Tables
from tidemark.workload.model_sql import RULES, clean_body, quarantine_body, with_ctes
from tidemark.workload.registry import query


def standardised(t: Tables, entity: str) -> DataFrame:
    return STANDARDISE[entity](RAW[entity](t))


def comparable(df: DataFrame) -> DataFrame:
    """Without load times and empty rescue columns; arrays as text; stamps without zone."""
    drop = {"_load_timestamp", "load_timestamp"}
    if e.RESCUED in df.columns and "payment_type" not in df.columns:
        drop.add(e.RESCUED)
    lists = {f.name: F.array_join(f.name, "|") for f in df.schema.fields if f.dataType.typeName() == "array"}
    return local_stamps(df.drop(*drop).withColumns(lists) if lists else df.drop(*drop))


def _register_entity(entity: str) -> None:
    rules = e.ENTITIES[entity].rules

    def clean(t: Tables) -> DataFrame:
        return comparable(quality.keep_valid(standardised(t, entity), rules))

    def rejected(t: Tables) -> DataFrame:
        return comparable(quality.quarantine(standardised(t, entity), rules, stamp=False))

    needs = (f"std_{entity}",)
    query(with_ctes(needs, clean_body(entity)), f"silver_{entity}_clean")(clean)
    query(with_ctes(needs, quarantine_body(entity)), f"silver_{entity}_quarantine")(rejected)


for _entity in e.ENTITIES:
    _register_entity(_entity)


@query(with_ctes(("std_customers",), """
    SELECT * FROM (SELECT *, CASE WHEN customer_id IS NULL THEN 'NULL_CUSTOMER_ID'
        WHEN segment IS NULL THEN 'INVALID_SEGMENT' WHEN region IS NULL THEN 'INVALID_REGION' END error_reason
        FROM std_customers) WHERE error_reason IS NOT NULL"""))
def quarantine_first_reason(t: Tables) -> DataFrame:
    return comparable(quality.quarantine_first(standardised(t, "customers"), e.CUSTOMERS.first_failure))


@query(with_ctes(("std_orders",), "SELECT * FROM (SELECT *, concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT ({r}) THEN '{n}' END" for n, r in RULES["orders"].items()
) + ") error_reason FROM std_orders) WHERE error_reason <> ''"))
def quarantine_ignoring_nulls(t: Tables) -> DataFrame:
    """The literal predicate: a rule that is NULL for a row is not reported."""
    found = quality.quarantine(standardised(t, "orders"), e.ORDERS.rules, nulls="ignore", stamp=False)
    return comparable(found)


@query(with_ctes(("std_transactions",), f"""
    , judged AS (SELECT *, ({' AND '.join(f'coalesce({r}, FALSE)' for r in RULES['transactions'].values())}) AS passed
                 FROM std_transactions)
    SELECT CASE WHEN passed THEN 'clean' ELSE 'quarantine' END verdict, count(*) AS row_count,
           count(DISTINCT order_id) order_count
    FROM judged GROUP BY ALL"""))
def split_by_verdict(t: Tables) -> DataFrame:
    """Clean and quarantined rows from one scan, counted."""
    split = quality.split_by_rules(standardised(t, "transactions"), e.TRANSACTIONS.rules)
    return split.groupBy("verdict").agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("order_count")
    )


# --- single repairs ---------------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS VARCHAR) END customer_id
          FROM customer""")
def coalesce_variants(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    raw = t.customer.select(
        "c_custkey",
        *[
            F.when((key % 4 == i) & (key % 11 != 0), key.cast("string")).alias(n)
            for i, n in enumerate(("customer_id", "CustomerID", "cust_id", "customer_identifier"))
        ],
    )
    ids = ["customer_id", "CustomerID", "cust_id", "customer_identifier", "absent"]
    return raw.select("c_custkey", c.merge_variants(raw, ids).alias("customer_id"))


@query(with_ctes(("raw_customers",), """
    SELECT k AS custkey, segment_text, CASE WHEN lower(segment_text) IN ('cons', 'cosumer') THEN 'Consumer'
        WHEN lower(segment_text) = 'corporate' THEN 'Corporate'
        WHEN lower(segment_text) IN ('ho', 'home office') THEN 'Home Office' END segment
    FROM raw_customers"""))
def segment_map(t: Tables) -> DataFrame:
    raw = RAW["customers"](t)
    text = c.merge_variants(raw, ["segment", "customer_segment"])
    key = F.regexp_extract(c.merge_variants(raw, ["customer_name", "full_name"]), r"(\d+)$", 1)
    return raw.select(
        key.cast("long").alias("custkey"),
        text.alias("segment_text"),
        c.map_values(text, e.SEGMENTS, ignore_case=True).alias("segment"),
    )


@query(with_ctes(("raw_customers",), """
    SELECT region_text, CASE region_text WHEN 'E' THEN 'East' WHEN 'West' THEN 'West' WHEN 'S' THEN 'South'
        WHEN 'North' THEN 'North' WHEN 'Central' THEN 'Central' END region, count(*) AS customers
    FROM raw_customers GROUP BY ALL"""))
def region_code_map(t: Tables) -> DataFrame:
    raw = RAW["customers"](t)
    mapped = raw.select(
        F.col("region").alias("region_text"), c.map_values(F.col("region"), e.REGIONS).alias("region")
    )
    return mapped.groupBy("region_text", "region").agg(F.count("*").alias("customers"))


@query(with_ctes(("raw_orders",), """
    SELECT k AS orderkey, CASE ship_mode WHEN '1st Class' THEN 'First Class' WHEN 'Std Class' THEN 'Standard Class'
        ELSE ship_mode END ship_mode FROM raw_orders"""))
def ship_mode_map(t: Tables) -> DataFrame:
    modes = {"1-URGENT": "1st Class", "2-HIGH": "Second Class", "3-MEDIUM": "Std Class",
             "4-NOT SPECIFIED": "Same Day", "5-LOW": "Drone"}
    raw = t.orders.replace(modes, subset=["o_orderpriority"])
    mode = c.map_values(F.col("o_orderpriority"), e.SHIP_MODES, keep_unknown=True)
    return raw.select(F.col("o_orderkey").alias("orderkey"), mode.alias("ship_mode"))


@query(with_ctes(("raw_customers",), """
    SELECT k AS custkey, file_region, 'city ' || n_name city, 'state ' || r_name state FROM raw_customers"""))
def column_swap(t: Tables) -> DataFrame:
    raw = RAW["customers"](t)
    city, state = c.swap_when(F.col("_region") == e.SWAPPED_REGION, F.col("city"), F.col("state"))
    name = c.merge_variants(raw, ["customer_name", "full_name"])
    return raw.select(
        F.regexp_extract(name, r"(\d+)$", 1).cast("long").alias("custkey"),
        F.col("_region").alias("file_region"),
        city.alias("city"),
        state.alias("state"),
    )


_STAMP_TEXT = """CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 1 THEN strftime(ts, '%m/%d/%Y %H:%M')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN strftime(ts, '%m/%d/%Y')
    WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 5 THEN 'on ' || strftime(ts, '%d %m %Y') END"""


@query(f"""SELECT event_id, stamp_text, coalesce(try_strptime(stamp_text, '%Y-%m-%d %H:%M:%S'),
    try_strptime(stamp_text, '%Y-%m-%d %H:%M'), try_strptime(stamp_text, '%m/%d/%Y %H:%M'),
    try_strptime(stamp_text, '%Y-%m-%d'), try_strptime(stamp_text, '%m/%d/%Y')) AS stamp
    FROM (SELECT event_id, {_STAMP_TEXT} stamp_text FROM events)""")
def parse_timestamps(t: Tables) -> DataFrame:
    layouts = ["yyyy-MM-dd HH:mm", "MM/dd/yyyy HH:mm", "yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss"]
    key = F.col("event_id") % 7
    texts = [F.when(key == i, F.date_format("ts", f)) for i, f in enumerate(layouts)]
    odd = F.when(key == 5, F.concat(F.lit("on "), F.date_format("ts", "dd MM yyyy")))
    raw = t.events.select("event_id", F.coalesce(*texts, odd).alias("stamp_text"))
    return local_stamps(raw.withColumn("stamp", c.parse_timestamp(F.col("stamp_text"))))


@query("""SELECT event_id, day_text, CASE WHEN event_id % 4 IN (0, 1) THEN CAST(ts AS DATE) END AS day
    FROM (SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d')
          WHEN 1 THEN strftime(ts, '%m-%d-%Y') WHEN 2 THEN 'NULL' ELSE strftime(ts, '%d.%m.%Y') END day_text
          FROM events)""")
def parse_return_dates(t: Tables) -> DataFrame:
    key = F.col("event_id") % 4
    text = (
        F.when(key == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(key == 1, F.date_format("ts", "MM-dd-yyyy"))
        .when(key == 2, "NULL")
        .otherwise(F.date_format("ts", "dd.MM.yyyy"))
    )
    raw = t.events.select("event_id", text.alias("day_text"))
    return raw.withColumn("day", c.parse_day(c.null_if(F.col("day_text"), "NULL")))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS line_count,
    CAST(sum(CASE WHEN l_partkey % 23 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sales
    FROM lineitem GROUP BY ALL""")
def currency_to_double(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("l_partkey") % 23 == 0, "abc").otherwise(F.concat(F.lit("$"), price))
    parsed = t.lineitem.withColumn("sales", c.money(text))
    return parsed.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("line_count"),
        F.sum(F.col("sales").cast("decimal(18,2)")).cast("double").alias("sales"),
    )


@query("""SELECT share_text, TRY_CAST(replace(share_text, '%', '') AS DOUBLE)
        * CASE WHEN share_text LIKE '%\\%%' ESCAPE '\\' THEN 1.0::DOUBLE ELSE 100.0::DOUBLE END AS discount,
        count(*) AS line_count
    FROM (SELECT CASE l_partkey % 4 WHEN 0 THEN CAST(CAST(l_discount * 100 AS INTEGER) AS VARCHAR) || '%'
          WHEN 1 THEN CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) WHEN 2 THEN 'abc' END share_text FROM lineitem)
    GROUP BY ALL""")
def percent_normalise(t: Tables) -> DataFrame:
    share, key = F.col("l_discount").cast("decimal(18,2)"), F.col("l_partkey") % 4
    text = (
        F.when(key == 0, F.concat((share * 100).cast("int").cast("string"), F.lit("%")))
        .when(key == 1, share.cast("string"))
        .when(key == 2, "abc")
    )
    raw = t.lineitem.select(text.alias("share_text"))
    return raw.groupBy("share_text", c.percent(F.col("share_text")).alias("discount")).agg(
        F.count("*").alias("line_count")
    )


@query(with_ctes(("std_transactions",), """
    SELECT payment_type, payment_installments, count(*) AS line_count,
           CAST(sum(CAST(profit AS DECIMAL(18,2))) AS DOUBLE) profit
    FROM std_transactions GROUP BY ALL"""))
def sentinel_defaults(t: Tables) -> DataFrame:
    df = standardised(t, "transactions")
    return df.groupBy("payment_type", "payment_installments").agg(
        F.count("*").alias("line_count"),
        F.sum(F.col("profit").cast("decimal(18,2)")).cast("double").alias("profit"),
    )


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def rescue_recover(t: Tables) -> DataFrame:
    raw = t.events.withColumn(
        "k", F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k"))
    )
    return raw.select("event_id", c.recover(F.col("k"), F.col("props"), "k").try_cast("int").alias("k"))


@query(with_ctes(("std_products",), "SELECT upc, upc_cleaned, count(*) AS products FROM std_products GROUP BY ALL"))
def upc_repair(t: Tables) -> DataFrame:
    raw = RAW["products"](t)
    return raw.groupBy("upc", c.plain_digits(F.col("upc")).alias("upc_cleaned")).agg(
        F.count("*").alias("products")
    )


@query(with_ctes(("raw_products",), """
    SELECT k AS partkey, coalesce(len(string_split(categories, ',')), 0)::INTEGER AS parts,
           coalesce(array_to_string(string_split(categories, ','), '|'), '') AS joined FROM raw_products"""))
def category_array(t: Tables) -> DataFrame:
    lists = c.split_list(F.col("categories"))
    return t.part.select("p_partkey", *_category_text()).select(
        F.col("p_partkey").alias("partkey"),
        F.size(lists).alias("parts"),
        F.array_join(lists, "|").alias("joined"),
    )


def _category_text():
    k = F.col("p_partkey") % 4
    return [
        F.when(k == 0, F.concat_ws(",", "p_type", "p_brand"))
        .when(k == 1, F.concat_ws(" > ", "p_type", "p_name"))
        .when(k == 3, F.col("p_type"))
        .alias("categories")
    ]


@query(with_ctes(("raw_products",), """
    SELECT k AS partkey, trim(split_part(categories, '>', 1)) category,
           CASE WHEN categories LIKE '%>%' THEN trim(split_part(categories, '>', 2)) END sub_category
    FROM raw_products"""))
def category_hierarchy(t: Tables) -> DataFrame:
    path = F.col("categories")
    return t.part.select("p_partkey", *_category_text()).select(
        F.col("p_partkey").alias("partkey"),
        c.path_level(path, 0).alias("category"),
        c.path_level(path, 1).alias("sub_category"),
    )


# --- rules counted, stamped and found -----------------------------------------------


@query(with_ctes([f"std_{n}" for n in RULES], " UNION ALL ".join(
    f"SELECT '{entity}' entity, '{name}' rule_name, count(*) FILTER (NOT coalesce({rule}, FALSE)) broken_rows, count(*) judged_rows FROM std_{entity}"
    for entity, rules in RULES.items() for name, rule in rules.items())))
def rule_counts(t: Tables) -> DataFrame:
    """Rows that break each rule, counted in the pass that judges them: a stream for transactions, jobs for the rest."""
    found: list[tuple[str, str, int, int]] = []
    for name, entity in e.ENTITIES.items():
        root = new_folder(t.spark, "rule-counts")
        if name == "transactions":
            RAW[name](t).write.parquet(f"{root}/in")
            run = silver.refine(t.spark, f"{root}/in", f"{root}/out", f"{root}/cp", entity)
            run.awaitTermination()
            counts = quality.stream_counts(run)
        else:
            watched = Observation()
            split = quality.split_by_rules(standardised(t, name), entity.rules, entity.first_failure)
            quality.counted_rules(split, entity.rules, watched).write.partitionBy(quality.VERDICT).parquet(f"{root}/out")
            counts = watched.get
        found += [(name, rule, counts[rule], counts[quality.ALL_ROWS]) for rule in entity.rules]
    return t.spark.createDataFrame(found, "entity string, rule_name string, broken_rows long, judged_rows long")


@query(with_ctes([f"quarantine_{n}" for n in RULES], " UNION ALL ".join(
    f"SELECT '{n}' entity, count(*) quarantined, count(*) stamped FROM quarantine_{n}" for n in RULES)))
def quarantine_stamps(t: Tables) -> DataFrame:
    """Quarantined rows of each entity, and those whose stamp lies within this job."""
    parts = []
    for name, entity in e.ENTITIES.items():
        start = datetime.now(UTC)
        rows = quality.quarantine(standardised(t, name), entity.rules)
        here = F.col(quality.STAMP).between(F.lit(start), F.current_timestamp())
        parts.append(rows.agg(F.count("*").alias("quarantined"), F.count_if(here).alias("stamped")).select(F.lit(name).alias("entity"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(with_ctes([f"quarantine_{n}" for n in ("orders", "returns", "vendors")], """
    SELECT 'silver_orders_quarantine' table_name, count(*) stored_rows FROM quarantine_orders
    UNION ALL SELECT 'returns_quaruntine', count(*) FROM quarantine_returns
    UNION ALL SELECT 'vendors_quarantine_old', count(*) FROM quarantine_vendors"""))
def quarantine_discovery(t: Tables) -> DataFrame:
    """Stored quarantine tables are found by name in a schema made for them, in either spelling; others are not."""
    root = new_folder(t.spark, "discovery")
    schema = f"found_{root[-32:]}"
    tables.ensure_schema(t.spark, schema)
    named = {"silver_orders_quarantine": "orders", "returns_quaruntine": "returns", "vendors_quarantine_old": "vendors"}
    for table, entity in named.items():
        rows = quality.quarantine(standardised(t, entity), e.ENTITIES[entity].rules)
        tables.refresh_table(rows, f"{schema}.{table}", f"{root}/{table}")
    tables.refresh_table(standardised(t, "vendors"), f"{schema}.vendors", f"{root}/vendors")
    first = [f"{schema}.silver_orders_quarantine", f"{schema}.silver_products_quarantine"]
    found = tables.read_tables(t.spark, tables.find_tables(t.spark, schema, first))
    parts = [df.agg(F.count("*").alias("stored_rows")).select(F.lit(n.split(".")[1]).alias("table_name"), "*") for n, df in found.items()]
    out = reduce(DataFrame.unionByName, parts)
    out.schema  # the views are resolved before their schema goes
    t.spark.sql(f"DROP DATABASE {schema} CASCADE")
    return out
