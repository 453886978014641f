"""Queries over the audit report, return risk, retrieval and insight plans."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.jobs import REPORT_ORDER
from tidemark.operators import quality
from tidemark.operators.keyed import top_per_key
from tidemark.operators.nearest import top_k_documents
from tidemark.operators.ordered import stored_in_order
from tidemark.operators.points import paged_points, points_json
from tidemark.operators.profile import null_profile
from tidemark.operators.replies import ReplyStore
from tidemark.operators.scoring import score_prompts
from tidemark.plans import entities as e
from tidemark.plans import deltas, insights, marts, quality_report, retrieval, return_risk, star, term_search
from tidemark.sources import tables
from tidemark.sources.scratch import new_folder
from tidemark.workload import gold_queries as gold
from tidemark.workload import inputs
from tidemark.workload.inputs import Tables
from tidemark.workload.model_sql import divide, money_total, with_ctes
from tidemark.workload.registry import query
from tidemark.workload.silver_queries import standardised

# --- audit report -------------------------------------------------------------------


def quarantine_frames(t: Tables) -> dict[str, DataFrame]:
    return {
        f"silver.silver_{name}_quarantine": quality.quarantine(
            standardised(t, name), entity.rules, stamp=False
        )
        for name, entity in e.ENTITIES.items()
    }


def rejects(t: Tables) -> DataFrame:
    return quality_report.all_rejects(quarantine_frames(t))


def stored_rejects(t: Tables) -> DataFrame:
    return t.stored("rejects", rejects)


def _hashed(columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split())
    return f"sha256(concat_ws('||', {parts}))"


_ALL_COLUMNS = {
    "customers": "customer_id customer_email customer_name segment country city state postal_code region _source_file _region error_reason",
    "orders": "order_id customer_id vendor_id ship_mode order_status order_purchase_date order_approved_at "
              "order_delivered_carrier_date order_delivered_customer_date _source_file _region "
              "order_estimated_delivery_date NULL error_reason",
    "returns": "order_id refund_amount return_date return_status return_reason NULL region error_reason",
    "products": "product_id product_name categories brand colors sizes upc weight dimension manufacturer dateAdded dateUpdated "
                "product_photos_qty _source_file _region NULL categories_list upc_cleaned error_reason",
    "vendors": "vendor_id vendor_name _source_file _region NULL error_reason",
}


def _reject_branch(entity: str, ident: str, trigger: str) -> str:
    return f"""
      SELECT '{entity}' entity_name, unnest(string_split(error_reason, ',')) issue_type, {ident} record_id,
             {trigger}, 'silver.silver_{entity}_quarantine' source_table
      FROM quarantine_{entity}"""


_NO_TRIGGERS = ("CAST(NULL AS VARCHAR) ship_mode, CAST(NULL AS VARCHAR) upc, CAST(NULL AS VARCHAR) return_reason, "
                "CAST(NULL AS VARCHAR) refund_amount")


def _triggers(**given: str) -> str:
    out = _NO_TRIGGERS
    for name, expr in given.items():
        out = out.replace(f"CAST(NULL AS VARCHAR) {name}", f"{expr} {name}")
    return out


def _named(entity: str, ident: str) -> str:
    return f"coalesce({ident}, {_hashed(_ALL_COLUMNS[entity])})"


# Records without an id are named by a hash over all their columns but the load stamps.
_REJECTS_CTE = f"""
    branches AS (
      {_reject_branch('customers', _named('customers', 'customer_id'), _NO_TRIGGERS)}
      UNION ALL {_reject_branch('orders', _named('orders', 'order_id'), _triggers(ship_mode='ship_mode'))}
      UNION ALL {_reject_branch('transactions', 'order_id', _NO_TRIGGERS)}
      UNION ALL {_reject_branch('returns', _named('returns', 'order_id'),
          _triggers(return_reason='return_reason', refund_amount='CAST(NULL AS VARCHAR)'))}
      UNION ALL {_reject_branch('products', _named('products', 'product_id'), _triggers(upc='upc'))}
      UNION ALL {_reject_branch('vendors', _named('vendors', 'vendor_id'), _NO_TRIGGERS)}),
    rejects AS (
      SELECT entity_name, replace(issue_type, 'valid_', '') field_name, issue_type, record_id,
             CASE issue_type WHEN 'valid_ship_mode' THEN ship_mode WHEN 'valid_upc' THEN upc
                  WHEN 'valid_return_reason' THEN return_reason WHEN 'valid_refund_amount' THEN refund_amount
             END trigger_value, source_table
      FROM branches)"""
_REJECT_NEEDS = tuple(f"quarantine_{n}" for n in e.ENTITIES)


@query(with_ctes(_REJECT_NEEDS, f", {_REJECTS_CTE} SELECT * FROM rejects"))
def dq_rejects_normalised(t: Tables) -> DataFrame:
    return rejects(t)


_GROUPED_CTE = """
    grouped AS (
      SELECT entity_name, field_name, issue_type, count(DISTINCT record_id) rejected_count,
             coalesce(array_to_string(list_sort(list(DISTINCT trigger_value)
                 FILTER (trigger_value IS NOT NULL))[1:5], '|'), '') sample_trigger_values,
             array_to_string(list_sort(list(DISTINCT source_table)), '|') source_tables
      FROM rejects GROUP BY entity_name, field_name, issue_type)"""
_EXPLAINED = """'Check ' || issue_type || ' turned away ' || rejected_count || ' records of ' || entity_name
    || ' for what their field ' || field_name || ' holds. No report counts them until they are repaired, '
    || 'so sums and comparisons over ' || entity_name || ' come out too low.'"""


def _flat(report: DataFrame) -> DataFrame:
    lists = {n: F.array_join(n, "|") for n in ("sample_trigger_values", "source_tables")}
    return report.withColumns(lists).drop("generated_at")


@query(with_ctes(_REJECT_NEEDS, f", {_REJECTS_CTE}, {_GROUPED_CTE} "
                 f"SELECT *, {_EXPLAINED} ai_business_impact_explanation FROM grouped"))
def dq_audit_report(t: Tables) -> DataFrame:
    return _flat(quality_report.audit_report(quality_report.grouped_report(stored_rejects(t))))


@query("""SELECT doc_id, source, regexp_matches(lower(text), 'risk|impact|audit|report|decision') has_risk_language,
          strpos(lower(text), lower(source)) > 0 mentions_field FROM documents""")
def dq_text_flags(t: Tables) -> DataFrame:
    return quality_report.text_flags(t.documents, "text", "source").select(
        "doc_id", "source", "has_risk_language", "mentions_field"
    )


@query("""SELECT event_id, sha256(concat_ws('||', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
          event_type, coalesce(props, ''))) record_id FROM events""")
def record_hash(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "user_id", "event_type", "props")
    return df.select("event_id", quality_report.row_hash(df).alias("record_id"))


# --- return risk ----------------------------------------------------------------------

_PROFILE_CTE = f"""
    anchor AS (SELECT max(CAST(return_date AS DATE)) latest FROM fact_returns WHERE customer_id IS NOT NULL),
    profile AS (
      SELECT customer_id, count(*) total_returns,
             {money_total('coalesce(refund_amount, 0)')} total_return_value,
             {divide("sum(CAST(coalesce(refund_amount, 0) AS DECIMAL(28,6))) * 1000000", 'count(*)', 2, 6)} avg_return_value,
             count(DISTINCT region_name) distinct_regions,
             CAST(sum(CASE WHEN days_to_return IS NULL THEN NULL WHEN days_to_return < 0 THEN 1 ELSE 0 END) AS BIGINT)
               negative_days_to_return_count,
             CAST(sum(CASE WHEN is_approved THEN 0 ELSE 1 END) AS BIGINT) non_approved_returns,
             count(*) FILTER (CAST(return_date AS DATE) >= latest - 30) returns_last_30d,
             count(*) FILTER (CAST(return_date AS DATE) >= latest - 7) returns_last_7d
      FROM fact_returns, anchor WHERE customer_id IS NOT NULL GROUP BY customer_id),
    profiles AS (
      SELECT p.*, CAST(negative_days_to_return_count AS DOUBLE) / total_returns negative_days_to_return_ratio,
             CAST(non_approved_returns AS DOUBLE) / total_returns non_approved_ratio,
             c.customer_name, c.region customer_region, c.segment customer_tier
      FROM profile p LEFT JOIN customers c ON p.customer_id = c.customer_id)"""
_SCORE_CTE = """
    ruled AS (
      SELECT *, CAST(total_returns >= 8 AS INTEGER) r1, CAST(total_return_value >= 1000 AS INTEGER) r2,
             CAST(coalesce(negative_days_to_return_ratio >= 0.15, FALSE) AS INTEGER) r3,
             CAST(distinct_regions >= 3 AS INTEGER) r4, CAST(non_approved_ratio >= 0.5 AS INTEGER) r5
      FROM profiles),
    scores AS (
      SELECT *, r1 * 20 + r2 * 25 + r3 * 20 + r4 * 15 + r5 * 20 anomaly_score,
             concat_ws(', ', CASE WHEN r1 = 1 THEN 'rule_high_return_frequency' END,
               CASE WHEN r2 = 1 THEN 'rule_high_return_value' END,
               CASE WHEN r3 = 1 THEN 'rule_negative_days_to_return' END,
               CASE WHEN r4 = 1 THEN 'rule_multi_region_returns' END,
               CASE WHEN r5 = 1 THEN 'rule_high_non_approved_ratio' END) rules_violated
      FROM ruled)"""
_RISK_NEEDS = ("fact_returns", "customers")


def profiles(t: Tables) -> DataFrame:
    # Read twice, for the latest day and for the profiles.
    facts = kept_returns(t)
    profile = return_risk.profiles(facts)
    return return_risk.with_customers(profile, star.dim_customer(inputs.tidy_customers(t)))


def scores(t: Tables) -> DataFrame:
    return return_risk.scored(profiles(t))


@query(with_ctes(_RISK_NEEDS, f", {_PROFILE_CTE} SELECT * FROM profiles"))
def return_profiles(t: Tables) -> DataFrame:
    return profiles(t)


@query(with_ctes(_RISK_NEEDS, f""", {_PROFILE_CTE}, {_SCORE_CTE}
    SELECT customer_id, r1 rule_high_return_frequency, r2 rule_high_return_value, r3 rule_negative_days_to_return,
           r4 rule_multi_region_returns, r5 rule_high_non_approved_ratio, anomaly_score, rules_violated,
           anomaly_score >= 65 is_flagged FROM scores"""))
def return_risk_scores(t: Tables) -> DataFrame:
    return scores(t).select(
        "customer_id",
        *return_risk.RULES,
        "anomaly_score",
        F.array_join("rules_violated", ", ").alias("rules_violated"),
        "is_flagged",
    )


@query(with_ctes(_RISK_NEEDS, f""", {_PROFILE_CTE}, {_SCORE_CTE}
    SELECT customer_id, customer_name, customer_region, customer_tier, total_returns::INTEGER total_returns,
           total_return_value, avg_return_value, returns_last_30d::INTEGER returns_last_30d,
           returns_last_7d::INTEGER returns_last_7d, distinct_regions::INTEGER distinct_regions,
           negative_days_to_return_count::INTEGER negative_days_to_return_count,
           {divide('negative_days_to_return_count', 'total_returns', 4)} negative_days_to_return_ratio,
           non_approved_returns::INTEGER non_approved_returns,
           {divide('non_approved_returns', 'total_returns', 4)} non_approved_ratio,
           anomaly_score, rules_violated, '{return_risk.BRIEF}' ai_investigation_brief
    FROM scores WHERE anomaly_score >= 65"""))
def flagged_return_customers(t: Tables) -> DataFrame:
    return return_risk.flagged_customers(scores(t)).drop("generated_at")


@query(with_ctes(_RISK_NEEDS, f""", {_PROFILE_CTE}, {_SCORE_CTE}
    , counts AS (SELECT count(*) customers_scored, count(*) FILTER (anomaly_score >= 65) flagged,
                 count(*) FILTER (anomaly_score >= 55) flagged_lower FROM scores)
    SELECT *, {divide('flagged * 100', 'customers_scored', 2)} flagged_pct, flagged_lower - flagged additional_cases
    FROM counts"""))
def threshold_sensitivity(t: Tables) -> DataFrame:
    return return_risk.threshold_sensitivity(scores(t))


# --- retrieval --------------------------------------------------------------------------

_MONTH_CTE = f"monthly AS ({gold.MONTHLY_BODY})"
_DOC_NEEDS = ("fact_sales", "dim_date", "products")


# Reports read stored facts and marts, as several of them share each table.


def kept_sales(t: Tables) -> DataFrame:
    """Sales with the columns that the marts take in."""
    return t.stored("fact_sales", lambda t: gold.all_sales(t).select(*deltas.SALES_COLUMNS))


def kept_returns(t: Tables) -> DataFrame:
    """Returns for queries that read them more than once."""
    return t.stored("fact_returns", gold.returns)


def monthly(t: Tables) -> DataFrame:
    def build(t: Tables) -> DataFrame:
        return marts.monthly_revenue(kept_sales(t), star.dim_date(t.spark), gold.customers(t))

    return t.stored("monthly_revenue", build)


def vendor_rates(t: Tables, returns: DataFrame | None = None) -> DataFrame:
    def build(t: Tables) -> DataFrame:
        vendors = star.dim_vendor(inputs.tidy_vendors(t))
        return marts.vendor_return_rate(kept_sales(t), gold.returns(t) if returns is None else returns, vendors, stored=True)

    return t.stored("vendor_return_rate", build)


def slow_movers(t: Tables) -> DataFrame:
    return t.stored("slow_moving_products", lambda t: gold.slow_movers(t, sales=kept_sales(t)))


_REGION_CTE = f"""
    region_revenue AS (
      SELECT region_name region, {money_total('total_sales_amount')} region_total_sales,
             {divide("sum(CAST(avg_order_value AS DECIMAL(28,6))) * 1000000", 'count(avg_order_value)', 2, 6)}
               region_avg_order_value,
             count(DISTINCT year || '-' || month_num) months_covered
      FROM monthly GROUP BY region_name)"""
_SLOW_SUMMARY_CTE = f"""
    slow_summary AS (
      SELECT product_id, bool_or(is_slow_mover) is_slow_mover, max(days_since_last_sale) max_days_since_last_sale,
             {money_total('total_revenue')} slow_mover_total_revenue,
             array_to_string(list_sort(list(DISTINCT region_name))[1:3], ', ') slow_regions_sample
      FROM slow GROUP BY product_id),
    slow_pick AS (
      SELECT product_id, arg_min(region_name, (-days_since_last_sale, region_name)) region FROM slow GROUP BY product_id)"""


@query(with_ctes(("fact_sales", "dim_date"), f", {_MONTH_CTE}, {_REGION_CTE} SELECT * FROM region_revenue"))
def region_revenue_rollup(t: Tables) -> DataFrame:
    return retrieval.region_revenue(monthly(t))


@query(with_ctes(("fact_sales", "products"), f", {gold.SLOW_CTE}, {_SLOW_SUMMARY_CTE} SELECT * FROM slow_summary"))
def slow_mover_rollup(t: Tables) -> DataFrame:
    return retrieval.slow_summary(slow_movers(t))


@query(with_ctes(("fact_sales", "products"), f", {gold.SLOW_CTE}, {_SLOW_SUMMARY_CTE} SELECT * FROM slow_pick"))
def slow_region_pick(t: Tables) -> DataFrame:
    return retrieval.slowest_region(slow_movers(t))


def _line(label: str, expr: str, absent: str) -> str:
    return f"'{label}: ' || coalesce({expr}, '{absent}') || '.'"


_PRODUCT_TEXT = " || ' ' || ".join([
    "'Product intelligence profile.'",
    _line("Product name", "product_name", "unknown"),
    _line("Category", "category", "unknown"),
    _line("Sub-category", "sub_category", "unknown"),
    _line("Brand", "brand", "unknown"),
    _line("Manufacturer", "manufacturer", "unknown"),
    _line("Region context", "k.region", "unknown"),
    _line("Slow mover flag", "CAST(is_slow_mover AS VARCHAR)", "false"),
    _line("Max days since last sale", "CAST(max_days_since_last_sale AS VARCHAR)", "n/a"),
    _line("Slow-mover regions sample", "slow_regions_sample", "n/a"),
    _line("Slow-mover revenue sum", "CAST(CAST(slow_mover_total_revenue AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
    _line("Region total sales context", "CAST(CAST(region_total_sales AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
    _line("Region average order value context", "CAST(CAST(region_avg_order_value AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
])
_PRODUCT_DOCS = f"""
    SELECT 'product::' || p.product_id doc_id, 'product' doc_type, p.product_id, CAST(NULL AS VARCHAR) vendor_id,
           coalesce(k.region, 'unknown') region, {_PRODUCT_TEXT} doc_text
    FROM products p LEFT JOIN slow_summary s ON p.product_id = s.product_id
    LEFT JOIN slow_pick k ON p.product_id = k.product_id LEFT JOIN region_revenue r ON k.region = r.region"""
_VENDOR_TEXT = " || ' ' || ".join([
    "'Vendor intelligence profile.'",
    _line("Vendor name", "vendor_name", "unknown"),
    _line("Vendor return rate pct", "CAST(CAST(return_rate_pct AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
    _line("Vendor average days to return", "CAST(CAST(avg_days_to_return AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
    _line("Vendor total returns", "CAST(total_returns AS VARCHAR)", "n/a"),
    _line("Vendor total revenue", "CAST(CAST(total_revenue AS DECIMAL(20,2)) AS VARCHAR)", "n/a"),
])
_VENDOR_DOCS = f"""
    SELECT 'vendor::' || vendor_id doc_id, 'vendor' doc_type, CAST(NULL AS VARCHAR) product_id, vendor_id,
           'global' region, {_VENDOR_TEXT} doc_text FROM vendor_rate"""
_VENDOR_NEEDS = ("fact_sales", "fact_returns", "vendors")


def product_docs(t: Tables) -> DataFrame:
    return retrieval.product_documents(
        star.dim_product(inputs.tidy_products(t)), slow_movers(t), monthly(t)
    )


def vendor_docs(t: Tables) -> DataFrame:
    return retrieval.vendor_documents(star.dim_vendor(inputs.tidy_vendors(t)), vendor_rates(t))


@query(with_ctes(_DOC_NEEDS, f", {_MONTH_CTE}, {_REGION_CTE}, {gold.SLOW_CTE}, {_SLOW_SUMMARY_CTE} {_PRODUCT_DOCS}"))
def product_documents(t: Tables) -> DataFrame:
    return product_docs(t)


@query(with_ctes(_VENDOR_NEEDS, f", {gold.VENDOR_RATE_CTE} {_VENDOR_DOCS}"))
def vendor_documents(t: Tables) -> DataFrame:
    return vendor_docs(t)


_ALL_NEEDS = ("fact_sales", "fact_returns", "vendors", "dim_date", "products")


@query(with_ctes(_ALL_NEEDS, f""", {_MONTH_CTE}, {_REGION_CTE}, {gold.SLOW_CTE}, {_SLOW_SUMMARY_CTE},
    {gold.VENDOR_RATE_CTE}, docs AS ({_PRODUCT_DOCS} UNION ALL {_VENDOR_DOCS})
    SELECT doc_type, region, count(*) AS documents, CAST(sum(length(doc_text)) AS BIGINT) characters
    FROM docs GROUP BY doc_type, region"""))
def document_union(t: Tables) -> DataFrame:
    docs = retrieval.all_documents(product_docs(t), vendor_docs(t))
    return docs.groupBy("doc_type", "region").agg(
        F.count("*").alias("documents"), F.sum(F.length("doc_text")).alias("characters")
    )


# One question for each label: its vector with the lowest id. Every vector is a document.
_NEAREST_CTE = """
    questions AS (SELECT label question_id, arg_min(embedding, vec_id) q FROM embeddings GROUP BY label),
    pairs AS (
      SELECT question_id, vec_id doc_id,
             round(list_inner_product(CAST(q AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) + 0.0 score
      FROM questions CROSS JOIN embeddings),
    best AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM pairs QUALIFY rank <= 5)"""


def label_questions(t: Tables) -> DataFrame:
    rows = top_per_key(t.embeddings, ["label"], [F.asc("vec_id")], 1)
    name = F.concat(F.lit("label "), F.col("label").cast("string"))
    return rows.select(
        F.col("label").alias("question_id"), name.alias("question"), F.col("embedding").alias("vector")
    )


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


@query(f"WITH {_NEAREST_CTE} SELECT * FROM best")
def vector_top_k(t: Tables) -> DataFrame:
    return top_k_documents(label_questions(t), vectors(t), 5, digits=6)


@query(f"WITH {_NEAREST_CTE} SELECT * FROM best")
def vector_top_k_blocked(t: Tables) -> DataFrame:
    """The same search with more than one block of questions."""
    return top_k_documents(label_questions(t), vectors(t), 5, digits=6, questions_per_block=3)


_CONTEXT_CTE = """
    found AS (
      SELECT b.*, 'label ' || question_id question, 'vector ' || doc_id || ' of label ' || label doc_text,
             '{"doc_id":"' || doc_id || '","doc_type":"vector","product_id":null,"vendor_id":null,"region":"r'
               || label || '"}' meta
      FROM best b JOIN embeddings e ON e.vec_id = b.doc_id),
    asked AS (
      SELECT question_id, question,
             string_agg('[Doc ' || rank || ' | score=' || printf('%.4f', score) || ' | meta=' || meta || ']' || chr(10)
               || doc_text, chr(10) || chr(10) ORDER BY rank) context,
             '[' || string_agg('"' || doc_text || '"', ',' ORDER BY rank) || ']' retrieved_documents,
             '[' || string_agg(meta, ',' ORDER BY rank) || ']' retrieved_metadata
      FROM found GROUP BY question_id, question)"""


def vector_contexts(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    label = F.col("label").cast("string")
    documents = t.embeddings.select(
        F.col("vec_id").alias("doc_id"),
        F.lit("vector").alias("doc_type"),
        none.alias("product_id"),
        none.alias("vendor_id"),
        F.concat(F.lit("r"), label).alias("region"),
        F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" of label "), label).alias("doc_text"),
    )
    found = retrieval.retrieve(label_questions(t), documents, vectors(t), 5, digits=6)
    return retrieval.contexts(found.withColumn("doc_id", F.col("doc_id").cast("string")))


@query(f"WITH {_NEAREST_CTE}, {_CONTEXT_CTE} SELECT * FROM asked")
def retrieved_context(t: Tables) -> DataFrame:
    return vector_contexts(t)


@query(f"""WITH {_NEAREST_CTE}, {_CONTEXT_CTE}
    SELECT question, '{retrieval.NO_ANSWER}' answer, retrieved_documents, retrieved_metadata, 5 top_k FROM asked""")
def query_history(t: Tables) -> DataFrame:
    return retrieval.answers(vector_contexts(t), 5).drop("generated_at")


@query(r"""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: w <> '')) AS BIGINT) terms,
    CASE WHEN regexp_matches(text, '[\p{L}\p{N}_]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END squared_norm FROM documents""")
def text_vectors(t: Tables) -> DataFrame:
    """Document vectors: the hashed counts add up to the words, and vectors have unit length."""

    def added(values, power: int = 1):
        term = (lambda a, x: a + x) if power == 1 else (lambda a, x: a + x.cast("double") * x)
        return F.aggregate(values, F.lit(0.0).cast("double"), lambda a, x: term(a, x).cast("double"))

    coded = retrieval.text_vectors(t.documents.select("doc_id", "text"), "text")
    return coded.select(
        "doc_id",
        added("term_counts").cast("long").alias("terms"),
        (F.round(added("vector", 2), 4) + 0.0).alias("squared_norm"),
    )


def _weights_sql(docs: str, key: str, column: str) -> str:
    """Rarity and weights of the texts of ``docs``."""
    return f"""
    tokens AS (
      SELECT {key}, term, count(*) tf
      FROM (SELECT {key}, unnest(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}_]+')) term FROM {docs})
      WHERE term <> '' GROUP BY ALL),
    rarity AS (
      SELECT term, ln((SELECT CAST(count(*) AS DOUBLE) FROM {docs}) / count(*)) idf FROM tokens GROUP BY term HAVING idf > 0),
    raw AS (SELECT {key}, t.term, (1 + ln(tf)) * idf w FROM tokens t JOIN rarity r ON t.term = r.term),
    weights AS (
      SELECT r.{key}, term, CAST(round(w / n, 9) AS DECIMAL(10,9)) weight
      FROM raw r JOIN (SELECT {key}, sqrt(sum(w * w)) n FROM raw GROUP BY {key}) l ON r.{key} = l.{key})"""


@query(f"WITH {_weights_sql('documents', 'doc_id', 'text')} SELECT doc_id, term, CAST(weight AS DOUBLE) weight FROM weights")
def term_weights(t: Tables) -> DataFrame:
    """Every weight of every document's vector."""
    weights, _ = term_search.document_weights(t.documents.select("doc_id", "text"), "doc_id", "text")
    return weights.withColumn("weight", F.col("weight").cast("double"))


# Of the five kinds that a report's reader asks.
QUESTIONS = (
    "Which products are slow movers in the region ASIA?",
    "Which vendor has the highest return rate?",
    "How large is the average order value in EUROPE?",
    "Show products with very many days since the last sale.",
    "Which vendor has the highest total returns?",
)
_QUESTIONS_SQL = " UNION ALL ".join(f"SELECT {i} question_id, '{q}' question" for i, q in enumerate(QUESTIONS))
_ANSWERS_CTE = f"""
    docs AS ({_PRODUCT_DOCS} UNION ALL {_VENDOR_DOCS}), {_weights_sql('docs', 'doc_id', 'doc_text')},
    questions AS ({_QUESTIONS_SQL}),
    asked_tokens AS (
      SELECT question_id, term, count(*) tf
      FROM (SELECT question_id, unnest(regexp_split_to_array(lower(question), '[^\\p{{L}}\\p{{N}}_]+')) term FROM questions)
      WHERE term <> '' GROUP BY ALL),
    asked_raw AS (SELECT question_id, t.term, (1 + ln(tf)) * idf w FROM asked_tokens t JOIN rarity r ON t.term = r.term),
    asked_weights AS (
      SELECT r.question_id, term, CAST(round(w / n, 9) AS DECIMAL(10,9)) weight
      FROM asked_raw r JOIN (SELECT question_id, sqrt(sum(w * w)) n FROM asked_raw GROUP BY question_id) l
      ON r.question_id = l.question_id),
    hits AS (
      SELECT q.question_id, w.doc_id, CAST(sum(CAST(q.weight AS DECIMAL(19,9)) * w.weight) AS DOUBLE) score
      FROM asked_weights q JOIN weights w ON q.term = w.term GROUP BY ALL),
    best AS (
      SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM hits QUALIFY rank <= 5),
    found AS (
      SELECT b.question_id, question, rank, to_json(d.doc_text) doc_json,
             '{{"doc_id":"' || d.doc_id || '","doc_type":"' || doc_type || '","product_id":'
               || coalesce('"' || product_id || '"', 'null') || ',"vendor_id":' || coalesce('"' || vendor_id || '"', 'null')
               || ',"region":"' || region || '"}}' meta
      FROM best b JOIN docs d ON b.doc_id = d.doc_id JOIN questions q ON q.question_id = b.question_id)
    SELECT question, '{retrieval.NO_ANSWER}' answer, '[' || string_agg(doc_json, ',' ORDER BY rank) || ']' retrieved_documents,
           '[' || string_agg(meta, ',' ORDER BY rank) || ']' retrieved_metadata, 5 top_k
    FROM found GROUP BY question_id, question"""


@query(with_ctes(_ALL_NEEDS, f""", {_MONTH_CTE}, {_REGION_CTE}, {gold.SLOW_CTE}, {_SLOW_SUMMARY_CTE},
    {gold.VENDOR_RATE_CTE}, {_ANSWERS_CTE}"""))
def product_question_answers(t: Tables) -> DataFrame:
    """Questions answered from product and vendor documents by weighted terms."""
    docs = t.stored("documents", lambda t: retrieval.all_documents(product_docs(t), vendor_docs(t)))
    asked = t.spark.createDataFrame(list(enumerate(QUESTIONS)), "question_id int, question string")
    weights, idf = term_search.document_weights(docs, "doc_id", "doc_text")
    found = term_search.retrieve_by_terms(asked, docs, weights, idf, retrieval.TOP_K)
    return retrieval.answers(retrieval.contexts(found)).drop("generated_at")


# --- insights -----------------------------------------------------------------------------


@query("""SELECT 'documents' table_name, column_name, row_count, null_count FROM (
    SELECT count(*) AS row_count, count(*) - count(doc_id) doc_id, count(*) - count(quality) quality,
           count(*) - count(toxic) toxic FROM (SELECT d.doc_id, quality, toxic FROM documents d
           LEFT JOIN labels l ON d.doc_id = l.doc_id))
    UNPIVOT (null_count FOR column_name IN (doc_id, quality, toxic))""", name="null_profile")
def label_gaps(t: Tables) -> DataFrame:
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return null_profile(labelled, "documents")


_REVENUE_JSON = """'{"total_revenue":' || CAST(sum(revenue) AS DECIMAL(20,2))
    || ',"avg_revenue_per_region":' || CAST(AVG_VALUE AS DECIMAL(20,2))
    || ',"top_regions":[' || (SELECT string_agg(j, ',' ORDER BY revenue DESC, region)
         FROM (SELECT * FROM points ORDER BY revenue DESC, region LIMIT 3))
    || '],"bottom_regions":[' || (SELECT string_agg(j, ',' ORDER BY revenue, region)
         FROM (SELECT * FROM points ORDER BY revenue, region LIMIT 3))
    || '],"region_count":' || count(*) || '}'""".replace(
    "AVG_VALUE", divide("sum(revenue) * 100", "count(revenue)", 2, 2))
_REVENUE_CTE = f"""
    points AS (
      SELECT region, revenue, '{{"region":"' || region || '","revenue":' || CAST(revenue AS DECIMAL(20,2)) || '}}' j
      FROM (SELECT region_name region, sum(CAST(total_sales_amount AS DECIMAL(18,2))) revenue
            FROM monthly GROUP BY region_name)),
    revenue_payload AS (SELECT {_REVENUE_JSON} kpi_payload_json FROM points)"""
_VENDOR_PAYLOAD_CTE = f"""
    vendor_points AS (
      SELECT vendor_id, vendor_name, return_rate_pct rate, '{{"vendor_name":"' || vendor_name || '","return_rate":'
             || CAST(coalesce(return_rate_pct, 0) AS DECIMAL(20,2)) || ',"total_returns":' || total_returns || '}}' j
      FROM vendor_rate),
    vendor_payload AS (
      SELECT '{{"avg_vendor_return_rate":' || CAST({divide('sum(CAST(rate AS DECIMAL(18,2))) * 100', 'count(rate)', 4, 2)}
               AS DECIMAL(20,4))
             || ',"high_return_rate_vendor_count_ge_20pct":' || count(*) FILTER (rate >= 20)
             || ',"top_vendor_return_rates":['
             || (SELECT string_agg(j, ',' ORDER BY rate DESC NULLS LAST, vendor_name, vendor_id)
                 FROM (SELECT * FROM vendor_points ORDER BY rate DESC NULLS LAST, vendor_name, vendor_id LIMIT 5))
             || '],"vendor_count":' || count(DISTINCT vendor_name) || '}}' kpi_payload_json
      FROM vendor_points)"""
_SLOW_PAYLOAD_CTE = """
    slow_regions AS (
      SELECT region_name region, count(product_name) n, sum(CAST(total_revenue AS DECIMAL(18,2))) worth
      FROM slow WHERE is_slow_mover GROUP BY region_name),
    slow_points AS (
      SELECT *, '{"region":"' || region || '","slow_product_count":' || n || ',"slow_inventory_value":'
             || CAST(worth AS DECIMAL(20,2)) || '}' j FROM slow_regions),
    slow_payload AS (
      SELECT '{"slow_moving_product_count":' || (SELECT count(*) FROM slow WHERE is_slow_mover)
             || ',"total_slow_moving_inventory_value":' || CAST(coalesce(sum(worth), 0) AS DECIMAL(20,2))
             || ',"top_regions_by_slow_inventory":['
             || coalesce((SELECT string_agg(j, ',' ORDER BY worth DESC, region)
                 FROM (SELECT * FROM slow_points ORDER BY worth DESC, region LIMIT 5)), '')
             || '],"region_count_with_slow_inventory":' || count(*) || '}' kpi_payload_json
      FROM slow_points)"""


@query(with_ctes(("fact_sales", "dim_date"), f", {_MONTH_CTE}, {_REVENUE_CTE} SELECT * FROM revenue_payload"))
def kpi_revenue(t: Tables) -> DataFrame:
    return insights.payload_json(insights.revenue_kpis(monthly(t)))


@query(with_ctes(_VENDOR_NEEDS, f", {gold.VENDOR_RATE_CTE}, {_VENDOR_PAYLOAD_CTE} SELECT * FROM vendor_payload"))
def kpi_vendor_return_rate(t: Tables) -> DataFrame:
    return insights.payload_json(insights.vendor_kpis(vendor_rates(t)))


@query(with_ctes(("fact_sales", "products"), f", {gold.SLOW_CTE}, {_SLOW_PAYLOAD_CTE} SELECT * FROM slow_payload"))
def kpi_slow_inventory(t: Tables) -> DataFrame:
    return insights.payload_json(insights.slow_inventory_kpis(slow_movers(t)))


@query(with_ctes(_ALL_NEEDS, f""", {_MONTH_CTE}, {_REVENUE_CTE}, {gold.VENDOR_RATE_CTE}, {_VENDOR_PAYLOAD_CTE},
    {gold.SLOW_CTE}, {_SLOW_PAYLOAD_CTE},
    payloads AS (SELECT 'revenue_performance' insight_type, * FROM revenue_payload
      UNION ALL SELECT 'vendor_return_rate', * FROM vendor_payload
      UNION ALL SELECT 'slow_moving_inventory', * FROM slow_payload)
    SELECT insight_type, '{insights.SUMMARY}' executive_summary, kpi_payload_json FROM payloads"""))
def business_insights(t: Tables) -> DataFrame:
    payloads = {
        "revenue_performance": insights.revenue_kpis(monthly(t)),
        "vendor_return_rate": insights.vendor_kpis(vendor_rates(t)),
        "slow_moving_inventory": insights.slow_inventory_kpis(slow_movers(t)),
    }
    return insights.business_insights(payloads).drop("generated_at")


@query(with_ctes(_VENDOR_NEEDS, f""", {gold.VENDOR_RATE_CTE},
    vendor_points AS (SELECT vendor_id, vendor_name, CAST(CAST(return_rate_pct AS DECIMAL(18,2)) AS VARCHAR) rate
                      FROM vendor_rate)
    SELECT substr(md5(vendor_id), 1, 1) page, count(*) point_count,
           '[' || string_agg('{{"vendor_name":"' || vendor_name || '"'
             || CASE WHEN rate IS NULL THEN '' ELSE ',"return_rate":"' || rate || '"' END || '}}', ','
             ORDER BY vendor_name, rate) || ']' points_json
    FROM vendor_points GROUP BY page"""))
def collected_points_json(t: Tables) -> DataFrame:
    rate = F.col("return_rate_pct").cast("decimal(18,2)")
    fields = {"vendor_name": F.col("vendor_name"), "return_rate": rate}
    return points_json(vendor_rates(t), fields, F.col("vendor_id"), page_digits=1)


PAGE_ROWS = 7


@query(with_ctes(_VENDOR_NEEDS, f""", {gold.VENDOR_RATE_CTE},
    vendor_points AS (SELECT vendor_name, CAST(CAST(return_rate_pct AS DECIMAL(18,2)) AS VARCHAR) rate FROM vendor_rate),
    placed AS (SELECT *, row_number() OVER (ORDER BY vendor_name NULLS FIRST, rate NULLS FIRST) place FROM vendor_points)
    SELECT (place - 1) // {PAGE_ROWS} + 1 page, count(*) point_count,
           '[' || string_agg('{{"vendor_name":"' || vendor_name || '"'
             || CASE WHEN rate IS NULL THEN '' ELSE ',"return_rate":"' || rate || '"' END || '}}', ',' ORDER BY place) || ']' points_json
    FROM placed GROUP BY page"""))
def paged_points_json(t: Tables) -> DataFrame:
    """Every vendor's rate on pages of a fixed size."""
    rate = F.col("return_rate_pct").cast("decimal(18,2)")
    return paged_points(vendor_rates(t), {"vendor_name": F.col("vendor_name"), "return_rate": rate}, PAGE_ROWS)


_LONG_PAGE = 400


@query(with_ctes(("fact_sales", "dim_date"), f""", {_MONTH_CTE},
    points AS (
      SELECT '{{"region":"' || region_name || '","revenue":"' || CAST(CAST(total_sales_amount AS DECIMAL(20,2)) AS VARCHAR) || '"}}' point,
             row_number() OVER (ORDER BY region_name, CAST(CAST(total_sales_amount AS DECIMAL(20,2)) AS VARCHAR)) place
      FROM monthly),
    pages AS (
      SELECT (place - 1) // {_LONG_PAGE} + 1 page, count(*) point_count, '[' || string_agg(point, ',' ORDER BY place) || ']' points_json
      FROM points GROUP BY page)
    SELECT page, point_count, 'Revenue: ' || length(points_json) || ' characters' assessment FROM pages"""))
def revenue_assessment(t: Tables) -> DataFrame:
    """An assessment of each page of regional revenue, as the model's second block gives it."""
    revenue = F.col("total_sales_amount").cast("decimal(20,2)")
    pages = paged_points(monthly(t), {"region": F.col("region_name"), "revenue": revenue}, _LONG_PAGE)

    def model(prompt: str) -> str:
        points = prompt[prompt.index("[{") :]
        return '[{"type": "reasoning"}, {"type": "text", "text": "Revenue: %d characters"}]' % len(points)

    return insights.assessments(pages, insights.REVENUE_QUESTION, model).select("page", "point_count", "assessment")


# --- prompts and replies --------------------------------------------------------------------


@query(with_ctes(_RISK_NEEDS, f""", {_PROFILE_CTE}, {_SCORE_CTE}
    SELECT customer_id, 'Customer ' || customer_id || ' (' || coalesce(customer_name, '') || ') made ' || total_returns
           || ' returns; score ' || anomaly_score || '; rules: ' || rules_violated prompt FROM scores"""))
def prompt_render(t: Tables) -> DataFrame:
    template = "Customer {customer_id} ({customer_name}) made {total_returns} returns; score {anomaly_score}; rules: {rules}"
    df = scores(t).withColumn("rules", F.array_join("rules_violated", ", "))
    names = ("customer_id", "customer_name", "total_returns", "anomaly_score", "rules")
    return df.select("customer_id", text.render(template, {n: F.col(n) for n in names}).alias("prompt"))


def stand_in_model(prompt: str) -> str | None:
    """Fails on questions, stays silent on short turns, and otherwise answers as a JSON list."""
    if "?" in prompt:
        raise ValueError("no answer")
    if len(prompt) < 40:
        return "  "
    return '[{"type": "reasoning", "text": "x"}, {"type": "text", "text": " length %d "}]' % len(prompt)


@query("""SELECT conv_id, turn, CASE WHEN strpos(text, '?') > 0 OR length(text) < 40 THEN 'none'
          ELSE 'length ' || length(text) END answer FROM conversations""")
def score_conversation_prompts(t: Tables) -> DataFrame:
    asked = t.conversations.select("conv_id", "turn", "text")
    return score_prompts(asked, "text", "answer", F.lit("none"), stand_in_model).drop("text")


@query("""SELECT conv_id, turn, answer, CASE WHEN answer <> 'none' THEN first_run END asked_in_run FROM (
          SELECT conv_id, turn, CASE WHEN strpos(text, '?') > 0 OR length(text) < 40 THEN 'none' ELSE 'length ' || length(text) END answer,
                 CASE WHEN min(turn) OVER (PARTITION BY text) = 0 THEN 1 ELSE 2 END first_run FROM conversations)""")
def stored_replies(t: Tables) -> DataFrame:
    """Prompts of first turns asked in one run and those of all turns in the next, which asks only what is open."""
    store = ReplyStore(t.spark, new_folder(t.spark, "replies"))
    asked = t.conversations.select("conv_id", "turn", "text")
    store.ask(asked.where("turn = 0"), "text", "1", stand_in_model)
    store.ask(asked, "text", "2", stand_in_model)
    store.ask(asked, "text", "2", stand_in_model)
    answered = store.replies(asked, "text", "answer", F.lit("none"))
    runs = store.read().where("reply IS NOT NULL").select("prompt", F.col("run").cast("int").alias("asked_in_run"))
    return answered.join(runs, F.col("text") == F.col("prompt"), "left").select("conv_id", "turn", "answer", "asked_in_run")


_REPLY_SQL = """CASE event_id % 6
    WHEN 0 THEN '[{"type":"reasoning","text":"skip"},{"type":"text","text":" ' || event_type || ' "}]'
    WHEN 1 THEN '[{"type":"text","text":"  "},{"type":"text","text":"' || event_type || '"}]'
    WHEN 2 THEN '  ' || event_type || chr(10) || '  again '
    WHEN 3 THEN '{"type":"text","text":"' || event_type || '"}'
    WHEN 4 THEN '["note",{"type":"text","text":"' || event_type || '"}]' END"""


@query(f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN event_type
    WHEN 2 THEN event_type || ' again' WHEN 3 THEN {_REPLY_SQL} WHEN 4 THEN event_type ELSE '' END reply_text,
    CASE event_id % 6 WHEN 0 THEN ' ' || event_type || ' ' WHEN 1 THEN event_type WHEN 4 THEN event_type END second_text
    FROM events""")
def extract_response_text(t: Tables) -> DataFrame:
    kind, key = F.col("event_type"), F.col("event_id") % 6

    def joined(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    reply = (
        F.when(key == 0, joined('[{"type":"reasoning","text":"skip"},{"type":"text","text":" ', kind, ' "}]'))
        .when(key == 1, joined('[{"type":"text","text":"  "},{"type":"text","text":"', kind, '"}]'))
        .when(key == 2, joined("  ", kind, "\n  again "))
        .when(key == 3, joined('{"type":"text","text":"', kind, '"}'))
        .when(key == 4, joined('["note",{"type":"text","text":"', kind, '"}]'))
    )
    return t.events.select(
        "event_id",
        text.reply_text(reply).alias("reply_text"),
        text.second_block_text(reply).alias("second_text"),
    )


# --- stored reports -------------------------------------------------------------------------


@query(with_ctes(_VENDOR_NEEDS, f""", {gold.VENDOR_RATE_CTE}
    SELECT 'after a failed refresh' AS seen, * FROM vendor_rate WHERE CAST(vendor_id AS BIGINT) % 2 = 0
    UNION ALL SELECT 'after the refresh', * FROM vendor_rate"""))
def table_refresh(t: Tables) -> DataFrame:
    """A refresh that fails midway leaves the rows before it; one that ends shows all new ones."""
    root = new_folder(t.spark, "refresh")
    name, rates = f"refreshed_{root[-32:]}", vendor_rates(t)
    number = F.col("vendor_id").cast("long")
    tables.refresh_table(rates.where(number % 2 == 0), name, root)
    broken = F.when(number % 3 == 1, F.raise_error(F.lit("broken off"))).otherwise(F.col("vendor_name"))
    try:
        tables.refresh_table(rates.withColumn("vendor_name", broken), name, root)
    except PySparkException:
        pass
    else:
        raise AssertionError("the refresh should have failed")
    before = t.spark.read.table(name).select(F.lit("after a failed refresh").alias("seen"), "*")
    before.schema  # bound to the files of the first refresh
    tables.refresh_table(rates, name, root)
    after = t.spark.read.table(name).select(F.lit("after the refresh").alias("seen"), "*")
    both = before.unionByName(after)
    t.spark.sql(f"DROP VIEW {name}")
    return both


_RANKED = {
    "mv_monthly_revenue_by_region": ("year NULLS FIRST, month_num NULLS FIRST, region_name NULLS FIRST, country", "concat_ws('|', year, month_num, region_name, country)", "monthly"),
    "mv_customer_return_history": ("total_returns DESC, customer_id", "customer_id", "customer_history"),
    "mv_vendor_return_rate": ("return_rate_pct DESC, vendor_id", "vendor_id", "vendor_rate"),
    "mv_slow_moving_products": ("is_slow_mover DESC, days_since_last_sale DESC, product_id, region_name", "concat_ws('|', product_id, region_name)", "slow"),
    "dq_audit_report": ("rejected_count DESC, entity_name, issue_type, field_name", "concat_ws('|', entity_name, issue_type, field_name)", "grouped"),
    "flagged_return_customers": ("anomaly_score DESC, customer_id", "customer_id", "(SELECT * FROM scores WHERE anomaly_score >= 65)"),
    "rag_query_history": ("question", "question", "asked"),
    "ai_business_insights": ("insight_type", "insight_type", "(SELECT unnest(['revenue_performance', 'vendor_return_rate', 'slow_moving_inventory']) insight_type)"),
}
_RANKED_KEYS = {
    "mv_monthly_revenue_by_region": ("year", "month_num", "region_name", "country"),
    "mv_customer_return_history": ("customer_id",),
    "mv_vendor_return_rate": ("vendor_id",),
    "mv_slow_moving_products": ("product_id", "region_name"),
    "dq_audit_report": ("entity_name", "issue_type", "field_name"),
    "flagged_return_customers": ("customer_id",),
    "rag_query_history": ("question",),
    "ai_business_insights": ("insight_type",),
}


def _ranked_tables(t: Tables) -> dict[str, DataFrame]:
    returns = kept_returns(t)
    rates = vendor_rates(t, returns)
    payloads = {
        "revenue_performance": insights.revenue_kpis(monthly(t)),
        "vendor_return_rate": insights.vendor_kpis(rates),
        "slow_moving_inventory": insights.slow_inventory_kpis(slow_movers(t)),
    }
    return {
        "mv_monthly_revenue_by_region": monthly(t),
        "mv_customer_return_history": marts.customer_return_history(returns, gold.customers(t)),
        "mv_vendor_return_rate": rates,
        "mv_slow_moving_products": slow_movers(t),
        "dq_audit_report": quality_report.audit_report(quality_report.grouped_report(stored_rejects(t))),
        "flagged_return_customers": return_risk.flagged_customers(scores(t)),
        "rag_query_history": retrieval.answers(vector_contexts(t), 5),
        "ai_business_insights": insights.business_insights(payloads),
    }


@query(with_ctes(tuple(dict.fromkeys((*_REJECT_NEEDS, *_RISK_NEEDS, *_ALL_NEEDS))), f""", {_MONTH_CTE}, {gold.VENDOR_RATE_CTE},
    {gold.SLOW_CTE}, {_REJECTS_CTE}, {_GROUPED_CTE}, {_PROFILE_CTE}, {_SCORE_CTE}, {_NEAREST_CTE}, {_CONTEXT_CTE},
    customer_history AS ({gold.CUSTOMER_RETURNS_SQL})
    """ + " UNION ALL ".join(
        f"SELECT '{name}' report, CAST({key} AS VARCHAR) row_key, row_number() OVER (ORDER BY {order}) report_rank FROM {rows}"
        for name, (order, key, rows) in _RANKED.items())))
def report_ranks(t: Tables) -> DataFrame:
    """The place of every row of the eight stored reports; ties go by the row's key."""
    parts = []
    for name, df in _ranked_tables(t).items():
        keys = [F.col(k) for k in _RANKED_KEYS[name]]
        placed = stored_in_order(df, [*REPORT_ORDER[name](), *keys])
        parts.append(placed.select(F.lit(name).alias("report"), F.concat_ws("|", *keys).alias("row_key"), "report_rank"))
    return reduce(DataFrame.unionByName, parts)
