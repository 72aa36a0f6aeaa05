"""The tables at hand in the roles the operators work on.

There is no account data, so whole tables stand in: orders for the incoming
extract and for clustered accounts, events for the historical master,
documents for records to match, order lines with their parts for linked pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmaster.functions.text import normalise_link_text
from kinmaster.operators import blocking
from kinmaster.schema import FieldSpec
from kinmaster.session import spread

SPLIT_VALUE = "1-URGENT"

# Documents compare by their words; a Spanish one plays a missing language.
DOCUMENT_FIELDS = (
    FieldSpec("text", "text", weight=0.8),
    FieldSpec("lang", "exact", has_missing=True, weight=0.2),
)
DOCUMENT_SIMILARITY = 0.6


def document_rules() -> dict[str, Column]:
    """Documents meet on common phrases, or on the same words in any order."""
    return {
        "phrases": blocking.rule_phrases("text"),
        "words": F.transform(blocking.rule_sorted_tokens("text"), lambda w: F.md5(w)),
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as incoming records: untidy keys, some keys and sources missing."""
    return as_extract(table(spark, sf_dir, "orders"))


def as_extract(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS ordinal",
        "CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"
        " THEN concat(' c', o_custkey, ' ') END AS q_id",
        "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS source",
        "concat('Account ', o_custkey) AS ship_to",
        "cast(o_custkey AS string) AS ship_to_code",
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the historical master."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS ordinal",
        "CASE WHEN NOT (event_type = 'signup' AND value < 5) THEN concat('C', user_id) END AS q_id",
        "CASE WHEN event_type = 'view' THEN '1-URGENT' WHEN event_type <> 'click' THEN event_type END AS source",
        "CASE WHEN event_type = 'error' THEN 'Not Found' ELSE 'Found' END AS final_status",
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deduplicated accounts; few have an ID, some are pending."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS record_number",
        "o_custkey AS cluster_id",
        "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"
        "     THEN concat('EMUSHCO', lpad(cast(o_custkey * 2 + CAST(o_totalprice > 250000 AS INT) + 1 AS string), 7, '0'))"
        "     WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'pending review'"
        "     WHEN o_orderpriority = '5-LOW' THEN '' END AS final_id",
        "cast(o_custkey AS string) AS ship_to_code",
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users as the second dataset's codes."""
    return table(spark, sf_dir, "events").selectExpr("user_id AS ship_to_number")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with cleaned whole text; ``es`` plays a missing language."""
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        normalise_link_text(F.col("text")).alias("text"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("lang"),
        "source",
        "n_chars",
    )


def is_left() -> Column:
    """Sources 0 to 9 play the first dataset of a linkage."""
    return F.length("source") == 4


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their parts as linked records, the order being the link."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .selectExpr(
            "l_orderkey AS cluster_id",
            "o_totalprice / 500000 AS link_score",
            "l_linenumber AS source_file",
            "l_suppkey AS ordinal",
            "l_partkey AS id",
            "l_extendedprice AS amount",
            "p_name AS name",
            "p_type AS address",
            "p_brand AS city",
            "l_returnflag AS state",
            "CASE WHEN p_size > 5 THEN cast(p_size AS string) END AS zip",
            "concat('Q', l_suppkey) AS q_id",
            "o_orderpriority AS source",
        )
    )


REVIEW_ORDER = ["source_file", "ordinal", "id", "amount"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts with blank, short, long and hyphenated values."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS record_number",
        "CASE WHEN c_acctbal >= 0 THEN c_name END AS name",
        "CASE WHEN c_acctbal > 9000 THEN concat('Unknown ? ', c_custkey)"
        "     WHEN c_mktsegment = 'BUILDING' THEN 'No number'"
        "     ELSE concat(c_nationkey, ' Main/St.') END AS address",
        "CASE WHEN c_acctbal < 0 THEN ''"
        "     WHEN c_mktsegment = 'BUILDING' THEN concat(c_custkey, '-', c_nationkey)"
        "     WHEN c_mktsegment <> 'MACHINERY' THEN cast(c_custkey * 1001 AS string) END AS zip",
        "concat(' ', lower(c_mktsegment), ' ') AS record_type",
    )


def _spelt(number: str) -> str:
    """A name from a number, a letter per digit."""
    return f"initcap(translate(cast(1000 + {number} AS string), '0123456789', 'aeioubdflm'))"


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts: three spellings of a name, moved addresses, missing zips."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        f"concat({_spelt('c_custkey div 3')}, CASE c_custkey % 3 WHEN 0 THEN ' Medical Supply' WHEN 1 THEN ' Medical Suply' ELSE ' Clinic' END) AS name",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN concat(c_custkey, ' Ocean Avenue')"
        "     ELSE concat(100 + c_custkey div 3, CASE WHEN c_acctbal < 2000 THEN ' Main Street' ELSE ' Main St.' END) END AS address",
        "concat('Town ', c_custkey div 30) AS city",
        "concat('S', c_nationkey) AS state",
        "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN cast(c_custkey div 3 AS string) END AS zip",
    )


def crm_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the accounts of the second dataset, at names or addresses of the first."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id",
        f"CASE WHEN s_suppkey % 4 = 3 THEN concat('Other ', {_spelt('s_suppkey * 7')}) ELSE concat({_spelt('s_suppkey')}, ' Medical Supply') END AS name",
        "CASE WHEN s_suppkey % 4 = 2 THEN concat(s_suppkey, ' Hill Road, Rear') ELSE concat(100 + s_suppkey, ' Main Street') END AS address",
        "concat('Town ', s_suppkey div 10) AS city",
        "concat('S', s_nationkey) AS state",
        "CASE WHEN s_suppkey % 5 > 0 THEN cast(s_suppkey AS string) END AS zip",
    )
