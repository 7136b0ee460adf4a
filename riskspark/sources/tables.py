"""Reading, writing and the logical tables the library works on.

``load`` reads one stored table. The functions below it bind the stored tables
to the logical ones (transactions, alerts, accounts, links ...). All of them are
lazy and column-pruned; none of them asks for a broadcast - dimension tables are
broadcast by Spark itself when their size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

ALERT_PRIORITY = "1-URGENT"
HISTORY_PRIORITY = "2-HIGH"
CUSTOMER_ALERT_PRIORITY = "3-MEDIUM"
# result code -> the results that mean it; anything else is unlabelled
ALERT_LABELS = {1: ["F"], 0: ["O"]}
HIGH_RISK_REGION = 0


def load(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet",
         schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a named table; pass a schema for csv / json so nothing is inferred."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{sf_dir}/{name}.{fmt}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed output table in the schema's column order; absent columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def save(df: DataFrame, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
         mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    out = conform(df, schema) if schema is not None else df
    writer = out.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def account_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"))


def transactions(spark: SparkSession, sf_dir: str, owners: DataFrame | None = None) -> DataFrame:
    """``owners``: ``account_owners`` with further columns, which come along."""
    items = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("account"),
        F.col("l_suppkey").alias("opp_party"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
        money("l_extendedprice").alias("amount"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("category"),
        F.when(F.col("l_linestatus") == "O", "incoming-all").otherwise("outgoing-all").alias("direction"),
    )
    return items.join(account_owners(spark, sf_dir) if owners is None else owners, "account")


def last_transaction_date(spark: SparkSession, sf_dir: str) -> Column:
    """Date of the last transaction of anyone: one column of one table, no join."""
    return load(spark, sf_dir, "lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).scalar()


def _alert_rows(spark: SparkSession, sf_dir: str, priority: str) -> DataFrame:
    return (
        load(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == priority)
        .select(
            F.col("o_orderkey").alias("alert_id"),
            F.col("o_custkey").alias("party"),
            F.col("o_orderdate").cast("date").alias("alert_date"),
            F.col("o_orderstatus").alias("result"),
        )
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(spark, sf_dir, ALERT_PRIORITY)


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(spark, sf_dir, HISTORY_PRIORITY)


def customer_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past alerts from reviews of customers."""
    return _alert_rows(spark, sf_dir, CUSTOMER_ALERT_PRIORITY)


def reference_points(alert_df: DataFrame) -> DataFrame:
    """Distinct (party, ref_date). Features are made per point, not per alert, so a party
    with very many alerts costs at most one row per calendar day."""
    return alert_df.select("party", F.col("alert_date").alias("ref_date")).distinct()


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("party"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"), money("c_acctbal").alias("balance"),
            F.col("c_nationkey").alias("nation"), F.col("n_name").alias("country"),
            F.col("n_regionkey").alias("region_key"), F.col("r_name").alias("region"),
        )
    )


def counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    return (
        load(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("opp_party"), F.col("s_name").alias("opp_name"),
            F.col("s_nationkey").alias("opp_nation"), F.col("n_name").alias("opp_country"),
            F.col("n_regionkey").alias("opp_region"), money("s_acctbal").alias("opp_balance"),
        )
    )


def high_risk_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (load(spark, sf_dir, "nation").filter(F.col("n_regionkey") == HIGH_RISK_REGION)
            .select(F.col("n_nationkey").alias("opp_nation")))


def high_risk_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (load(spark, sf_dir, "supplier").filter(money("s_acctbal") < 0)
            .select(F.col("s_suppkey").alias("opp_party")))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = (load(spark, sf_dir, "lineitem")
              .groupBy(F.col("l_orderkey").alias("account"))
              .agg(F.max(F.col("l_shipdate").cast("date")).alias("closed_date")))
    return (
        load(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"),
            F.col("o_orderdate").cast("date").alias("open_date"),
            F.col("o_orderpriority").alias("account_type"),
            F.col("o_orderstatus").alias("account_unit"),
        )
        .join(closed, "account", "left")
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party-to-party links: each order ties its customer to a near-by customer key."""
    known = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("linked_party"))
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("link_id"),
        F.col("o_custkey").alias("party"),
        (F.col("o_custkey") + 1 + F.col("o_orderkey") % 3).alias("linked_party"),
        F.col("o_orderpriority").alias("relation"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), 720)).alias("end_date"),
    )
    return rows.join(known, "linked_party", "left_semi")


def high_risk_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals of high-risk parties: one per 5-LOW order, open-ended while pending."""
    return (
        load(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "5-LOW")
        .select(
            F.col("o_custkey").alias("party"), F.col("o_orderkey").alias("interval_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.when(F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), 365)).alias("expiry_date"),
        )
    )


def scored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled alerts with a model score in [0, 1]."""
    return (
        load(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
        .select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("party"),
            F.col("o_orderpriority").alias("segment"), F.col("o_orderdate").cast("date").alias("run_date"),
            F.round(F.col("o_totalprice") / 600000.0, 4).alias("score"),
            F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        )
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels")
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "source", "lang",
        F.round(F.col("n_chars") / (F.col("n_chars") + 1000.0), 6).alias("score"),
        F.col("quality").alias("label"), "toxic",
    )
