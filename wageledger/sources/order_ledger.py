"""A compensation snapshot derived from order tables.

One record per order: the customer is the person, the region the agency, the
line items the pay. Dirt of every kind a real snapshot has (unparsable years,
padded or missing names, bad dates, NULL labels, rates that are not numbers)
is injected by rules over the keys, so that any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.operators.names import anonymize
from wageledger.schemas import RAW_COLUMNS

SALT = "ledger-salt"
US_DATE = "MM/dd/yyyy"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _pay(flag: str, status: Column | None = None) -> Column:
    """Sum in whole cents: exact in any order, and cheaper than decimals."""
    picked = F.col("l_returnflag") == flag
    if status is not None:
        picked = picked & status
    return F.sum(F.when(picked, F.rint(F.col("l_extendedprice") * 100).cast("bigint")))


def _money_text(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)").cast("string")


def order_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot before anonymization: the landed columns with ``Name`` in clear."""
    pay = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            _pay("N").alias("Regular_Pay"),
            _pay("R").alias("Overtime_Pay"),
            _pay("A", F.col("l_linestatus") == "F").alias("Cash_Outs"),
            _pay("A", F.col("l_linestatus") != "F").alias("Retro_Pay"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    # Orders and pay both grow with the data and pay is already partitioned by
    # order, so they are merged by order key at every size.
    orders = (
        table(spark, folder, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(pay.hint("merge"), "o_orderkey", "left")
    )

    year = F.year("o_orderdate").cast("string")
    first_day = F.trunc(F.to_date("o_orderdate"), "year")
    paid = ("Regular_Pay", "Overtime_Pay", "Cash_Outs", "Retro_Pay")
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in paid), F.lit(0).cast("bigint"))

    return orders.select(
        F.when(_every("o_orderkey", 97), F.concat(F.lit("FY"), year)).otherwise(year).alias("Year"),
        F.when(_every("o_custkey", 50), F.lit(None))
        .when(_every("o_custkey", 3), F.concat(F.lit("  "), "c_name", F.lit(" ")))
        .otherwise(F.col("c_name"))
        .alias("Name"),
        F.when(_every("o_orderkey", 89), F.lit(None))
        .when(_every("o_orderkey", 5), F.concat(F.lit(" "), F.lower("r_name")))
        .otherwise(F.col("r_name"))
        .alias("Working_Agency"),
        F.date_format(F.date_sub(first_day, F.when(F.col("o_custkey") % 2 == 1, 365).otherwise(0)), US_DATE).alias(
            "Start_Date"
        ),
        F.when(_every("o_orderkey", 83), F.lit("13/45/2025"))
        .when(F.col("o_orderstatus") == "F", F.date_format("last_ship", US_DATE))
        .alias("Separation_Date"),
        F.col("c_mktsegment").alias("Title"),
        F.col("n_name").alias("Department"),
        F.when(~_every("o_orderkey", 7), F.col("o_orderpriority")).alias("Pay_Basis"),
        F.when(_every("o_orderkey", 79), F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("Hourly_Rate"),
        *[_money_text(F.col(c)).alias(c) for c in paid],
        F.lit("0.00").alias("Other_Pay"),
        _money_text(total).alias("Total_Earnings"),
        F.date_format("o_orderdate", US_DATE).alias("Updated_At"),
        F.col("o_orderkey").alias("record_id"),
    )


def order_raw(spark: SparkSession, folder: str, salt: str = SALT) -> DataFrame:
    """The raw table shape: hashed names, source file and ingestion time.

    Records land in four files, one a day. A feed that lost the name hash is
    included (NULL ``name_hash``), since the raw table has to be checked for it.
    """
    shipment = F.col("record_id") % 4
    hashed = anonymize(order_snapshot(spark, folder), salt)
    return (
        hashed.withColumn("name_hash", F.when(~_every("record_id", 101), F.col("name_hash")))
        .withColumn("raw_ingested_at", F.date_add(F.lit("2025-01-01").cast("date"), shipment.cast("int")).cast("timestamp"))
        .withColumn("source_file", F.concat(F.lit("payroll_"), shipment.cast("string"), F.lit(".csv")))
        .select(*RAW_COLUMNS, "raw_ingested_at", "source_file", "record_id")
    )
