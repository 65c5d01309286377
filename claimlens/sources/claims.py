"""Reading claims: a table with the explicit schema, or the claims view over the
star-schema test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.schema import CLAIMS_SCHEMA
from claimlens.sources.storage import stage

# unique row key of the view; used to break ties wherever rows are ordered
VIEW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
DAY_ZERO = "1995-01-01"
# Customers that are still broadcast to the lines; more of them meet the orders, which are fewer and narrower.
FEW_CUSTOMERS = 500_000


def ingest(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CLAIMS_SCHEMA,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Raw claims with a declared schema (nothing is inferred)."""
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


REJECTS_SCHEMA = "reason string, record string, file string"


def ingest_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CLAIMS_SCHEMA,
    fmt: str = "csv",
    required: Sequence[str] = ("Claim",),
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with the declared schema, and rejected ones as ``reason, record, file``.

    A record is ``malformed`` if it has another number of fields or a value of another type, or cannot be
    parsed at all; one without a value in a ``required`` column is ``missing <column>`` (the first of
    them).  Every record is in exactly one of the two tables.  The source is read once: both come from
    one written table.  CSV and JSON keep a malformed record's text; other formats have types of
    their own and are only checked for missing values.
    """
    raw, origin = "input record", "input file"
    names = [f.name for f in schema.fields]
    if fmt in ("csv", "json"):
        wide = T.StructType([*schema.fields, T.StructField(raw, T.StringType())])
        reader = spark.read.schema(wide).format(fmt)
        read = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=raw, **options).load(path)
    else:
        read = ingest(spark, path, schema, fmt, **options).withColumn(raw, F.lit(None).cast("string"))
    reason = F.when(F.col(raw).isNotNull(), "malformed")
    for c in required:
        reason = reason.when(F.col(c).isNull(), f"missing {c}")
    kept = stage(read.withColumns({origin: F.input_file_name(), "input fault": reason}), "checked-claims")
    bad = kept.filter(F.col("input fault").isNotNull())
    record = F.coalesce(F.col(raw), F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
    rejected = bad.select(F.col("input fault").alias("reason"), record.alias("record"), F.col(origin).alias("file"))
    return kept.filter(F.col("input fault").isNull()).select(*[F.col(f"`{c}`") for c in names]), rejected


def claims_view(
    spark: SparkSession, data_dir: str, first_year: int | None = None
) -> DataFrame:
    """Claims derived from lineitem, orders, customer and part (see ``joined_sources``)."""
    return claims_of(joined_sources(spark, data_dir, first_year))


def joined_sources(
    spark: SparkSession, data_dir: str, first_year: int | None = None
) -> DataFrame:
    """The key, ``Claim`` and the source columns of every claim; ``claims_of`` makes the others from them row by
    row, so what is shuffled and written meanwhile is only these.

    Each dimension key is unique, so every join keeps the lineitem grain.  With
    ``first_year`` the accident-year bound is also stated on the source dates, where
    the Parquet scans can use it (the derived ``AccYear`` cannot be pushed down);
    reports never precede accidents, so the same date bounds the ship date.
    """

    def table(name: str, *cols: str) -> DataFrame:
        return spark.read.parquet(f"{data_dir}/{name}.parquet").select(*cols)

    lines = table(
        "lineitem",
        *VIEW_KEY,
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_linestatus",
        "l_shipdate",
    )
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    if first_year is not None:
        start = F.lit(f"{first_year}-01-01").cast("timestamp")
        lines = lines.filter(F.col("l_shipdate") >= start)
        orders = orders.filter(F.col("o_orderdate") >= start)
    customers = table("customer", "c_custkey", "c_acctbal")
    parts = table("part", "p_partkey", "p_size")

    of_customer = F.col("o_custkey") == F.col("c_custkey")
    many_customers = customers.count() > FEW_CUSTOMERS  # from the files' footers
    if many_customers:
        orders = orders.join(customers, of_customer)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).filter(
        F.col("l_shipdate") >= F.col("o_orderdate")
    )
    if not many_customers:
        joined = joined.join(customers, of_customer)
    return (
        joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("o_orderkey", "o_custkey", "c_custkey", "p_partkey")
        .withColumn("l_extendedprice", F.col("l_extendedprice").cast(CLAIMS_SCHEMA["Claim"].dataType))
        .withColumnRenamed("l_extendedprice", "Claim")
    )


def claims_of(joined: DataFrame, *more: str) -> DataFrame:
    """The key and the claims' columns from joined sources, and ``more`` columns of theirs."""
    accident_day = F.datediff("o_orderdate", F.lit(DAY_ZERO).cast("date"))
    report_day = F.datediff("l_shipdate", F.lit(DAY_ZERO).cast("date"))
    expressions = {
        "Claim": F.col("Claim"),
        "Age": F.col("p_size") * 2,
        "Gender": F.col("l_linestatus"),
        "MaritalStatus": F.col("o_orderstatus"),
        "PartTimeFullTime": F.when(F.col("l_tax") >= 0.04, "F").otherwise("P"),
        "DependentChildren": F.col("l_linenumber") - 1,
        "DependentsOther": F.col("l_suppkey") % 3,
        "WeeklyPay": F.abs("c_acctbal") / 5,
        "HoursWorkedPerWeek": F.col("l_quantity") * 2 - 10,
        "DaysWorkedPerWeek": F.col("l_partkey") % 7 + 1,
        "AccYear": F.year("o_orderdate"),
        "AccMonth": F.month("o_orderdate"),
        "AccWeekday": F.weekday("o_orderdate") + 1,
        "AccTime": F.col("l_suppkey") % 24,
        "AccDay": accident_day,
        "RepDay": report_day,
        "RepYear": F.year("l_shipdate"),
        "RepDelay": report_day - accident_day,
    }
    typed = [
        expressions[field.name].cast(field.dataType).alias(field.name)
        for field in CLAIMS_SCHEMA.fields
    ]
    return joined.select(*VIEW_KEY, *typed, *more)
