"""Inputs the checks derive from the test tables with Spark (FIXTURES.md §3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.operators.mapping import ColumnMap

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ORDERS_MAPPING = [
    ColumnMap("o_orderkey", "order_no", "STRING"),
    ColumnMap("o_totalprice", "amount", "NUMBER"),
    ColumnMap("o_orderdate", "order_date", "DATE"),
    ColumnMap("o_orderpriority", "priority", "STRING"),
    ColumnMap("o_orderstatus", "status", "TEXTISH"),
]

CUSTOMER_MAPPING = [
    ColumnMap("c_custkey", "customer_no", "STRING"),
    ColumnMap("c_name", "name", "STRING"),
    ColumnMap("c_acctbal", "balance", "NUMBER"),
    ColumnMap("c_mktsegment", "segment", "TEXTISH"),
]

EXPORT_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names or TABLES:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def _export_text(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus"),
        F.format_number("o_totalprice", 2).alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        F.when(k % 7 == 0, F.lit("NA")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def orders_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a dirty CSV export: text cells, ``1,234.50`` amounts, ``NA`` priorities, repeated rows."""
    o = table(spark, sf_dir, "orders")
    return _export_text(o).unionByName(_export_text(o.filter(F.col("o_orderkey") % 10 == 0)))


def mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows derived from nation/region: one document per region, one entry per nation."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    types = F.array(*[F.lit(t) for t in ("STRING", "NUMBER", "DATE", "BOOLEAN", "OTHER")])
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("tbl_"), F.lower("r_name")).alias("target_table"),
        F.col("r_regionkey").cast("string").alias("view_id"),
        F.col("r_name").alias("source_table"),
        F.col("n_nationkey").alias("position"),
        F.col("n_name").alias("source_key"),
        F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))).alias("destination_key"),
        F.element_at(types, (F.col("n_regionkey") % 5) + 1).alias("data_type"),
    )


def _entry(src: str, dst: str, typ: str) -> Column:
    return F.struct(F.lit(src).alias("source_key"), F.lit(dst).alias("destination_key"), F.lit(typ).alias("data_type"))


def jobs_frame(spark: SparkSession, sf_dir: str, run: str = "") -> DataFrame:
    """Job registry: one job per nation syncing that nation's customers; status by key % 3. ``run`` ends the target names."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        k.cast("string").alias("job_id"),
        F.lit("customer").alias("source_table"),
        F.concat(F.lit("select * from customer where c_nationkey = "), k.cast("string")).alias("source_sql"),
        F.concat(F.lit("cust_nation_"), k.cast("string"), F.lit(run)).alias("target_table"),
        F.array(*[_entry(m.source_key, m.destination_key, m.data_type) for m in CUSTOMER_MAPPING]).alias(
            "column_mapping"),
        F.when(k % 3 == 0, F.lit("PENDING")).when(k % 3 == 1, F.lit("PASS")).otherwise(F.lit("FAILED")).alias("status"),
        F.lit(None).cast("string").alias("message"),
        F.lit(0).cast("bigint").alias("updated_at"),
    )


def shared_jobs_frame(spark: SparkSession, sf_dir: str, run: str = "") -> DataFrame:
    """The same jobs, all pending, as criteria on one source table; one of them names a column that there is not."""
    k = F.col("job_id").cast("int")
    where = F.when(k == 7, F.lit("no_such_column = 1")).otherwise(F.concat(F.lit("c_nationkey = "), F.col("job_id")))
    return jobs_frame(spark, sf_dir, run).withColumns({"source_sql": F.lit(None).cast("string"), "status": F.lit("PENDING"),
                                                       "source_where": where})
