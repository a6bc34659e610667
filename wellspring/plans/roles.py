"""The driver's tables in the roles of a screen: line items are cells, parts constructs, brands genes, flags plates and wells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = ["q", "price", "disc", "tax"]
KEYS = ["l_orderkey", "construct", "l_suppkey", "l_linenumber"]
BATCH = ["plate", "well"]

#: The same rows for the SQL side.
CELLS_SQL = """cells AS (
  SELECT l_orderkey, l_partkey AS construct, l_suppkey, l_linenumber, l_returnflag AS plate, l_linestatus AS well,
         l_shipdate, p_brand AS gene, l_quantity AS q, l_extendedprice AS price, l_discount AS disc, l_tax AS tax
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cells(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select(F.col("p_partkey").alias("construct"), F.col("p_brand").alias("gene"))
    line = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("construct"), "l_suppkey", "l_linenumber", F.col("l_returnflag").alias("plate"), F.col("l_linestatus").alias("well"),
        "l_shipdate", F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
    )
    return line.join(part, "construct")


def control(gene: str = "gene") -> Column:
    return F.coalesce(F.col(gene).startswith("Brand#1"), F.lit(False))


def rounded(df: DataFrame, digits: int = 4, columns: list[str] | None = None) -> DataFrame:
    """Floating results rounded: engines differ in the last bits of sums."""
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double" and (columns is None or c in columns)})
