"""What the text operators share: row identity that survives null and repeated ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two 64-bit columns that tell rows apart by id and text.

    Rows that agree in both are interchangeable for every operator, so a repeated row needs no identity of its own; null
    ids and null texts hash like a value of their own.
    """
    null_text = F.col(text_col).isNull()
    return [
        F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.lit("id")).alias("_k1"),
        F.xxhash64(F.col(text_col), null_text, F.col(id_col)).alias("_k2"),
    ]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_per_key(keyed: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """One of the rows of each key. ``counts`` has the keys and ``_rows``; only rows of repeated keys are shuffled."""
    repeated = counts.filter("_rows > 1").select(*keys)
    if not repeated.head(1):
        return keyed
    rest = keyed.join(repeated, keys, "left_anti")
    return rest.unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))


def merged_spans(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the union of its spans [a, b) as a sorted list of disjoint ones; spans that touch are one."""
    rows = rows.groupBy(*keys, "a").agg(F.max("b").alias("b"))
    along = Window.partitionBy(*keys).orderBy("a")
    upto = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", (upto.isNull() | (F.col("a") > upto)).cast("int"))
    whole = rows.withColumn("_span", F.sum("_new").over(along)).groupBy(*keys, "_span")
    whole = whole.agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return whole.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
