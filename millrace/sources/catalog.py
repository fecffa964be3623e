"""Tables of the session's catalog and their metadata, and counted delivery. Survey ids S12, K10-K12, A17, J7, F19, Q14."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: The table property that keeps the columns rows are sorted by; Parquet tables have no such clause.
SORT_KEYS = "sort_keys"


@dataclass(frozen=True)
class Definition:
    """``columns``: name and type in DDL, partition columns last."""

    columns: str
    partition: Sequence[str] = ()
    order: Sequence[str] = ()


def create_tables(spark: SparkSession, database: str, tables: Mapping[str, Definition], location: str | None = None) -> None:
    """The database and its tables, where they are missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))
    for name, d in tables.items():
        partition = f" PARTITIONED BY ({', '.join(d.partition)})" if d.partition else ""
        order = f" TBLPROPERTIES ('{SORT_KEYS}' = '{','.join(d.order)}')"
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({d.columns}) USING parquet{partition}{order}")


def load_table(rows: DataFrame, database: str, name: str, definition: Definition) -> DataFrame:
    """Appends rows in the table's layout and returns the table.

    Rows are dealt by ranges of partition and sort columns, so that a partition with most of the rows is written by many tasks.
    """
    spark, table = rows.sparkSession, f"`{database}`.`{name}`"
    rows = rows.select(*spark.table(table).columns)
    if keys := [*definition.partition, *definition.order]:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.mode("append").insertInto(table)
    return spark.table(table)


def metadata(spark: SparkSession, database: str) -> DataFrame:
    """A row per column: table_name, position, column_name, type, is_partition, sort_keys. The catalog alone is read."""
    found = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        named = f"`{database}`.`{table.name}`"
        properties = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {named}").collect()}
        for i, c in enumerate(spark.catalog.listColumns(named)):
            found.append((table.name, i, c.name, c.dataType, c.isPartition, properties.get(SORT_KEYS, "")))
    return spark.createDataFrame(
        found, "table_name string, position int, column_name string, type string, is_partition boolean, sort_keys string"
    )


def table_summary(columns: DataFrame) -> DataFrame:
    """A row per table of :func:`metadata`: number of columns and of partition columns, sort keys, and the columns by name."""
    named = F.concat_ws(":", "column_name", "type")
    return columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("columns"), F.count_if("is_partition").alias("partition_columns"),
        F.any_value("sort_keys").alias("sort_keys"), F.array_join(F.array_sort(F.collect_list(named)), ",").alias("column_list"),
    )


def definition_differences(columns: DataFrame, expected: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """(table_name, column_name, problem) where :func:`metadata` is not as (table, column, type, is_partition) say."""
    tuples = F.array(*[F.struct(*[F.lit(x).alias(f"_{i}") for i, x in enumerate(e)]) for e in expected])
    want = columns.sparkSession.range(1).select(F.inline(tuples))
    joined = columns.join(want, (F.col("table_name") == F.col("_0")) & (F.col("column_name") == F.col("_1")), "full_outer")
    problem = (
        F.when(F.col("column_name").isNull(), F.lit("missing")).when(F.col("_1").isNull(), F.lit("unexpected"))
        .when(F.col("type") != F.col("_2"), F.concat(F.lit("type "), "type", F.lit(", expected "), "_2"))
        .when(F.col("is_partition") != F.col("_3"), F.lit("partition column or not"))
    )
    names = F.coalesce("table_name", "_0").alias("table_name"), F.coalesce("column_name", "_1").alias("column_name")
    return joined.select(*names, problem.alias("problem")).filter("problem is not null")


def deliver(records: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Writes (key, value) records and says what was delivered: records, keyless, bytes of values.

    Counted while they are written, without a second pass. A write that fails raises and counts nothing.
    """
    seen = Observation("delivery")
    write(records.observe(
        seen, F.count(F.lit(1)).alias("records"), F.count_if(F.col("key").isNull()).alias("keyless"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
    ))
    return seen.get


def to_kafka(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """A write for :func:`deliver`: acknowledged by all replicas, idempotent. Needs the Kafka connector."""

    def write(records: DataFrame) -> None:
        sink = records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        sink.option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save()

    return write
