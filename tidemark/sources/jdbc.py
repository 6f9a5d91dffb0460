"""Database tables through JDBC; address and credentials come from the caller's options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 32,
) -> DataFrame:
    """A whole table, read in ``partitions`` parallel ranges of ``partition_column`` within ``bounds``.

    Without both the whole table would be one task, so they are required; one partition is asked
    for by ``partitions=1``.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partitions > 1:
        if not partition_column or bounds is None:
            raise ValueError("name a partition column and its bounds, or ask for one partition")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    return reader.load()


def append_jdbc(df: DataFrame, table: str, options: Mapping[str, str], writers: int = 16) -> None:
    """Append rows with a bounded number of connections; what is before the write stays parallel."""
    df.repartition(writers).write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
