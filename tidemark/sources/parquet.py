"""Parquet folders: one schema for mixed files, repair and rewrite, provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` by name and type; missing ones become null, others are dropped."""
    present = {c.lower(): c for c in df.columns}
    columns = []
    for field in schema:
        source = present.get(field.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def read_parquet_folder(
    spark: SparkSession, paths: str | Sequence[str], golden: str | StructType | None = None
) -> DataFrame:
    """Read one or more folders whose files disagree on column types.

    ``golden`` is a file (or a schema) that sets names and types; without it the first file
    does. A plain read with that schema fails where a file stores long and the schema says
    double. Files are therefore grouped by their footer schema, each group is read with its
    own schema and cast, and the groups are united. Only footers are read on the driver; the
    number of scans is the number of different schemas. Partition values in a folder's paths
    (``key=value``) are columns like those in the files.
    """
    folders = [paths] if isinstance(paths, str) else list(paths)
    files = [(folder, file) for folder in folders for file in sorted(spark.read.parquet(folder).inputFiles())]
    if not files:
        raise ValueError(f"no parquet files under {folders}")

    def within(folder: str) -> DataFrameReader:
        # a folder given by a pattern, or a single file, has no partition values above its files
        plain = not any(c in folder for c in "*?[{") and not folder.endswith(".parquet")
        return spark.read.option("basePath", folder) if plain else spark.read

    if isinstance(golden, StructType):
        schema = golden
    elif golden:
        schema = spark.read.parquet(golden).schema
    else:
        schema = within(files[0][0]).parquet(files[0][1]).schema
    groups: dict[tuple[str, str], list[str]] = {}
    for folder, file in files:
        groups.setdefault((folder, within(folder).parquet(file).schema.json()), []).append(file)
    out: DataFrame | None = None
    for (folder, _), members in groups.items():
        part = conform(within(folder).parquet(*members), schema)
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out


def repair_and_rewrite(
    spark: SparkSession, source: str, target: str, casts: dict[str, str], file_bytes: int | None = None
) -> DataFrame:
    """Cast columns and write the folder anew; ``file_bytes`` compacts it to files of about that size.

    The target must differ from the source, which is still being read while the target is
    written. Fewer files come from a repartition, so that the reading and casting before it
    keep their own parallelism.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("cannot overwrite the folder that is being read")
    repaired = spark.read.parquet(source)
    for column, kind in casts.items():
        repaired = repaired.withColumn(column, F.col(column).cast(kind))
    if file_bytes:
        at = spark._jvm.org.apache.hadoop.fs.Path(source)
        size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
        repaired = repaired.repartition(max(1, -(-size // file_bytes)))
    repaired.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_with_provenance(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder with the path each row came from (``file_path``)."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Write part files; appending adds new uniquely named ones, ``overwrite`` replaces all."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
