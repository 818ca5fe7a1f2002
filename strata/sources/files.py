"""Text, CSV and JSON files and stored tables, static and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.fs import SharedFs


def read_text(spark: SparkSession, path: str, line_sep: str = ".") -> DataFrame:
    """Records of text files, cut at a separator of the caller's choice."""
    return spark.read.option("lineSep", line_sep).text(path)


def stream_text(spark: SparkSession, path: str, line_sep: str = ".") -> DataFrame:
    return spark.readStream.option("lineSep", line_sep).text(path)


def read_json_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def query_file(
    spark: SparkSession, path: str, columns: str = "*", kind: str = "json", schema: str | None = None,
) -> DataFrame:
    """SQL straight on a file. With a schema the file is not read a first time to infer one."""
    if schema is None:
        return spark.sql(f"SELECT {columns} FROM {kind}.`{path}`")
    return spark.sql(f"SELECT {columns} FROM {{rows}}", rows=spark.read.schema(schema).format(kind).load(path))


def stream_files(
    spark: SparkSession, kind: str, path: str, schema: str,
    files_per_trigger: int | None = None, clean_source: str = "off", archive_to: str | None = None,
    bytes_per_trigger: str | int | None = None, **options: str,
) -> DataFrame:
    """New files of a folder or glob as a stream with a declared schema.

    A micro-batch takes up to ``files_per_trigger`` files, or up to ``bytes_per_trigger`` (such as ``"10g"``) of them and one at least:
    bytes bound a batch's work where files differ in size.

    ``clean_source`` deletes or archives files once they are processed; the last batch's files
    stay until a later batch completes.
    """
    if clean_source not in ("off", "delete", "archive"):
        raise ValueError(f"clean_source is off, delete or archive, not {clean_source}")
    if (clean_source == "archive") != (archive_to is not None):
        raise ValueError("archive_to goes with clean_source='archive', and only with it")
    if files_per_trigger is not None and bytes_per_trigger is not None:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if clean_source != "off":
        reader = reader.option("cleanSource", clean_source)
    if archive_to is not None:
        reader = reader.option("sourceArchiveDir", archive_to)
    return reader.load(path)


def with_source_file(df: DataFrame, name: str = "InputFile") -> DataFrame:
    """Adds the file each row came from. Apply it directly to a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def with_lineage(df: DataFrame) -> DataFrame:
    """Adds load time and source file. Apply it directly to a file scan."""
    return df.select(
        "*", F.current_timestamp().alias("load_time"), F.col("_metadata.file_path").alias("source_file"))


def with_load_day(df: DataFrame) -> DataFrame:
    """Adds the day of the load time, by which raw tables are partitioned."""
    return df.withColumn("load_day", F.to_date("load_time"))


def stream_loaded(spark: SparkSession, path: str, schema: str, since: str | None = None) -> DataFrame:
    """A raw table that is partitioned by load day as a stream, from a load time on.

    The day is a partition filter, so that the history before it is not opened; the time then cuts its first day.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    if since is None:
        return rows
    start = F.lit(since).cast("timestamp")
    return rows.where((F.col("load_day") >= F.to_date(start)) & (F.col("load_time") >= start))


def stream_csv(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None, bytes_per_trigger: str | int | None = None,
) -> DataFrame:
    """CSV files with a header line, with lineage columns."""
    return with_lineage(stream_files(
        spark, "csv", path, schema, files_per_trigger, bytes_per_trigger=bytes_per_trigger, header="true"))


def stream_json(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None, bytes_per_trigger: str | int | None = None,
) -> DataFrame:
    """JSON-lines files, with lineage columns."""
    return with_lineage(stream_files(spark, "json", path, schema, files_per_trigger, bytes_per_trigger=bytes_per_trigger))


def stream_parquet(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stored Parquet table, be it one file or a folder, as a stream."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if SharedFs(spark, path).is_dir(path):
        return reader.parquet(path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def stream_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table as a stream of appended rows."""
    return spark.readStream.table(table)
