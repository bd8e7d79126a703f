"""Readers and writers of plain tables. Text stays text: no types are guessed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_text_csv(spark: SparkSession, paths: str | list[str], columns: list[str], key: str | None = None) -> DataFrame:
    """CSV with a header, every column text, null as ''; rows with a blank `key` dropped; `file_name` and `row_at` order rows
    as the files and their lines do."""
    rows = spark.read.schema(text_schema(columns)).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(paths)
    rows = rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns], F.col("_metadata.file_name").alias("file_name"), F.monotonically_increasing_id().alias("row_at"))
    return rows if key is None else rows.filter(F.col(key) != "")


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The table at `path`, or an empty one where there is none."""
    try:
        return read_text_csv(spark, path, columns)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], text_schema([*columns, "file_name"])).withColumn("row_at", F.lit(0).cast("bigint"))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_csv(df: DataFrame, path: str, order: list | None = None) -> None:
    """CSV with a header; lists are joined by `; `; sorted across files where `order` is given."""
    flat = df.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    (flat.orderBy(*order) if order else flat).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per row, every value text."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Rows added to an append-only log, with the time of the run, so that the last row of a key can be told."""
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
