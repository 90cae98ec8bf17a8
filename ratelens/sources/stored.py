"""The stored ``filings`` table: plain parquet with a folder per effective year, changed by Spark's dynamic partition overwrite.

A reader that asks for a range of dates opens the folders of its years only. ``NO_YEAR`` holds rows without a date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.sources.schemas import FILINGS, conform

NO_YEAR = 0
YEAR = "effective_year"
#: Setting, and number, of files that a task may write at once; with more years than that in a task, Spark sorts the rest.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN = 16
#: Rows of a file are sorted by these, so that a filter on states skips row groups.
ORDER = ["State", "Effective_Date", "Record_ID"]


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _files(spark, path)
    return fs.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _files(spark, path)
    fs.delete(folder, True)


def effective_year() -> Column:
    return F.coalesce(F.year("Effective_Date"), F.lit(NO_YEAR)).alias(YEAR)


def read_stored(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The table with its year; an empty one if nothing was stored yet. With ``years`` only their folders are read."""
    schema = T.StructType([*FILINGS.fields, T.StructField(YEAR, T.IntegerType())])
    if not exists(spark, path):
        return spark.createDataFrame([], schema).limit(0)  # known to be empty: joins with it are planned away
    table = spark.read.schema(schema).parquet(path)
    return table if years is None else table.filter(F.col(YEAR).isin(years))


def read_filings(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The stored filings; a range of effective dates limits the folders that are read."""
    table = read_stored(spark, path)
    if first is not None:
        table = table.filter((F.col(YEAR) >= first.year) & (F.col("Effective_Date") >= F.lit(first)))
    if last is not None:
        table = table.filter((F.col(YEAR) <= last.year) & (F.col("Effective_Date") <= F.lit(last)))
    return conform(table)


def packed(rows: DataFrame) -> DataFrameWriter:
    """Writer of parquet files that take less room than Spark's usual ones."""
    return rows.write.option("compression", "zstd")


def laid_out(filings: DataFrame) -> DataFrame:
    """Rows with their year, dealt so that a year of any size is spread over tasks of like size, and sorted inside them."""
    return filings.withColumn(YEAR, effective_year()).hint("rebalance", YEAR).sortWithinPartitions(YEAR, *ORDER)


def replace_years(new: DataFrame, path: str, years: list[int]) -> None:
    """Let the folders of ``years`` hold the rows of ``new``, which has the year; other folders stay as they are.

    Spark writes beside the table and moves finished folders into place; a year that has no rows any more loses its folder. Doing it again
    gives the same, so a replacement that broke off is simply repeated. ``new`` must not be read from ``path``. The rows of ``new`` lie in
    a folder per year, as ``laid_out`` left them, so a task meets few years; with a file open for each they need not be sorted again, which
    would spill them to disk.
    """
    spark = new.sparkSession
    held = {r[0] for r in new.select(YEAR).distinct().collect()}  # a row per year
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(MOST_OPEN))
    try:
        packed(new).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)
    finally:
        spark.conf.set(OPEN_FILES, before)
    for year in set(years) - held:
        delete(spark, f"{path}/{YEAR}={year}")
