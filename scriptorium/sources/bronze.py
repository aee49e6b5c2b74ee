"""Raw JSON records per run date, in two layouts.

``landed``: one file per run date holding one JSON array, as a fetcher drops
it. ``lake``: JSON lines under ``ds=<run date>`` folders, as ``write_bronze``
stores it; files split across tasks and dates prune.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scriptorium.schemas import BRONZE

# The run date in a landed file's name or in a lake folder's.
RUN_DATE = r"(?:/arxiv_papers_|/ds=)(\d{4}-\d{2}-\d{2})(?:\.json$|/)"

# Where a raw record stood: the stated order for "keep the first".
ORIGIN = T.StructType(
    [
        T.StructField("ds", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_row", T.LongType()),
    ]
)
BRONZE_ORDER = ("ds", "source_file", "source_row")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on its file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def empty_bronze(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType(BRONZE.fields + ORIGIN.fields))


def _in_range(df: DataFrame, ds: Column, start_ds: str | None, end_ds: str | None) -> DataFrame:
    if start_ds is not None:
        df = df.filter(ds >= start_ds)
    if end_ds is not None:
        df = df.filter(ds <= end_ds)
    return df


def with_origin(df: DataFrame, ds: Column) -> DataFrame:
    """Add ``ORIGIN``. A file is read front to back, so within one file the
    row number rises in file order."""
    return df.select(
        *BRONZE.fieldNames(),
        ds.cast("string").alias("ds"),
        F.col("_metadata.file_path").alias("source_file"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def run_date() -> Column:
    """The run date of the file a row comes from."""
    return F.regexp_extract(F.col("_metadata.file_path"), RUN_DATE, 1)


def read_landed(
    spark: SparkSession, folder: str, start_ds: str | None = None, end_ds: str | None = None
) -> DataFrame:
    """Array files of the given run dates; an absent date gives no rows. The
    dates are tested on the file's path, below the row numbers, so that files
    of other dates are left out before any is read."""
    pattern = f"{folder.rstrip('/')}/arxiv_papers_*.json"
    if not path_exists(spark, pattern):
        return empty_bronze(spark)
    raw = spark.read.schema(BRONZE).option("multiLine", True).json(pattern)
    return with_origin(_in_range(raw, run_date(), start_ds, end_ds), run_date())


def read_bronze(
    spark: SparkSession, folder: str, start_ds: str | None = None, end_ds: str | None = None
) -> DataFrame:
    """JSON lines of the given run dates; other dates' folders are not read."""
    if not path_exists(spark, f"{folder.rstrip('/')}/ds=*"):
        return empty_bronze(spark)
    schema = T.StructType(BRONZE.fields + [T.StructField("ds", T.StringType())])
    raw = spark.read.schema(schema).json(folder)
    return with_origin(_in_range(raw, F.col("ds"), start_ds, end_ds), F.col("ds"))
