"""Which objects have landed under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.sources.bronze import path_exists

PDF_KEY = r"/arxiv_pdfs/(.+)\.pdf$"  # fixed value


def object_inventory(
    spark: SparkSession, folder: str, key_pattern: str = PDF_KEY, glob: str = "*.pdf"
) -> DataFrame:
    """(arxiv_id, path, length). Contents are pruned from the scan, so objects
    are listed but not opened."""
    if not path_exists(spark, f"{folder.rstrip('/')}/{glob}"):
        return spark.createDataFrame([], "arxiv_id string, path string, length bigint")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )
    return keyed(files, key_pattern)


def keyed(files: DataFrame, key_pattern: str = PDF_KEY) -> DataFrame:
    key = F.regexp_extract("path", key_pattern, 1)
    return files.withColumn("arxiv_id", key).filter(F.col("arxiv_id") != "").select(
        "arxiv_id", "path", "length"
    )
