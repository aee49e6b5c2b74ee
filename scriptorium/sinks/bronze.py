"""Archive of raw records, one folder per run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scriptorium.schemas import BRONZE


def write_bronze(raw: DataFrame, folder: str, ds: str | None = None) -> None:
    """Write raw records as JSON lines, replacing only the dates they carry.

    ``ds`` stamps all rows with one run date; without it the frame brings its
    own ``ds`` column. An empty frame leaves every date as it is.
    """
    if ds is not None:
        raw = raw.withColumn("ds", F.lit(ds))
    (
        raw.select(*BRONZE.fieldNames(), "ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("ds")
        .json(folder)
    )
