"""python tests/check_oracle.py FOLDER [KEY ...] - compare queries with SQL."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, differences


def main(folder: str, keys: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, failed = connect(folder), oracle_sql(), 0
    for key, build in queries().items():
        if keys and key not in keys:
            continue
        begun = time.time()
        try:
            df = build(spark, folder)
            found = differences(df, connection, oracle[key]) if key in oracle else []
            note = "" if key in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:
            found, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {key:28} {time.time() - begun:6.2f}s {note}", *found)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
