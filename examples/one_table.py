"""One-shot read of full tables from landed download envelopes and zips.

    python examples/one_table.py ENVELOPES ZIPS OUT

Envelopes whose status is not SUCCESS are skipped; the matching archives are
unpacked by one distributed job and their CSVs read with plain inference.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from cubelake import get_spark, scratch_dir
from cubelake.sources.archives import read_envelopes, unzip_to_landing


def main(envelopes: str, zips: str, out: str) -> None:
    spark = get_spark()
    ready = [r.product_id for r in read_envelopes(spark, envelopes).where("ok").collect()]
    landing = f"{scratch_dir(spark, 'one-table')}/landing"
    unzip_to_landing(spark, zips, landing, rule="digits", only=ready).collect()
    df = (
        spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(landing)
        .withColumn("product_id", F.regexp_replace(F.col("_metadata.file_name"), "[^0-9]", "").cast("bigint"))
    )
    df.write.mode("overwrite").partitionBy("product_id").parquet(out)


if __name__ == "__main__":
    main(*sys.argv[1:4])
