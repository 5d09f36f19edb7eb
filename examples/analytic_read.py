"""Analytic read of a published cube with partition pruning.

    python examples/analytic_read.py LAKE PRODUCT_ID "GEO = 'Yukon' AND year = 2010"

Conditions on stored columns go to the parquet scan (PushedFilters), those on
the year prune folders (PartitionFilters).
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cubelake import get_spark
from cubelake.sources.lake import register_cube


def main(lake: str, product_id: int, condition: str) -> None:
    spark = get_spark()
    register_cube(spark, lake, product_id, "cube")
    df = spark.table("cube").where(condition)
    df.explain("formatted")
    df.show(20, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
