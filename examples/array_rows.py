"""Array-of-arrays JSON responses (row 0 = names) as a table.

    python examples/array_rows.py RESPONSES_DIR
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cubelake import get_spark
from cubelake.sources.json_rows import read_json_rows


def main(path: str) -> None:
    spark = get_spark()
    read_json_rows(spark, path).show(20, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1])
