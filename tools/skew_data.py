"""Write a skewed copy of a driver data folder: a third of all line items moved to
one order (and that order's customer), the case every plan must survive.

usage: python tools/skew_data.py SRC_DIR DST_DIR
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from marketlens.session import local_session  # noqa: E402
from marketlens.sources.standins import DRIVER_TABLES  # noqa: E402


def main() -> None:
    src, dst = sys.argv[1], sys.argv[2]
    spark = local_session(8, 8)
    for t in DRIVER_TABLES:
        path = f"{src}/{t}.parquet"
        if not os.path.exists(path):
            continue
        df = spark.read.parquet(path)
        if t == "lineitem":
            hot = df.agg(F.min("l_orderkey")).first()[0]
            df = df.withColumn("l_orderkey", F.when(F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0,
                                                    F.lit(hot)).otherwise(F.col("l_orderkey")))
        df.coalesce(1).write.parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
