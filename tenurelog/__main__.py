"""Daily run: ``spark-submit``-able entry that refreshes all layers.

    python -m tenurelog --landing DIR --root DIR --load-date 2024-02-01
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from .plans import Warehouse
from .sources.landing import LAYOUTS
from .sources.table import BUCKETS


def main() -> None:
    parser = argparse.ArgumentParser(prog="tenurelog")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--root", required=True, help="folder of the raw, refined and curated layers")
    parser.add_argument("--load-date", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, help="last day of the headcount, default today")
    parser.add_argument("--layout", choices=LAYOUTS, default=LAYOUTS[0])
    parser.add_argument("--max-days", type=int, help="longest calendar, default no limit")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="of tables that do not exist yet")
    parser.add_argument("--purge", action="store_true", help="delete landed files once their records are in RAW")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tenurelog").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    result = Warehouse(spark, args.root, args.buckets).refresh(
        args.landing, args.load_date, args.as_of, layout=args.layout, max_days=args.max_days, purge=args.purge
    )
    for load in result.loads:
        print(f"{load.entity}: {load.files} files, {load.records} records, {load.bad_records} set aside")


if __name__ == "__main__":
    main()
