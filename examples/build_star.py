"""Build the immigration / temperature star from raw files and print its reports.

    python examples/build_star.py --immigration <parquet dir> --temperature <csv> \
        --demographics <csv, ';'> --airport <csv> --labels <label file> --out <base path>

Sources are read as in the original layout: immigration as parquet, the
three others as header CSV with every column as text (demographics with ';').
The five tables are written under --out (rejected rows under --out/_rejects);
the load, row-count, completeness and reject reports are printed.  --out
should be a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stellate.plans.star import build_warehouse  # noqa: E402
from stellate.session import build_session  # noqa: E402
from stellate.sources.csv import read_csv_strings  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--immigration", required=True)
    ap.add_argument("--temperature", required=True)
    ap.add_argument("--demographics", required=True)
    ap.add_argument("--airport", required=True)
    ap.add_argument("--labels", required=True, nargs="+")
    ap.add_argument("--out", required=True)
    ap.add_argument("--state-default", default=None, help="label for state codes not in the list")
    ap.add_argument("--sample-rows", type=int, default=None, help="write only the first rows of each table")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name="stellate-build-star")
    reports = build_warehouse(
        spark,
        spark.read.parquet(args.immigration),
        read_csv_strings(spark, args.temperature),
        read_csv_strings(spark, args.demographics, sep=";"),
        read_csv_strings(spark, args.airport),
        args.labels,
        args.out,
        state_default=args.state_default,
        sample_rows=args.sample_rows,
    )
    for name, df in reports.items():
        print(f"== {name}")
        df.orderBy(*df.columns[:2]).show(truncate=False)


if __name__ == "__main__":
    main()
