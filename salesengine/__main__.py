"""Command line: run the batch job and print its summary as one JSON line.

    python -m salesengine --raw DIR_OR_FILE --out DIR [--generate N]
    spark-submit --py-files salesengine.zip -m salesengine ...   (on a cluster)

``--generate N`` first writes N synthetic rows as CSV to ``--raw`` (G1, S2).
The job then reads the CSV files, cleans them, writes the fact table and the
summary tables under ``--out``, and prints the data-quality counters and the
run summary (P1). Only those two one-row results reach the driver.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators.generate import generate_sales
from .operators.summaries import run_summary
from .plans.pipeline import run
from .plans.refresh import refresh
from .sources.csv import write_csv


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="salesengine")
    ap.add_argument("--raw", required=True, help="raw CSV file or folder")
    ap.add_argument("--out", required=True, help="output folder for the tables")
    ap.add_argument("--generate", type=int, default=0, help="first write N synthetic rows to --raw")
    ap.add_argument("--no-quality", action="store_true", help="skip the data-quality counters")
    ap.add_argument("--multi-line", action="store_true", help="read line breaks inside quoted fields")
    ap.add_argument("--quoted-breaks", action="store_true", help="the same, with all splits of a file read in parallel")
    ap.add_argument("--quarantine", action="store_true", help="write broken records apart and count what reading loses")
    ap.add_argument("--versioned", action="store_true", help="replace the tables of an earlier run as one")
    ap.add_argument("--refresh", action="store_true", help="add the raw files to the current version instead of replacing it")
    ap.add_argument("--jdbc-url", help="also load the fact table and the summaries into this database")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("salesengine").getOrCreate()
    if args.generate:
        write_csv(generate_sales(spark, args.generate), args.raw)
    if args.refresh:
        res = refresh(spark, args.out, args.raw, multi_line=args.multi_line, quoted_breaks=args.quoted_breaks)
    else:
        res = run(spark, args.raw, args.out, quality=not args.no_quality, multi_line=args.multi_line, jdbc_url=args.jdbc_url,
                  quoted_breaks=args.quoted_breaks, quarantine=args.quarantine, versioned=args.versioned)
    out = {"sales": res.sales_path, "summaries": res.summary_paths}
    if res.quality is not None:
        out["quality"] = res.quality.collect()[0].asDict()
    if res.losses is not None:
        out["losses"] = [r.asDict() for r in res.losses.collect()]
    out["summary"] = run_summary(res.sales).collect()[0].asDict()
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
