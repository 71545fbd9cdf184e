"""Command line: drain a queue of params files and write every extract.

    python -m caseload serve --level region --data /data/v4 --queue /queue/region \
        --out /results --ledger /ledgers/region [--full] [--quarantine /bad] \
        [--sample-rate 0.01] [--clean-source archive --archive-dir /done]

The session comes from ``spark-submit`` / the environment; nothing here sets a master.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from caseload.plans.job import serve_queue
from caseload.sources.dataset import Dataset


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="caseload")
    sub = parser.add_subparsers(dest="command", required=True)
    serve = sub.add_parser("serve", help="process every queued params file once")
    serve.add_argument("--level", required=True, choices=["provider", "region", "national"])
    serve.add_argument("--data", required=True, help="base path of the parquet tables")
    serve.add_argument("--table", action="append", default=[], metavar="NAME=SOURCE",
                       help="override one table with a path or a catalog name")
    serve.add_argument("--queue", required=True)
    serve.add_argument("--out", required=True)
    serve.add_argument("--ledger", required=True, help="table of the file versions that were served")
    serve.add_argument("--quarantine")
    serve.add_argument("--full", action="store_true", help="also write the row-level extracts")
    serve.add_argument("--sample-rate", type=float, help="national sample rate (else read from params)")
    serve.add_argument("--year-field", default="start_year")
    serve.add_argument("--clean-source", choices=["archive", "delete"])
    serve.add_argument("--archive-dir")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("caseload").getOrCreate()
    tables = dict(item.split("=", 1) for item in args.table)
    count = serve_queue(
        spark, Dataset(spark, args.data, tables), args.queue, args.out, args.ledger, args.level,
        quarantine_path=args.quarantine, year_field=args.year_field, sample_rate=args.sample_rate,
        full=args.full, clean_source=args.clean_source, archive_dir=args.archive_dir,
    )
    print(f"params files taken: {count}")


if __name__ == "__main__":
    main()
