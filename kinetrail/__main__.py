"""python -m kinetrail: lists and runs registered queries, scans sources and verifies files."""

from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinetrail", description=__doc__)
    jobs = out.add_subparsers(dest="job", required=True)
    jobs.add_parser("queries", help="names of the registered queries")
    run = jobs.add_parser("run", help="run a query over a folder of tables")
    run.add_argument("name")
    run.add_argument("tables")
    run.add_argument("--into", help="write Parquet here instead of showing rows")
    run.add_argument("--explain", action="store_true", help="show the plan only")
    scan = jobs.add_parser("scan", help="scan a source into a table")
    scan.add_argument("kind")
    scan.add_argument("root")
    scan.add_argument("--into")
    verify = jobs.add_parser("verify", help="files that are missing or have another size")
    verify.add_argument("expected", help="JSON lines with path and size")
    verify.add_argument("root")
    return out


def main(argv: list[str] | None = None) -> int:
    asked = parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from kinetrail.operators import reports
    from kinetrail.plans import catalog
    from kinetrail.sources import episodes, files, sinks

    if asked.job == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = SparkSession.builder.appName("kinetrail").getOrCreate()
    if asked.job == "run":
        if asked.name not in catalog.QUERIES:
            print(f"unknown query: {asked.name}", file=sys.stderr)
            return 2
        df = catalog.QUERIES[asked.name](spark, asked.tables)
        if asked.explain:
            df.explain("formatted")
            return 0
    elif asked.job == "scan":
        df = episodes.scan(spark, asked.kind, asked.root)
    else:
        expected = files.json_lines(spark, asked.expected, "path string, size bigint")
        root = asked.root.rstrip("/") + "/"
        have = episodes.listed(spark, root, "*").select(F.regexp_replace("path", "^.*?" + root.lstrip("/"), "").alias("path"), F.col("length").alias("size"))
        df = reports.verify(expected, have, "path", "size")
    if getattr(asked, "into", None):
        sinks.write_table(df, asked.into)
    else:
        df.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
