"""Command line: `list` names the queries, `run NAME DATA OUT` writes a query's rows as Parquet, `show NAME DATA` prints the first ones, `summary DATA` the state of all projects."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans import registry


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomwork", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run")
    show = commands.add_parser("show")
    summary = commands.add_parser("summary")
    for p in (run, show):
        p.add_argument("name", choices=sorted(registry.QUERIES))
    for p in (run, show, summary):
        p.add_argument("data")
    run.add_argument("out")
    a = parser.parse_args(arguments)
    if a.command == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    spark = SparkSession.builder.appName("loomwork").getOrCreate()
    if a.command == "run":
        registry.QUERIES[a.name](spark, a.data).write.mode("errorifexists").parquet(a.out)
    else:
        registry.QUERIES["project_summary" if a.command == "summary" else a.name](spark, a.data).show(20, truncate=60)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
