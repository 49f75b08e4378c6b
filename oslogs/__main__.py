"""``spark-submit oslogs/__main__.py`` or ``python -m oslogs``: print the report of one log, optionally export all of it.

    python -m oslogs mem 2024-11-09 00:00:00 23:59:59 /logs/syslog
    python -m oslogs ubu 2024-11-01 00:00:00 23:59:59 /logs/syslog --last 2024-11-09 --out /data/counts
    python -m oslogs host 2024-11-09 00:00:00 23:59:59 /data/readings --series paging=/data/paging --processes /data/ps
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from oslogs import sinks
from oslogs.api import KINDS, analyze, host_report, report
from oslogs.sources.host import host_snapshots, process_samples, sar_series
from oslogs.sources.tables import daily_summaries


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="oslogs")
    parser.add_argument("kind", choices=(*KINDS, "host"))
    parser.add_argument("date")
    parser.add_argument("start", nargs="?", default="00:00:00")
    parser.add_argument("end", nargs="?", default="23:59:59")
    parser.add_argument("path", nargs="?", default="nofile")
    parser.add_argument("--last", help="last day of a range")
    parser.add_argument("--exclusive", action="store_true", help="leave out both outer days of the range")
    parser.add_argument("--all-bsd-times", action="store_true", help="no time filter on year-less lines")
    parser.add_argument("--year", type=lambda text: text if text == "modified" else int(text), help="year of year-less lines, or 'modified'")
    parser.add_argument("--by-name", action="store_true", help="the last file by name holds the last lines, not the one changed last")
    parser.add_argument("--header", help="tab-separated column names that hold for all System exports")
    parser.add_argument("--landed", action="store_true", help="the path is a table of parsed rows")
    parser.add_argument("--repetitive", action="store_true", help="the log repeats its messages: search each different one once")
    parser.add_argument("--summaries", metavar="TABLE", help="report whole days from stored daily summaries, without the log")
    parser.add_argument("--store-summaries", metavar="TABLE", help="store the daily summaries of these rows; same files again replace theirs")
    parser.add_argument("--series", action="append", default=[], metavar="KIND=PATH", help="exported series of a host report")
    parser.add_argument("--processes", metavar="PATH", help="process samples of a host report")
    parser.add_argument("--as-of", help="refuse days more than a week before this one (host report)")
    parser.add_argument("--rows", type=int, default=50, help="rows shown per table; exports have all")
    parser.add_argument("--out", help="folder for the exported tables")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("oslogs").getOrCreate()
    if args.kind == "host":
        snapshots = host_snapshots(spark, args.path)
        series = {kind: sar_series(spark, path, kind) for kind, _, path in (s.partition("=") for s in args.series)}
        samples = process_samples(spark, args.processes) if args.processes else None
        tables = host_report(snapshots, args.date, args.start, args.end, series, samples, args.as_of)
        if args.out:
            sinks.write_tables(tables, args.out)
    elif args.summaries:
        tables = report(daily_summaries(spark, args.summaries, args.kind, (args.date, args.last or args.date)), args.kind)
        if args.out:
            sinks.write_tables(tables, args.out)
            sinks.export_counts(tables, args.out)
    else:
        rows = analyze(
            spark, args.kind, args.date, args.start, args.end, args.path, args.last,
            "neither" if args.exclusive else "both", not args.all_bsd_times, args.year, not args.by_name,
            args.header.split("\t") if args.header else None, args.landed, args.repetitive,
        )
        if args.store_summaries and args.repetitive:
            raise SystemExit("--store-summaries needs the files of the rows, which --repetitive drops")
        if args.store_summaries:
            sinks.write_summaries(rows, args.store_summaries, args.kind)
        tables = report(rows, args.kind)
        if args.out:
            sinks.write_tables(tables, args.out)
            sinks.export_counts(tables, args.out)
    for name, table in tables.items():
        print(name)
        table.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
