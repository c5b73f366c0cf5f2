"""Command line: export and inspect."""

from __future__ import annotations

import argparse
import sys

from parquill import VERSION
from parquill.errors import ParquillError, SettingsError
from parquill.settings import Array, EnumAs, Float16, Interval, Json, Macaddr, Numeric, Settings

#: Exit codes: of failures, and of wrong arguments.
FAILED, WRONG = 1, 2


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("parquill", description="Exports query results as typed Parquet.")
    top.add_argument("--version", action="version", version=VERSION)
    commands = top.add_subparsers(dest="command", required=True, metavar="COMMAND")
    e = commands.add_parser("export", help="write the result of a query or a table", add_help=False, usage="parquill export (-q SQL | -t TABLE) -o FILE [options]", formatter_class=lambda prog: argparse.HelpFormatter(prog, max_help_position=38, width=120))
    e.add_argument("-h", action="help", help="this help")
    e.add_argument("--help", action="help", help=argparse.SUPPRESS)
    what = e.add_mutually_exclusive_group(required=True)
    what.add_argument("-q", "--query", metavar="SQL", help="query to run")
    what.add_argument("-t", "--table", metavar="NAME", help="table to read whole")
    e.add_argument("-o", "--output-file", required=True, metavar="FILE", help="file to write; replaced if it exists")
    e.add_argument("--input", action="append", default=[], metavar="NAME=PATH", help="register a Parquet file or folder as a table, in place of a server")
    e.add_argument("--compression", default="zstd", choices=["none", "snappy", "gzip", "lzo", "brotli", "lz4", "zstd"], metavar="CODEC", help="none, snappy, gzip, brotli, lz4 or zstd (default)")
    e.add_argument("--compression-level", type=int, metavar="N", help="for zstd, gzip, brotli (3)")
    e.add_argument("--sink", default="native", choices=["native", "annotated"], metavar="SINK", help="native or annotated")
    e.add_argument("--quiet", action="store_true", help="print errors only")
    e.add_argument("--partition-column", metavar="NAME", help="number or date column by which a server is read in parallel")
    e.add_argument("--partition-bounds", metavar="LOW,HIGH", help="its range; rows outside are read too")
    e.add_argument("--partitions", type=int, default=8, metavar="N", help="reads at a time (8)")
    c = e.add_argument_group("connection")
    c.add_argument("-c", "--connection", metavar="URL", help="connection string; else POSTGRES_URL, DATABASE_URL")
    c.add_argument("-H", "--host")
    c.add_argument("-U", "--user")
    c.add_argument("-d", "--dbname")
    c.add_argument("-p", "--port", type=int)
    c.add_argument("--password")
    c.add_argument("--sslmode", choices=["disable", "prefer", "require"], metavar="MODE", help="disable, prefer, require")
    c.add_argument("--ssl-root-cert", "--ssl-ca", metavar="FILE")
    c.add_argument("--ssl-client-cert", "--ssl-cert", metavar="FILE")
    c.add_argument("--ssl-client-key", "--ssl-key", metavar="FILE")
    t = e.add_argument_group("types")
    for name, kind in (("macaddr", Macaddr), ("json", Json), ("enum", EnumAs), ("interval", Interval), ("numeric", Numeric), ("array", Array), ("float16", Float16)):
        t.add_argument(f"--{name}-handling", metavar="HOW", help=", ".join(m.value for m in kind) + f" ({getattr(Settings(), name).value})")
    t.add_argument("--decimal-scale", type=int, default=18, metavar="N", help="(18)")
    t.add_argument("--decimal-precision", type=int, default=38, metavar="N", help="(38)")
    i = commands.add_parser("inspect", help="show the footers of a Parquet file or folder")
    i.add_argument("path")
    return top


def settings_of(args: argparse.Namespace) -> Settings:
    names = ("macaddr", "json", "enum", "interval", "numeric", "array", "float16")
    given = {n: v for n in names if (v := getattr(args, f"{n}_handling")) is not None}
    return Settings(decimal_scale=args.decimal_scale, decimal_precision=args.decimal_precision, **given)


def check(args: argparse.Namespace):
    """Settings and connection; wrong combinations are refused before anything starts."""
    from parquill.sources import postgres

    settings = settings_of(args)
    wrong = [n for n in ("host", "user", "dbname", "port", "password", "sslmode") if args.connection and getattr(args, n) is not None]
    if wrong:
        raise SettingsError(f"--connection cannot be used with --{wrong[0]}")
    if (args.partition_column is None) != (args.partition_bounds is None):
        raise SettingsError("--partition-column and --partition-bounds go together")
    if args.partition_bounds and len(args.partition_bounds.split(",")) != 2:
        raise SettingsError("--partition-bounds are two values: LOW,HIGH")
    if args.input:
        return settings, None
    names = ("host", "dbname", "port", "user", "password", "sslmode", "ssl_root_cert", "ssl_client_cert", "ssl_client_key")
    return settings, postgres.connection(url=args.connection, **{n: getattr(args, n) for n in names})


def run(args: argparse.Namespace) -> None:
    from pyspark.sql import SparkSession

    if args.command == "inspect":
        from parquill.sources.footers import file_schema, inspect

        spark = SparkSession.builder.appName("parquill").getOrCreate()
        print(file_schema(spark, args.path))
        inspect(spark, args.path).show(10_000, truncate=60)
        return
    settings, at = check(args)
    from parquill.operators.export import export
    from parquill.sources import postgres

    spark = SparkSession.builder.appName("parquill").getOrCreate()
    writing = {"compression": args.compression, "level": args.compression_level, "sink": args.sink, "quiet": args.quiet, "settings": settings}
    if at is None:
        for item in args.input:
            name, _, path = item.partition("=")
            spark.read.parquet(path).createOrReplaceTempView(name)
        export(spark, args.output_file, query=args.query, table=args.table, **writing)
        return
    partition = None
    if args.partition_column:
        low, high = args.partition_bounds.split(",")
        partition = {"partitionColumn": args.partition_column, "lowerBound": low, "upperBound": high, "numPartitions": str(args.partitions)}
    df, types = postgres.read_query(spark, at, args.query, partition=partition) if args.query else postgres.read_table(spark, at, args.table, partition=partition)
    export(spark, args.output_file, df=df, types=types, **writing)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        run(args)
    except SettingsError as e:
        print(f"error: {e}", file=sys.stderr)
        return WRONG
    except (ParquillError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return FAILED
    except Exception as e:
        from py4j.protocol import Py4JError
        from pyspark.errors import PySparkException

        if not isinstance(e, PySparkException | Py4JError):
            raise
        print(f"error: {str(e).strip().splitlines()[0]}", file=sys.stderr)
        return FAILED
    return 0
