"""Command line for spark-submit: ``spark-submit --py-files netwatch.zip jobs.py <job> ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netwatch.functions.times import parse_time
from netwatch.operators.split import ordered_split
from netwatch.plans.increments import (
    merged_patterns,
    merged_reputation,
    merged_timeline,
    run_days,
    run_incremental,
)
from netwatch.plans.publish import publish_files
from netwatch.session import build_session
from netwatch.sinks.days import WRITE_OPTIONS, write_by_day, write_view
from netwatch.sources.envelope import decode_envelope, encode_envelope
from netwatch.sources.logs import read_day, read_text_logs
from netwatch.sources.stream import read_stream, write_messages
from netwatch.streaming.runs import await_any, run_detectors, with_lateness


def split(spark: SparkSession, args: argparse.Namespace) -> None:
    """The earlier part of a CSV log to one folder, the later part to another."""
    if args.input in (args.batch, args.stream):
        raise ValueError("the parts must not be written over the input")
    timed = read_text_logs(spark, args.input).withColumn("_time", parse_time(F.col("timestamp")))
    for part, path in zip(ordered_split(timed, ["_time"], args.fraction), (args.batch, args.stream)):
        part.drop("_time").write.options(**WRITE_OPTIONS["csv"]).csv(path)


def partition(spark: SparkSession, args: argparse.Namespace) -> None:
    """A CSV log to day folders; lines without a valid day go to the reject folder."""
    rejected = write_by_day(read_text_logs(spark, args.input), args.base, overwrite=args.overwrite)
    rejected.write.mode("overwrite").options(**WRITE_OPTIONS["csv"]).csv(args.rejects)


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """A CSV log to keyed messages: to a topic, or to a folder of message files."""
    messages = encode_envelope(read_day(spark, args.input))
    if args.folder:
        messages.write.mode("append").parquet(args.folder)
    else:
        write_messages(messages, **_options(args.option))


def days(spark: SparkSession, args: argparse.Namespace) -> None:
    """All day folders after the marker, one after the other."""
    print("\n".join(run_days(spark, args.base, args.state)))


def incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    """All days after the mark in one run."""
    print(run_incremental(spark, args.base, args.state, partitions=args.partitions))


def _merged(spark: SparkSession, state: str) -> dict[str, DataFrame]:
    return {
        "ip_reputation": merged_reputation(spark, state),
        "attack_patterns": merged_patterns(spark, state),
        "threat_timeline": merged_timeline(spark, state),
    }


def views(spark: SparkSession, args: argparse.Namespace) -> None:
    """The merged views in columnar form."""
    for name, view in _merged(spark, args.state).items():
        write_view(view, f"{args.output}/{name}")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """The merged views as cells and points in file stores; the same run again replaces its rows."""
    for name, view in _merged(spark, args.state).items():
        publish_files(view, name, args.store, args.run)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """The four detectors over a message stream, until one of them ends."""
    logs = decode_envelope(read_stream(spark, args.source, **_options(args.option)))
    trigger = {"availableNow": True} if args.once else None
    queries = run_detectors(
        spark,
        with_lateness(logs, args.lateness),
        args.root,
        args.checkpoint,
        trigger=trigger,
        state_partitions=args.partitions,
    )
    if args.once:
        for query in queries.values():
            query.awaitTermination()
    else:
        await_any(spark, queries)


def _options(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def parse(argv: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(function, *names: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(function.__name__, help=function.__doc__)
        sub.set_defaults(job=function)
        for name in names:
            sub.add_argument(name)
        return sub

    job(split, "input", "batch", "stream").add_argument("--fraction", type=float, default=0.75)
    job(partition, "input", "base", "rejects").add_argument(
        "--overwrite", choices=["dynamic", "static"], default="dynamic"
    )
    sub = job(replay, "input")
    sub.add_argument("--folder")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    job(days, "base", "state")
    job(incremental, "base", "state").add_argument("--partitions", type=int)
    job(views, "state", "output")
    job(publish, "state", "store").add_argument("--run", default="latest")
    sub = job(stream, "root", "checkpoint")
    sub.add_argument("--source", default="kafka")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    sub.add_argument("--lateness")
    sub.add_argument("--partitions", type=int)
    sub.add_argument("--once", action="store_true")
    return parser.parse_args(argv)


def main(argv: Sequence[str]) -> None:
    args = parse(argv)
    args.job(build_session(f"netwatch-{args.job.__name__}"), args)


if __name__ == "__main__":
    main(sys.argv[1:])
