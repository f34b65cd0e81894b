"""Command line for ``spark-submit``; ``COMMANDS`` lists what it can do.

Exit codes: 0 success / parity, 1 drift, 2 bad arguments or rejected change event,
3 missing input or engine error.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from typing import NamedTuple

from . import jobs


class Option(NamedTuple):
    name: str
    meaning: str
    kind: type = str
    default: object = None
    needed: bool = False
    choices: tuple | None = None


class Command(NamedTuple):
    meaning: str
    options: tuple[Option, ...]
    act: Callable


def _run(spark, a) -> int:
    stats = jobs.run(spark, a.stream, a.state, mode=a.mode, files_per_trigger=a.files_per_trigger, checkpoint=a.checkpoint,
                     bytes_per_trigger=a.batch_bytes, batch_size=a.batch_size, compact_after=a.compact_after)
    print(jobs.render_stats(stats, a.mode))
    return jobs.EXIT_OK


def _topic(spark, a) -> int:
    jobs.merge_topic(spark, a.bootstrap, a.topic, a.table, a.checkpoint, a.starting_offsets, a.batch_size, a.once)
    return jobs.EXIT_OK


def _reconcile(spark, a) -> int:
    verdict = jobs.reconcile(spark, a.stream, a.state)
    print((jobs.render_json if a.json else jobs.render_text)(verdict))
    return jobs.EXIT_OK if verdict.ok else jobs.EXIT_DRIFT


def _told(found: dict) -> int:
    print(", ".join(f"{name}={value}" for name, value in found.items()))
    return jobs.EXIT_OK


def _inspect(spark, a) -> int:
    return _told(jobs.inspect(spark, a.state))


def _history(spark, a) -> int:
    for entry in jobs.history(spark, a.state, a.last):
        _told(entry)
    return jobs.EXIT_OK


def _upkeep(spark, a) -> int:
    return _told(jobs.upkeep(spark, a.state, a.keep_bases, a.drop_tombstones_below))


STREAM = Option("stream", "directory, glob or file of JSON-lines envelopes", needed=True)
STATE = Option("state", "root of the state table, on shared storage", needed=True)
COMMANDS = {
    "run": Command("merge what is new in the change files into the state table", (
        STREAM, STATE,
        Option("mode", "which change of a key wins", default="lsn", choices=("lsn", "arrival")),
        Option("batch-size", "events of an epoch", int),
        Option("batch-bytes", "input bytes of a micro-batch", int),
        Option("files-per-trigger", "input files of a micro-batch", int),
        Option("compact-after", "waiting commits that start a compaction", int, jobs.COMPACT_AFTER),
        Option("checkpoint", "folder of the stream's progress (default: under the state root)")), _run),
    "topic": Command("merge a Kafka change topic into a catalog table", (
        Option("bootstrap", "brokers", needed=True), Option("topic", "name of the topic", needed=True),
        Option("table", "table of a catalog with row-level operations", needed=True),
        Option("checkpoint", "folder of the stream's progress", needed=True),
        Option("starting-offsets", "where a new checkpoint begins", default="earliest"),
        Option("batch-size", "offsets of a micro-batch", int),
        Option("once", "end when the topic is read to its end", bool)), _topic),
    "reconcile": Command("compare the state table with the folded log", (
        STREAM, STATE, Option("json", "tell the verdict as JSON", bool)), _reconcile),
    "inspect": Command("count live rows and committed epochs", (STATE,), _inspect),
    "history": Command("show the commit log, newest first", (STATE, Option("last", "entries to show", int, 20)), _history),
    "upkeep": Command("compact the state table and delete what it no longer needs", (
        STATE, Option("keep-bases", "bases that stay readable", int, 2),
        Option("drop-tombstones-below", "LSN below which nothing can arrive any more", int)), _upkeep),
}

#: The first kind an error is of decides; an engine error that carries a rejected event is bad input.
EXITS = ((FileNotFoundError, jobs.EXIT_ENGINE), ((ValueError, KeyError), jobs.EXIT_BAD_INPUT), (Exception, jobs.EXIT_ENGINE))


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description="Change-data merge and reconciliation on Spark.")
    parsers = parser.add_subparsers(dest="command", required=True)
    for name, command in COMMANDS.items():
        own = parsers.add_parser(name, help=command.meaning)
        for option in command.options:
            if option.kind is bool:
                own.add_argument(f"--{option.name}", action="store_true", help=option.meaning)
            else:
                own.add_argument(f"--{option.name}", type=option.kind, default=option.default, required=option.needed,
                                 choices=option.choices, help=option.meaning)
    return parser


def main(argv: list[str] | None = None, spark=None) -> int:
    try:
        args = build_parser().parse_args(argv)
    except SystemExit as e:
        return jobs.EXIT_BAD_INPUT if e.code else jobs.EXIT_OK
    try:
        if spark is None:
            from pyspark.sql import SparkSession
            spark = SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
        return COMMANDS[args.command].act(spark, args)
    except Exception as error:  # noqa: BLE001 - the exit code tells the kind
        text = str(error)
        code = next(code for kind, code in EXITS if isinstance(error, kind))
        print(f"tidemark {args.command}: {text.splitlines()[0] if text else repr(error)}", file=sys.stderr)
        return jobs.EXIT_BAD_INPUT if "rejected change event" in text else code


if __name__ == "__main__":
    raise SystemExit(main())
