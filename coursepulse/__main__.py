"""Command line: ``python -m coursepulse <job> ...``, or this file under spark-submit.

Connector packages, hosts, file-system settings and resources come from spark-submit or ``--conf``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from coursepulse import model
from coursepulse.operators.ingest import identified, interactions_from, unusable
from coursepulse.operators.profiles import cohort_affinity, daypart_profile, quality_report
from coursepulse.operators.popularity import HOUR
from coursepulse.plans import (
    Moved,
    Tables,
    ingest_landed,
    popularity_job,
    publish_landed,
    recommendation_job,
    replay_to_landing,
)
from coursepulse.sinks import ExternalStore
from coursepulse.sources import (
    build_session,
    read_landed,
    read_messages,
    stream_landed,
    stream_messages,
    unusable_landed,
)
from coursepulse.streaming import await_all, late_rows, start_quarantine


_PAIRS = {"action": "append", "default": [], "metavar": "KEY=VALUE"}


def _mapping(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _time(text: str) -> datetime:
    found = datetime.fromisoformat(text)
    return found if found.tzinfo else found.replace(tzinfo=UTC)


def _say(moved: Moved) -> None:
    print(f"{moved.taken} taken, {moved.aside} set aside in {moved.folder}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="coursepulse", description=__doc__)
    parser.add_argument("--conf", **_PAIRS)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(
        name: str, text: str, *, tables: bool = True, feed: bool = False, topic: bool = False,
        store: bool = False,
    ):
        added = jobs.add_parser(name, help=text)
        if tables:
            added.add_argument("--root", required=True, help="folder of the tables")
        if feed:
            source = added.add_mutually_exclusive_group(required=True)
            source.add_argument("--servers", help="brokers of the topic")
            source.add_argument("--landed", help="folder or glob of landed files")
        if topic:
            added.add_argument("--servers", required=True, help="brokers of the topic")
        if feed or topic:
            added.add_argument("--topic", default=model.TOPIC)
            added.add_argument("--topic-option", **_PAIRS, help="any connector option")
        if store:
            added.add_argument("--store-format", help="write to a keyed store by this connector")
            added.add_argument("--store-option", **_PAIRS, help="{table} stands for the table")
        return added

    stream = job("popularity", "keep the interaction log and course popularity current", feed=True,
                 store=True)
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--mode", choices=("complete", "update", "append"), default="update")
    stream.add_argument("--exact", action="store_true")
    stream.add_argument("--once", action="store_true", help="process what is there, then stop")
    stream.add_argument("--every", help="trigger interval, e.g. '1 minute'")
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--rocksdb", action="store_true")
    stream.add_argument("--window", default=HOUR, help="length of the windows, e.g. '1 day'")
    stream.add_argument("--watermark", default=HOUR, help="how late rows may come")
    stream.add_argument("--weight", **_PAIRS, help="score of an interaction type, e.g. a=3")
    stream.add_argument("--files-per-trigger", type=int, help="bounds a trigger on landed files")
    stream.add_argument("--offsets-per-trigger", type=int, help="bounds a trigger on a topic")
    stream.add_argument("--quarantine", help="folder for what yields no interaction")

    recommend = job("recommend", "store every student's top courses", store=True)
    recommend.add_argument("--landed", required=True)
    recommend.add_argument("--top", type=int, default=5)
    recommend.add_argument("--exclude-seen", action="store_true")

    load = job("load", "load landed files into the interaction log")
    load.add_argument("--landed", required=True)
    job("compact", "settle the batches of each day of the keyed tables into one")

    top = job("top", "print the most popular courses")
    top.add_argument("--mode", choices=("complete", "update", "append"), default="update")
    top.add_argument("--exact", action="store_true")
    top.add_argument("--window", default=HOUR)
    top.add_argument("--since", type=_time, help="first start of a window, ISO time, UTC")
    top.add_argument("--until", type=_time, help="end of the starts")
    top.add_argument("-n", type=int, default=10)

    profile = job("profile", "print the feed's quality and usage profiles", tables=False)
    profile.add_argument("--landed", required=True)

    send = job("publish", "publish landed events to a topic", tables=False, topic=True)
    send.add_argument("--landed", required=True)
    send.add_argument("--quarantine", required=True, help="folder for what yields no interaction")

    land = job("land", "land a topic's events by date", tables=False, topic=True)
    land.add_argument("--to", required=True)
    land.add_argument("--rebalance", action="store_true", help="shuffle for files of even size")
    land.add_argument("--quarantine", help="folder for what yields no interaction")
    return parser


def _store(options: argparse.Namespace) -> ExternalStore | None:
    if not options.store_format:
        return None
    return ExternalStore(options.store_format, _mapping(options.store_option))


def _run_popularity(spark: SparkSession, options: argparse.Namespace) -> None:
    trigger = None
    if options.once:
        trigger = {"availableNow": True}
    elif options.every:
        trigger = {"processingTime": options.every}
    if options.servers:
        topic = _mapping(options.topic_option)
        if options.offsets_per_trigger:
            topic["maxOffsetsPerTrigger"] = str(options.offsets_per_trigger)
        messages = stream_messages(spark, options.servers, options.topic, **topic)
        feed, rejected = interactions_from(messages), unusable(messages)
    else:
        lines = stream_landed(spark, options.landed, options.files_per_trigger)
        feed, rejected = identified(lines).drop("_corrupt"), unusable_landed(lines)
    queries = []
    if options.quarantine:
        queries.append(start_quarantine(
            rejected, options.quarantine, f"{options.checkpoints}/quarantine", trigger))
    weights = model.ENGAGEMENT_WEIGHTS | {
        kind: int(weight) for kind, weight in _mapping(options.weight).items()}
    log, popularity = popularity_job(
        feed, Tables(spark, options.root), options.checkpoints, options.mode, options.exact,
        trigger, _store(options), options.window, watermark=options.watermark, weights=weights,
        state_partitions=options.state_partitions, rocksdb=options.rocksdb)
    await_all(*queries, log, popularity)
    print(f"{late_rows(popularity)} rows came after the watermark")


def _run_profile(spark: SparkSession, options: argparse.Namespace) -> None:
    interactions = read_landed(spark, options.landed)
    for report in (quality_report, daypart_profile, cohort_affinity):
        report(interactions).show(100, truncate=False)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "popularity":
        _run_popularity(spark, options)
    elif options.job == "recommend":
        recommendation_job(
            spark, read_landed(spark, options.landed), Tables(spark, options.root),
            options.top, options.exclude_seen, store=_store(options))
    elif options.job == "load":
        _say(ingest_landed(spark, options.landed, Tables(spark, options.root)))
    elif options.job == "compact":
        for table in Tables(spark, options.root).keyed():
            table.compact()
    elif options.job == "top":
        store = Tables(spark, options.root).course_popularity(
            options.mode, options.exact, options.window)
        store.top(options.n, options.since, options.until).show(options.n, truncate=False)
    elif options.job == "profile":
        _run_profile(spark, options)
    elif options.job == "publish":
        _say(publish_landed(spark, options.landed, options.servers, options.topic,
                            options.quarantine, **_mapping(options.topic_option)))
    elif options.job == "land":
        _say(replay_to_landing(
            read_messages(
                spark, options.servers, options.topic, **_mapping(options.topic_option)),
            options.to, options.rebalance, options.quarantine))


def main(arguments: Sequence[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    run(build_session(f"coursepulse {options.job}", _mapping(options.conf)), options)


if __name__ == "__main__":
    main()
