"""Command-line jobs, for ``spark-submit`` or ``python -m tallyflow.jobs``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from .operators.caching import cached
from .operators.lookups import parse_ranges
from .plans import ads, calls, devices, orders, ratings, sales, search, words
from .schemas import AD_EVENT_SOURCE
from .session import build_session
from .settings import Settings
from .sinks.cells import CELL_KEYS, FIELD_KEYS, count_cells
from .sinks.files import write_text
from .sinks.jdbc import jdbc_options
from .sinks.keyed import BY_FIELD, BY_ROW, keyed_table
from .sinks.streams import console_sink, keyed_sink, topic_sink
from .sinks.tables import REGION_COUNTS, REGION_KPIS, append_partitions, create_database, replace_partitions
from .sources import kafka_options, line_stream, publish_regions, read_day, read_json, read_lines, read_regions, topic_stream
from .streaming.lifecycle import drain, start, stop_on_marker
from .workspace import new_folder

KAFKA = "kafka://"
# What a micro-batch takes unless told otherwise: a backlog is worked off in bounded steps, nothing is dropped.
BATCH_FILES, BATCH_OFFSETS = 1_000, 5_000_000


def word_count(spark: SparkSession, args: argparse.Namespace) -> None:
    """Counts as text, as cells of a key-value table or as rows of a keyed table."""
    counts = words.word_counts(read_lines(spark, args.input))
    if args.to == "cells":
        keyed_table(spark, args.output, *CELL_KEYS).upsert(count_cells(counts), unique=True)
    elif args.to == "table":
        keyed_table(spark, args.output, "word").upsert(counts, unique=True)
    else:
        write_text(counts, args.output, "\t", stamped=True)


def search_report(spark: SparkSession, args: argparse.Namespace) -> None:
    search.write_search_reports(read_lines(spark, args.input), args.output)


def top_rated(spark: SparkSession, args: argparse.Namespace) -> None:
    records = ratings.rating_records(read_lines(spark, args.input), args.delimiter)
    report = ratings.top_rated(records, min_count=args.min_count, k=args.k)
    jdbc = jdbc_options(args.jdbc_url, args.jdbc_table, args.jdbc_user, args.jdbc_password) if args.jdbc_url else None
    ratings.write_top_rated(report, args.output, jdbc)


def ads_extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """One day of events into the partitioned table; ``--replace`` makes a repeated run harmless."""
    extract = ads.daily_extract(read_json(spark, args.input, AD_EVENT_SOURCE), _ranges(spark, args.ranges), args.as_of)
    database = args.table.rpartition(".")[0]
    if database:
        create_database(spark, database)
    if args.replace and spark.catalog.tableExists(args.table):
        replace_partitions(extract, args.table, one_value=True)
    else:
        append_partitions(extract, args.table, path=args.path, one_value=True)


def ads_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Region counts and KPIs of one day from one cached scan; unknown regions are reported as such."""
    day = ads.known_regions(read_day(spark, args.table, args.as_of))
    with cached(day.select(*ads.REPORT_COLUMNS)) as events:
        counts = keyed_table(spark, f"{args.output}/{REGION_COUNTS.name}", *REGION_COUNTS.keys)
        ads.store_region_counts(ads.region_counts(events, as_of=args.as_of), counts)
        kpis = keyed_table(spark, f"{args.output}/{REGION_KPIS.name}", *REGION_KPIS.keys)
        ads.store_region_kpis(ads.region_kpis(events, as_of=args.as_of, variant=args.variant), kpis)


def order_etl(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    return [_to_topic(orders.enrich_orders(_records(spark, args), _ranges(spark, args.ranges)), args)]


def _to_topic(records: DataFrame, args: argparse.Namespace) -> DataStreamWriter:
    if args.target.startswith(KAFKA):
        servers, topic = _kafka_address(args.target)
        return topic_sink(records, args.checkpoint, kafka={"kafka.bootstrap.servers": servers, "topic": topic})
    return topic_sink(records, args.checkpoint, args.target)


def call_etl(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    return [_to_topic(calls.calls_with_status(_records(spark, args)), args)]


def sales_totals(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    """All totals from one query into one table; ``--bounded`` needs a query for each kind of day total.

    ``--rejects`` sums batch by batch without state and keeps the records that can't be summed.
    """
    if args.rejects:
        return [sales.batch_totals_writer(_records(spark, args), args.target, args.checkpoint, args.rejects, args.daily)]
    if not args.bounded:
        table = keyed_table(spark, args.target, *FIELD_KEYS)
        return [sales.all_totals_writer(sales.order_money(_records(spark, args)), table, args.checkpoint, args.daily)]
    tables = {kind: keyed_table(spark, f"{args.target}/{kind}", *FIELD_KEYS) for kind in sales.KINDS}
    money = sales.order_money(_records(spark, args))
    options = {"bounded": args.bounded} if args.daily else {}
    return list(sales.totals_writers(money, tables, args.checkpoint, args.daily, **options).values())


def index_orders(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    table = keyed_table(spark, args.target, "orderId", merge=args.merge)
    return [orders.index_orders(_records(spark, args), table, args.checkpoint, args.rejects)]


def put_orders(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    return [orders.put_orders(_records(spark, args), keyed_table(spark, args.target, "row_key"), args.checkpoint, args.rejects)]


def device_stats(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    stats = devices.device_stats(devices.device_signals(_records(spark, args)))
    return [console_sink(stats, "complete", 10).option("checkpointLocation", args.checkpoint)]


def stream_words(spark: SparkSession, args: argparse.Namespace) -> list[DataStreamWriter]:
    counts = words.stream_word_counts(line_stream(spark, args.source, args.max_per_batch or BATCH_FILES))
    return [keyed_sink(counts, keyed_table(spark, args.target, "word"), args.checkpoint)]


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """Region dictionary from its text form, parsed, checked and cut once into a table of blocks.

    Ranges that overlap are refused, unreadable lines are counted.
    """
    read, folder = Observation("ranges"), new_folder(spark, "regions")
    publish_regions(parse_ranges(read_lines(spark, path), rejected=read), folder, 0)
    if (bad := read.get["lines"] - read.get["kept"]) > 0:
        print(f"{path}: {bad} of {read.get['lines']} lines are no ranges", file=sys.stderr)
    return read_regions(spark, folder, 0)


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source.startswith(KAFKA):
        return topic_stream(spark, kafka=kafka_options(*_kafka_address(args.source), args.max_per_batch or BATCH_OFFSETS))
    return topic_stream(spark, args.source, max_files=args.max_per_batch or BATCH_FILES)


def _kafka_address(text: str) -> tuple[str, str]:
    servers, _, topic = text.removeprefix(KAFKA).rpartition("/")
    return servers, topic


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyflow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, *positional):
        added = jobs.add_parser(name)
        for argument in positional:
            added.add_argument(argument)
        added.set_defaults(run=run)
        return added

    def stream(name, run, *positional):
        added = job(name, run, "source", *positional, "checkpoint")
        added.add_argument("--max-per-batch", type=int, help=f"files ({BATCH_FILES}) or offsets ({BATCH_OFFSETS}) read per micro-batch")
        added.add_argument("--stop-marker", help="stop once this path exists")
        added.add_argument("--every", help="interval between micro-batches, such as '5 seconds'")
        added.add_argument("--once", action="store_true", help="process what is there and end")
        return added

    counted = job("word-count", word_count, "input", "output")
    counted.add_argument("--to", choices=("text", "cells", "table"), default="text")
    job("search-report", search_report, "input", "output")
    rated = job("top-rated", top_rated, "input", "output")
    rated.add_argument("--delimiter", default="::")
    rated.add_argument("--min-count", type=int, default=Settings.min_ratings)
    rated.add_argument("-k", type=int, default=Settings.top_items)
    for name in ("url", "table", "user", "password"):
        rated.add_argument(f"--jdbc-{name}")
    extract = job("ads-extract", ads_extract, "input", "ranges", "table")
    extract.add_argument("--path", help="location of a new table")
    extract.add_argument("--replace", action="store_true")
    report = job("ads-report", ads_report, "table", "output")
    report.add_argument("--variant", choices=("strict", "basic"), default="strict")
    for dated in (extract, report):
        dated.add_argument("--as-of", type=date.fromisoformat, default=Settings().as_of)
    stream("order-etl", order_etl, "ranges", "target")
    call = stream("call-etl", call_etl, "target")
    call.add_argument("--continuous", help="checkpoint interval of a continuous query, topic to topic only")
    totals = stream("sales-totals", sales_totals, "target")
    totals.add_argument("--daily", action="store_true")
    totals.add_argument("--rejects", help="folder for records that can't be summed")
    totals.add_argument("--bounded", action="store_true", help="close a day once its orders are late")
    index = stream("index-orders", index_orders, "target")
    index.add_argument("--merge", choices=(BY_FIELD, BY_ROW), default=BY_FIELD, help="what a document replaces")
    for stored in (index, stream("put-orders", put_orders, "target")):
        stored.add_argument("--rejects", help="folder for records without a key; without it they end the job")
    stream("device-stats", device_stats)
    stream("word-totals", stream_words, "target")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    session = spark or build_session(args.job)
    writers = args.run(session, args)
    if not writers:
        return
    if args.once:
        drain(*writers)
        return
    queries = [start(writer, every=args.every, continuous=getattr(args, "continuous", None)) for writer in writers]
    if args.stop_marker:
        stop_on_marker(session, args.stop_marker, queries)
    else:
        session.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
