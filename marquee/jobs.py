"""Command line of the flows, for ``spark-submit``.

``python -m marquee.jobs reports --source warehouse.catalogue --column rating=Stars
--decades warehouse.decades --tags warehouse.tags`` and likewise ``revenue``, ``alerts``, ``ingest``
and ``publish``; see ``--help``. A table is a catalog name, or a path or connector table with a format
and ``key=value`` options.
"""

from __future__ import annotations

import argparse
import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import absolute_alerts, decade_trends, relative_alerts, revenue_model, tag_ratings
from marquee.schemas import (
    REVIEW_DATE_FORMAT,
    REVIEW_MESSAGE,
    REVIEW_MESSAGE_WITH_OVERALL,
    CatalogueColumns,
    ReviewColumns,
    SupplementColumns,
)
from marquee.session import get_session
from marquee.sources import (
    ingest_csv,
    preview_table,
    publish_json,
    read_json_objects,
    scan_csv,
    scan_table,
    stream_source,
    topic_options,
    write_table,
)
from marquee.streaming import low_rated_stream, overwrite_each_batch


def _pairs(items: list[str] | None) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items or [])


def _catalogue_columns(args: argparse.Namespace) -> CatalogueColumns:
    return dataclasses.replace(CatalogueColumns(), **_pairs(args.column))


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return scan_table(spark, args.source, args.source_format, **_pairs(args.source_option))


def _target(args: argparse.Namespace, name: str) -> dict:
    """Keyword arguments of ``write_table`` for the table ``name``. With ``--target-key`` the name is
    given to the connector as that option."""
    options = _pairs(args.target_option)
    if args.target_key:
        return {"target": None, "fmt": args.target_format, **options, args.target_key: name}
    return {"target": name, "fmt": args.target_format, **options}


def reports(spark: SparkSession, args: argparse.Namespace) -> None:
    catalogue, columns = _source(spark, args), _catalogue_columns(args)
    if args.decades:
        write_table(decade_trends(catalogue, columns), **_target(args, args.decades))
    if args.tags:
        write_table(tag_ratings(catalogue, columns), **_target(args, args.tags))


def revenue(spark: SparkSession, args: argparse.Namespace) -> None:
    supplement_columns = SupplementColumns(args.location, tuple(args.numeric))
    result = revenue_model(
        _source(spark, args),
        scan_csv(spark, args.supplement, args.supplement_schema),
        _catalogue_columns(args),
        supplement_columns,
        order_by=args.order_by,
        vocab_size=args.vocab_size,
        min_df=args.min_df,
        max_categories=args.max_categories,
        category_slots=args.category_slots,
        encode=args.encode,
    )
    result.report.show()
    result.r2.show()
    write_table(result.importances, **_target(args, args.importances))


def alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        options = topic_options(
            args.servers,
            args.topic,
            min_partitions=args.min_partitions,
            max_per_trigger=args.max_per_trigger,
        )
        messages = stream_source(spark, **options)
    else:
        messages = stream_source(spark, "text", args.topic, "value string")
    columns = dataclasses.replace(ReviewColumns(), **_pairs(args.column))
    if args.gap is None:
        frame = absolute_alerts(messages, args.below, args.schema or REVIEW_MESSAGE, columns, args.date_format)
    else:
        schema = args.schema or REVIEW_MESSAGE_WITH_OVERALL
        frame = relative_alerts(
            messages, args.gap, schema, columns, args.date_format, args.digits, args.first_by
        )
    target = _target(args, args.target)
    query = low_rated_stream(
        frame, overwrite_each_batch(**target), args.checkpoint, every=None if args.once else args.every
    )
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    table = ingest_csv(spark, args.csv, args.target, args.target_format, args.mode)
    preview_table(spark, table, args.preview).show(args.preview, truncate=False)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    objects = read_json_objects(spark, args.json, array=args.array)
    if args.servers:
        publish_json(
            objects, None, "kafka", **{"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        )
    else:
        publish_json(objects, args.topic)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="marquee.jobs", description="Catalogue and review jobs")
    jobs = root.add_subparsers(required=True)

    def job(run: Callable[[SparkSession, argparse.Namespace], None], text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=text)
        sub.set_defaults(run=run)
        return sub

    def source_arguments(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--source", help="catalogue table")
        sub.add_argument("--source-format", help="format of the catalogue (default: catalog table)")
        sub.add_argument("--source-option", action="append", metavar="KEY=VALUE")
        sub.add_argument("--column", action="append", metavar="ROLE=NAME", help="column of a role")

    def target_arguments(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--target-format", help="format of results (default: catalog table)")
        sub.add_argument("--target-option", action="append", metavar="KEY=VALUE")
        sub.add_argument("--target-key", help="connector option that takes the table name")

    sub = job(reports, "decade and tag reports")
    source_arguments(sub)
    target_arguments(sub)
    sub.add_argument("--decades", help="table for the decade report")
    sub.add_argument("--tags", help="table for the tag report")

    sub = job(revenue, "revenue model and its importances")
    source_arguments(sub)
    target_arguments(sub)
    sub.add_argument("--supplement", required=True, help="CSV files with the supplement")
    sub.add_argument("--location", default=SupplementColumns.location)
    sub.add_argument("--numeric", nargs="+", default=list(SupplementColumns.numeric))
    sub.add_argument("--importances", required=True, help="table for the importances")
    sub.add_argument("--supplement-schema", help="DDL of the supplement (default: inferred in one more pass)")
    sub.add_argument("--order-by", nargs="+", help="which supplement row of a title counts: the first by these")
    sub.add_argument("--vocab-size", type=int, help="most frequent terms to keep (default: all)")
    sub.add_argument("--min-df", type=float, default=1.0, help="rows, or under 1 their share, that a term needs")
    sub.add_argument("--max-categories", type=int, default=100_000, help="refuse one-hot columns with more")
    sub.add_argument("--encode", choices=["one_hot", "label_means"], default="one_hot", help="how categories become inputs")
    sub.add_argument("--category-slots", type=int, help="encode categories by hash in so many slots")

    sub = job(alerts, "low-rating alerts over a topic, or over a folder of text files")
    target_arguments(sub)
    sub.add_argument("--servers", help="brokers; without them --topic is a folder")
    sub.add_argument("--topic", required=True)
    sub.add_argument("--below", type=float, default=6.0, help="alert under this daily mean")
    sub.add_argument("--gap", type=float, help="alert this far under the overall rating instead")
    sub.add_argument("--column", action="append", metavar="ROLE=NAME", help="column of a role")
    sub.add_argument("--schema", help="DDL of a message")
    sub.add_argument("--date-format", default=REVIEW_DATE_FORMAT)
    sub.add_argument("--digits", type=int, help="round gaps to so many digits")
    sub.add_argument("--first-by", help="column that says which overall rating of a day counts")
    sub.add_argument("--target", required=True)
    sub.add_argument("--checkpoint")
    sub.add_argument("--every", default="2 seconds")
    sub.add_argument("--once", action="store_true", help="process what is there and stop")
    sub.add_argument("--min-partitions", type=int)
    sub.add_argument("--max-per-trigger", type=int)

    sub = job(ingest, "load CSV files into a table and show its first rows")
    sub.add_argument("--csv", nargs="+", required=True)
    sub.add_argument("--target", required=True)
    sub.add_argument("--target-format")
    sub.add_argument("--mode", default="append")
    sub.add_argument("--preview", type=int, default=100)

    sub = job(publish, "send the objects of JSON files to a topic or a text folder")
    sub.add_argument("--json", nargs="+", required=True)
    sub.add_argument("--array", action="store_true", help="one array per file, not one object per line")
    sub.add_argument("--servers")
    sub.add_argument("--topic", required=True)
    return root


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(spark or get_session("marquee"), args)


if __name__ == "__main__":
    main()
