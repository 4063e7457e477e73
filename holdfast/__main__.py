"""The jobs, for spark-submit: python -m holdfast <job> --help"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from holdfast import values
from holdfast.operators.boosting import ENCODED, REFERENCE_PARITY
from holdfast.operators.cleaning import clean_accounts
from holdfast.operators.domain import domain_violations
from holdfast.plans import serving, training
from holdfast.sources import accounts, files, models, requests
from holdfast.streaming import scorer


def inventory(spark: SparkSession, args: argparse.Namespace) -> None:
    files.file_inventory(spark, args.path).write.mode("overwrite").parquet(args.out)


def violations(spark: SparkSession, args: argparse.Namespace) -> None:
    domain_violations(accounts.scan_accounts(spark, args.raw)).write.mode("overwrite").parquet(args.out)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    table = clean_accounts(accounts.scan_accounts(spark, args.raw), keep_id=args.keep_id)
    accounts.write_table(table, args.out, args.format)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    table = accounts.scan_clean(spark, args.clean, args.format)
    key = values.ID if values.ID in table.columns else None
    trained = training.train(table, key, fill=args.fill, max_iter=args.trees)
    models.save_model(spark, trained.stored, args.model)
    trained.report().show()


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = models.load_model(spark, args.model)
    texts = requests.scan_requests(spark, args.requests, args.format)
    requests.write_responses(serving.score_requests(texts, stored, args.mode, args.fill), args.out)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = models.load_model(spark, args.model)
    texts = requests.stream_requests(spark, args.requests, args.format)
    trigger = {"processingTime": args.every} if args.every else None
    scorer.score_stream(texts, stored, args.out, args.checkpoint, args.mode, args.fill, trigger).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="holdfast")
    jobs = top.add_subparsers(required=True)

    def job(run, *paths: str) -> argparse.ArgumentParser:
        found = jobs.add_parser(run.__name__)
        found.set_defaults(run=run)
        for path in paths:
            found.add_argument(path)
        return found

    job(inventory, "path", "out")
    job(violations, "raw", "out")
    tables = [job(clean, "raw", "out"), job(train, "clean", "model")]
    for table in tables:
        table.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    tables[0].add_argument("--keep-id", action="store_true", help="keep the identifier, as the key of the split")
    tables[1].add_argument("--trees", type=int, default=values.TREES)
    scoring = [job(score, "requests", "model", "out"), job(stream, "requests", "model", "out", "checkpoint")]
    for requests_job in scoring:
        requests_job.add_argument("--format", choices=["text", "json", "parquet"], default="text")
        requests_job.add_argument("--mode", choices=[ENCODED, REFERENCE_PARITY], default=ENCODED)
    scoring[1].add_argument("--every", help="keep running with this interval, as '10 seconds'")
    for filling in [tables[1], *scoring]:
        filling.add_argument("--fill", type=float, default=values.STAND_IN, help="stands for missing numbers")
        filling.add_argument("--strict", dest="fill", action="store_const", const=None, help="missing numbers are errors")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("holdfast").getOrCreate(), args)


if __name__ == "__main__":
    main()
