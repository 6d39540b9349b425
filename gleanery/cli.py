"""Commands over record files: python -m gleanery COMMAND. Every data command takes --dry-run: work all out, write nothing."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import dedup, ingest, json_schema, normalize, review, validate
from gleanery.operators.open_records import OPEN
from gleanery.schema import record_document
from gleanery.sources import files


def positive(text: str) -> int:
    n = int(text)
    if n < 1:
        raise argparse.ArgumentTypeError("must be a positive integer")
    return n


def session() -> SparkSession:
    return SparkSession.builder.appName("gleanery").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _written(args, df: DataFrame, write, **more) -> dict:
    """Writes df, unless it is a dry run, and says how many rows there are. Input and output must differ."""
    if os.path.abspath(args.input) == os.path.abspath(args.output):
        raise files.BadInput("output must not be the input")
    rows = df.count() if args.dry_run else write(df, args.output)
    return {"input": args.input, "output": None if args.dry_run else args.output, "rows": rows, **more}


def _normalize(spark, args):
    return _written(args, normalize.normalize_records(files.read_open_jsonl(spark, args.input)), files.write_open_jsonl)


def _conform(spark, args):
    """Violations of a JSON-schema document, that of the record format if none is given; how many of each keyword."""
    document = json.loads(Path(args.schema).read_text(encoding="utf-8")) if args.schema else record_document()
    found = json_schema.violations(files.read_open_jsonl(spark, args.input), document, OPEN, "question_id")
    report = {r.keyword: r["count"] for r in found.groupBy("keyword").count().collect()}  # a row for each keyword
    return _written(args, found, files.write_csv, violations=report)


def _validate(spark, args):
    out = validate.validate_records(files.read_open_jsonl(spark, args.input), args.latest_year)
    report = validate.nested_report(spark, validate.validation_summary(out))
    if not args.dry_run:
        files.write_json_report(report, args.report)
    return _written(args, out, files.write_open_jsonl, report=report)


def _deduplicate(spark, args):
    result = dedup.deduplicate_records(files.read_open_jsonl(spark, args.input), args.threshold)
    if args.dry_run:
        return _written(args, result.records, files.write_open_jsonl, **result.summary().first().asDict())
    out = _written(args, result.records, files.write_open_jsonl)
    return out | files.write_dedup_reports(result, args.report_dir, out["rows"])


def _export_review(spark, args):
    return _written(args, review.review_rows(files.read_jsonl(spark, args.input)), files.write_csv)


def _export_csv(spark, args):
    return _written(args, review.canonical_rows(files.read_jsonl(spark, args.input)), files.write_csv)


def _merge_review(spark, args):
    records, sheet = files.read_open_jsonl(spark, args.input), files.read_sheet(spark, args.review, review.REVIEW_COLUMNS)
    outcomes = review.merge_outcomes(records, sheet)
    summary = review.merge_summary(outcomes).first().asDict()
    errors = [r.message for r in review.merge_errors(outcomes).orderBy("line").limit(args.errors).collect()]  # for the screen
    if not args.dry_run:
        files.write_json_report(summary | {"errors": errors}, args.report)
    return _written(args, review.merge_review(records, sheet), files.write_open_jsonl, errors=errors, **summary)


def _report(spark, args):
    report = validate.nested_report(spark, validate.quality_report(files.read_jsonl(spark, args.input)))
    if not args.dry_run:
        files.write_json_report(report, args.output)
    return report


def _sources(spark, args):
    """Why each source of a registry may not be crawled; '' if it may."""
    rows = ingest.registry_frame(spark, list(files.load_registry(args.registry).values())).withColumn("authenticated", F.lit(args.authenticated))
    return {r.source_id: r.refusal for r in rows.select("source_id", ingest.crawl_refusals().alias("refusal")).collect()}  # a registry's few entries


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="python -m gleanery", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, handler, text, **options):
        p = commands.add_parser(name, help=text)
        p.set_defaults(handler=handler)
        for option, about in options.items():
            p.add_argument(f"--{option.replace('_', '-')}", **about)
        p.add_argument("--dry-run", action="store_true")

    io = {"input": {"required": True}, "output": {"required": True}}
    command("normalize", _normalize, "clean records", **io)
    command("validate", _validate, "find issues and statuses", **io, report={"default": "data/reports/validation.json"}, latest_year={"type": positive, "required": True})
    command("conform", _conform, "list what a JSON-schema document does not allow", **io, schema={"default": ""})
    command("deduplicate", _deduplicate, "find equal, reordered and similar records", **io, report_dir={"default": "data/reports/deduplication"}, threshold={"type": float, "default": 0.88})
    command("export-review", _export_review, "write a sheet for reviewers", **io)
    command("export-csv", _export_csv, "write records as flat CSV", **io)
    command("merge-review", _merge_review, "take over what reviewers decided", **io, review={"required": True}, report={"default": "data/reports/review_merge.json"}, errors={"type": positive, "default": 100})
    command("report", _report, "count statuses", **io)
    command("sources", _sources, "say which sources may be crawled", registry={"required": True}, authenticated={"action": "store_true"})
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    try:
        print(json.dumps(args.handler(session(), args), ensure_ascii=False, sort_keys=True, indent=2))
        return 0
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
