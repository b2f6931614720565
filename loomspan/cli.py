"""Command line: python -m loomspan.cli COMMAND. Exit codes: 0 well, 1 findings (check-report only), 2 an error."""

from __future__ import annotations

import argparse
import logging
import os
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomspan import config as C
from loomspan.operators import reader, report_rules
from loomspan.operators.ingest import Evidence, candidate_id, ingest
from loomspan.operators.ranking import ranked
from loomspan.operators.render import fragments
from loomspan.period import TIMEZONE, build_period
from loomspan.sources.evidence import indexed_item, read_texts, write_document
from loomspan.sources.rest import service_for, snapshot
from loomspan.storage import keeper, scratch


logger = logging.getLogger("loomspan")

#: Names that a message about skipped items gives at most.
NAMED = 10


@contextmanager
def progress() -> Iterator[None]:
    """Messages of the package on stderr while the block runs."""
    level, propagate, handler = logger.level, logger.propagate, logging.StreamHandler()
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s", "%Y-%m-%d %H:%M:%S"))
    logger.addHandler(handler)
    logger.setLevel(logging.INFO)
    logger.propagate = False
    try:
        yield
    finally:
        logger.removeHandler(handler)
        handler.close()
        logger.setLevel(level)
        logger.propagate = propagate


class CommandError(Exception):
    """Shown on stderr with exit code 2."""


def _whole(low: int, high: int):
    def check(text: str) -> int:
        if not text.isdigit() or not low <= int(text) <= high:
            raise argparse.ArgumentTypeError(f"must be between {low} and {high}")
        return int(text)

    return check


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomspan")
    commands = top.add_subparsers(dest="command", required=True)
    check = commands.add_parser("validate-config")
    collect = commands.add_parser("collect")
    for sub in (check, collect):
        sub.add_argument("--config", type=Path, required=True)
    collect.add_argument("--start-date", type=date.fromisoformat)
    collect.add_argument("--end-date", type=date.fromisoformat)
    collect.add_argument("--dry-run", action="store_true")
    collect.add_argument("--workers", type=_whole(1, 16), default=8)
    collect.add_argument("--requests-per-second", type=_whole(1, 15), default=10)
    collect.add_argument("--base-url", default="https://api.github.com")
    collect.add_argument("--snapshot", help="folder of the raw zone; on a cluster, one that all executors see")
    collect.add_argument("--transport", default="loomspan.sources.rest:over_http", help=argparse.SUPPRESS)
    overview = commands.add_parser("overview")
    index = commands.add_parser("index")
    item = commands.add_parser("item")
    for sub in (overview, index, item):
        sub.add_argument("document", type=Path)
    for sub in (index, item):
        sub.add_argument("kind", choices=["issue", "pull_request"])
    index.add_argument("--offset", type=int, default=0)
    index.add_argument("--limit", type=int, default=reader.MAX_INDEX_ROWS)
    index.add_argument("--max-bytes", type=int, default=reader.MAX_INDEX_BYTES)
    item.add_argument("item_id")
    item.add_argument("--view", default="triage")
    item.add_argument("--chunk", type=int, default=1)
    item.add_argument("--max-bytes", type=int, default=reader.MAX_ITEM_BYTES)
    report = commands.add_parser("check-report")
    report.add_argument("report", type=Path)
    report.add_argument("--org", required=True)
    report.add_argument("--title", required=True)
    return top


def session() -> SparkSession:
    spark = SparkSession.builder.appName("loomspan").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _documents(path: Path):
    if not path.is_file():
        raise CommandError(f"cannot read {path}")
    return read_texts(session(), path.resolve().as_uri())


def _tell(made: Evidence) -> None:
    """What was retained, skipped and lost, with a few names of each."""
    rows = made.items.select(F.coalesce("reason", F.lit("retained")).alias("outcome"), candidate_id(F.col("repository"), F.col("number")).alias("name"))
    names: dict[str, list[str]] = {}
    for r in ranked(rows, ["outcome"], [F.asc("name")]).where(F.col("rank") <= NAMED).orderBy("outcome", "rank").collect():
        names.setdefault(r.outcome, []).append(r.name)
    for r in rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).orderBy("outcome").collect():
        logger.info("%s: %d (%s%s)", r.outcome, r.n, ", ".join(names[r.outcome]), ", ..." if r.n > NAMED else "")
    for r in made.warnings.orderBy("scope", "message").limit(NAMED).collect():
        logger.warning("%s: %s%s", r.scope, r.message, f" ({r.url})" if r.url else "")


def collect(args: argparse.Namespace) -> int:
    config = C.load(args.config)
    period = build_period(config.days, args.start_date, args.end_date)
    target = C.output_path(args.config, config.file, org=config.org, start_date=period.start_date, end_date=period.end_date)
    counts: dict[str, object] = {"issues": 0, "pull_requests": 0, "failed_requests": 0, "rate_limit_remaining": None}
    if not args.dry_run:
        if not os.environ.get(config.token_env):
            raise CommandError(f"Missing GitHub token environment variable: {config.token_env}")
        spark = session()
        service = service_for(period, args.base_url, config.org, config.token_env, rate=float(args.requests_per_second), workers=args.workers, transport=args.transport)
        folder = args.snapshot or scratch(spark, "collect")
        with progress():
            logger.info("Starting GitHub collection of %s, %s through %s", config.org, period.start_date, period.end_date)
            made = ingest(snapshot(spark, service, period, folder), period, keeper(spark, f"{folder}/typed-{uuid.uuid4().hex}"))
            counts = made.summary.first().asDict()
            _tell(made)
            logger.info("Rendering Markdown evidence")
            rows = fragments(made, config.org, period, datetime.now(UTC))
            logger.info("Writing evidence file: %s", target)
            write_document(rows, target)
            logger.info("Evidence collection completed")
    rate = counts["rate_limit_remaining"]
    print(f"Organization: {config.org}\nScan start: {period.local_start.isoformat()}\nScan end: {period.local_end.isoformat()}\nTimezone: {TIMEZONE}")
    print(f"Issues: {counts['issues']}\nPull requests: {counts['pull_requests']}\nAPI request failures: {counts['failed_requests']}\nEvidence file: {target}")
    print(f"GitHub API rate limit remaining: {'unknown' if rate is None else rate}")
    if args.dry_run:
        print("Dry run: no GitHub requests were made and no evidence file was written.")
    return 0


def view(args: argparse.Namespace) -> int:
    docs = indexed_item(session(), args.document, args.kind, args.item_id) if args.command == "item" and args.document.exists() else None
    docs = _documents(args.document) if docs is None else docs
    if args.command == "overview":
        row = reader.overview(docs).first()
        note = f"overview bytes: {row.bytes}"
    elif args.command == "index":
        row = reader.index(docs, args.kind, args.offset, args.limit, args.max_bytes).first()
        note = f"items {row.first}-{row.last} of {row.total}; output bytes: {len(row.text.encode())}; " + ("end of index" if row.next_offset is None else f"next offset: {row.next_offset}")
    else:
        row = reader.item(docs, args.kind, args.item_id, args.view, args.chunk, args.max_bytes).first()
        more = f"use --chunk {row.chunk + 1} for the next chunk" if row.chunk < row.chunks else "end of item view"
        note = f"chunk {row.chunk}/{row.chunks}; output bytes: {len(row.text.encode())}; view bytes: {row.view_bytes}; {more}"
    sys.stdout.write(row.text)
    print(note, file=sys.stderr)
    return 0


def check_report(args: argparse.Namespace) -> int:
    found = report_rules.in_order(report_rules.findings(_documents(args.report), report_rules.Style(args.org, args.title))).collect()
    for f in found:
        print("error: " + ("" if f.line_no is None else f"line {f.line_no}: ") + f.message, file=sys.stderr)
    if not found:
        print("Report format is valid.")
    return 1 if found else 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        if args.command == "validate-config":
            config = C.load(args.config)
            period = build_period(config.days)
            C.output_path(args.config, config.file, org=config.org, start_date=period.start_date, end_date=period.end_date)
            print("Configuration is valid.")
            return 0
        return {"collect": collect, "check-report": check_report}.get(args.command, view)(args)
    except (CommandError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
    except PySparkException as e:
        print(f"error: {str(e).splitlines()[0]}", file=sys.stderr)
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
