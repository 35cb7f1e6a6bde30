"""Command line of the two scheduled jobs.

    python -m trafficlens reports --facts DIR --out DIR [--config FILE] [--tier T] [--now T]
    python -m trafficlens site-pages --page-views DIR --out DIR [--start D] [--end D] ...
    python -m trafficlens declare-tables --out DIR [--tier T] [--database NAME]

Each runs in the session that spark-submit or the environment configures.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence
from pathlib import Path

from trafficlens.functions.calendar import resolve_run_dates
from trafficlens.plans import jobs
from trafficlens.schemas import OUTPUTS
from trafficlens.session import build_session, drop_staged
from trafficlens.sinks.datasets import TIERS, declare_tables
from trafficlens.sources.readers import read_fact, read_views


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trafficlens")
    commands = parser.add_subparsers(dest="command", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--out", required=True, help="root of the published datasets")
    shared.add_argument("--tier", choices=TIERS, default="test")
    shared.add_argument(
        "--now",
        type=dt.datetime.fromisoformat,
        default=dt.datetime.now(dt.timezone.utc),
        help="time of the run, UTC unless it has an offset",
    )
    reports = commands.add_parser("reports", parents=[shared])
    reports.add_argument("--facts", required=True)
    reports.add_argument("--config", type=Path)
    reports.add_argument("--views", help="view dimension, JSON lines")
    reports.add_argument("--sessions", help="folder that keeps sessions from run to run")
    reports.add_argument(
        "--delivered",
        nargs="*",
        default=(),
        choices=("daily", "monthly"),
        help="reports stored ready made under the facts",
    )
    pages = commands.add_parser("site-pages", parents=[shared])
    pages.add_argument("--page-views", required=True)
    pages.add_argument("--start", type=dt.date.fromisoformat)
    pages.add_argument("--end", type=dt.date.fromisoformat)
    tables = commands.add_parser("declare-tables", parents=[shared])
    tables.add_argument("--database", default="default")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"trafficlens {args.command}")
    if args.command == "reports":
        run = resolve_run_dates(spark, args.now)
        config = jobs.ReportConfig.from_json(args.config.read_text() if args.config else "{}")
        views = read_views(spark, args.views) if args.views else None
        try:
            facts = jobs.stored_facts(
                spark, args.facts, run, views, args.delivered, args.sessions
            )
            jobs.publish_reports(spark, facts, config, run, args.out, args.tier)
        finally:
            drop_staged(spark)
    elif args.command == "site-pages":
        page_views = read_fact(spark, args.page_views, "page_views")
        jobs.publish_site_pages(
            spark, page_views, args.out, args.now, args.tier, args.start, args.end
        )
    else:
        undated = [name for name in OUTPUTS if name != "monitoring_location_pages"]
        declare_tables(spark, args.out, args.tier, undated, args.database)


if __name__ == "__main__":
    main()
