"""Command line: ``python -m ledgertalk build|validate|prepare|compare|losses|figures``."""

from __future__ import annotations

import argparse
import sys

from ledgertalk.config import PROFILES, Recipe
from ledgertalk.operators import quality
from ledgertalk.plans import job
from ledgertalk.session import session
from ledgertalk.sources.scratch import discard_scratch
from ledgertalk.sources.sinks import write_csv


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgertalk")
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="transaction CSV to chat data and statistics")
    build.add_argument("--input", required=True)
    build.add_argument("--output", required=True)
    build.add_argument("--profile", choices=PROFILES, default="n")
    for name in ("max_orders", "max_products", "max_recs", "max_cancellations", "seed"):
        build.add_argument(f"--{name}", type=int)
    build.add_argument(
        "--max_items_per_basket", "--max_basket_size_for_pairs", dest="basket_cap", type=int
    )
    build.add_argument("--train_ratio", type=float)
    build.add_argument("--files", type=int, help="JSONL files per split; their bytes decide without it")

    validate = commands.add_parser("validate", help="check JSONL lines")
    validate.add_argument("paths", nargs="+")
    validate.add_argument("--max_check", type=int, help="lines of each file")
    validate.add_argument("--report", help="folder for a CSV of all faulty lines")

    prepare = commands.add_parser("prepare", help="JSONL to model text and a packing plan")
    prepare.add_argument("--train", required=True)
    prepare.add_argument("--validation", required=True)
    prepare.add_argument("--output", required=True)
    prepare.add_argument("--max_seq_length", type=int, default=1024)
    prepare.add_argument("--max_train", type=int, default=job.SUBSET["train"])
    prepare.add_argument("--max_validation", type=int, default=job.SUBSET["validation"])
    prepare.add_argument("--seed", type=int, default=42)

    compare = commands.add_parser("compare", help="replies of two models side by side")
    compare.add_argument("--base", required=True)
    compare.add_argument("--tuned", required=True)
    compare.add_argument("--output", required=True)

    losses = commands.add_parser("losses", help="training log to a loss curve")
    losses.add_argument("--log", required=True)
    losses.add_argument("--output", required=True)

    figures = commands.add_parser("figures", help="statistics folders to report tables")
    figures.add_argument("--profile", choices=PROFILES, default="n")
    figures.add_argument("--stats", required=True, help="stats folder, or eda in profile s")
    figures.add_argument("--output", required=True)
    return parser.parse_args(argv)


def recipe_from(args: argparse.Namespace) -> Recipe:
    settable = (
        "max_orders",
        "max_products",
        "max_recs",
        "max_cancellations",
        "basket_cap",
        "train_ratio",
        "seed",
    )
    given = {name: getattr(args, name) for name in settable if getattr(args, name) is not None}
    return Recipe.for_profile(args.profile, **given)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = session(f"ledgertalk-{args.command}")
    try:
        if args.command == "build":
            job.build(spark, args.input, args.output, recipe_from(args), args.files)
        elif args.command == "prepare":
            job.prepare(
                spark,
                args.train,
                args.validation,
                args.output,
                args.max_seq_length,
                args.seed,
                {"train": args.max_train, "validation": args.max_validation},
            )
        elif args.command == "figures":
            tables = job.figures_s if args.profile == "s" else job.figures
            tables(spark, args.stats, args.output)
        elif args.command == "compare":
            job.compare(spark, args.base, args.tuned, args.output)
        elif args.command == "losses":
            job.losses(spark, args.log, args.output)
        else:
            return validate(spark, args.paths, args.max_check, args.report)
    finally:
        discard_scratch(spark)
        spark.stop()
    return 0


# Faulty lines that are printed of each path; all are in the report.
SHOWN = 20


def validate(spark, paths: list[str], max_check: int | None, report: str | None = None) -> int:
    faulty = 0
    for at, path in enumerate(paths):
        lines = job.checked(spark, path, max_check)
        # At most one row per rule.
        for row in quality.fault_counts(lines).collect():
            print(f"{path}\t{row.result}\t{row.line_count}")
            faulty += row.result != "ok"
        bad = quality.violations(lines)
        for row in bad.orderBy("file", "line_no").limit(SHOWN).collect():
            print(f"{row.file}:{row.line_no}\t{row.fault}")
        if report is not None:
            write_csv(bad, f"{report}/{at}", files=None, order=["file", "line_no"])
    return 1 if faulty else 0


if __name__ == "__main__":
    sys.exit(main())
