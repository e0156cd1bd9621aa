"""Command line: mine, mine-multiple, mine-continuation, merge, recover."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import functions as F

from . import sinks
from .plans import jobs, mining, recover
from .session import get_spark
from .sources import dataset
from .storage import written


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docweft", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    mine = commands.add_parser("mine")
    mine.add_argument("--repo-url", required=True)
    mine.add_argument("--cache-dir", default="cache")
    mine.add_argument("--output-dir", default="output")
    mine.add_argument("--max-commits", type=int, default=1000)
    mine.add_argument("--max-samples", type=int, default=50)
    mine.add_argument("--full-history", action="store_true")
    mine.add_argument("--force-refresh", action="store_true")
    mine.add_argument("--skip-commits", type=int, default=0)
    mine.add_argument("--no-fetch-existing", action="store_true")
    mine.add_argument("--progress-interval", type=int, default=0)
    for name in ("mine-multiple", "mine-continuation"):
        many = commands.add_parser(name)
        many.add_argument("--repositories", required=True, help="JSON array of {name, url}")
        many.add_argument("--root-dir", default=".")
        many.add_argument("--final-dir", default="final_dataset")
        many.add_argument("--cache-dir", default="cache")
        many.add_argument("--baseline-dir", default="", required=name == "mine-continuation")
        many.add_argument("--target-total", type=int, default=1000 if name == "mine-multiple" else 3000)
        many.add_argument("--start-from", default="")
        many.add_argument("--max-commits-per-repo", type=int)
        many.add_argument("--max-repos", type=int)
        many.add_argument("--dry-run", action="store_true")
        many.add_argument("--force-refresh", action="store_true")
        if name == "mine-continuation":
            many.add_argument("--expected-baseline", type=int, help="number of samples the baseline must have")
    recover = commands.add_parser("recover")
    recover.add_argument("--nested", required=True, help="grouped dataset: Parquet as merge writes it, or JSON")
    recover.add_argument("--cache-dir", default="cache")
    recover.add_argument("--output-dir", required=True)
    recover.add_argument("--least-changes", type=int, default=3)
    recover.add_argument("--only", nargs=2, action="append", default=[], metavar=("PROJECT", "COMMIT"))
    recover.add_argument("--force-refresh", action="store_true")
    recover.add_argument("--no-fetch-existing", action="store_true")
    merge = commands.add_parser("merge")
    merge.add_argument("--old-dir", required=True)
    merge.add_argument("--new-dir", required=True)
    merge.add_argument("--commits", default="", help="Parquet table of commits for weak summaries")
    merge.add_argument("--output-dir", required=True)
    merge.add_argument("--expected-old", type=int, help="number of samples the older dataset must have")
    merge.add_argument("--expected-new", type=int, help="number of samples the newer dataset must have")
    merge.add_argument("--backup-dir", default="", help="where to keep the sources' metadata, statistics and descriptions as they were")
    return parser


def _recover(spark, args) -> dict:  # noqa: ANN001
    nested = dataset.read_nested(spark, args.nested) if args.nested.endswith(".json") else spark.read.parquet(args.nested)
    if "row_seq" not in nested.columns:
        order = F.col("first_order") if "first_order" in nested.columns else F.monotonically_increasing_id()
        nested = written(nested.withColumn("row_seq", order), "nested")
    options = recover.RecoverOptions(args.cache_dir, args.output_dir, args.least_changes, [tuple(x) for x in args.only], args.force_refresh, not args.no_fetch_existing)
    return recover.recover_repositories(spark, nested, options)


def _merge(spark, args) -> dict:  # noqa: ANN001
    if args.backup_dir:
        for side, folder in (("old", args.old_dir), ("new", args.new_dir)):
            sinks.backup([f"{folder}/{n}" for n in ("validation_report.json", "README.md")], f"{args.backup_dir}/{side}")
            for project in sinks.folders(folder):
                sinks.backup([f"{project}/{n}" for n in ("metadata.json", "stats.json", "combined_samples.json")], f"{args.backup_dir}/{side}/{project.rpartition('/')[2]}")
    old = dataset.read_samples(spark, args.old_dir, "old").withColumn("batch_id", F.lit(0))
    new = dataset.read_samples(spark, args.new_dir, "new").withColumn("batch_id", F.lit(1))
    sinks.require_rows(old, args.expected_old, args.old_dir)
    sinks.require_rows(new, args.expected_new, args.new_dir)
    # Rows of both datasets keep their own order; the merged number is unique.
    both = old.unionByName(new).withColumns({"sample_id": F.col("source_order") * 2 + F.col("batch_id"), "repo": F.lit("")})
    empty = "commit_seq bigint, project_slug string, commit_hash string, message string"
    commits = spark.read.parquet(args.commits) if args.commits else spark.createDataFrame([], empty)
    parts = jobs.merge_and_clean(both, commits)
    for name in ("nested", "flat", "rejected", "duplicates", "unresolved", "conflicts", "findings"):
        parts[name].write.mode("overwrite").parquet(f"{args.output_dir}/{name}")
    sinks.write_summary(parts["summary"], args.output_dir)
    return parts["summary"].first().asDict()


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_spark("docweft")
    if args.command == "mine":
        options = mining.MineOptions(
            args.repo_url, args.cache_dir, args.output_dir, args.max_commits, args.max_samples, args.full_history, args.force_refresh, args.skip_commits, not args.no_fetch_existing,
            progress_interval=args.progress_interval,
        )
        result: object = mining.mine_repository(spark, options)
    elif args.command == "merge":
        result = _merge(spark, args)
    elif args.command == "recover":
        result = _recover(spark, args)
    else:
        specs = [mining.Repository(r["name"], r["url"]) for r in json.loads(Path(args.repositories).read_text(encoding="utf-8"))]
        options = mining.ManyOptions(
            args.root_dir, args.final_dir, args.cache_dir, args.target_total, args.start_from, args.max_commits_per_repo, args.max_repos, args.dry_run, args.force_refresh, args.baseline_dir
        )
        if args.command == "mine-continuation":
            result = mining.mine_continuation(spark, options, specs, args.expected_baseline)
        else:
            result = mining.plan(options, specs) if args.dry_run else mining.mine_multiple(spark, options, specs)
    print(json.dumps(result, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
