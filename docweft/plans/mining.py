"""Mining repositories: one, many up to a target, and continuation of a frozen dataset."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import messages, paths, summaries
from ..functions.text import fingerprint
from ..operators import dedup, entities, quality
from ..operators.running import numbered
from ..sources import dataset, git
from ..storage import written
from . import jobs

SIX = sinks.SIX


@dataclass
class Repository:
    name: str
    url: str

    @property
    def slug(self) -> str:
        return "_".join("".join(c if c.isascii() and c.isalnum() else " " for c in self.name.lower()).split())


@dataclass
class MineOptions:
    repo_url: str
    cache_dir: str
    output_dir: str
    max_commits: int = 1000
    max_samples: int | None = 50
    full_history: bool = False
    force_refresh: bool = False
    skip_commits: int = 0
    fetch_existing: bool = True
    git_timeout: float = 180
    chunk_commits: int = 500  # read at first; each further chunk is twice as large, until enough samples are found
    progress_interval: int = 0  # print a line when this many commits more have been read; 0: never


@dataclass
class ManyOptions:
    root_dir: str
    final_dir: str
    cache_dir: str
    target_total: int = 1000
    start_from: str = ""
    max_commits_per_repo: int | None = None
    max_repos: int | None = None
    dry_run: bool = False
    force_refresh: bool = False
    baseline_dir: str = ""
    extra: dict = field(default_factory=dict)


def mined(spark: SparkSession, options: MineOptions, clone: str, skip: int, take: int) -> tuple[DataFrame, dict]:
    """(samples with disposition, counters) of ``take`` commits after ``skip``; commits are gated before blobs are read."""
    read = git.commits(
        spark, clone, fullHistory=str(options.full_history), maxCommits=str(options.max_commits), skipCommits=str(skip), takeCommits=str(take), timeout=str(options.git_timeout)
    )
    flags = read.withColumns(
        {"has_docs": F.coalesce(paths.has_doc_changes(F.col("patch")), F.lit(False)), "has_code": F.coalesce(paths.has_code_changes(F.col("patch")), F.lit(False)), "low": messages.is_low_signal_message(F.col("message"))}
    ).select("scan_seq", "commit_hash", "message", "name_status", "has_docs", "has_code", "low")
    flags = written(flags, "mined-commits")
    counters = flags.agg(
        F.count("*").alias("total_commits_scanned"), F.count_if("has_docs").alias("total_commits_containing_javadoc_changes"),
        F.count_if(F.col("has_docs") & F.col("has_code")).alias("total_commits_containing_code_and_javadoc_changes"),
    ).first().asDict()
    good = flags.where("has_docs and has_code and not low")
    targets = good.select("commit_hash", "scan_seq", F.posexplode(paths.changed_paths(F.col("name_status"))).alias("file_seq", "path"))
    told = jobs.samples_of(jobs.aligned_pairs(*entities_of(targets, clone, git.repository_path(options.repo_url))))
    summary = summaries.with_fallback(F.col("message"))
    described = flags.select("commit_hash", F.col("message").alias("commit_message"), summary.alias("_s"), F.coalesce(F.get(messages.issue_ids(F.col("message")), F.lit(0)), F.lit("")).alias("issue_id"))
    base = git.commit_url(options.repo_url, clone, "")
    samples = told.join(described, "commit_hash").select(
        F.lit(git.repository_path(options.repo_url)).alias("repo"), "commit_hash", "commit_message", F.col("_s.summary").alias("issue_summary"), *jobs.TEXTS,
        "entity_name", "entity_signature", F.lit("JAVADOC_MODIFICATION").alias("javadoc_change_type"), F.lit("METHOD_MODIFICATION").alias("method_change_type"), "issue_id",
        F.concat(F.lit(base), "commit_hash").alias("commit_url"), "entity_type", F.col("path").alias("file_path"), F.col("_s.fallback").alias("issue_summary_fallback_applied"),
        "change_type", "disposition", "reason", "scan_seq", "file_seq", "new_id",
    )
    return written(samples, "mined"), counters


def entities_of(targets: DataFrame, clone: str, project: str) -> tuple[DataFrame, DataFrame]:
    """(entities, files) of the paths in ``targets`` (commit_hash, scan_seq, file_seq, path), both with numbers of their own.

    A file's number is its commit's and its own, 32 bits each; entities are numbered in order, so no two share one.
    """
    files = git.file_changes(targets.select("commit_hash", "scan_seq", "file_seq", "path"), clone)
    files = written(files.withColumns({"file_id": F.shiftleft(F.col("scan_seq").cast("bigint"), 32) + F.col("file_seq"), "project_slug": F.lit(project)}), "mined-files")
    found = written(entities.extract_entities(entities.both_sides(files)), "mined-entities")
    return numbered(found, [], ["file_id", "side", "entity_seq"], "entity_id"), files


ORDER = ["scan_seq", "file_seq", "new_id"]


def candidates(spark: SparkSession, options: MineOptions, baseline: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """(samples, counters) of a repository: commits are read in growing chunks and no further once ``max_samples`` are retained.

    Of equal contents the first in scan order stays, whatever chunk it is in; what stands in ``baseline`` is left out and counted.
    """
    clone = git.clone_or_update(options.repo_url, options.cache_dir, options.force_refresh, options.fetch_existing)
    skip, take, told, samples, known, stopped = options.skip_commits, max(1, options.chunk_commits), {}, None, 0, False
    while True:
        more, counters = mined(spark, options, clone, skip, take)
        told = {k: told.get(k, 0) + v for k, v in counters.items()}
        if options.progress_interval and (skip + counters["total_commits_scanned"]) // options.progress_interval > skip // options.progress_interval:
            print(f"{options.repo_url}: {told['total_commits_scanned']} commits read", flush=True)
        samples = more if samples is None else samples.unionByName(more)
        first = dedup.keep_first(samples.withColumn("fp", fingerprint(*[F.col(c) for c in jobs.TEXTS])), ["fp"], ORDER, ["scan_seq", "file_seq", "new_id", "commit_hash"])
        unique = samples.join(first.select("scan_seq", "file_seq", "new_id"), ORDER, "left_semi")
        fresh = unique if baseline is None else dedup.not_in(unique, baseline, SIX)
        retained = fresh.where("disposition = 'retain'").count()
        stopped = options.max_samples is not None and retained >= options.max_samples
        if stopped or counters["total_commits_scanned"] < take:
            break
        skip, take = skip + take, take * 2
    if baseline is not None:
        known = unique.count() - fresh.count()
    return fresh, told | {"duplicate_against_baseline": known, "history_complete": options.full_history and not stopped}


def mine_repository(spark: SparkSession, options: MineOptions, baseline: DataFrame | None = None) -> dict:
    """Mines one repository into ``output_dir`` and returns its counters; samples that stand in ``baseline`` are left out and counted."""
    samples, stats = candidates(spark, options, baseline)
    return stats | write_mined(samples, options.output_dir, options.max_samples, stats)


def write_mined(samples: DataFrame, folder: str, most: int | None, stats: dict) -> dict:
    """Writes samples, their review part, their discarded part and counters; gives the counters of what came out."""
    kept = sinks.write_samples(samples, folder, ORDER, most)
    told = samples.agg(
        F.count("*").alias("candidate_samples_found"), F.count_if(F.col("disposition") == "review").alias("moved_to_review"),
        F.count_if(F.col("reason").startswith("truncated_code_context")).alias("discarded_truncated_code_context"), F.count_if(F.col("reason") == "weak_inheritdoc_only").alias("discarded_weak_inheritdoc"),
    ).first().asDict()
    last = kept.agg(F.count("*").alias("n"), F.count_if("issue_summary_fallback_applied").alias("f")).first()
    told |= {"samples_retained": last["n"], "issue_summary_fallbacks": last["f"], "samples_filtered": max(0, told["candidate_samples_found"] - last["n"] - told["moved_to_review"])}
    sinks.write_json(f"{folder}/stats.json", stats | told)
    return told


def selected(repositories: Iterable[Repository], start_from: str = "", most: int | None = None) -> list[Repository]:
    specs = list(repositories)
    if start_from:
        at = next((i for i, r in enumerate(specs) if start_from.lower() in (r.name.lower(), r.slug)), None)
        if at is None:
            raise ValueError(f"unknown repository: {start_from}")
        specs = specs[at:]
    return specs[:most] if most is not None else specs


def stop_reason(stats: dict, kept: int, remaining: int, options: ManyOptions) -> str:
    if stats.get("history_complete"):
        return "full_history_scanned"
    if options.max_commits_per_repo is not None:
        return f"max_commits_per_repo={options.max_commits_per_repo} reached"
    return f"target_total={options.target_total} reached" if kept >= remaining else "history_incomplete"


def read_final(spark: SparkSession, folder: str) -> DataFrame:
    """The samples of all projects under a final folder, with their project; none if there are none."""
    if sinks.latest(folder, "") is None:
        return spark.createDataFrame([], "project_slug string, source_order bigint, " + ", ".join(f"{c} string" for c in SIX))
    return dataset.read_samples(spark, folder, "final").select("project_slug", "source_order", *SIX)


def dataset_count(spark: SparkSession, folder: str) -> int:
    return read_final(spark, folder).count()


def plan(options: ManyOptions, repositories: Iterable[Repository]) -> list[dict]:
    """What a run would do with each source, without doing it: skip complete ones, mine the others in order."""
    out = []
    for spec in selected(repositories, options.start_from, options.max_repos):
        metadata = sinks.read_json(f"{options.final_dir}/{spec.slug}/metadata.json", {})
        out.append({"repository": spec.name, "slug": spec.slug, "action": "skip" if isinstance(metadata, dict) and metadata.get("complete_history") else "mine"})
    return out


def mine_multiple(spark: SparkSession, options: ManyOptions, repositories: Iterable[Repository]) -> list[dict]:
    """Sources in order until the target is reached; bounded runs are never promoted, a failing source is passed over."""
    specs = {r.slug: r for r in selected(repositories, options.start_from, options.max_repos)}
    steps = plan(options, specs.values())
    if options.dry_run:
        return []
    total, done = dataset_count(spark, options.final_dir), []
    baseline = read_final(spark, options.baseline_dir) if options.baseline_dir else None
    for step in steps:
        if total >= options.target_total:
            break
        if step["action"] == "skip":
            continue
        spec, remaining = specs[step["slug"]], options.target_total - total
        staged = f"{options.root_dir}/dataset_{spec.slug}_in_progress"
        mine = MineOptions(
            spec.url, options.cache_dir, staged, options.max_commits_per_repo or 1000, remaining, options.max_commits_per_repo is None, options.force_refresh
        )
        try:
            stats = mine_repository(spark, mine, baseline)
        except (git.GitError, OSError) as error:
            done.append({"repository": spec.name, "project_slug": spec.slug, "error": str(error)[:1000]})
            continue
        kept = stats["samples_retained"]
        metadata = {
            "repository": spec.name, "repository_url": spec.url, "project_slug": spec.slug, "retained_samples": kept, **stats, "complete_history": bool(stats["history_complete"]),
            "stop_reason": stop_reason(stats, kept, remaining, options), "mined_at_utc": datetime.now(UTC).isoformat(timespec="seconds"),
        }
        sinks.write_json(f"{staged}/metadata.json", metadata)
        target = f"{options.root_dir}/dataset_{spec.slug}_{kept}" if options.max_commits_per_repo is not None else f"{options.final_dir}/{spec.slug}"
        sinks.promote(staged, target)
        done.append(metadata)
        total = dataset_count(spark, options.final_dir)
    summarise_projects(spark, options.final_dir)
    return done


# Columns of the summary of projects.
PROJECT_COLUMNS = (
    "repository repository_url project_slug retained_samples total_commits_scanned total_commits_containing_javadoc_changes total_commits_containing_code_and_javadoc_changes "
    "candidate_samples_found samples_filtered moved_to_review issue_summary_fallbacks complete_history stop_reason mined_at_utc"
).split()
CONTINUATION_COLUMNS = [*PROJECT_COLUMNS, "duplicate_against_baseline", "duplicate_inside_new"]


def summarise_projects(spark: SparkSession, folder: str, columns: Iterable[str] = tuple(PROJECT_COLUMNS)) -> None:
    """Writes one line a project from the metadata files of a final folder."""
    rows = [r for f in sinks.folders(folder) if isinstance(r := sinks.read_json(f"{f}/metadata.json", None), dict)]
    sinks.write_projects(spark, sorted(rows, key=lambda r: str(r.get("project_slug"))), list(columns), folder)


def first_incomplete(options: ManyOptions, repositories: Iterable[Repository]) -> str:
    """The first source whose history is not complete; empty if all are."""
    return next((s["slug"] for s in plan(options, repositories) if s["action"] == "mine"), "")


def mine_continuation(spark: SparkSession, options: ManyOptions, repositories: Iterable[Repository], expected_baseline: int | None = None) -> dict:
    """Adds to a final folder what is neither in the baseline nor collected yet, from the first incomplete source on.

    A source that was read in part goes on after the commits it has read. Each project's samples are its old ones and the
    new, numbered on. Repeat counters never go down. At the end all samples are checked against the baseline.
    """
    specs = list(repositories)
    if not options.baseline_dir:
        raise ValueError("a continuation needs a baseline")
    baseline = written(read_final(spark, options.baseline_dir), "baseline")
    sinks.require_rows(baseline, expected_baseline, options.baseline_dir)
    start = options.start_from or first_incomplete(options, specs)
    chosen = selected(specs, start, options.max_repos) if start else []
    if options.dry_run:
        return {"plan": plan(options, chosen)}
    done = []
    for spec in chosen:
        collected = written(read_final(spark, options.final_dir), "collected")
        remaining = options.target_total - collected.count()
        final, staged = f"{options.final_dir}/{spec.slug}", f"{options.root_dir}/dataset_{spec.slug}_in_progress"
        held = sinks.read_json(f"{final}/metadata.json", {})
        if remaining <= 0 or held.get("complete_history"):
            continue
        read_before = int(held.get("total_commits_scanned") or 0)
        mine = MineOptions(spec.url, options.cache_dir, staged, options.max_commits_per_repo or 1000, None, options.max_commits_per_repo is None, options.force_refresh, read_before)
        try:
            samples, stats = candidates(spark, mine)
        except (git.GitError, OSError) as error:
            done.append({"repository": spec.name, "project_slug": spec.slug, "error": str(error)[:1000]})
            continue
        ordered = numbered(samples, [], ORDER, "source_order").withColumn("project_slug", F.lit(spec.slug))
        keep = written(ordered.where("disposition = 'retain'"), "retained")
        fresh, repeats = continuation(keep, baseline, collected, remaining)
        old = collected.where(F.col("project_slug") == spec.slug).select((F.col("source_order") - F.lit(2**40)).alias("source_order"), *SIX)
        both = numbered(old.unionByName(fresh.select("source_order", *SIX)), [], ["source_order"], "_n").withColumn("sample_id", F.format_string("sample_%04d", "_n"))
        both.select("sample_id", *SIX).write.mode("overwrite").option("ignoreNullFields", False).json(f"{staged}/samples")
        samples.where("disposition = 'review'").select(F.col("reason").alias("review_reason"), *SIX).write.mode("overwrite").json(f"{staged}/review")
        told = repeats.first().asDict()
        kept = both.count()
        totals = {k: int(held.get(k) or 0) + v for k, v in stats.items() if k.startswith("total_commits")}
        repeated = {k: max(int(held.get(k) or 0), told[k]) for k in told}
        metadata = {
            "repository": spec.name, "repository_url": spec.url, "project_slug": spec.slug, "retained_samples": kept, **totals, **repeated,
            "complete_history": bool(stats["history_complete"]) and kept - old.count() < remaining, "stop_reason": stop_reason(stats, kept, remaining, options),
            "mined_at_utc": datetime.now(UTC).isoformat(timespec="seconds"),
        }
        sinks.write_json(f"{staged}/metadata.json", metadata)
        sinks.promote(staged, final)
        done.append(metadata)
    every = read_final(spark, options.final_dir)
    checks = {r["check"]: r["findings"] for r in quality.by_check(quality.flat_findings(every, baseline, "source_order")).collect()}
    report = {"samples": every.count(), "baseline": baseline.count(), "findings": checks}
    sinks.write_json(f"{options.final_dir}/validation_report.json", report)
    summarise_projects(spark, options.final_dir, CONTINUATION_COLUMNS)
    sinks.write_text(f"{options.final_dir}/README.md", render_readme("Continuation", {"samples": report["samples"], **checks}, [{c: r.get(c, "") for c in ("project_slug", "retained_samples", "stop_reason")} for r in done]))
    return {"projects": done, "validation": report}


def continuation(samples: DataFrame, baseline: DataFrame, collected: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(new samples in order, one-row duplicate counters): what is neither in the baseline nor collected yet.

    ``samples`` has project_slug, the six fields and a total ``source_order``; keys are not normalised.
    """
    keys = ["project_slug", *SIX]
    frozen = baseline.select(*keys).withColumn("_from", F.lit("baseline")).unionByName(collected.select(*keys).withColumn("_from", F.lit("collected")))
    told = dedup.against_frozen(samples, frozen.where("_from = 'baseline'"), keys, "source_order")
    fresh = dedup.not_in(told.where("outcome = 'new'"), frozen.where("_from = 'collected'"), keys)
    kept = fresh if most is None else fresh.orderBy("source_order").limit(most)
    counters = told.agg(F.count_if(F.col("outcome") == "in_frozen").alias("duplicate_against_baseline"), F.count_if(F.col("outcome") == "repeated").alias("duplicate_inside_new"))
    return kept.drop("outcome"), counters


def refresh(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(all distinct samples, project counts) of a final folder, made anew from its projects.

    Counts are taken before repeats across projects are dropped, so their sum can exceed the samples.
    """
    sound = read_final(spark, folder)
    first = dedup.keep_first(sound, ["project_slug", *SIX], ["source_order"], ["source_order"])
    return first.drop("copies"), sound.groupBy("project_slug").agg(F.count("*").alias("retained_samples"))


def render_readme(title: str, summary: dict, projects: Iterable[dict] = ()) -> str:
    """A dataset's Markdown description from its summary and project rows."""
    lines = [f"# {title}", "", "| Figure | Value |", "| --- | ---: |", *(f"| {k} | {v} |" for k, v in summary.items())]
    rows = list(projects)
    if rows:
        head = list(rows[0])
        lines += ["", "| " + " | ".join(head) + " |", "| " + " | ".join("---" for _ in head) + " |", *("| " + " | ".join(str(r.get(h, "")) for h in head) + " |" for r in rows)]
    return "\n".join(lines) + "\n"
