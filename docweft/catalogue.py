"""The library's own queries over the test tables, and the SQL that gives the same rows.

``samples`` stand for flat changes (``sample_id`` is their order, batch 0 the frozen dataset), ``commits_nested``
for grouped datasets, ``commits``, ``file_changes`` and ``entities`` for what is mined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import java_scan, javadoc, messages, paths, summaries
from .functions.kernels import seq_ratio, spelling_only
from .functions.text import fingerprint, line_form, slug
from .functions.tokens import identifier_shape, java_tokens, multiset_minus
from .operators import classify, dedup, entities, issues, limits, nest, quality, summarize
from .oracle import SQL
from .plans import jobs, recover
from .storage import ship, table

Query = Callable[[SparkSession, str], DataFrame]
TEXTS = ["code_before", "code_after", "javadoc_before", "javadoc_after"]
_QUERIES: dict[str, Query] = {}


def _query(*tables: str) -> Callable:
    """Registers a function of tables under its own name."""
    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return f(*[table(spark, folder, t) for t in tables])

        _QUERIES[f.__name__] = run
        return f

    return register


def _fp() -> F.Column:
    return fingerprint(*[F.col(c) for c in TEXTS])


def _flat(samples: DataFrame) -> DataFrame:
    return samples.withColumns({"fp": _fp(), "dataset": F.when(F.col("batch_id") == 0, "old").otherwise("new"), "source_order": F.col("sample_id")})


# Normal forms and fingerprints


@_query("samples")
def norm_fingerprint(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", _fp().alias("fp"))


@_query("samples")
def line_normal_form(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", line_form(F.col("code_before")).alias("form"))


@_query("samples")
def layout_normal_form(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", javadoc.layout_form(F.col("javadoc_after")).alias("form"))


@_query("samples")
def format_normal_form(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", javadoc.format_form(F.col("javadoc_after")).alias("form"))


@_query("samples")
def format_only(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", javadoc.format_only_reason(F.col("javadoc_before"), F.col("javadoc_after")).alias("reason"))


@_query("samples")
def semantic_normal_form(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", F.array_join(javadoc.semantic_tokens(F.col("javadoc_after")), " ").alias("form"))


@_query("samples")
def substantive_change(samples: DataFrame) -> DataFrame:
    tokens = samples.select("sample_id", javadoc.semantic_tokens(F.col("javadoc_before")).alias("a"), javadoc.semantic_tokens(F.col("javadoc_after")).alias("b"))
    return javadoc.with_substantive(tokens, "a", "b").select("sample_id", "substantive")


@_query("samples")
def inheritdoc_weak(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", javadoc.is_weak_inheritdoc(F.col("javadoc_after")).alias("weak"))


@_query("samples")
def format_review(samples: DataFrame) -> DataFrame:
    fields = F.array(*[F.struct(F.lit(f).alias("field"), javadoc.format_review(F.col(f)).alias("reasons")) for f in TEXTS[2:]])
    each = samples.select("sample_id", F.explode(fields).alias("x"))
    return each.where(F.size("x.reasons") > 0).select("sample_id", "x.field", F.array_join("x.reasons", ",").alias("reasons"))


# Messages, paths, patches


@_query("commits")
def weak_summary(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", messages.is_weak_issue_summary(F.col("message")).alias("weak"))


@_query("samples")
def dangling_subject(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", messages.ends_with_dangling_word(F.col("issue_summary")).alias("dangling"))


@_query("samples")
def dangling_summary(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", messages.is_dangling_summary(F.col("issue_summary")).alias("dangling"))


@_query("commits")
def issue_ids(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", F.array_join(messages.issue_ids(F.col("message")), " ").alias("ids"))


@_query("commits")
def low_signal_filter(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", messages.is_low_signal_message(F.col("message")).alias("low_signal"))


@_query("commits")
def first_paragraph_summary(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", summaries.first_paragraph(F.col("message")).alias("summary"))


@_query("commits")
def summary_fallback(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", summaries.with_fallback(F.col("message")).alias("s")).select("commit_seq", "s.summary", "s.fallback")


@_query("commits")
def canonical_slug(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", slug(F.col("project_slug")).alias("slug"))


@_query("file_changes")
def path_filter(file_changes: DataFrame) -> DataFrame:
    return file_changes.select("file_id", paths.is_target_path(F.col("path")).alias("target"))


@_query("commits")
def commit_prefilter(commits: DataFrame) -> DataFrame:
    return commits.select("commit_seq", paths.has_doc_changes(F.col("patch")).alias("has_docs"), paths.has_code_changes(F.col("patch")).alias("has_code"))


@_query("commits")
def stats_funnel(commits: DataFrame) -> DataFrame:
    docs, code = paths.has_doc_changes(F.col("patch")), paths.has_code_changes(F.col("patch"))
    named = commits.withColumn("slug", slug(F.col("project_slug")))
    return summarize.funnel(named, {"with_docs": docs, "with_docs_and_code": docs & code, "worth_reading": docs & code & ~messages.is_low_signal_message(F.col("message"))}, "slug")


# Code


@_query("samples")
def brace_scan(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", java_scan.scan(F.col("code_after")).alias("s")).select("sample_id", "s.*")


@_query("samples")
def validate_snippet(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", java_scan.snippet_problem(F.col("code_after"), F.col("entity_type")).alias("problem"))


@_query("samples")
def infer_type(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", java_scan.infer_type(F.col("code_before"), F.col("code_after")).alias("inferred"))


@_query("samples")
def sample_dispositions(samples: DataFrame) -> DataFrame:
    weak = javadoc.is_weak_inheritdoc(F.col("javadoc_after"))
    return samples.select("sample_id", java_scan.disposition(F.col("code_before"), F.col("code_after"), F.col("entity_type"), weak).alias("d")).select("sample_id", "d.*")


@_query("samples")
def disposition_stats(samples: DataFrame) -> DataFrame:
    weak = javadoc.is_weak_inheritdoc(F.col("javadoc_after"))
    told = samples.select("project_slug", F.col("issue_summary_fallback_applied").alias("fallback"), java_scan.disposition(F.col("code_before"), F.col("code_after"), F.col("entity_type"), weak).alias("d"))
    return summarize.disposition_counts(told.select("project_slug", "fallback", "d.*"), "project_slug")


@_query("samples")
def java_token_counts(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", F.size(java_tokens(F.col("code_after"))).alias("tokens"))


@_query("samples")
def code_shape(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", F.array_join(identifier_shape(java_tokens(F.col("code_after"))), " ").alias("shape"))


@_query("samples")
def multiset_diff(samples: DataFrame) -> DataFrame:
    both = samples.select("sample_id", java_tokens(F.col("code_before")).alias("a"), java_tokens(F.col("code_after")).alias("b"))
    return both.select("sample_id", F.array_join(multiset_minus(F.col("a"), F.col("b")), " ").alias("removed"), F.array_join(multiset_minus(F.col("b"), F.col("a")), " ").alias("added"))


@_query("samples")
def substantial_code(samples: DataFrame) -> DataFrame:
    both = samples.select("sample_id", java_tokens(F.col("code_before")).alias("a"), java_tokens(F.col("code_after")).alias("b"))
    return both.select("sample_id", classify.substantial_code(F.col("a"), F.col("b")).alias("substantial"))


@_query("samples")
def doc_similarity(samples: DataFrame) -> DataFrame:
    pairs = samples.select("sample_id", F.col("javadoc_before").alias("old_doc"), F.col("javadoc_after").alias("new_doc"))
    return entities.doc_similarities(pairs).select("sample_id", F.round("similarity", 6).alias("similarity"))


@_query("samples")
def spelling_changes(samples: DataFrame) -> DataFrame:
    tokens = samples.select("sample_id", javadoc.semantic_tokens(F.col("javadoc_before")).alias("a"), javadoc.semantic_tokens(F.col("javadoc_after")).alias("b"))
    changed = tokens.withColumn("s", javadoc.substantive_change(F.col("a"), F.col("b")))
    return changed.select("sample_id", spelling_only(F.col("s.removed"), F.col("s.added")).alias("spelling_only"))


@_query("samples")
def token_ratio(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", F.round(seq_ratio(java_tokens(F.col("code_before")), java_tokens(F.col("code_after"))), 6).alias("ratio"))


# Entities


@_query("file_changes")
def parse_entities(file_changes: DataFrame) -> DataFrame:
    return entities.extract_entities(entities.both_sides(file_changes)).drop("parameters", "throws")


@_query("entities")
def align_entities(table_: DataFrame) -> DataFrame:
    return entities.align(table_)


@_query("samples")
def class_context(samples: DataFrame) -> DataFrame:
    pairs = samples.select(F.col("sample_id").alias("pair_id"), "entity_type", "code_before", "code_after")
    return entities.bounded_class_contexts(pairs)


@_query("samples")
def classify_changes(samples: DataFrame) -> DataFrame:
    none = F.expr("cast(null as array<string>)")
    same = {"entity_type": F.col("entity_type"), "name": F.col("entity_name"), "signature": F.col("entity_signature"), "parameters": none, "throws": none, "return_type": F.lit("")}
    sides = {f"{s}_{k}": v for s in ("old", "new") for k, v in same.items()}
    docs = {"old_javadoc": F.col("javadoc_before"), "new_javadoc": F.col("javadoc_after")}
    pairs = samples.withColumns({**sides, **docs, "pair_id": F.col("sample_id"), "code_changed": F.col("code_before") != F.col("code_after")})
    return classify.with_gates(pairs)


@_query("entities", "file_changes")
def recovery_reasons(table_: DataFrame, file_changes: DataFrame) -> DataFrame:
    return jobs.recovered_changes(table_, file_changes).groupBy("entity_type", "reason").agg(F.count("*").alias("changes"))


@_query("entities", "file_changes")
def mine_funnel(table_: DataFrame, file_changes: DataFrame) -> DataFrame:
    return jobs.pair_funnel(table_, file_changes)


@_query("commits", "file_changes", "entities")
def mine_job(commits: DataFrame, file_changes: DataFrame, table_: DataFrame) -> DataFrame:
    """The whole job's outcome a project: what was paired, and what of it came out as a sample, for review or not at all."""
    samples = jobs.mined_samples(commits, file_changes, table_)
    counts = samples.groupBy(slug(F.col("project_slug")).alias("slug")).agg(*[F.count_if(F.col("disposition") == d).alias(d) for d in ("retain", "review", "discard")])
    told = jobs.pair_funnel(table_, file_changes).join(counts, "slug", "left")
    return told.select("slug", "files", "pairs", "documented", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("retain", "review", "discard")])


# Deduplication, joins, order


@_query("samples")
def project_curation(samples: DataFrame) -> DataFrame:
    kept = dedup.keep_first(_flat(samples), ["fp"], ["sample_id"], ["sample_id", "project_slug"])
    return kept.groupBy("project_slug").agg(F.count("*").alias("changes"), F.sum("copies").alias("records"))


@_query("samples")
def dedup_keep_first(samples: DataFrame) -> DataFrame:
    return dedup.keep_first(_flat(samples), ["fp"], ["sample_id"], ["sample_id"])


def _priority(samples: DataFrame) -> DataFrame:
    flat = _flat(samples)
    rank = dedup.priority_rank(F.col("issue_summary"), F.col("dataset") == "old", F.col("source_order"), F.col("sample_id"))
    return dedup.priority_dedup(flat, "fp", rank, "sample_id")


@_query("samples")
def dedup_priority_audit(samples: DataFrame) -> DataFrame:
    return dedup.removed_groups(_priority(samples), "fp", "sample_id")


@_query("samples")
def dup_counts_by_dataset(samples: DataFrame) -> DataFrame:
    sets = _flat(samples).groupBy("fp").agg(F.array_join(F.array_sort(F.collect_set("dataset")), "+").alias("datasets"), F.count("*").alias("n"))
    return sets.where("n > 1").groupBy("datasets").agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("removed"))


@_query("samples")
def baseline_anti_join(samples: DataFrame) -> DataFrame:
    flat = _flat(samples)
    return dedup.not_in(flat.where("dataset = 'new'"), flat.where("dataset = 'old'"), ["project_slug", "fp"]).select("sample_id")


def _outcomes(samples: DataFrame) -> DataFrame:
    flat = _flat(samples).select("sample_id", "project_slug", "fp", "dataset")
    return dedup.against_frozen(flat.where("dataset = 'new'"), flat.where("dataset = 'old'"), ["project_slug", "fp"], "sample_id")


@_query("samples")
def baseline_anti_join_counts(samples: DataFrame) -> DataFrame:
    return _outcomes(samples).groupBy("project_slug", "outcome").agg(F.count("*").alias("rows"))


@_query("samples")
def baseline_filter_with_limit(samples: DataFrame) -> DataFrame:
    return dedup.filter_with_limit(_outcomes(samples), "project_slug", "sample_id", 5)


@_query("commits", "commits_nested")
def semi_target_commits(commits: DataFrame, nested: DataFrame) -> DataFrame:
    targets = nested.where(F.size("changes") > 2).select("commit_hash").where("commit_hash is not null").distinct()
    return commits.join(targets, "commit_hash", "left_semi").select("commit_seq")


@_query("samples", "repositories")
def lookup_left_coalesce(samples: DataFrame, repositories: DataFrame) -> DataFrame:
    urls = repositories.select(F.col("slug").alias("project_slug"), "url")
    return samples.join(urls, "project_slug", "left").select("sample_id", F.coalesce(F.nullif("repo", F.lit("")), "url", F.lit("")).alias("repository_url"))


@_query("samples")
def union_lineage_order(samples: DataFrame) -> DataFrame:
    flat = _flat(samples).select("sample_id", "fp", "dataset", (F.col("sample_id") % 1000).alias("source_order"))
    merged = limits.interleaved(flat.where("dataset = 'old'"), flat.where("dataset = 'new'"), "fp", "source_order")
    return merged.select("sample_id", "source_order", "dataset_rank", F.col("position._seen.dataset_rank").alias("seen_rank"), F.col("position._seen.source_order").alias("seen_order"))


@_query("samples")
def sequence_ids(samples: DataFrame) -> DataFrame:
    return limits.sequence_ids(samples, "project_slug", "sample_id").select("sample_id", "seq_id")


@_query("samples")
def limit_per_source(samples: DataFrame) -> DataFrame:
    return limits.limit_per_source(samples, "project_slug", "sample_id", 5).select("project_slug", "sample_id")


@_query("repositories", "samples")
def cumulative_target(repositories: DataFrame, samples: DataFrame) -> DataFrame:
    counts = samples.groupBy(F.col("project_slug").alias("slug")).agg(F.count("*").alias("n"))
    return limits.cumulative_target(repositories.join(counts, "slug").select("slug", "priority", "n"), "priority", "n", 200)


@_query("repositories")
def start_from_max_n(repositories: DataFrame) -> DataFrame:
    return limits.start_from(repositories, "cukani/lens", 5).select("priority", "slug")


@_query("samples")
def early_stop_limit(samples: DataFrame) -> DataFrame:
    """One row a commit, in order of its first sample; a row without a hash is a commit of its own."""
    flat = _flat(samples)
    first = flat.groupBy("fp").agg(F.min_by(F.struct("sample_id", "code_after", "entity_type"), "sample_id").alias("f"))
    good = java_scan.snippet_problem(F.col("f.code_after"), F.col("f.entity_type")) == ""
    new = first.select(F.col("f.sample_id").alias("sample_id"), F.coalesce(good, F.lit(False)).alias("good"))
    commit = F.coalesce(F.lower("commit_hash"), F.col("sample_id").cast("string"))
    told = flat.select("sample_id", "project_slug", commit.alias("commit")).join(new, "sample_id", "left")
    flags = told.groupBy("project_slug", "commit").agg(F.min("sample_id").alias("scan_seq"), F.count("good").alias("uniques"), F.count_if("good").alias("retained"))
    return limits.early_stop(flags.select("scan_seq", "uniques", "retained"), "scan_seq", 150)


@_query("commits_nested", "commits")
def resume_skip(nested: DataFrame, commits: DataFrame) -> DataFrame:
    done = nested.select(slug(F.col("project_slug")).alias("slug"), "commit_hash").where("commit_hash is not null")
    return dedup.not_in(commits.select("commit_seq", slug(F.col("project_slug")).alias("slug"), "commit_hash"), done, ["slug", "commit_hash"]).select("commit_seq")


# Nesting and summaries


def _changes(samples: DataFrame) -> DataFrame:
    return _flat(samples).select("project_slug", F.coalesce(F.lower("commit_hash"), F.lit("")).alias("commit_hash"), F.col("repo").alias("repository_url"), F.coalesce("issue_summary", F.lit("")).alias("issue_summary"), F.lit("existing_issue_summary").alias("issue_summary_source"), "entity_type", "fp", "source_order", *TEXTS)


@_query("samples")
def group_to_nested(samples: DataFrame) -> DataFrame:
    grouped = nest.group(_changes(samples))
    each = grouped.select("project_slug", "commit_hash", "issue_summary", "first_order", F.explode("changes").alias("c"))
    return each.select("project_slug", "commit_hash", "issue_summary", "first_order", "c.change_index", "c.entity_type", F.md5(F.coalesce("c.code_after", F.lit(""))).alias("code_md5"))


@_query("commits_nested")
def flatten_nested(nested: DataFrame) -> DataFrame:
    return nest.flatten(nested, "row_seq").select("row_seq", "commit_hash", "change_index", "entity_type", "source_order", "code_after")


@_query("samples")
def group_conflicts(samples: DataFrame) -> DataFrame:
    return nest.conflicts(_changes(samples)).select("project_slug", "commit_hash", F.array_join("candidates", " | ").alias("candidates"))


@_query("samples")
def choose_summary_argmax(samples: DataFrame) -> DataFrame:
    return nest.group(_changes(samples)).select("project_slug", "commit_hash", "issue_summary")


def _sizes(nested: DataFrame) -> DataFrame:
    return nested.select("row_seq", F.lower("commit_hash").alias("commit_hash"), F.size("changes").alias("size")).where("size > 0")


@_query("commits_nested")
def size_distribution_exact(nested: DataFrame) -> DataFrame:
    return summarize.size_distribution(_sizes(nested))


@_query("orders")
def size_distribution_bucket(orders: DataFrame) -> DataFrame:
    return summarize.bucketed_distribution(summarize.group_sizes(orders, "o_custkey"))


@_query("samples")
def top_commits(samples: DataFrame) -> DataFrame:
    return summarize.top_groups(summarize.group_sizes(_changes(samples), "project_slug", "commit_hash"), ["project_slug", "commit_hash"])


@_query("samples")
def per_project_type_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("project_slug", "entity_type").agg(F.count("*").alias("changes"))


@_query("samples")
def avg_max_multi(samples: DataFrame) -> DataFrame:
    return summarize.size_summary(summarize.group_sizes(_changes(samples), "project_slug", "commit_hash"))


@_query("samples", "commits")
def repair_summaries(samples: DataFrame, commits: DataFrame) -> DataFrame:
    return jobs.repaired_summaries(samples, commits).select("sample_id", "issue_summary", "issue_summary_source")


@_query("samples", "commits")
def merge_job(samples: DataFrame, commits: DataFrame) -> DataFrame:
    return jobs.merge_and_clean(samples, commits)["summary"]


@_query("samples")
def reject_chain(samples: DataFrame) -> DataFrame:
    return jobs.rejected(samples).select("sample_id", "reject_reason")


@_query("commits_nested", "entities", "file_changes")
def recover_job(nested: DataFrame, table_: DataFrame, file_changes: DataFrame) -> DataFrame:
    reasons = recover.reprocess(table_, file_changes, recover.targets(nested, 1))
    return recover.report(reasons, recover.merge_recovered(recover.flat_changes(nested), reasons))


@_query("commits_nested")
def recovery_targets(nested: DataFrame) -> DataFrame:
    return recover.targets(nested, 2).select("slug", "h", "current_change_count")


@_query("commits", "samples")
def resolve_issue_titles(commits: DataFrame, samples: DataFrame) -> DataFrame:
    named = samples.where("issue_id is not null").select("project_slug", "issue_id", F.col("issue_summary").alias("title"), F.lit("jira_issue").alias("source"))
    keyed = commits.select("commit_seq", slug(F.col("project_slug")).alias("project_slug"), "message", messages.issue_ids(F.col("message")).alias("issue_ids"))
    return issues.resolve(keyed, named)


@_query("samples")
def quality_report_flat(samples: DataFrame) -> DataFrame:
    return quality.by_check(quality.flat_findings(samples.where("batch_id > 0"), samples.where("batch_id = 0")))


@_query("commits_nested")
def quality_report_nested(nested: DataFrame) -> DataFrame:
    return quality.by_check(quality.nested_findings(nested))


@_query("entities", "file_changes")
def unresolved_failures(table_: DataFrame, file_changes: DataFrame) -> DataFrame:
    failures = jobs.missing_sides(table_, file_changes)
    return summarize.unresolved(failures).select("project_slug", "commit_hash", F.array_join("reasons", ",").alias("reasons"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in SQL.items() if name in _QUERIES}
