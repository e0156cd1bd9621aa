"""Whole jobs as plans: mining, recovery, merging. Each stage is a DataFrame; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import java_scan, javadoc, messages, paths, summaries
from ..functions.text import WS_CHARS, commit_hash, fingerprint, line_form, slug, strip, text_or_empty
from ..operators import classify, dedup, entities, nest, quality, summarize
from ..storage import written

TEXTS = ["code_before", "code_after", "javadoc_before", "javadoc_after"]
ENTITY_COLUMNS = ["entity_type", "name", "parameters", "return_type", "throws", "signature", "javadoc", "code_start_line", "code_end_line"]


def code_text(content: Column, first: Column, last: Column) -> Column:
    """Lines ``first`` to ``last`` without white space at line ends and around them; empty where anything is missing."""
    lines = F.slice(F.split(content, "\n"), F.greatest(first, F.lit(1)), F.greatest(last - F.greatest(first, F.lit(1)) + 1, F.lit(0)))
    return F.coalesce(strip(F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(WS_CHARS + "\r"))), "\n")), F.lit(""))


def aligned_pairs(table: DataFrame, file_changes: DataFrame) -> DataFrame:
    """Each aligned pair with both entities' columns, code texts and whether the code changed.

    Only line slices leave the join with the files.
    """
    pairs = entities.align(table)
    sides = {
        s: table.where(F.col("side") == s).select("file_id", F.col("entity_id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in ENTITY_COLUMNS])
        for s in ("old", "new")
    }
    joined = pairs.join(sides["old"], ["file_id", "old_id"]).join(sides["new"], ["file_id", "new_id"])
    files = file_changes.select("file_id", "project_slug", "commit_hash", "path", "scan_seq", "file_seq", "old_content", "new_content")
    full = joined.join(files, "file_id")
    code = {f"code_{t}": code_text(F.col(f"{s}_content"), F.col(f"{s}_code_start_line"), F.col(f"{s}_code_end_line")) for t, s in (("before", "old"), ("after", "new"))}
    sliced = full.withColumns(code).drop("old_content", "new_content")
    return sliced.withColumns({"pair_id": F.col("new_id"), "code_changed": F.col("code_before") != F.col("code_after")})


def pair_funnel(table: DataFrame, file_changes: DataFrame) -> DataFrame:
    """Counts a project: files, target files, pairs of methods and classes in these, and how many pass each cheap gate in turn."""
    target = F.coalesce(paths.is_target_path(F.col("path")), F.lit(False))
    files = file_changes.select("file_id", slug(F.col("project_slug")).alias("slug"), target.alias("target"))
    pairs = aligned_pairs(table, file_changes.where(target)).where("new_entity_type in ('method', 'class')")
    documented = (strip(text_or_empty(F.col("old_javadoc"))) != "") & (strip(text_or_empty(F.col("new_javadoc"))) != "")
    told = pairs.select("file_id", "code_changed", documented.alias("documented"), (text_or_empty(F.col("old_javadoc")) != text_or_empty(F.col("new_javadoc"))).alias("redocumented"))
    gates = told.groupBy("file_id").agg(
        F.count("*").alias("pairs"), F.count_if("code_changed").alias("code_changed"), F.count_if(F.expr("code_changed and documented")).alias("documented"),
        F.count_if(F.expr("code_changed and documented and redocumented")).alias("doc_changed"),
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "code_changed", "documented", "doc_changed")]
    return files.join(gates, "file_id", "left").groupBy("slug").agg(F.count("*").alias("files"), F.count_if("target").alias("target_files"), *sums)


def classified_changes(table: DataFrame, file_changes: DataFrame) -> DataFrame:
    """The pairs that pass every gate, with their label."""
    return classify.with_gates(aligned_pairs(table, file_changes)).withColumnRenamed("pair_id", "new_id")


def recovered_changes(table: DataFrame, file_changes: DataFrame) -> DataFrame:
    """Every aligned pair of methods and classes with the recovery gates' reason; empty where it is kept."""
    pairs = aligned_pairs(table, file_changes).where("new_entity_type in ('method', 'class')")
    texts = pairs.withColumns({"javadoc_before": F.col("old_javadoc"), "javadoc_after": F.col("new_javadoc"), "entity_type": F.col("new_entity_type")})
    forms = classify.with_line_forms(texts)
    told = forms.withColumn("reason", classify.recovery_reject_reason(F.col("code_changed"), F.col("entity_type")))
    return told.drop(*[f"lf_{c}" for c in TEXTS])


def read_commits(commits: DataFrame) -> DataFrame:
    """(slug, h, message, scan_seq) of the commits worth reading: cheap gates on patch and message come first."""
    keyed = commits.select(slug(F.col("project_slug")).alias("slug"), commit_hash(F.col("commit_hash")).alias("h"), "message", "patch", "scan_seq", "commit_seq")
    passed = keyed.where("slug is not null and h is not null").where(
        paths.has_doc_changes(F.col("patch")) & paths.has_code_changes(F.col("patch")) & ~messages.is_low_signal_message(F.col("message"))
    )
    return passed.groupBy("slug", "h").agg(F.min_by("message", "commit_seq").alias("message"), F.min("scan_seq").alias("scan_seq"))


def mined_samples(commits: DataFrame, file_changes: DataFrame, table: DataFrame) -> DataFrame:
    """Samples of all changes that pass: classified, bounded, deduplicated in scan order, validated.

    ``commits`` narrow the files only where they hold the commit; a file whose commit is unknown is read.
    """
    targets = file_changes.where(paths.is_target_path(F.col("path")))
    known = commits.select(slug(F.col("project_slug")).alias("slug"), commit_hash(F.col("commit_hash")).alias("h")).dropna().distinct()
    good = read_commits(commits).select("slug", "h", F.lit(True).alias("good"))
    flags = known.join(good, ["slug", "h"], "left").select("slug", "h", F.coalesce("good", F.lit(False)).alias("good"))
    keyed = targets.withColumns({"slug": slug(F.col("project_slug")), "h": commit_hash(F.col("commit_hash"))})
    files = keyed.join(flags, ["slug", "h"], "left").where(F.coalesce("good", F.lit(True))).drop("slug", "h", "good")
    return samples_of(aligned_pairs(table, files))


def samples_of(pairs: DataFrame) -> DataFrame:
    """Classified pairs, the first of each content in scan order, classes bounded, each with its disposition."""
    pairs = written(pairs, "pairs")
    labels = classify.with_gates(pairs)
    kept = pairs.join(labels, "pair_id").withColumns({"javadoc_before": F.col("old_javadoc"), "javadoc_after": F.col("new_javadoc"), "entity_type": F.col("new_entity_type")})
    order = F.struct("scan_seq", "file_seq", "file_id", "new_id")
    unique = kept.withColumns({"fp": fingerprint(*[F.col(c) for c in TEXTS]), "_order": order})
    first = unique.groupBy("fp").agg(F.min_by("pair_id", "_order").alias("pair_id"))
    one = unique.join(first, ["fp", "pair_id"])
    bounded = entities.bounded_class_contexts(one.select("pair_id", "entity_type", "code_before", "code_after"))
    out = one.drop("code_before", "code_after", "entity_type").join(bounded, "pair_id")
    weak = javadoc.is_weak_inheritdoc(F.col("javadoc_after"))
    told = out.withColumn("d", java_scan.disposition(F.col("code_before"), F.col("code_after"), F.col("entity_type"), weak))
    return told.select(
        "new_id", "project_slug", "commit_hash", "path", F.col("new_name").alias("entity_name"), F.col("new_signature").alias("entity_signature"),
        "entity_type", "change_type", "similarity", *TEXTS, "scan_seq", "file_seq", "d.disposition", "d.reason",
    )


def missing_sides(table: DataFrame, file_changes: DataFrame) -> DataFrame:
    """(project_slug, commit_hash, reason) of entities whose side of the file could not be read."""
    held = file_changes.select("file_id", F.col("old_content").isNotNull().alias("old"), F.col("new_content").isNotNull().alias("new"))
    joined = table.join(held, "file_id", "left")
    there = F.coalesce(F.when(F.col("side") == "old", F.col("old")).otherwise(F.col("new")), F.lit(False))
    return joined.where(~there).select("project_slug", "commit_hash", F.concat(F.lit("git_extract_failed:"), "side").alias("reason")).distinct()


def rejected(samples: DataFrame) -> DataFrame:
    """Every sample with the merge's reason to leave it out; null where it is kept."""
    fields = F.lit(True)
    for c in ("commit_hash", "issue_summary"):
        fields = fields & (line_form(F.col(c)) != "")
    for c in TEXTS:
        fields = fields & (F.col(f"lf_{c}") != "")
    forms = classify.with_line_forms(samples)
    typed = forms.withColumn("inferred_type", java_scan.infer_type(F.col("lf_code_before"), F.col("lf_code_after")))
    return typed.withColumn("reject_reason", classify.merge_reject_reason(fields, F.col("inferred_type"))).drop(*[f"lf_{c}" for c in TEXTS])


def repaired_summaries(changes: DataFrame, commits: DataFrame) -> DataFrame:
    """``changes`` with weak summaries replaced by their commit's subject; ``issue_summary_source`` is null where none serves.

    Subjects are looked up by canonical slug and hash, one a commit, for weak rows only.
    """
    weak = messages.is_weak_issue_summary(F.col("issue_summary"))
    keyed = changes.withColumns({"_weak": weak, "_slug": slug(F.col("project_slug")), "_h": commit_hash(F.col("commit_hash"))})
    subjects = (
        commits.select(slug(F.col("project_slug")).alias("_slug"), commit_hash(F.col("commit_hash")).alias("_h"), "commit_seq", summaries.subject(F.col("message")).alias("_subject"))
        .where("_slug is not null and _h is not null and _subject <> ''")
        .groupBy("_slug", "_h")
        .agg(F.min_by("_subject", "commit_seq").alias("_subject"))
    )
    mended = keyed.where("_weak").join(subjects, ["_slug", "_h"], "left")
    serves = F.col("_subject").isNotNull() & ~messages.is_weak_issue_summary(F.col("_subject"))
    mended = mended.withColumns(
        {"issue_summary": F.when(serves, F.col("_subject")).otherwise(F.col("issue_summary")), "issue_summary_source": F.when(serves, "commit_subject")}
    )
    sound = keyed.where("not _weak").withColumn("issue_summary_source", F.lit("existing_issue_summary"))
    return sound.unionByName(mended, allowMissingColumns=True).drop("_weak", "_slug", "_h", "_subject")


def merge_and_clean(samples: DataFrame, commits: DataFrame) -> dict[str, DataFrame]:
    """Two datasets (batch 0 is the older) to one: reject, deduplicate by priority, repair, group, check, sum up."""
    normal = samples.withColumns({c: line_form(F.col(c)) for c in ("commit_hash", "issue_summary", *TEXTS)})
    # Three results and the summary follow from these rows: the costly normal forms are computed once.
    told = written(rejected(normal), "told")
    kept = told.where("reject_reason is null").withColumns(
        {"fp": fingerprint(*[F.col(c) for c in TEXTS]), "dataset": F.when(F.col("batch_id") == 0, "old").otherwise("new"), "source_order": F.col("sample_id")}
    )
    rank = dedup.priority_rank(F.col("issue_summary"), F.col("dataset") == "old", F.col("source_order"), F.col("sample_id"))
    audit = written(dedup.priority_dedup(kept, "fp", rank, "sample_id"), "audit")
    unique = kept.join(audit.where("is_kept").select("sample_id"), "sample_id", "left_semi")
    repaired = written(repaired_summaries(unique, commits), "repaired")
    resolved = repaired.where("issue_summary_source is not null").withColumns({"entity_type": F.col("inferred_type"), "repository_url": text_or_empty(F.col("repo"))})
    nested = written(nest.group(resolved), "nested")
    sizes = nested.select(F.size("changes").alias("size"))
    reasons = told.agg(
        F.count("*").alias("raw_changes"),
        *[F.count_if(F.col("reject_reason") == r).alias(r) for r in ("invalid_schema_or_empty_field", "unknown_entity_type", "identical_code", "identical_javadoc")],
        F.count_if(F.col("reject_reason").rlike("_only$")).alias("format_only"),
    )
    duplicates = audit.agg(F.count_if(~F.col("is_kept")).alias("duplicates_removed"))
    sources = repaired.agg(
        F.count_if(F.col("issue_summary_source") == "commit_subject").alias("repaired_from_subject"), F.count_if(F.col("issue_summary_source").isNull()).alias("weak_unresolved")
    )
    # One row each: a product of single rows.
    summary = reasons.crossJoin(duplicates).crossJoin(sources).crossJoin(summarize.size_summary(sizes))
    return {
        "nested": nested, "flat": resolved, "rejected": told.where("reject_reason is not null"), "duplicates": dedup.removed_groups(audit, "fp", "sample_id"),
        "unresolved": repaired.where("issue_summary_source is null"), "conflicts": nest.conflicts(resolved), "findings": quality.nested_findings(nested.withColumnRenamed("first_order", "row_seq")), "summary": summary,
    }
