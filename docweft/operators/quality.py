"""Quality reports in long form: one row a finding (check, id), counted by check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.java_scan import either_problem
from ..functions.javadoc import format_only_reason
from ..functions.messages import collapse, is_dangling_summary, is_weak_issue_summary
from ..functions.text import fingerprint, strip, text_or_empty

SIX = ["commit_hash", "issue_summary", "code_before", "code_after", "javadoc_before", "javadoc_after"]
TEXTS = SIX[2:]


def _blank(name: str) -> Column:
    return strip(text_or_empty(F.col(name))) == ""


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _findings(rows: DataFrame, checks: dict[str, Column], row_id: str) -> DataFrame:
    """(check, id) for each true condition, in one pass over the rows."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))
    return rows.select(F.explode(hits).alias("check"), F.col(row_id).cast("string").alias("id"))


def flat_findings(rows: DataFrame, baseline: DataFrame, row_id: str = "sample_id") -> DataFrame:
    """Findings of flat samples: empty fields, repeats inside and against a baseline, dangling summaries, equal or broken texts."""
    key = F.sha2(F.concat_ws("\x1f", "project_slug", *[F.coalesce(F.col(c), F.lit("")) for c in SIX]), 256)
    keyed = rows.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(row_id).alias("_first"))
    known = baseline.select(key.alias("_key")).distinct().withColumn("_known", F.lit(True))
    ready = keyed.join(first, "_key").join(known, "_key", "left")
    checks = {
        "empty_field": _any([_blank(c) for c in SIX]),
        "duplicate_inside_new": F.col(row_id) > F.col("_first"),
        "duplicate_against_baseline": F.col("_known"),
        "dangling_issue_summary": is_dangling_summary(F.col("issue_summary")),
        "identical_code": text_or_empty(F.col("code_before")) == text_or_empty(F.col("code_after")),
        "identical_javadoc": collapse(text_or_empty(F.col("javadoc_before"))) == collapse(text_or_empty(F.col("javadoc_after"))),
        "invalid_code_before": either_problem(F.col("code_before")) != "",
        "invalid_code_after": either_problem(F.col("code_after")) != "",
    }
    return _findings(ready, checks, row_id)


def nested_findings(nested: DataFrame, row_id: str = "row_seq") -> DataFrame:
    """Findings of nested commits and of their changes; a change's id is ``commit/position``."""
    first = nested.groupBy(F.col("project_slug").alias("_p"), F.col("commit_hash").alias("_h")).agg(F.min(row_id).alias("_first"))
    commits = nested.join(first, F.col("project_slug").eqNullSafe(F.col("_p")) & F.col("commit_hash").eqNullSafe(F.col("_h")))
    top = _findings(
        commits,
        {
            "missing_commit_fields": F.col("commit_hash").isNull() | F.col("issue_summary").isNull() | F.col("changes").isNull(),
            "duplicate_commits": F.col(row_id) > F.col("_first"),
            "empty_issue_summary": _blank("issue_summary"),
            "weak_issue_summary": ~_blank("issue_summary") & is_weak_issue_summary(F.col("issue_summary")),
            "empty_changes": F.coalesce(F.size("changes"), F.lit(0)) <= 0,
        },
        row_id,
    )
    changes = nested.select(row_id, F.posexplode("changes").alias("pos", "c")).select(row_id, (F.col("pos") + 1).alias("pos"), "c.*")
    changes = changes.withColumns({"fp": fingerprint(*[F.col(c) for c in TEXTS]), "id": F.concat_ws("/", row_id, "pos")})
    at = F.struct(row_id, "pos")
    firsts = changes.groupBy("fp").agg(F.min(at).alias("_first"))
    within = changes.groupBy("fp", row_id).agg(F.min("pos").alias("_here"))
    ready = changes.join(firsts, "fp").join(within, ["fp", row_id])
    below = _findings(
        ready,
        {
            "bad_change_index": ~F.col("change_index").eqNullSafe(F.col("pos")),
            "bad_entity_type": ~F.coalesce(F.col("entity_type").isin("method", "class"), F.lit(False)),
            "empty_change_fields": _any([_blank(c) for c in ("entity_type", *TEXTS)]),
            "identical_code": F.col("code_before").eqNullSafe(F.col("code_after")),
            "identical_javadoc": F.col("javadoc_before").eqNullSafe(F.col("javadoc_after")),
            "format_only_javadoc": format_only_reason(F.col("javadoc_before"), F.col("javadoc_after")) != "",
            "duplicate_changes": at > F.col("_first"),
            "duplicate_changes_within_commit": F.col("pos") > F.col("_here"),
        },
        "id",
    )
    return top.union(below)


def by_check(findings: DataFrame) -> DataFrame:
    return findings.groupBy("check").agg(F.count("*").alias("findings"))


def passed(findings: DataFrame) -> bool:
    return findings.isEmpty()
