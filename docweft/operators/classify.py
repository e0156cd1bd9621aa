"""Which pairs of an old and a new entity are changes worth keeping, and why the others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import java_scan, javadoc
from ..functions.expr import let
from ..functions.kernels import seq_ratio
from ..functions.text import line_form, strip, text_or_empty
from ..functions.tokens import BEHAVIOUR, CONTRACT_GROUPS, LINK_STOP_WORDS, changed_terms, code_terms, identifier_shape, java_tokens, multiset_changes, parameter_types, split_identifier, words
from ..storage import written


def substantial_code(old: Column, new: Column, api_changed: Column | None = None) -> Column:
    """Whether two token arrays differ in more than order, names or a touch."""
    def judge(changed: Column) -> Column:
        return let(changed, decided)

    def decided(changed: Column) -> Column:
        real = F.arrays_overlap(changed, words(BEHAVIOUR)) | F.exists(changed, lambda t: t.rlike(r"\A[\"']")) | (F.size(changed) >= 4)
        return real if api_changed is None else F.coalesce(api_changed, F.lit(False)) | real

    same = (F.size(old) == 0) | (F.size(new) == 0) | (F.sort_array(old) == F.sort_array(new))
    verdict = let(multiset_changes(old, new), lambda c: judge(F.concat(c["removed"], c["added"])))
    return F.when(same, False).when(identifier_shape(old) == identifier_shape(new), False).otherwise(verdict)


def code_and_doc_terms(code_old: Column, code_new: Column, doc_old: Column, doc_new: Column) -> tuple[Column, Column]:
    """The words changed in code and in documentation, without words that link nothing; arguments are token arrays."""
    stop = words(LINK_STOP_WORDS)
    code = F.array_except(changed_terms(code_terms(code_old), code_terms(code_new)), stop)
    return code, F.array_except(changed_terms(doc_old, doc_new), stop)


def shared_group(code: Column, doc: Column) -> Column:
    """Both sides touch one group of contract words."""
    found = F.lit(False)
    for group in CONTRACT_GROUPS:
        found = found | (F.arrays_overlap(code, words(group)) & F.arrays_overlap(doc, words(group)))
    return found


def with_gates(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the boolean of every gate and ``change_type``, null where a gate rejects.

    Columns read: pair_id, old_/new_ entity_type, name, parameters, return_type, throws, signature, javadoc,
    and code_before, code_after, code_changed. Cheap gates filter before the kernels run: rows that fail
    them are rejected without being sent to Python. Tokens are written once, as a filter over a computed
    column would be moved below its projection and compute it anew for each use.
    """
    none = F.expr("cast(array() as array<string>)")
    arrays = {f"{s}_{c}": F.coalesce(f"{s}_{c}", none) for s in ("old", "new") for c in ("parameters", "throws")}
    ready = pairs.withColumns(arrays)
    kinds = F.col("old_entity_type").isin("method", "class") & F.col("new_entity_type").isin("method", "class")
    documented = (strip(text_or_empty(F.col("old_javadoc"))) != "") & (strip(text_or_empty(F.col("new_javadoc"))) != "")
    first = kinds & F.coalesce("code_changed", F.lit(False)) & documented
    passed = ready.where(F.coalesce(first, F.lit(False)))
    code = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(s)) for c, s in (("code_before", "old_signature"), ("code_after", "new_signature"))]
    read = [f"{s}_{c}" for s in ("old", "new") for c in ("entity_type", "name", "parameters", "return_type", "throws", "javadoc")]
    passed = written(passed.select("pair_id", *read, java_tokens(code[0]).alias("_c0"), java_tokens(code[1]).alias("_c1")), "code-tokens")
    types_differ = parameter_types(F.col("old_parameters")) != parameter_types(F.col("new_parameters"))
    returns_differ, throws_differ = ~F.col("old_return_type").eqNullSafe(F.col("new_return_type")), F.col("old_throws") != F.col("new_throws")
    passed = passed.where(substantial_code(F.col("_c0"), F.col("_c1"), types_differ | returns_differ | throws_differ))
    passed = passed.withColumns({"_d0": javadoc.semantic_tokens(F.col("old_javadoc")), "_d1": javadoc.semantic_tokens(F.col("new_javadoc"))})
    passed = written(passed.drop("old_javadoc", "new_javadoc"), "doc-tokens")
    passed = javadoc.with_substantive(passed, "_d0", "_d1").where("substantive")
    terms = code_and_doc_terms(F.col("_c0"), F.col("_c1"), F.col("_d0"), F.col("_d1"))
    passed = passed.withColumns({"_code": terms[0], "_doc": terms[1], "similarity": seq_ratio(F.col("_d0"), F.col("_d1"))}).drop("_c0", "_c1", "_d0", "_d1")
    passed = written(passed, "terms")
    direct = F.array_intersect("_code", "_doc")
    named = F.flatten(F.transform(F.concat("old_parameters", "new_parameters"), split_identifier))
    api = (
        (types_differ & F.arrays_overlap(named, F.col("_doc")))
        | (throws_differ & F.arrays_overlap(F.col("_doc"), words(["throw", "throws", "exception"])))
        | (returns_differ & F.arrays_overlap(F.col("_doc"), words(["return", "returns"])))
    )
    passed = passed.withColumns({"_direct": direct, "_group": shared_group(F.col("_code"), F.col("_doc")), "_api": api})
    strong = (F.size("_direct") > 0) | F.col("_group") | F.col("_api")
    loose_class = (F.col("old_entity_type") == "class") & (F.col("similarity") >= 0.85) & (F.size("_direct") < 2) & ~F.col("_group")
    alike = (F.col("similarity") >= 0.9) & ~(F.arrays_overlap("_direct", words(javadoc.CONTRACT_TERMS)) | F.col("_group") | F.col("_api"))
    label = (
        F.when(F.col("old_entity_type") != F.col("new_entity_type"), "class_api_change")
        .when(F.col("old_name") != F.col("new_name"), F.when(F.col("new_entity_type") == "method", "method_rename").otherwise("class_api_change"))
        .when(F.col("old_parameters") != F.col("new_parameters"), "parameter_change")
        .when(returns_differ, "return_type_change")
        .when(throws_differ, "exception_change")
        .otherwise("code_and_javadoc_change")
    )
    kept = passed.where(strong & ~loose_class & ~alike)
    return kept.select("pair_id", label.alias("change_type"), F.round("similarity", 6).alias("similarity"))


def with_line_forms(rows: DataFrame) -> DataFrame:
    """``rows`` with the line form of each text as ``lf_`` columns, computed once for all rules that follow."""
    return rows.withColumns({f"lf_{c}": line_form(F.col(c)) for c in ("code_before", "code_after", "javadoc_before", "javadoc_after")})


def merge_reject_reason(has_fields: Column, entity_type: Column) -> Column:
    """Why a flat change is left out of a merge; null to keep it. Reads ``lf_`` columns."""
    old, new = F.col("lf_javadoc_before"), F.col("lf_javadoc_after")
    return (
        F.when(~has_fields, "invalid_schema_or_empty_field")
        .when(entity_type.isNull(), "unknown_entity_type")
        .when(F.col("lf_code_before") == F.col("lf_code_after"), "identical_code")
        .when(old == new, "identical_javadoc")
        .otherwise(F.nullif(javadoc.format_only_reason(old, new), F.lit("")))
    )


def recovery_reject_reason(code_changed: Column, entity_type: Column) -> Column:
    """The looser gates of a recovery run, in their order; empty to keep a pair. Reads ``lf_`` columns."""
    before, after, old, new = (F.col(f"lf_{c}") for c in ("code_before", "code_after", "javadoc_before", "javadoc_after"))

    def invalid(side: str, code: Column, otherwise: Column) -> Column:
        return let(java_scan.snippet_problem(code, entity_type), lambda p: F.when(p != "", F.concat(F.lit(f"invalid_code_{side}:"), p)).otherwise(otherwise))

    return (
        F.when((strip(text_or_empty(F.col("javadoc_before"))) == "") | (strip(text_or_empty(F.col("javadoc_after"))) == ""), "empty_javadoc")
        .when(javadoc.is_weak_inheritdoc(F.col("javadoc_after")), "weak_inheritdoc_only")
        .when(~code_changed, "code_not_changed")
        .when((before == "") | (after == ""), "empty_code")
        .when(before == after, "identical_code")
        .when(old == new, "identical_javadoc")
        .when(javadoc.format_only_reason(old, new) != "", "format_only_javadoc")
        .otherwise(invalid("before", before, invalid("after", after, F.lit(""))))
    )
