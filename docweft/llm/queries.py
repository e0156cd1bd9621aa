"""The queries of this package, each over its whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..storage import ship, table
from . import batch_dedup, format_dups, function_docs, leakage, markup, near_dups, pages, shared_spans, splits, survivor, tokenizer

Query = Callable[[SparkSession, str], DataFrame]


def _on(operator: Callable[..., DataFrame], *tables: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return operator(*[table(spark, folder, t) for t in tables])

    return run


def queries() -> dict[str, Query]:
    return {
        "p1_found": _on(splits.linked_projects, "commits"),
        "p1_splits": _on(splits.assign_splits, "commits"),
        "p2_found": _on(function_docs.found, "samples", "entities", "file_changes"),
        "p2_pairs": _on(function_docs.pairs, "samples", "entities", "file_changes"),
        "p3_found": _on(batch_dedup.found, "samples"),
        "p4_found": _on(near_dups.found, "samples"),
        "p4_classes": _on(near_dups.classes, "samples"),
        "p4_weighted": _on(near_dups.weighted_links, "samples"),
        "p5_found": _on(markup.found, "samples"),
        "p5_clean": _on(markup.cleaned, "samples"),
        "p5_pages": _on(pages.differenced_comments, "samples"),
        "p6_found": _on(survivor.found, "commits_nested", "dataset_trust"),
        "p6_best": _on(survivor.best_commits, "commits_nested", "dataset_trust"),
        "p7_found": _on(format_dups.found, "samples"),
        "p7_copies": _on(format_dups.collapsed, "samples"),
        "p8_ids": _on(tokenizer.encode, "documents"),
        "p8_decoded": _on(lambda documents: tokenizer.decode(tokenizer.encode(documents)), "documents"),
        "p9_found": _on(leakage.found, "documents", "eval_items"),
        "p9_overlaps": _on(leakage.overlaps, "documents", "eval_items"),
        "p10_found": _on(shared_spans.found, "documents"),
        "p10_report": _on(shared_spans.shared_report, "documents"),
    }


_SLUG = "nullif(trim(regexp_replace(lower(project_slug), '[^a-z0-9]+', '_', 'g'), '_'), '')"
_HASH = "case when regexp_matches(lower(regexp_replace(commit_hash, '^\\s+|\\s+$', '', 'g')), '^0*$') then null else lower(regexp_replace(commit_hash, '^\\s+|\\s+$', '', 'g')) end"
_SHINGLES = """
w as (select sample_id, regexp_extract_all(lower(coalesce(code_before, '') || chr(10) || coalesce(code_after, '') || chr(10) || coalesce(javadoc_after, '')), '[a-z0-9_]+') t from samples),
g as (select sample_id, list_distinct(list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) s from w),
e as (select sample_id, len(s) n, unnest(s) x from g)
"""
_WEAK = """
u as (select *, trim(regexp_replace(coalesce(issue_summary, ''), '\\s+', ' ', 'g')) flat from r),
t as (select *, lower(trim(regexp_replace(flat, '^[ .,:;!\\-_]+|[ .,:;!\\-_]+$', '', 'g'))) bare from u),
v as (select *, regexp_replace(regexp_extract(bare, '[^ ]*$'), '^[.,;:!?]+|[.,;:!?]+$', '', 'g') tail from t),
z as (select *, issue_summary is not null and not regexp_matches(flat, '(\\.\\.\\.|…)$') and not (
  bare in ('', 'pr', 'fix', 'fixed', 'update', 'changes', 'cleanup', 'clean up', 'revert') or length(bare) <= 3
  or (not regexp_matches(flat, '[.!?]$') and tail in ('by', 'to', 'for', 'with', 'of', 'in', 'on', 'and', 'or', 'from', 'into'))) usable from v)
"""
_FLAT = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


def _canonical_doc(field: str) -> str:
    parts = f"string_split(regexp_replace(coalesce({field}, ''), '([\\s*])@', '\\1' || chr(1) || '@', 'g'), chr(1))"
    flat = f"list_transform({parts}, lambda x: {_FLAT.format('x')})"
    return f"{flat}[1] || chr(2) || coalesce(array_to_string(list_sort({flat}[2:]), chr(3)), '')"


def oracle_sql() -> dict[str, str]:
    copies = f"""with c as (select sample_id, {_FLAT.format("coalesce(code_before, '')")} || chr(4) || {_canonical_doc('javadoc_before')} || chr(4) || {_canonical_doc('javadoc_after')} k from samples),
      g as (select k, min(sample_id) keep_id, count(*)::bigint copies from c group by k) """
    records = f"""r as (select {_SLUG} s, {_HASH} h, row_seq, n.dataset, issue_summary, repository_url, mined_at, trust_rank from commits_nested n left join dataset_trust t on n.dataset = t.dataset), {_WEAK},
          f as (select distinct a.s, a.h, (select b.h from z b where b.s = a.s and starts_with(b.h, a.h) order by length(b.h) desc, b.h limit 1) full_ from z a where a.s is not null and a.h is not null),
          k as (select z.*, full_, count(*) over (partition by z.s, full_) n from z join f on z.s = f.s and z.h = f.h)"""
    return {
        "p1_found": f"""with recursive c as (select distinct {_SLUG} s, {_HASH} h from commits),
          e as (select distinct a.s x, b.s y from c a join c b on left(a.h, 12) = left(b.h, 12) and (starts_with(a.h, b.h) or starts_with(b.h, a.h)) where a.s <> b.s),
          r(x, y) as (select x, y from e union select r.x, e.y from r join e on r.y = e.x)
          select x slug_a, y slug_b from r where x < y""",
        "p3_found": """with recursive w as (select sample_id, coalesce(batch_id, -1) b, lower(commit_hash) h, regexp_replace(coalesce(code_after, ''), '\\s+', '', 'g') c,
            regexp_extract_all(lower(coalesce(code_after, '') || chr(10) || coalesce(javadoc_after, '')), '[a-z0-9_]+') t from samples),
          o as (select *, row_number() over (order by b, sample_id) i, list_distinct(list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) s from w),
          e as (select i, len(s) n, unnest(s) x from o),
          m as (select x.i later, y.i earlier, count(*) both_, any_value(x.n) nx, any_value(y.n) ny from e x join e y on x.x = y.x and x.i > y.i group by 1, 2),
          l as (select later, earlier from m where both_ * 1.0 / (nx + ny - both_) >= 0.6 union select x.i, y.i from o x join o y on x.h = y.h and x.c = y.c and x.i > y.i where x.c <> ''),
          k as (select o.i, b, sample_id, coalesce(list(earlier) filter (earlier is not null), []) seen from o left join l on later = i group by 1, 2, 3),
          a(i, kept) as (select 0::bigint, []::bigint[] union all select k.i, case when k.b <= 0 or not list_has_any(kept, seen) then list_append(kept, k.i) else kept end from a join k on k.i = a.i + 1)
          select sample_id from k where i not in (select unnest(kept) from a where i = (select max(i) from a))""",
        "p4_found": f"""with {_SHINGLES},
          m as (select a.sample_id a, b.sample_id b, any_value(a.n) na, any_value(b.n) nb, count(*) both_ from e a join e b on a.x = b.x and a.sample_id < b.sample_id group by 1, 2)
          select a sample_a, b sample_b from m where both_ * 1.0 / (na + nb - both_) >= 0.6""",
        "p4_classes": f"""with recursive {_SHINGLES},
          f as (select sample_id, list_sort(s) k from g where len(s) > 0),
          c as (select k, min(sample_id) rep from f group by k),
          q as (select sample_id, rep from f join c using (k)),
          y as (select e.* from e where sample_id in (select rep from q)),
          m as (select a.sample_id a, b.sample_id b, any_value(a.n) na, any_value(b.n) nb, count(*) both_ from y a join y b on a.x = b.x and a.sample_id <> b.sample_id group by 1, 2),
          l as (select a, b from m where both_ * 1.0 / (na + nb - both_) >= 0.6),
          t(a, b) as (select a, b from l union select t.a, l.b from t join l on t.b = l.a),
          o as (select a, count(*)::bigint links from l group by a), z as (select a, least(a, min(b)) grp from t group by a)
          select s.sample_id, coalesce(rep, s.sample_id) class_id, coalesce(grp, rep, s.sample_id) group_id, coalesce(links, 0)::bigint links
          from samples s left join q using (sample_id) left join o on o.a = rep left join z on z.a = rep""",
        "p6_found": f"""with {records}, o as (select *, row_number() over (partition by s, full_ order by coalesce(trust_rank, 2147483647), mined_at desc nulls last, row_seq) i from k where usable and n >= 2)
          select s project_slug, full_ commit_hash, row_seq from o where i = 1""",
        "p6_best": f"""with recursive {records},
          p as (select *, usable::int c, coalesce(trust_rank, 2147483647) t, coalesce(epoch_us(mined_at), -9223372036854775807) e from k where n >= 2),
          l(row_seq, s, full_, c, t, e, layer) as (select row_seq, s, full_, c, t, e, 0 from p
            union select b.row_seq, b.s, b.full_, b.c, b.t, b.e, layer + 1 from l join p b on l.s = b.s and l.full_ = b.full_ and l.c >= b.c and l.t <= b.t and l.e >= b.e and (l.c > b.c or l.t < b.t or l.e > b.e)),
          m as (select row_seq, max(layer) layer from l group by row_seq),
          o as (select p.*, layer, row_number() over (partition by s, full_ order by layer, c desc, t, e desc, row_seq) i from p join m using (row_seq))
          select s project_slug, full_ commit_hash, min(row_seq) filter (i = 1) row_seq, count(*)::bigint copies, count(distinct (c, t)) filter (layer = 0)::int undominated, max(c) complete,
            first(issue_summary order by i) filter (usable) issue_summary, first(repository_url order by i) filter (repository_url is not null) repository_url,
            first(mined_at order by i) filter (mined_at is not null) mined_at from o group by s, full_""",
        "p7_found": copies + "select keep_id, sample_id from c join g using (k) where sample_id <> keep_id",
        "p7_copies": copies + "select keep_id, copies, false as collided from g",
        "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
        "p9_found": """with w as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') t from documents),
          d as (select doc_id, unnest(list_transform(range(1, greatest(len(t) - 10, 1)), lambda i: array_to_string(t[i:i + 11], ' '))) x from w),
          v as (select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') t from eval_items),
          q as (select item_id, unnest(list_transform(range(1, greatest(len(t) - 10, 1)), lambda i: array_to_string(t[i:i + 11], ' '))) x from v)
          select distinct doc_id, item_id from d join q using (x)""",
        "p10_found": """with w as (select doc_id, unnest(list_transform(range(1, greatest(length(text) - 298, 1)), lambda i: substr(text, i, 300))) x from documents),
          r as (select x from w group by x having min(doc_id) < max(doc_id))
          select distinct doc_id from w join r using (x)""",
        "p10_report": """with w as (select distinct doc_id, unnest(range(1, greatest(length(text) - 298, 1))) i, text from documents),
          x as (select doc_id, i, substr(text, i, 300) x from w),
          r as (select x from x group by x having min(doc_id) < max(doc_id)),
          h as (select doc_id, i, lead(i) over (partition by doc_id order by i) n from (select distinct doc_id, i from x join r using (x))),
          c as (select doc_id, sum(least(300, coalesce(n - i, 300)))::bigint shared_chars from h group by doc_id)
          select doc_id, coalesce(length(text), 0)::bigint n_chars, coalesce(shared_chars, 0)::bigint shared_chars,
            case when length(text) > 0 then round(coalesce(shared_chars, 0) / length(text), 6) else 0.0 end as share from documents left join c using (doc_id)""",
    }
