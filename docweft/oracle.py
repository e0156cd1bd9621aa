"""SQL, as DuckDB reads it, for the queries of the catalogue that SQL can express."""

from __future__ import annotations

_WS = "chr(9) || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
_TEXTS = ("code_before", "code_after", "javadoc_before", "javadoc_after")


def _unix(x: str) -> str:
    return f"replace(replace(coalesce({x}, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def _line_form(x: str) -> str:
    return f"trim(array_to_string(list_transform(string_split({_unix(x)}, chr(10)), lambda y: rtrim(y, {_WS})), chr(10)), chr(10))"


def _strip(x: str) -> str:
    return f"trim({x}, chr(10) || chr(13) || {_WS})"


_FP = "sha256(" + " || '␞' || ".join(_line_form(c) for c in _TEXTS) + ")"
_FLAT = f"f as (select *, {_FP} fp, case when batch_id = 0 then 'old' else 'new' end dataset from samples)"
_SPACE = "[\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}]"
_COLLAPSE = "trim(regexp_replace({}, '" + _SPACE.replace("{", "{{").replace("}", "}}") + "+', ' ', 'g'))"
_DANGLING = "('by', 'to', 'for', 'with', 'of', 'in', 'on', 'and', 'or', 'from', 'into')"
_SLUG = "nullif(trim(regexp_replace(lower(project_slug), '[^a-z0-9]+', '_', 'g'), '_'), '')"
_LAST = "regexp_replace(lower(regexp_extract(flat, '[^ ]*$')), '^[.,;:!?]+|[.,;:!?]+$', '', 'g')"


def _weak(x: str) -> str:
    flat = _COLLAPSE.format(f"coalesce({x}, '')")
    bare = f"lower(trim(regexp_replace({flat}, '^[ .,:;!\\-_]+|[ .,:;!\\-_]+$', '', 'g')))"
    last = f"regexp_replace(regexp_extract({bare}, '[^ ]*$'), '^[.,;:!?]+|[.,;:!?]+$', '', 'g')"
    return f"""({bare} in ('', 'pr', 'fix', 'fixed', 'update', 'changes', 'cleanup', 'clean up', 'revert') or length({bare}) <= 3
      or (not regexp_matches({flat}, '[.!?]$') and {last} in {_DANGLING}))"""


def _lines(x: str) -> str:
    """Content lines of a comment."""
    one = _strip("y")
    opened = _strip(f"regexp_replace({one}, '^/\\*\\*', '')")
    closed = _strip(f"regexp_replace({opened}, '\\*/$', '')")
    unstarred = _strip(f"regexp_replace({closed}, '^\\*', '')")
    bare = _strip(f"regexp_replace({unstarred}, '{_SPACE}+', ' ', 'g')")
    return f"list_filter(list_transform(string_split({_unix(x)}, chr(10)), lambda y: {bare}), lambda y: y <> '')"


_FORMAT_TAGS = "(?i)</?(?:p|br|b|i|em|strong|code|pre|ul|ol|li|blockquote|span)\\b[^>]*>"


def _layout(x: str) -> str:
    return f"array_to_string({_lines(_line_form(x))}, ' ')"


def _format(x: str) -> str:
    plain = f"regexp_replace(regexp_replace({_layout(x)}, '{_FORMAT_TAGS}', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    plain = f"regexp_replace({plain}, '\\{{@([a-zA-Z]+)\\s+([^}}]*)\\}}', '\\1 \\2', 'g')"
    return f"array_to_string(regexp_extract_all(lower({plain}), '@?[A-Za-z0-9_$]+'), ' ')"


_PRIORITY = f"""p as (select *, first_value(sample_id) over w survivor, count(*) over (partition by fp) n from f
  window w as (partition by fp order by {_weak('issue_summary')}, dataset <> 'old', sample_id))"""
_OUTCOMES = """o as (select n.sample_id, n.project_slug, case when exists (select 1 from f b where b.dataset = 'old' and b.project_slug is not distinct from n.project_slug and b.fp = n.fp) then 'in_frozen'
  when row_number() over (partition by n.project_slug, n.fp order by n.sample_id) > 1 then 'repeated' else 'new' end outcome from f n where n.dataset = 'new')"""
_CHANGES = "c as (select project_slug, coalesce(lower(commit_hash), '') commit_hash, coalesce(issue_summary, '') issue_summary, entity_type, fp, sample_id, code_after from f)"
_BEST = f"b as (select project_slug, commit_hash, issue_summary, row_number() over (partition by project_slug, commit_hash order by {_weak('issue_summary')}, sample_id) i from c)"
_TOKENS = (
    "list_transform(regexp_extract_all(regexp_replace(coalesce({}, ''), '(?s)/\\*.*?\\*/|//[^\\n]*', ' ', 'g'), "
    "'\"(?:\\\\.|[^\"\\\\])*\"|''(?:\\\\.|[^''\\\\])*''|[A-Za-z_$][\\w$]*|\\d+(?:\\.\\d+)?|==|!=|<=|>=|&&|\\|\\||\\+\\+|--|->|[{{}}()\\[\\];,.?:+\\-*/%<>=!]'), lambda t: lower(t))"
)
_DOC_LINE = "(regexp_matches(pl, '^(/\\*\\*|\\*)') or contains(pl, '@param') or contains(pl, '@return') or contains(pl, '@throws') or contains(pl, '@exception') or contains(pl, '@see') or contains(pl, '@since'))"
_PATCH = f"""l as (select commit_seq, unnest(string_split(coalesce(patch, ''), chr(10))) ln from commits),
  m as (select commit_seq, ln, {_strip("case when regexp_matches(ln, '^[+-]') and not regexp_matches(ln, '^([+]{3}|-{3})') then substr(ln, 2) else ln end")} pl, regexp_matches(ln, '^[+-]') and not regexp_matches(ln, '^([+]{{3}}|-{{3}})') ch from l),
  g as (select commit_seq, bool_or(ch and {_DOC_LINE}) has_docs, bool_or(ch and pl <> '' and not {_DOC_LINE} and not regexp_matches(pl, '^(//|/\\*|\\*)')) has_code from m group by 1)"""
_PATCH = _PATCH.replace("{{3}}", "{3}")
_FIRST_LINE = _strip(f"coalesce(list_filter(string_split(coalesce(message, ''), chr(10)), lambda x: {_strip('x')} <> '')[1], '')")
_LOW = (
    f"(regexp_matches({_FIRST_LINE}, '(?i)^(?:javadocs?|docs?|documentation|sort(?:ed|ing)?\\s+members?|format(?:ting)?|reformat(?:ting)?|cleanup|clean\\s*up|typos?|fix\\s+typos?)\\b') "
    f"or regexp_matches({_FIRST_LINE}, '(?i)\\b(?:refactor(?:ing)?|rename(?:d|s|ing)?\\s+internal|empty\\s+lines?|whitespace|imports?\\s+only|code\\s+duplication)\\b'))"
)
_BUCKET = """case when n between 1 and 3 then n::varchar when n between 4 and 5 then '4-5' when n between 6 and 10 then '6-10' when n between 11 and 20 then '11-20' when n between 21 and 50 then '21-50' else '>50' end"""

_SUMMARY = "coalesce(issue_summary, '')"

SQL: dict[str, str] = {
    "norm_fingerprint": f"select sample_id, {_FP} fp from samples",
    "line_normal_form": f"select sample_id, {_line_form('code_before')} form from samples",
    "layout_normal_form": f"select sample_id, {_layout('javadoc_after')} form from samples",
    "format_normal_form": f"select sample_id, {_format('javadoc_after')} form from samples",
    "format_only": f"""select sample_id, case when {_layout('javadoc_before')} = {_layout('javadoc_after')} then 'whitespace_or_line_wrapping_only'
      when {_format('javadoc_before')} = {_format('javadoc_after')} then 'punctuation_or_html_formatting_only' else '' end reason from samples""",
    "format_review": f"""with x as (select sample_id, unnest([{{'field': 'javadoc_before', 'v': coalesce(javadoc_before, '')}}, {{'field': 'javadoc_after', 'v': coalesce(javadoc_after, '')}}], recursive := true) from samples),
      y as (select sample_id, field, array_to_string(list_filter([case when contains(v, chr(65533)) then 'replacement_character' end,
        case when starts_with({_strip('v')}, '/**') and not ends_with({_strip('v')}, '*/') then 'unclosed_javadoc' end,
        case when length(v) - length(replace(v, '<', '')) <> length(v) - length(replace(v, '>', '')) then 'unbalanced_angle_brackets' end], lambda r: r is not null), ',') reasons from x)
      select * from y where reasons <> ''""",
    "weak_summary": f"select commit_seq, {_weak('message')} weak from commits",
    "dangling_summary": f"select sample_id, {_LAST} in {_DANGLING} dangling from (select sample_id, {_COLLAPSE.format(_SUMMARY)} flat from samples)",
    "issue_ids": "select commit_seq, array_to_string(list_transform(list_sort(list_distinct(list_transform(ids, lambda x: {'p': list_position(ids, x), 'x': x}))), lambda s: s.x), ' ') ids from (select commit_seq, regexp_extract_all(coalesce(message, ''), '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+') ids from commits)",
    "low_signal_filter": f"select commit_seq, {_LOW} low_signal from commits",
    "canonical_slug": f"select commit_seq, {_SLUG} slug from commits",
    "commit_prefilter": f"with {_PATCH} select commit_seq, has_docs, has_code from g",
    "stats_funnel": f"""with {_PATCH} select {_SLUG} slug, count(*)::bigint scanned, count(*) filter (has_docs)::bigint with_docs, count(*) filter (has_docs and has_code)::bigint with_docs_and_code,
      count(*) filter (has_docs and has_code and not {_LOW})::bigint worth_reading from commits join g using (commit_seq) group by 1""",
    "java_token_counts": f"select sample_id, len({_TOKENS.format('code_after')})::int tokens from samples",
    "project_curation": f"with {_FLAT}, k as (select arg_min(project_slug, sample_id) project_slug, count(*) n from f group by fp) select project_slug, count(*)::bigint changes, sum(n)::bigint records from k group by 1",
    "dedup_keep_first": f"with {_FLAT} select fp, min(sample_id) sample_id, count(*)::bigint copies from f group by fp",
    "dedup_priority_audit": f"with {_FLAT}, {_PRIORITY} select fp, survivor, (n - 1)::bigint removed from p where n > 1 group by fp, survivor, n",
    "dup_counts_by_dataset": f"with {_FLAT}, k as (select fp, array_to_string(list_sort(list(distinct dataset)), '+') datasets, count(*) n from f group by fp) select datasets, count(*)::bigint as groups, sum(n - 1)::bigint removed from k where n > 1 group by 1",
    "baseline_anti_join": f"with {_FLAT} select sample_id from f n where dataset = 'new' and not exists (select 1 from f b where b.dataset = 'old' and b.fp = n.fp and b.project_slug is not distinct from n.project_slug)",
    "baseline_anti_join_counts": f"with {_FLAT}, {_OUTCOMES} select project_slug, outcome, count(*)::bigint as rows from o group by 1, 2",
    "baseline_filter_with_limit": f"""with {_FLAT}, {_OUTCOMES}, r as (select *, sum(case when outcome = 'new' then 1 else 0 end) over (partition by project_slug order by sample_id) n from o)
      select project_slug, count(*) filter (outcome = 'new')::bigint kept, count(*) filter (outcome = 'in_frozen')::bigint duplicate_against_baseline, count(*) filter (outcome = 'repeated')::bigint duplicate_inside
      from r where n < 5 or (n = 5 and outcome = 'new') group by 1""",
    "semi_target_commits": "select commit_seq from commits where commit_hash in (select commit_hash from commits_nested where len(changes) > 2)",
    "lookup_left_coalesce": "select sample_id, coalesce(nullif(repo, ''), url, '') repository_url from samples s left join repositories r on s.project_slug = r.slug",
    "union_lineage_order": f"""with {_FLAT}, u as (select sample_id, fp, sample_id % 1000 source_order, case when dataset = 'old' then 0 else 1 end dataset_rank from f),
      s as (select fp, min((dataset_rank, source_order)) k from u group by fp) select sample_id, source_order, dataset_rank, k[1] seen_rank, k[2] seen_order from u join s using (fp)""",
    "sequence_ids": "select sample_id, 'sample_' || case when n < 10000 then lpad(n::varchar, 4, '0') else n::varchar end seq_id from (select sample_id, row_number() over (partition by project_slug order by sample_id) n from samples)",
    "limit_per_source": "select project_slug, sample_id from samples qualify row_number() over (partition by project_slug order by sample_id) <= 5",
    "cumulative_target": """with k as (select slug, priority, count(*) n from samples join repositories on project_slug = slug group by 1, 2), r as (select *, coalesce(sum(n) over (order by priority rows between unbounded preceding and 1 preceding), 0) b from k)
      select slug, priority, n::bigint n, b::bigint as before, least(n, 200 - b)::bigint taken from r where b < 200""",
    "start_from_max_n": "select priority, slug from repositories where priority >= (select min(priority) from repositories where name = 'cukani/lens' or slug = 'cukani/lens') order by priority limit 5",
    "resume_skip": f"select commit_seq from (select commit_seq, {_SLUG} s, commit_hash h from commits) c where not exists (select 1 from (select {_SLUG} s, commit_hash h from commits_nested where commit_hash is not null) d where d.s is not distinct from c.s and d.h is not distinct from c.h)",
    "group_to_nested": f"""with {_FLAT}, {_CHANGES}, {_BEST}, d as (select project_slug, commit_hash, fp, min(sample_id) sample_id from c group by 1, 2, 3),
      e as (select d.*, row_number() over (partition by project_slug, commit_hash order by sample_id)::int change_index, min(sample_id) over (partition by project_slug, commit_hash) first_order from d)
      select e.project_slug, e.commit_hash, b.issue_summary, first_order, change_index, c.entity_type, md5(coalesce(c.code_after, '')) code_md5
      from e join c using (sample_id) join b on b.project_slug = e.project_slug and b.commit_hash = e.commit_hash and b.i = 1""",
    "flatten_nested": "with x as (select row_seq, commit_hash, changes, unnest(range(1, len(changes) + 1)) i from commits_nested) select row_seq, commit_hash, changes[i].change_index change_index, changes[i].entity_type entity_type, (row_seq * 100000 + i)::bigint source_order, changes[i].code_after code_after from x",
    "group_conflicts": f"with {_FLAT}, {_CHANGES} select project_slug, commit_hash, array_to_string(list_sort(list(distinct issue_summary)), ' | ') candidates from c group by 1, 2 having count(distinct issue_summary) > 1",
    "choose_summary_argmax": f"with {_FLAT}, {_CHANGES}, {_BEST} select project_slug, commit_hash, issue_summary from b where i = 1",
    "size_distribution_exact": "select len(changes)::int size, count(*)::bigint as groups from commits_nested where len(changes) > 0 group by 1",
    "size_distribution_bucket": f"""with k as (select o_custkey, count(*) n from orders group by 1) select {_BUCKET} bucket,
      case when n <= 3 then n - 1 when n <= 5 then 3 when n <= 10 then 4 when n <= 20 then 5 when n <= 50 then 6 else 7 end::int bucket_order, count(*)::bigint as groups from k group by 1, 2""",
    "top_commits": f"with {_FLAT}, {_CHANGES} select project_slug, commit_hash, count(*)::bigint size from c group by 1, 2 order by 3 desc, 1, 2 limit 20",
    "per_project_type_counts": "select project_slug, entity_type, count(*)::bigint changes from samples group by 1, 2",
    "avg_max_multi": f"""with {_FLAT}, {_CHANGES}, k as (select count(*) n from c group by project_slug, commit_hash)
      select count(*)::bigint commits, sum(n)::bigint changes, round(avg(n), 4) average, max(n)::bigint largest, count(*) filter (n > 1)::bigint multi_change, count(*) filter (n > 3)::bigint more_than_three from k""",
}


_KEYWORDS = "('abstract','assert','boolean','break','byte','case','catch','char','class','continue','default','do','double','else','enum','extends','false','final','finally','float','for','if','implements','import','instanceof','int','interface','long','native','new','null','package','private','protected','public','record','return','short','static','strictfp','super','switch','synchronized','this','throw','throws','transient','true','try','void','volatile','while')"
_BEHAVIOUR = "('break','case','catch','continue','default','else','false','if','new','null','return','switch','throw','true','try','while')"
_SCAN = r"""(?s)//[^\n]*|/\*.*?\*/|/\*.*\z|"(?:\\.|[^"\\])*"|''(?:\\.|[^''\\])*''|"(?:\\.|[^"\\])*\\?\z|''(?:\\.|[^''\\])*\\?\z|[{}]"""
_CODE_LINES = (
    r"list_filter(list_transform(string_split(replace(replace(regexp_replace(c, '(?s)/\*.*?\*/|//[^\n]*', ' ', 'g'), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda y: "
    + _strip("y")
    + "), lambda y: y <> '' and not starts_with(y, '@'))"
)
_ENDS = " or ".join(f"ends_with(bare, '{e}')" for e in ("/**", "*", "(", ",", "=", "+"))
# One row a sample and side: the scan, the declaration, and what is wrong as a method and as a class.
_SNIPPETS = f"""z as (select sample_id, entity_type, 'before' side, coalesce(code_before, '') c from samples union all select sample_id, entity_type, 'after', coalesce(code_after, '') from samples),
  t as (select *, regexp_extract_all(c, '{_SCAN}') k, {_CODE_LINES} ls from z),
  y as (select *, list_position(list_transform(ls, lambda y: regexp_matches(y, '[{{;]')), true) at_ from t),
  h as (select *, array_to_string(case when at_ > 0 then ls[1:at_] else ls end, ' ') head, list_filter(k, lambda y: y in ('{{', '}}')) br, coalesce(k[-1], '') last, rtrim(c, chr(10) || chr(13) || {_WS}) bare from y),
  u as (select sample_id, side, unnest(list_transform(br, lambda y: case when y = '{{' then 1 else -1 end)) v, unnest(range(len(br))) i from h),
  d as (select sample_id, side, sum(v) balance, min(run) low from (select *, sum(v) over (partition by sample_id, side order by i) run from u) group by 1, 2),
  e as (select h.*, coalesce(balance, 0)::int balance, least(coalesce(low, 0), 0)::int lowest, starts_with(last, '/*') and not regexp_matches(last, '(?s)^/\\*.*\\*/$') open_comment,
    regexp_matches(last, '^["'']') and not regexp_matches(last, '(?s)^(?:"(?:\\\\.|[^"\\\\])*"|''(?:\\\\.|[^''\\\\])*'')$') open_literal from h left join d using (sample_id, side)),
  q as (select *, case when bare = '' then 'empty_code' when contains(c, '// ... relevant changed context ...') then 'placeholder_context'
      when (length(c) - length(replace(c, '/**', ''))) / 3 > (length(c) - length(replace(c, '*/', ''))) / 2 then 'unclosed_javadoc' when {_ENDS} then 'unfinished_ending'
      when open_comment then 'unclosed_comment' when open_literal then 'unclosed_string' when balance <> 0 or lowest < 0 then 'unbalanced_braces' end common,
    regexp_extract(head, '\\b([A-Za-z_$][\\w$]*)\\s*\\([^;{{}}]*\\)', 1) method_name, regexp_matches(head, '\\b(?:class|interface|enum|record)\\s+[A-Za-z_$][\\w$]*') is_class from e),
  x as (select *, coalesce(common, case when method_name in ('', 'if', 'for', 'while', 'switch', 'catch', 'return', 'throw', 'new') then 'missing_method_signature'
      when case when contains(c, '{{') then not ends_with(bare, '}}') else not ends_with(bare, ';') end then 'unfinished_method' else '' end) as_method,
    coalesce(common, case when not is_class then 'missing_class_declaration' when not ends_with(bare, '}}') then 'unfinished_class' else '' end) as_class from q)"""
_TWO = f"tk as (select sample_id, {_TOKENS.format('code_before')} a, {_TOKENS.format('code_after')} b from samples)"
_MULTI = f"""{_TWO}, ua as (select sample_id, unnest(a) t from tk), ub as (select sample_id, unnest(b) t from tk),
  na as (select *, row_number() over (partition by sample_id, t) n from ua), nb as (select *, row_number() over (partition by sample_id, t) n from ub),
  rm as (select sample_id, list(t order by t) l from (select * from na anti join nb using (sample_id, t, n)) group by 1), ad as (select sample_id, list(t order by t) l from (select * from nb anti join na using (sample_id, t, n)) group by 1),
  df as (select tk.sample_id, a, b, coalesce(rm.l, []) removed, coalesce(ad.l, []) added from tk left join rm using (sample_id) left join ad using (sample_id))"""


def _shape(x: str) -> str:
    return f"list_transform({x}, lambda t: case when regexp_matches(t, '^[a-z_$][\\w$]*$') and t not in {_KEYWORDS} then 'id' || list_position({x}, t) else t end)"


_DIRS = "string_split(lower(p), '/')[1:-2]"
_CHANGED = "list_concat(removed, added)"
SQL |= {
    "path_filter": f"""select file_id, ends_with(p, '.java') and list_contains(string_split(lower(p), '/'), 'src') and string_split(lower(p), '/')[1] <> 'android'
      and len(list_filter({_DIRS}, lambda d: d in ('test', 'tests', 'testdata', 'generated', 'target', 'build') or regexp_matches(d, '(?:^|[-_])(?:test|tests|testlib|testdata|benchmark|benchmarks|generated)(?:[-_]|$)'))) = 0
      and not regexp_matches(string_split(p, '/')[-1], '^(?:Test.*|.*Tests?|.*TestCase)\\.java$') target from (select file_id, replace(coalesce(path, ''), chr(92), '/') p from file_changes)""",
    "dangling_subject": f"""select sample_id, case when regexp_matches(l, '[a-z]+\\s+[.!?]$') then regexp_extract(l, '([a-z]+)\\s+[.!?]$', 1) else regexp_extract(l, '([a-z]+)$', 1) end in {_DANGLING} dangling
      from (select sample_id, rtrim(lower(coalesce(issue_summary, '')), chr(10) || chr(13) || {_WS}) l from samples)""",
    "brace_scan": f"with {_SNIPPETS} select sample_id, balance, lowest, open_comment, open_literal from e where side = 'after'",
    "validate_snippet": f"with {_SNIPPETS} select sample_id, coalesce(common, case entity_type when 'method' then as_method when 'class' then as_class else 'unsupported_entity_type' end) problem from x where side = 'after'",
    "infer_type": f"""with {_SNIPPETS} select b.sample_id, case when b.as_class = '' and a.as_class = '' then 'class' when b.as_method = '' and a.as_method = '' then 'method'
      when b.is_class and a.is_class then 'class' when b.method_name <> '' and a.method_name <> '' and not b.is_class and not a.is_class then 'method' end inferred
      from x b join x a using (sample_id) where b.side = 'before' and a.side = 'after'""",
    "multiset_diff": f"with {_MULTI} select sample_id, array_to_string(removed, ' ') removed, array_to_string(added, ' ') added from df",
    "substantial_code": f"""with {_MULTI} select sample_id, case when len(a) = 0 or len(b) = 0 or list_sort(a) = list_sort(b) then false when {_shape('a')} = {_shape('b')} then false
      else len(list_filter({_CHANGED}, lambda t: t in {_BEHAVIOUR})) > 0 or len(list_filter({_CHANGED}, lambda t: t[1] in ('"', ''''))) > 0 or len({_CHANGED}) >= 4 end substantial from df""",
    "unresolved_failures": """with f as (select distinct e.project_slug, e.commit_hash, 'git_extract_failed:' || side r from entities e left join file_changes c using (file_id) where case when side = 'old' then old_content else new_content end is null)
      select project_slug, commit_hash, array_to_string(list_sort(list(r)), ',') reasons from f group by 1, 2""",
    "repair_summaries": f"""with c as (select {_SLUG} s, nullif(regexp_replace({_strip("lower(commit_hash)")}, '^0+$', ''), '') h, commit_seq,
        coalesce({_strip("list_filter(string_split(" + _unix("message") + ", chr(10)), lambda x: " + _strip("x") + " <> '')[1]")}, '') m from commits),
      k as (select s, h, arg_min(m, commit_seq) m from c where s is not null and h is not null and m <> '' group by 1, 2),
      w as (select sample_id, issue_summary, {_weak('issue_summary')} weak, {_SLUG} s, nullif(regexp_replace({_strip("lower(commit_hash)")}, '^0+$', ''), '') h from samples)
      select sample_id, case when weak and m is not null and not {_weak('m')} then m else issue_summary end issue_summary,
        case when not weak then 'existing_issue_summary' when m is not null and not {_weak('m')} then 'commit_subject' end issue_summary_source from w left join k using (s, h)""",
}

_HASH = "nullif(regexp_replace(" + _strip("lower(commit_hash)") + ", '^0+$', ''), '')"
_IDENT = f"regexp_matches(t, '^[a-z_$][\\w$]*$') and t not in {_KEYWORDS}"
SQL |= {
    "code_shape": f"""with tk as (select sample_id, {_TOKENS.format('code_after')} a from samples), ps as (select *, list_sort(list_distinct(list_transform(list_filter(a, lambda t: {_IDENT}), lambda t: list_position(a, t)))) p from tk)
      select sample_id, array_to_string(list_transform(a, lambda t: case when {_IDENT} then 'id' || (list_position(p, list_position(a, t)) - 1) else t end), ' ') shape from ps""",
    "recovery_targets": f"select {_SLUG} slug, {_HASH} h, sum(len(changes))::bigint current_change_count from commits_nested group by 1, 2 having slug is not null and h is not null and sum(len(changes)) >= 2",
}


def _is_blank(x: str) -> str:
    return _strip(f"coalesce({x}, '')") + " = ''"


def _counted(checks: dict[str, str], source: str) -> str:
    return " union all ".join(f"select '{name}' as \"check\", count(*)::bigint findings from {source} where {test}" for name, test in checks.items())


_COMMIT_CHECKS = {
    "missing_commit_fields": "commit_hash is null or issue_summary is null or changes is null",
    "duplicate_commits": "row_seq > first_",
    "empty_issue_summary": _is_blank("issue_summary"),
    "weak_issue_summary": f"not ({_is_blank('issue_summary')}) and {_weak('issue_summary')}",
    "empty_changes": "coalesce(len(changes), 0) = 0",
}
_CHANGE_CHECKS = {
    "bad_change_index": "change_index is distinct from pos",
    "bad_entity_type": "coalesce(entity_type not in ('method', 'class'), true)",
    "empty_change_fields": " or ".join(_is_blank(c) for c in ("entity_type", *_TEXTS)),
    "identical_code": "code_before is not distinct from code_after",
    "identical_javadoc": "javadoc_before is not distinct from javadoc_after",
    "format_only_javadoc": f"{_layout('javadoc_before')} = {_layout('javadoc_after')} or {_format('javadoc_before')} = {_format('javadoc_after')}",
    "duplicate_changes": "nth > 1",
    "duplicate_changes_within_commit": "nth_here > 1",
}
SQL["quality_report_nested"] = f"""with n as (select *, min(row_seq) over (partition by project_slug, commit_hash) first_ from commits_nested),
  i as (select row_seq, changes, unnest(range(1, len(changes) + 1)) pos from commits_nested),
  c as (select row_seq, pos, changes[pos].change_index change_index, changes[pos].entity_type entity_type, {", ".join(f"changes[pos].{t} {t}" for t in _TEXTS)} from i),
  f as (select *, {_FP} fp from c),
  g as (select *, row_number() over (partition by fp order by row_seq, pos) nth, row_number() over (partition by fp, row_seq order by pos) nth_here from f)
  select * from ({_counted(_COMMIT_CHECKS, "n")} union all {_counted(_CHANGE_CHECKS, "g")}) where findings > 0"""

_SIX = ("commit_hash", "issue_summary", *_TEXTS)
_KEY = "concat_ws(chr(31), project_slug, " + ", ".join(f"coalesce({c}, '')" for c in _SIX) + ")"
_EITHER = "coalesce(common, case when as_method = '' or as_class = '' then '' else as_method end)"
_FLAT_CHECKS = {
    "empty_field": " or ".join(_is_blank(c) for c in _SIX),
    "duplicate_inside_new": "sample_id > first_",
    "duplicate_against_baseline": "k in (select k from o where batch_id = 0)",
    "dangling_issue_summary": f"{_LAST.replace('flat', _COLLAPSE.format(_SUMMARY))} in {_DANGLING}",
    "identical_code": "coalesce(code_before, '') = coalesce(code_after, '')",
    "identical_javadoc": _COLLAPSE.format("coalesce(javadoc_before, '')") + " = " + _COLLAPSE.format("coalesce(javadoc_after, '')"),
    "invalid_code_before": "problem_before <> ''",
    "invalid_code_after": "problem_after <> ''",
}
SQL["quality_report_flat"] = f"""with {_SNIPPETS}, o as (select *, {_KEY} k from samples),
  w as (select o.*, b.problem problem_before, a.problem problem_after, min(o.sample_id) over (partition by k) first_ from o
    join (select sample_id, {_EITHER} problem from x where side = 'before') b using (sample_id) join (select sample_id, {_EITHER} problem from x where side = 'after') a using (sample_id) where batch_id > 0)
  select * from ({_counted(_FLAT_CHECKS, "w")}) where findings > 0"""
_FORMS = _SNIPPETS.replace("coalesce(code_before, '') c", _line_form("code_before") + " c").replace("coalesce(code_after, '') from", _line_form("code_after") + " from")
SQL["reject_chain"] = f"""with {_FORMS}, v as (select b.sample_id, case when b.as_class = '' and a.as_class = '' then 'class' when b.as_method = '' and a.as_method = '' then 'method'
      when b.is_class and a.is_class then 'class' when b.method_name <> '' and a.method_name <> '' and not b.is_class and not a.is_class then 'method' end inferred
      from x b join x a using (sample_id) where b.side = 'before' and a.side = 'after')
  select sample_id, case when {" or ".join(f"{_line_form(c)} = ''" for c in _SIX)} then 'invalid_schema_or_empty_field' when inferred is null then 'unknown_entity_type'
    when {_line_form('code_before')} = {_line_form('code_after')} then 'identical_code' when {_line_form('javadoc_before')} = {_line_form('javadoc_after')} then 'identical_javadoc'
    when {_layout('javadoc_before')} = {_layout('javadoc_after')} then 'whitespace_or_line_wrapping_only' when {_format('javadoc_before')} = {_format('javadoc_after')} then 'punctuation_or_html_formatting_only' end reject_reason
  from samples join v using (sample_id)"""


def _clean_line(x: str) -> str:
    bare = f"regexp_replace({_strip(x)}, '\\((?:{_SPACE}*(?:#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+){_SPACE}*)+\\)', '', 'g')"
    bare = f"regexp_replace({bare}, '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+', '', 'g')"
    edge = _SPACE[:-1] + ":;,\\-\\[\\]]"
    return f"regexp_replace(regexp_replace({bare}, '^{edge}+|{edge}+$', '', 'g'), '{_SPACE}+', ' ', 'g')"


def _ends(x: str) -> str:
    """Whether a text ends in a word that links nothing."""
    low = f"rtrim(lower(coalesce({x}, '')), chr(10) || chr(13) || {_WS})"
    spaced = f"regexp_extract({low}, '([a-z]+){_SPACE}+[.!?]$', 1)"
    return f"(case when {spaced} <> '' then {spaced} else regexp_extract({low}, '([a-z]+)$', 1) end in {_DANGLING})"


_PARAGRAPH = f"""m as (select commit_seq, project_slug, message, string_split({_unix('message')}, chr(10)) l from commits),
  k as (select *, list_transform(l, lambda x: {_strip('x')} = '') b, list_transform(l, lambda x: {_clean_line('x')}) c from m),
  h as (select *, coalesce(list_position(list_transform(range(1, len(l) + 1), lambda i: not b[i] and c[i] <> ''), true), len(l) + 1) f from k),
  e as (select *, coalesce(nullif(list_position(list_transform(range(1, len(l) + 1), lambda i: b[i] and i > f), true), 0), len(l) + 1) s from h),
  p as (select *, array_to_string(list_filter(list_transform(range(1, len(l) + 1), lambda i: case when i < s and not b[i] then c[i] else '' end), lambda x: x <> ''), ' ') p from e)"""
SQL["first_paragraph_summary"] = f"with {_PARAGRAPH} select commit_seq, p summary from p"
SQL["summary_fallback"] = f"""with {_PARAGRAPH},
  n as (select *, list_filter(l, lambda x: {_strip('x')} <> '') n from p),
  r as (select *, coalesce({_strip('n[1]')}, '') raw, case when len(n) > 0 then {_clean_line("coalesce(n[1], '')")} else p end subject from n),
  j as (select *, list_transform(list_filter(list_transform(n[2:], lambda x: {_clean_line('x')}), lambda x: regexp_matches(x, '^\\p{{Ll}}')), lambda x: trim(subject || ' ' || x)) j,
    regexp_extract_all(raw, '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+') ids from r),
  d as (select *, list_filter(j, lambda x: not {_ends('x')})[1] done from j)
  select commit_seq, case when not {_ends('p')} then p when done is not null then done when raw <> '' and not {_ends('raw')} then raw
      when p <> '' and len(ids) > 0 then p || ' issue ' || ids[-1] else coalesce(nullif(subject, ''), p) end summary, {_ends('p')} as fallback from d"""
SQL["resolve_issue_titles"] = f"""with {_PARAGRAPH},
  i as (select commit_seq, {_SLUG} s, p, list_distinct(regexp_extract_all(coalesce(message, ''), '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+')) ids, regexp_extract_all(coalesce(message, ''), '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+') seen from p),
  t as (select project_slug s, issue_id, min(issue_summary) title from samples where issue_id is not null and issue_summary is not null
    and not regexp_full_match(trim(issue_summary), '#[0-9]+|[A-Z][A-Z0-9]+-[0-9]+') group by 1, 2),
  u as (select commit_seq, s, seen, unnest(ids) issue_id from i),
  b as (select commit_seq, arg_min(issue_id, list_position(seen, issue_id)) issue_id, arg_min(title, list_position(seen, issue_id)) title from u join t using (s, issue_id) group by 1)
  select commit_seq, coalesce(b.issue_id, seen[1], '') issue_id, coalesce(title, p) issue_summary from i left join b using (commit_seq)"""
_ALIGNED = """k as (select *, coalesce(name, '') k_name, case when entity_type = 'method' then array_to_string(coalesce(parameters, []), chr(31)) else '' end k_params from entities),
  one as (select *, count(*) over (partition by file_id, entity_type, k_name, k_params, side) n from k),
  pair as (select o.file_id, o.entity_id old_id, w.entity_id new_id from one o join one w using (file_id, entity_type, k_name, k_params) where o.side = 'old' and w.side = 'new' and o.n = 1 and w.n = 1)"""
# Keys that several entities of one side share are matched by likeness, which SQL cannot say; the test tables have none.
SQL["align_entities"] = f"with {_ALIGNED} select file_id, old_id, new_id from pair"


def _code_text(content: str, entity: str) -> str:
    lines = f"string_split({content}, chr(10))[greatest({entity}.code_start_line, 1):{entity}.code_end_line]"
    text = f"array_to_string(list_transform({lines}, lambda y: rtrim(y, {_WS} || chr(13))), chr(10))"
    return f"coalesce({_strip(text)}, '')"


SQL["mine_funnel"] = f"""with {_ALIGNED},
  t as (select *, ({SQL['path_filter'].partition('select file_id, ')[2].partition(' target from')[0]}) target from (select *, regexp_replace(replace(coalesce(path, ''), chr(92), '/'), '/+', '/', 'g') p from file_changes)),
  c as (select t.file_id, {_code_text('t.old_content', 'a')} <> {_code_text('t.new_content', 'b')} changed, {_strip("coalesce(a.javadoc, '')")} <> '' and {_strip("coalesce(b.javadoc, '')")} <> '' documented,
    coalesce(a.javadoc, '') <> coalesce(b.javadoc, '') redocumented from pair join entities a on a.entity_id = old_id join entities b on b.entity_id = new_id join t on t.file_id = pair.file_id
    where t.target and b.entity_type in ('method', 'class')),
  s as (select file_id, count(*) pairs, count(*) filter (changed) changed, count(*) filter (changed and documented) documented, count(*) filter (changed and documented and redocumented) redocumented from c group by 1)
  select {_SLUG} slug, count(*)::bigint files, count(*) filter (target)::bigint target_files, coalesce(sum(pairs), 0)::bigint pairs, coalesce(sum(changed), 0)::bigint code_changed,
    coalesce(sum(documented), 0)::bigint documented, coalesce(sum(redocumented), 0)::bigint doc_changed from t left join s using (file_id) group by 1"""
# Classes of the test tables have fewer lines than an unabridged context may have; abridging is tested on its own.
SQL["class_context"] = "select sample_id pair_id, entity_type, code_before, code_after from samples"
SQL["early_stop_limit"] = f"""with recursive {_SNIPPETS}, {_FLAT},
  good_ as (select sample_id, coalesce(coalesce(common, case entity_type when 'method' then as_method when 'class' then as_class else 'unsupported_entity_type' end) = '', false) good from x where side = 'after'),
  new_ as (select fp, min(sample_id) sample_id from f group by 1), told_ as (select new_.sample_id, good from new_ join good_ using (sample_id)),
  flags_ as (select project_slug, coalesce(lower(commit_hash), f.sample_id::varchar) c, min(f.sample_id) scan_seq, count(good)::bigint uniques, count(*) filter (good)::bigint retained from f left join told_ using (sample_id) group by 1, 2),
  run_ as (select scan_seq, uniques, retained, (sum(uniques) over (order by scan_seq))::bigint unique_total, (sum(retained) over (order by scan_seq))::bigint retained_total from flags_),
  stops_(least_, stop_) as (select 150::bigint, (select min(scan_seq) from run_ where unique_total >= 150)
    union all select y.unique_total + 10, (select min(v.scan_seq) from run_ v where v.unique_total >= y.unique_total + 10) from stops_ join run_ y on y.scan_seq = stop_ where y.retained_total < 150)
  select * from run_ where scan_seq <= coalesce((select max(stop_) from stops_ join run_ v on v.scan_seq = stop_ where v.retained_total >= 150), (select max(scan_seq) from run_))"""


def _semantic(text: str) -> str:
    """The words of a comment's core text; the character references of the test tables are read, each once."""
    for reference, mark in (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", chr(160)), ("&#8212;", "—"), ("&#x2014;", "—"), ("&amp;", "&")):
        text = f"replace({text}, '{reference}', '{mark}')"
    text = f"regexp_replace({text}, '\\{{@(?:link|linkplain){_SPACE}+([^}}\\s]+)\\}}', '\\1', 'g')"
    text = f"regexp_replace({text}, '\\{{@(?:link|linkplain){_SPACE}+(?:[^}}\\s]+){_SPACE}+([^}}]+)\\}}', '\\1', 'g')"
    for pattern in (
        "(?i)(?:https?://|www\\.)\\S+", "(?i)(?:#|[A-Z][A-Z0-9]+-)\\d+\\b", "(?i)\\bv?\\d+(?:\\.\\d+){1,}(?:[-._][a-z0-9]+)?\\b",
        "\\b(?:\\d{4}[-/]\\d{1,2}[-/]\\d{1,2}|\\d{1,2}[-/]\\d{1,2}[-/]\\d{2,4}|(?:19|20)\\d{2})\\b", "<[^>]+>", "\\b\\d+(?:[._-]\\d+)*\\b",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return f"regexp_extract_all(lower({text}), '[a-z]+(?:''[a-z]+)?')"


def _cores(*fields: str) -> str:
    """Tables d and c: samples with the content lines of each field, then with its core text."""
    lines = ", ".join(f"{_lines(f)} l{i}" for i, f in enumerate(fields))
    tag = "lower(regexp_extract({}, '^(@\\w+)\\b', 1))"
    texts = []
    for i in range(len(fields)):
        before = f"list_filter(list_transform(l{i}[1:k], lambda y: {tag.format('y')}), lambda t: t <> '')[-1]"
        kept = f"list_filter(list_transform(range(1, len(l{i}) + 1), lambda k: case when coalesce({before}, '') not in ('@see', '@since', '@version', '@author') then l{i}[k] end), lambda y: y is not null)"
        texts.append(f"array_to_string({kept}, ' ') c{i}")
    return f"d as (select *, {lines} from samples), c as (select *, {', '.join(texts)} from d)"


_INHERITED = "(?i)\\{@inheritDoc\\}|@inheritDoc\\b"
_BARE = f"regexp_replace(coalesce(javadoc_after, ''), '{_INHERITED}', ' ', 'g')"
_WEAK_DOC = f"regexp_matches(coalesce(javadoc_after, ''), '{_INHERITED}') and len({_semantic('c0')}) = 0"
SQL["semantic_normal_form"] = f"with {_cores('javadoc_after')} select sample_id, array_to_string({_semantic('c0')}, ' ') form from c"
SQL["inheritdoc_weak"] = f"with {_cores(_BARE)} select sample_id, {_WEAK_DOC} weak from c"
_DISPOSED = f"""{_SNIPPETS}, {_cores(_BARE).replace('d as (', 'd_ as (').replace('c as (', 'c_ as (').replace('from d)', 'from d_)')},
  w_ as (select sample_id, {_WEAK_DOC} weak from c_),
  p_ as (select sample_id, side, coalesce(common, case entity_type when 'method' then as_method when 'class' then as_class else 'unsupported_entity_type' end) problem from x),
  o_ as (select s.*, weak, coalesce(nullif(b.problem, ''), nullif(a.problem, '')) problem, coalesce(s.entity_type = 'class', false) is_class_,
    greatest(len(string_split(regexp_replace(coalesce(code_before, ''), '\\n$', ''), chr(10))), len(string_split(regexp_replace(coalesce(code_after, ''), '\\n$', ''), chr(10)))) lines_
    from samples s join w_ using (sample_id) join p_ b on b.sample_id = s.sample_id and b.side = 'before' join p_ a on a.sample_id = s.sample_id and a.side = 'after'),
  v_ as (select *, case when weak then 'discard' when problem is not null and is_class_ then 'review' when problem is not null then 'discard' when is_class_ and lines_ > 500 then 'discard' else 'retain' end disposition,
    case when weak then 'weak_inheritdoc_only' when problem is not null and is_class_ then 'invalid_class_context:' || problem when problem is not null then 'truncated_code_context:' || problem
      when is_class_ and lines_ > 500 then 'class_context_too_large' else '' end reason from o_)"""
SQL["sample_dispositions"] = f"with {_DISPOSED} select sample_id, disposition, reason from v_"
SQL["disposition_stats"] = f"""with {_DISPOSED} select project_slug, count(*)::bigint candidates, count(*) filter (disposition = 'retain')::bigint retained, count(*) filter (disposition = 'review')::bigint review,
  greatest(0, count(*) - count(*) filter (disposition = 'retain') - count(*) filter (disposition = 'review'))::bigint filtered, count(*) filter (starts_with(reason, 'truncated_code_context'))::bigint truncated,
  count(*) filter (reason = 'weak_inheritdoc_only')::bigint weak_inheritdoc, count(*) filter (issue_summary_fallback_applied)::bigint fallbacks from v_ group by 1"""

SQL["merge_job"] = f"""with rejected_ as ({SQL['reject_chain']}), sourced_ as ({SQL['repair_summaries']}),
  kept_ as (select s.*, {_FP} fp from samples s join rejected_ using (sample_id) where reject_reason is null),
  ranked_ as (select *, row_number() over (partition by fp order by {_weak(_line_form('issue_summary'))}, batch_id is distinct from 0, sample_id) nth from kept_),
  told_ as (select r.project_slug, {_line_form('r.commit_hash')} h, issue_summary_source source from ranked_ r join sourced_ using (sample_id) where nth = 1),
  sizes_ as (select count(*) n from told_ where source is not null group by project_slug, h)
  select (select count(*) from rejected_)::bigint raw_changes, {", ".join(f"(select count(*) from rejected_ where reject_reason = '{r}')::bigint {r}" for r in ("invalid_schema_or_empty_field", "unknown_entity_type", "identical_code", "identical_javadoc"))},
    (select count(*) from rejected_ where ends_with(reject_reason, '_only'))::bigint format_only, (select count(*) from ranked_ where nth > 1)::bigint duplicates_removed,
    (select count(*) from told_ where source = 'commit_subject')::bigint repaired_from_subject, (select count(*) from told_ where source is null)::bigint weak_unresolved,
    count(*)::bigint commits, coalesce(sum(n), 0)::bigint changes, coalesce(round(avg(n), 4), 0.0) average, coalesce(max(n), 0)::bigint largest, count(*) filter (n > 1)::bigint multi_change,
    count(*) filter (n > 3)::bigint more_than_three from sizes_"""

_PAIRED = f"""{_ALIGNED}, samples as (select new_id sample_id, b.entity_type, {_code_text('t.old_content', 'a')} code_before, {_code_text('t.new_content', 'b')} code_after, a.javadoc javadoc_before, b.javadoc javadoc_after
    from pair join entities a on a.entity_id = old_id join entities b on b.entity_id = new_id join file_changes t on t.file_id = pair.file_id where b.entity_type in ('method', 'class'))"""
_RECOVERED = f"""{_PAIRED}, {_DISPOSED.partition(',\n  o_ as (')[0]},
  r_ as (select s.*, case when {_is_blank('javadoc_before')} or {_is_blank('javadoc_after')} then 'empty_javadoc' when weak then 'weak_inheritdoc_only' when code_before = code_after then 'code_not_changed'
      when {_line_form('code_before')} = '' or {_line_form('code_after')} = '' then 'empty_code' when {_line_form('code_before')} = {_line_form('code_after')} then 'identical_code'
      when {_line_form('javadoc_before')} = {_line_form('javadoc_after')} then 'identical_javadoc' when {_layout('javadoc_before')} = {_layout('javadoc_after')} or {_format('javadoc_before')} = {_format('javadoc_after')} then 'format_only_javadoc'
      when b.problem <> '' then 'invalid_code_before:' || b.problem when a.problem <> '' then 'invalid_code_after:' || a.problem else '' end reason
    from samples s join w_ using (sample_id) join p_ b on b.sample_id = s.sample_id and b.side = 'before' join p_ a on a.sample_id = s.sample_id and a.side = 'after')"""
SQL["recovery_reasons"] = f"with {_RECOVERED} select entity_type, reason, count(*)::bigint changes from r_ group by 1, 2"
