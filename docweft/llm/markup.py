"""Documentation comments to clean text: HTML, Javadoc inline tags, Markdown, wiki and LaTeX.

The comment frame is taken off, and each kind of markup is told by its own patterns from what only looks
like it (type arguments, operators, prices, paths, placeholders, identifiers). Texts without any of the marks that
markup needs never leave the JVM; for the others one set of patterns, without bounds on length, both tells the
kinds and makes text with one notation for what is kept: ``#`` headings, ``-`` and ``1.`` items, ```` ``` ````
code blocks, backticks for code in a line, ``$`` for formulas, ``|`` for table cells.

Page differencing, the method named for this task, is in ``pages``: it removes lines that neighbouring pages share.
It cannot tell markup, which stands inside lines of its own page, from text; README has its figures.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("javadoc_before", "javadoc_after")

# Element names of HTML, commands of LaTeX that stand without a brace.
HTML_NAMES = (
    "a abbr acronym address article aside audio b bdi bdo big blockquote body br button caption center cite code col "
    "colgroup dd del details dfn dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 "
    "h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript "
    "object ol optgroup option p param picture pre q rp rt ruby s samp script section select small source span strike "
    "strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr track tt u ul var video wbr"
).split()
LATEX_BARE = (
    "alpha beta gamma delta epsilon theta lambda mu pi sigma phi omega infty log ln exp sin cos tan min max lim sum prod int "
    "cdot times leq geq neq le ge ne in subset cup cap to rightarrow ldots dots quad item bf it em tt rm sc noindent par"
).split()

_UPPER = "|".join(n.upper() for n in HTML_NAMES if len(n) > 1)
_SINGLE = "|".join(n.upper() for n in HTML_NAMES if len(n) == 1)
_ELEMENT = (
    rf"</?(?:{'|'.join(HTML_NAMES)}|{_UPPER})(?:\s[^<>]*)?/?>|(?<![A-Za-z0-9_$.])<(?:{_SINGLE})(?:\s[^<>]*)?/?>|</(?:{_SINGLE})>"
)
# A line that begins like an item or a quotation counts only after a blank line, a finished sentence or its like;
# otherwise it is the rest of a wrapped sentence ("where a\n> 0").
_AFTER = r"(?:\A|(?<=[.:;!?`)}>\n])[ \t]*\n|\A[ \t]*\n)[ \t]*"



def _run(stop: str) -> str:
    """A run without the marks ``stop`` that does not cross a blank line; matched in one way only, so in linear time."""
    return rf"[^{stop}\n]*+(?:\n(?![ \t]*\n)[^{stop}\n]*+)*+"


# Spans, each used to tell and to convert. A span ends at its mark or fails; most do not cross a blank line.
CODE = rf"(?<!`)(`{{1,2}})(?![`\s])({_run('`')})(?<!\s)\1(?!`)"
STRONG = rf"(?<![*\w])\*\*(?=[^\s*])({_run('*')})(?<=[^\s*])\*\*(?![*\w])"
STRONG_LOW = r"(?<!\w)__(?=[^\W_])(?=[^_\s]*\s)([^_]++)(?<=[^\s_])__(?!\w)"
EMPHASIS = rf"(?<![*\w/])\*(?=[^\s*/])({_run('*')})(?<=[^\s*])\*(?![*\w/])"
EMPHASIS_LOW = rf"(?<!\w)_(?=[A-Za-z])(?=[^_.\s]*\s)({_run('_.')})(?<=[^\s_])_(?!\w)"
STRIKE = rf"~~(?=[^\s~])({_run('~')})(?<=[^\s~])~~"
LINK = r"!?\[([^\[\]]++)\]\([^()\s]++\)"
WIKI_LINK = r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]"
WIKI_URL = r"\[([^\[\]|\n]++)\|(?:https?:|mailto:)[^\[\]\n]++\]"
WIKI_QUOTES = r"(?<!')('{5}|'{2,3})(?=[^\s'])([^']++)(?<=[^\s'])\1(?!')"
WIKI_HEADING = r"(?m)^[ \t]*[hH]([1-6])\.[ \t]+(\S.*)$"
WIKI_EQUALS = r"(?m)^[ \t]*(={2,6})[ \t]*([^=\s][^=\n]*?)[ \t]*\1[ \t]*$"
WIKI_TRIPLE = r"\{\{\{((?:[^{}]|\{(?!\{\{)|\}(?!\}\}))++)\}\}\}"
WIKI_BRACES = r"\{\{(?:monospace\s+)?([^{}]++)\}\}"
WIKI_BLOCK = r"(?is)\{(code|noformat)(?::[^{}\n]*)?\}(.*?)\{\1\}"
WIKI_MACRO = r"(?is)\{(color|quote|panel)(?::[^{}\n]*)?\}(.*?)\{\1\}"
WIKI_QUOTE = r"(?m)^[ \t]*bq\.[ \t]+(?=\S)"
RULE = r"(?m)^[ \t]*(?:-{3,}|={3,})[ \t]*$"
QUOTE = r"(?m)" + _AFTER + r">[ \t]+(?=\S)"
BRACKETS = r"\\\[(?!\\\])([^\\\n]*+(?:(?:\\(?![\[\]])|\n(?![ \t]*\n))[^\\\n]*+)*+)\\\]"
PARENTHESES = r"\\\((?!\\\))([^\\\n]*+(?:(?:\\(?![()])|\n(?![ \t]*\n))[^\\\n]*+)*+)\\\)"
DISPLAY = rf"\$\$(?!\$)({_run('$')})(?<!\$)\$\$"
INLINE = rf"(?<![\w$\\])\$(?![\s$])(?=[^$\\^_]*[\\^_])({_run('$')})(?<![\s$])\$(?![\w$])"

#: kind, marks (one of these must be in the text), pattern.
RULES: list[tuple[str, tuple[str, ...], str]] = [
    ("html_comment", ("<!--",), r"<!--"),
    ("html_element", ("<",), _ELEMENT),
    ("html_reference", ("&",), r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,31}\d{0,2});"),
    ("javadoc_inline", ("{@",), r"\{@[A-Za-z]+"),
    ("markdown_fence", ("```", "~~~"), r"(?m)^[ \t]*(?:```|~~~)"),
    ("markdown_code", ("`",), CODE),
    ("markdown_strong", ("**",), STRONG),
    ("markdown_strong", ("__",), STRONG_LOW),
    ("markdown_emphasis", ("*",), EMPHASIS),
    ("markdown_emphasis", ("_",), EMPHASIS_LOW),
    ("markdown_strike", ("~~",), STRIKE),
    ("markdown_link", ("](",), LINK),
    ("markdown_heading", ("#",), r"(?m)^[ \t]*#{1,6}[ \t]+\S"),
    ("markdown_rule", ("---", "==="), RULE),
    ("table", ("|",), r"(?m)^[ \t]*\|.*\|[ \t]*$"),
    ("markdown_item", ("- ", "+ "), r"(?m)" + _AFTER + r"[-+][ \t]+(?=[\w*`\[{\"(])"),
    ("markdown_item", (". ", ") "), r"(?m)" + _AFTER + r"\d{1,2}[.)][ \t]+(?=[A-Za-z*`\[{])"),
    ("markdown_quote", ("> ",), QUOTE),
    ("wiki_link", ("[[",), WIKI_LINK),
    ("wiki_link", ("|",), WIKI_URL),
    ("wiki_quotes", ("''",), WIKI_QUOTES),
    ("wiki_heading", ("h", "H"), WIKI_HEADING),
    ("wiki_heading", ("==",), WIKI_EQUALS),
    ("wiki_braces", ("{{",), WIKI_BRACES),
    ("wiki_braces", ("{{{",), WIKI_TRIPLE),
    ("wiki_macro", ("{",), WIKI_BLOCK),
    ("wiki_macro", ("{",), WIKI_MACRO),
    ("wiki_macro", ("{panel:",), r"\{panel:[^{}\n]+\}"),
    ("wiki_quote", ("bq.",), WIKI_QUOTE),
    ("latex_command", ("\\",), r"(?<![\w:.\\/])\\[A-Za-z]+[*_^]?(?:\[[^\[\]\n]*\])?\{"),
    ("latex_command", ("\\",), rf"(?<![\w:.\\/])\\(?:{'|'.join(LATEX_BARE)})(?![A-Za-z\\])"),
    ("latex_math", ("\\[",), BRACKETS),
    ("latex_math", ("\\(",), PARENTHESES),
    ("latex_math", ("$$",), DISPLAY),
    ("latex_math", ("$",), INLINE),
]
_COMPILED = [(kind, marks, re.compile(pattern, re.ASCII)) for kind, marks, pattern in RULES]
# Signs of which any markup has at least one: texts without them are plain.
SIGNS = r"[<&{`*_~\[|#>=\\$']|---|[-+.)][ \t]|[hH][1-6]\."


def body(doc: Column) -> Column:
    """The comment without its frame: no opening and closing marks, no star and one space before each line."""
    unix = F.regexp_replace(F.coalesce(doc, F.lit("")), r"\r\n?", "\n")
    inside = F.regexp_replace(unix, r"\A\s*/\*+|\*+/\s*\z", "")
    return F.regexp_replace(inside, r"(?m)^[ \t]*\*(?!\*) ?", "")


def kinds(text: str) -> list[str]:
    """The kinds of markup in a comment's body, each once, in the order of the rules."""
    return list(dict.fromkeys(kind for kind, marks, pattern in _COMPILED if any(m in text for m in marks) and pattern.search(text)))


def _bodies(samples: DataFrame) -> DataFrame:
    """(sample_id, field, body) of every comment that is not null."""
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("doc")) for f in FIELDS])
    each = samples.select("sample_id", F.explode(fields).alias("x")).where("x.doc is not null")
    return each.select(F.col("sample_id").cast("bigint").alias("sample_id"), "x.field", body(F.col("x.doc")).alias("body"))


def found(samples: DataFrame) -> DataFrame:
    """(sample_id, field) of the comments that contain markup. Nulls and empty texts contain none."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["sample_id", "field"]).filter(pa.array([bool(kinds(x)) for x in batch.column("body").to_pylist()], pa.bool_()))

    return _bodies(samples).where(F.col("body").rlike(SIGNS)).mapInArrow(kernel, "sample_id bigint, field string").distinct()


_PRE = re.compile(r"<pre\b[^<>]*>(.*?)(?:</pre>|\Z)", re.S | re.I)
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting)\}(.*?)\\end\{\1\}", re.S)
_ELEMENTS = re.compile(_ELEMENT)


class _Keeper:
    """Takes finished pieces out of the text, so that later rules do not read them as markup."""

    def __init__(self) -> None:
        self.kept: list[str] = []

    def __call__(self, piece: str) -> str:
        self.kept.append(piece)
        return f"\ue000{len(self.kept) - 1}\ue001"

    def restore(self, text: str) -> str:
        for _ in range(8):
            new = re.sub("\ue000(\\d+)\ue001", lambda m: self.kept[int(m[1])], text)
            if new == text:
                break
            text = new
        return text


def _inline_tags(text: str, keep: _Keeper) -> str:
    """Javadoc inline tags, braces matched: code stays code, links give their label or target."""
    out, at = [], 0
    for m in re.finditer(r"\{@([A-Za-z]+)", text):
        if m.start() < at:
            continue
        depth, end = 1, m.end()
        while end < len(text) and depth:
            depth += (text[end] == "{") - (text[end] == "}")
            end += 1
        content = text[m.end() : end - (depth == 0)].strip()
        name = m[1].lower()
        if name in ("code", "snippet"):
            new = keep(f"`{content}`") if content else ""
        elif name == "literal":
            new = keep(content)
        elif name in ("link", "linkplain"):
            target = re.match(r"[^\s(]*(?:\([^()]*\))?", content)[0]
            new = content[len(target) :].strip() or target.lstrip("#").replace("#", ".")
        elif name == "value":
            new = keep(f"`{content.lstrip('#')}`") if content else ""
        elif name == "inheritdoc":
            new = ""
        else:
            new = content
        out += [text[at : m.start()], new]
        at = end
    return "".join(out) + text[at:]


def clean(text: str) -> str:
    """Clean text of a comment's body (see the module's notation)."""
    keep = _Keeper()

    def block(code: str) -> str:
        lines = code.strip("\n").split("\n")
        while lines and not lines[-1].strip():
            lines.pop()
        margin = min((len(x) - len(x.lstrip()) for x in lines if x.strip()), default=0)
        return "\n" + keep("```\n" + "\n".join(x[margin:].rstrip() for x in lines) + "\n```") + "\n"

    text = text.replace("\ue000", "").replace("\ue001", "")
    text = re.sub(r"<!--.*?(?:-->|\Z)", "", text, flags=re.S)
    text = _PRE.sub(lambda m: block(html.unescape(_ELEMENTS.sub("", m[1]))), text)
    text = _FENCE.sub(lambda m: block(m[2]), text)
    text = re.sub(WIKI_BLOCK, lambda m: block(m[2]), text)
    text = _VERBATIM.sub(lambda m: block(m[2]), text)
    text = re.sub(WIKI_TRIPLE, lambda m: keep(f"`{m[1].strip()}`"), text)
    text = re.sub(WIKI_BRACES, lambda m: keep(f"`{m[1].strip()}`"), text)
    text = _inline_tags(text, keep)
    text = re.sub(CODE, lambda m: keep(f"`{m[2]}`"), text, flags=re.A)
    for pattern in (DISPLAY, BRACKETS, PARENTHESES, INLINE):
        text = re.sub(pattern, lambda m: keep(f"${' '.join(m[1].split())}$"), text, flags=re.A)
    # HTML
    text = re.sub(r"<code\b[^<>]*>(.*?)</code>", lambda m: keep(f"`{html.unescape(m[1].strip())}`"), text, flags=re.S | re.I)
    text = re.sub(r"<h([1-6])\b[^<>]*>(.*?)</h\1>", lambda m: f"\n{'#' * int(m[1])} {' '.join(m[2].split())}\n", text, flags=re.S | re.I)

    def ordered(m: re.Match) -> str:
        number = iter(range(1, len(m[0])))
        return re.sub(r"<li\b[^<>]*>\s*", lambda _: f"\n{next(number)}. ", m[1], flags=re.I) + "\n"

    text = re.sub(r"<ol\b[^<>]*>(.*?)</ol>", ordered, text, flags=re.S | re.I)
    text = re.sub(r"<(?:li|dt)\b[^<>]*>\s*", "\n- ", text, flags=re.I)
    text = re.sub(r"<dd\b[^<>]*>\s*", ": ", text, flags=re.I)
    text = re.sub(r"</t[dh]>\s*<t[dh]\b[^<>]*>", " | ", text, flags=re.I)
    text = re.sub(r"<tr\b[^<>]*>\s*<t[dh]\b[^<>]*>", "\n| ", text, flags=re.I)
    text = re.sub(r"</t[dh]>\s*</tr>", " |\n", text, flags=re.I)
    text = re.sub(r"<img\b[^<>]*?alt=['\"]([^'\"]*)['\"][^<>]*>", r"\1", text, flags=re.I)
    text = re.sub(r"<br\s*/?>", "\n", text, flags=re.I)
    text = re.sub(r"</?(?:p|div|ul|dl|table|blockquote|hr|section|article)\b[^<>]*>", "\n\n", text, flags=re.I)
    text = _ELEMENTS.sub("", text)
    text = html.unescape(text) if "&" in text else text
    # LaTeX
    text = re.sub(r"(?<![\w:.\\/])\\(sub)*section\*?\{([^{}]*)\}", lambda m: f"\n## {m[2]}\n", text)
    text = re.sub(r"(?<![\w:.\\/])\\(?:begin|end)\{[^{}]*\}", "\n", text)
    text = re.sub(r"(?<![\w:.\\/])\\item\b\s*", "\n- ", text)
    text = re.sub(r"\{\\(?:bf|it|em|tt|rm|sc)\s+([^{}]*)\}", r"\1", text)
    text = re.sub(r"(?<![\w:.\\/])(\\(?:sum|prod|int|lim|frac|sqrt)(?:[_^]?\{[^{}]*\}|[_^]\w)*(?:\s*\w+_\w+)?)", lambda m: keep(f"${m[1]}$"), text)
    text = re.sub(r"(?<![\w:.\\/])\\[A-Za-z]+\*?(?:\[[^\[\]\n]*\])?\{([^{}]*)\}", r"\1", text)
    # Wiki
    text = re.sub(WIKI_HEADING, lambda m: f"{'#' * int(m[1])} {m[2]}", text)
    text = re.sub(WIKI_EQUALS, lambda m: f"{'#' * len(m[1])} {m[2]}", text)
    text = re.sub(WIKI_LINK, r"\1", text)
    text = re.sub(WIKI_URL, r"\1", text)
    text = re.sub(WIKI_QUOTES, r"\2", text)
    text = re.sub(WIKI_MACRO, r"\2", text)
    text = re.sub(r"(?m)^[ \t]*\|\|(.+)\|\|[ \t]*$", lambda m: "| " + " | ".join(x.strip() for x in m[1].split("||")) + " |", text)
    text = re.sub(WIKI_QUOTE, "", text)
    # Markdown
    for pattern in (LINK, STRONG, STRONG_LOW, EMPHASIS, EMPHASIS_LOW, STRIKE):
        text = re.sub(pattern, r"\1", text, flags=re.A)
    text = re.sub(r"(?m)^[ \t]*(\S.*)\n[ \t]*(-{3,}|={3,})[ \t]*$", lambda m: f"## {m[1]}" if "|" not in m[1] else m[0], text)
    text = re.sub(r"(?m)^[ \t]*\|(?:[ \t]*:?-{2,}:?[ \t]*\|)+[ \t]*\n?", "", text)
    text = re.sub(r"(?m)^[ \t]*(?:-{3,}|={3,})[ \t]*$", "", text)
    text = re.sub(r"(?m)(?:(?<=\A)|(?<=[.:;!?`\n]\n)|(?<=\n\n))[ \t]*>[ \t]+", "", text)
    text = re.sub(r"[ \t]+\n", "\n", text)
    return keep.restore(re.sub(r"\n{3,}", "\n\n", text)).strip()


def cleaned(samples: DataFrame) -> DataFrame:
    """(sample_id, field, kinds, clean_text) of every comment that is not null.

    Texts without a sign of markup only lose their frame, inside the JVM; the others are read by a Python worker, and
    those in which a rule finds markup are converted.
    """
    each = _bodies(samples).withColumn("signs", F.col("body").rlike(SIGNS))
    trimmed = F.regexp_replace("body", r"(?U)\A\s+|\s+\z", "")
    plain = each.where("not signs").select("sample_id", "field", F.expr("cast(array() as array<string>)").alias("kinds"), trimmed.alias("clean_text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").to_pylist()
            told = [kinds(x) for x in texts]
            done = [clean(x) if k else x.strip() for x, k in zip(texts, told, strict=True)]
            same = {c: batch.column(c) for c in ("sample_id", "field")}
            yield pa.record_batch({**same, "kinds": pa.array(told, pa.list_(pa.string())), "clean_text": pa.array(done, pa.string())})

    marked = each.where("signs").select("sample_id", "field", "body").mapInArrow(kernel, "sample_id bigint, field string, kinds array<string>, clean_text string")
    return plain.union(marked)
