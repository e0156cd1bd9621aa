"""Shape of Java snippets: braces outside comments and literals, declarations, and what is wrong with a snippet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import let
from .text import WS_CHARS, strip, text_or_empty, unix_lines
from .tokens import COMMENTS

# Fixed values.
PLACEHOLDER = "// ... relevant changed context ..."
UNFINISHED = ["/**", "*", "(", ",", "=", "+"]
CONTROL = ["if", "for", "while", "switch", "catch", "return", "throw", "new"]
CLASS_DECLARATION = r"(?U)\b(?:class|interface|enum|record)\s+[A-Za-z_$][\w$]*"
METHOD_DECLARATION = r"(?U)\b([A-Za-z_$][\w$]*)\s*\([^;{}]*\)"
_SCAN = (
    r"(?s)//[^\n]*|/\*.*?\*/|/\*.*\z|\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\\?\z|'(?:\\.|[^'\\])*\\?\z|[{}]"
)


def scan(code: Column) -> Column:
    """STRUCT(balance, lowest, open_comment, open_literal) of the braces outside comments and literals."""
    return let(F.regexp_extract_all(text_or_empty(code), F.lit(_SCAN), 0), _scan_tokens)


def _scan_tokens(tokens: Column) -> Column:
    braces = F.filter(tokens, lambda t: t.isin("{", "}"))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low"))

    def fold(state: Column, brace: Column) -> Column:
        depth = state["depth"] + F.when(brace == "{", 1).otherwise(-1)
        return F.struct(depth.alias("depth"), F.least(state["low"], depth).alias("low"))

    folded = F.aggregate(braces, start, fold)
    last = F.coalesce(F.try_element_at(tokens, F.lit(-1)), F.lit(""))
    return let(F.struct(folded.alias("f"), last.alias("last")), lambda x: _scan_result(x["f"], x["last"]))


def _scan_result(folded: Column, last: Column) -> Column:
    closed_literal = last.rlike(r"(?s)\A(?:\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*')\z")
    return F.struct(
        folded["depth"].alias("balance"),
        folded["low"].alias("lowest"),
        (F.startswith(last, F.lit("/*")) & ~last.rlike(r"(?s)\A/\*.*\*/\z")).alias("open_comment"),
        (last.rlike(r"\A[\"']") & ~closed_literal).alias("open_literal"),
    )


def declaration(code: Column) -> Column:
    """Lines without comments and annotation lines, up to the first with a brace or semicolon, joined by spaces."""
    lines = F.transform(F.split(unix_lines(F.regexp_replace(text_or_empty(code), COMMENTS, " ")), "\n"), strip)
    lines = F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("@")))

    def head(ls: Column) -> Column:
        ends = F.filter(F.transform(ls, lambda x, i: F.when(x.rlike("[{;]"), i + 1)), lambda i: i.isNotNull())
        return F.array_join(F.slice(ls, 1, F.coalesce(F.get(ends, F.lit(0)), F.size(ls))), " ")

    return let(lines, head)


def _count(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)


def common_problem(code: Column) -> Column:
    """The first fault that any snippet can have; null if none."""
    text = text_or_empty(code)
    bare = F.rtrim(text, F.lit(WS_CHARS + "\n\r"))
    unfinished = F.endswith(bare, F.lit(UNFINISHED[0]))
    for end in UNFINISHED[1:]:
        unfinished = unfinished | F.endswith(bare, F.lit(end))
    deep = let(
        scan(code),
        lambda s: F.when(s["open_comment"], "unclosed_comment").when(s["open_literal"], "unclosed_string").when((s["balance"] != 0) | (s["lowest"] < 0), "unbalanced_braces"),
    )
    return (
        F.when(bare == "", "empty_code")
        .when(F.contains(text, F.lit(PLACEHOLDER)), "placeholder_context")
        .when(_count(text, "/**") > _count(text, "*/"), "unclosed_javadoc")
        .when(unfinished, "unfinished_ending")
        .otherwise(deep)
    )


def _as_method(code: Column, head: Column) -> Column:
    text = text_or_empty(code)
    bare = F.rtrim(text, F.lit(WS_CHARS + "\n\r"))
    name = F.regexp_extract(head, METHOD_DECLARATION, 1)
    ended = F.when(F.contains(text, F.lit("{")), F.endswith(bare, F.lit("}"))).otherwise(F.endswith(bare, F.lit(";")))
    return F.when(name.isin("", *CONTROL), "missing_method_signature").when(~ended, "unfinished_method").otherwise("")


def _as_class(code: Column, head: Column) -> Column:
    bare = F.rtrim(text_or_empty(code), F.lit(WS_CHARS + "\n\r"))
    return F.when(~head.rlike(CLASS_DECLARATION), "missing_class_declaration").when(~F.endswith(bare, F.lit("}")), "unfinished_class").otherwise("")


def snippet_problem(code: Column, entity_type: Column) -> Column:
    """What is wrong with a snippet of the given type; empty if nothing."""
    def special(head: Column) -> Column:
        return F.when(entity_type == "method", _as_method(code, head)).when(entity_type == "class", _as_class(code, head)).otherwise("unsupported_entity_type")

    return F.coalesce(common_problem(code), let(declaration(code), special))


def either_problem(code: Column) -> Column:
    """As ``snippet_problem`` of a method or a class, whichever it can be; else the method's fault."""
    def special(head: Column) -> Column:
        return let(_as_method(code, head), lambda method: F.when((method == "") | (_as_class(code, head) == ""), "").otherwise(method))

    return F.coalesce(common_problem(code), let(declaration(code), special))


def infer_type(before: Column, after: Column) -> Column:
    """class, method or null, from validity on both sides, else from the declarations."""
    def decide(problem: Column, a: Column, b: Column) -> Column:
        def valid(kind: Column) -> Column:
            return problem.isNull() & (kind == "")

        neither_class = ~a.rlike(CLASS_DECLARATION) & ~b.rlike(CLASS_DECLARATION)
        return (
            F.when(valid(F.concat(_as_class(before, a), _as_class(after, b))), "class")
            .when(valid(F.concat(_as_method(before, a), _as_method(after, b))), "method")
            .when(a.rlike(CLASS_DECLARATION) & b.rlike(CLASS_DECLARATION), "class")
            .when(a.rlike(METHOD_DECLARATION) & b.rlike(METHOD_DECLARATION) & neither_class, "method")
        )

    faults = F.struct(F.coalesce(common_problem(before), common_problem(after)).alias("p"), declaration(before).alias("a"), declaration(after).alias("b"))
    return let(faults, lambda x: decide(x["p"], x["a"], x["b"]))


def line_count(code: Column) -> Column:
    text = text_or_empty(code)
    return F.when(text == "", 0).otherwise(F.size(F.split(F.regexp_replace(text, r"\n\z", ""), "\n")))


def disposition(before: Column, after: Column, entity_type: Column, weak_inherit: Column, most_lines: int = 500) -> Column:
    """STRUCT(disposition, reason): retain, review or discard. The reason is the first side's that has one."""
    large = (entity_type == "class") & (F.greatest(line_count(before), line_count(after)) > most_lines)
    facts = F.struct(
        F.array(snippet_problem(before, entity_type), snippet_problem(after, entity_type)).alias("problems"),
        F.coalesce(large, F.lit(False)).alias("large"), F.coalesce(entity_type == "class", F.lit(False)).alias("is_class"), weak_inherit.alias("weak"),
    )

    def verdict(name: str, reason: Column) -> Column:
        return F.struct(F.lit(name).alias("disposition"), reason.alias("reason"))

    def decide(x: Column) -> Column:
        first = F.get(F.filter(x["problems"], lambda p: p != ""), F.lit(0))
        return (
            F.when(x["weak"], verdict("discard", F.lit("weak_inheritdoc_only")))
            .when(first.isNotNull() & x["is_class"], verdict("review", F.concat(F.lit("invalid_class_context:"), first)))
            .when(first.isNotNull(), verdict("discard", F.concat(F.lit("truncated_code_context:"), first)))
            .when(x["large"], verdict("discard", F.lit("class_context_too_large")))
            .otherwise(verdict("retain", F.lit("")))
        )

    return let(facts, decide)
