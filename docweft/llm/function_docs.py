"""Functions paired with their documentation comment.

Comments and literals of a source are blanked by one expression, their places kept. What stands before an opening
brace is told by expressions: a type's head, a function's signature, or something else. A stack of open types is kept;
bodies are delimited by counting braces and are not looked into. A function gets the documentation comment before it
whose distance, in lines that hold something else than annotations, line comments and blank space, is none.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .markup import HTML_NAMES

LEAST_WORDS = 4
HIDDEN = re.compile(r"/\*.*?(?:\*/|\Z)|//[^\n]*|\"\"\".*?(?:(?<!\\)\"\"\"|\Z)|\"(?:\\.|[^\"\\\n])*(?:\"|(?=\n)|\Z)|'(?:\\.|[^'\\\n])*(?:'|(?=\n)|\Z)", re.S)
MARK = re.compile(r"@(?!\s*interface\b)(?=\s*[^\W\d]|\s*\$)|[(){};\[\]]")
BRACE, ROUND = re.compile(r"[{}]"), re.compile(r"[()\[\]]")
ANNOTATION = re.compile(r"@\s*[\w$]+(?:\s*\.\s*[\w$]+)*(?:\s*(?P<open>\())?")
CONTROL_WORDS = ("if", "for", "while", "switch", "catch", "synchronized", "try", "do", "else", "return", "new", "throw", "assert")
TYPE_HEAD = re.compile(r"\b(?:class|interface|enum|record)\s+(?:[^\W\d]|\$)")
# Modifiers, type parameters and result; then the name before the first parenthesis.
SIGNATURE = re.compile(rf"(?:.*[^\w$])?(?P<name>(?!(?:{'|'.join(CONTROL_WORDS)})\s*\()(?:[^\W\d]|\$)[\w$]*)\s*\(", re.S)
COMPACT = re.compile(r"\s*(?:(?:public|protected|private)\s+)*(?P<name>[^\W\d_a-z][\w$]*)\s*")
VALUE = re.compile(r"=|->|\)[^(]*\bdefault\b")


class _Blanked:
    """A source without the contents of comments and literals; every place stays where it was."""

    def __init__(self, code: str) -> None:
        self.comments: list[tuple[int, int]] = []  # block comments

        def blank(m: re.Match) -> str:
            text = m[0]
            if text.startswith("/*"):
                self.comments.append(m.span())
            empty = re.sub(r"[^\n]", " ", text)
            return empty if text.startswith("/") else '"' + empty[1:]

        self.code, self.text = code, HIDDEN.sub(blank, code)
        self.begins = [b for b, _ in self.comments]

    def closing(self, marks: re.Pattern, at: int) -> int:
        """The place after what closes the mark at ``at``; -1 if nothing does."""
        depth = 0
        for m in marks.finditer(self.text, at):
            depth += 1 if m[0] in "({[" else -1
            if not depth:
                return m.end()
        return -1

    def documentation(self, begin: int, first: int, notes: list[tuple[int, int]]) -> str | None:
        """The comment between ``begin`` and ``first`` at no distance from the declaration that begins at ``first``.

        ``notes`` are the places of annotations. The nearest block comment counts, and only if it is a documentation comment.
        """
        k = bisect_right(self.begins, first) - 1
        if k < 0 or self.begins[k] < begin:
            return None
        comment = self.code[slice(*self.comments[k])]
        if not (comment.startswith("/**") and comment.endswith("*/") and len(comment) > 4):
            return None
        return comment if not self._distance(self.comments[k][1], first, notes) else None

    def _distance(self, begin: int, end: int, notes: list[tuple[int, int]]) -> int:
        """How many lines between two places hold something else than annotations, line comments and blank space."""
        gap = self.text[begin:end]
        for a, b in notes:
            if begin <= a and b <= end:
                gap = gap[: a - begin] + re.sub(r"[^\n]", " ", gap[a - begin : b - begin]) + gap[b - begin :]
        return sum(1 for line in gap.split("\n") if line.strip())


class _Declaration:
    """What is read of a member so far: where it may begin, its annotations and what stands outside its parentheses."""

    def __init__(self, begin: int, value: bool = False) -> None:
        self.begin, self.value = begin, value
        self.notes: list[tuple[int, int]] = []
        self.round: tuple[int, int] | None = None  # its first parentheses
        self.holes: list[tuple[int, int]] = []  # annotations and contents of parentheses

    def outside(self, text: str, end: int) -> str:
        """The text up to ``end``; annotations and what is in parentheses are blank."""
        out, at = [], self.begin
        for a, b in self.holes:
            out += [text[at:a], " " * (b - a)]
            at = b
        return "".join([*out, text[at:end]])


def functions(code: str) -> list[tuple[str, int, str | None]]:
    """(name, offset of the name, documentation or None) of each function with a complete body, types nested or not.

    The text may begin inside a type body (a single method) or with the type itself, and may be cut off.
    """
    source, out = _Blanked(code), []
    text, types, now, at = source.text, 0, _Declaration(0), 0
    while m := MARK.search(text, at):
        place, mark, at = m.start(), m[0], m.end()
        if mark == "@":
            note = ANNOTATION.match(text, place)
            at = source.closing(ROUND, note.start("open")) if note["open"] else note.end()
            if at < 0:
                break
            now.notes.append((place, at))
            now.holes.append((place, at))
        elif mark in "([":
            end = source.closing(ROUND, place)
            if end < 0:
                break
            if mark == "(" and now.round is None:
                now.round = place, end
            now.holes.append((place + 1, end - 1))
            at = end
        elif mark == "{":
            outside = now.outside(text, place)
            value = now.value or bool(VALUE.search(outside))
            if not value and TYPE_HEAD.search(outside):
                types, now = types + 1, _Declaration(at)
                continue
            at = source.closing(BRACE, place)
            if at < 0:
                break
            named = None
            if not value and now.round:
                named = SIGNATURE.fullmatch(outside, 0, now.round[0] - now.begin + 1)
            elif not value and types:
                named = COMPACT.fullmatch(outside)
            if named:
                first = now.begin + len(outside) - len(outside.lstrip())
                out.append((named["name"], now.begin + named.start("name"), source.documentation(now.begin, first, now.notes)))
            now = _Declaration(at, value=not named and (value or now.round is not None))
        elif mark in "};":
            types, now = max(0, types - (mark == "}")), _Declaration(at)
    return out


_TAG = re.compile(rf"</?(?:{'|'.join(HTML_NAMES)})(?:\s[^<>]*)?/?>|<!--.*?-->", re.S | re.I)
_BLOCK_TAG = re.compile(r"(?:^|(?<=[\s*]))@(?=[A-Za-z])")
_INLINE = re.compile(r"\{@([A-Za-z]+)\s*((?:[^{}]|\{[^{}]*\})*)\}?")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[^\W\dA-Za-z_]+")
_WORD = re.compile(r"[^\W_]+")


def main_description(doc: str) -> str:
    """The text before the first block tag, frame taken off, markup read as its content."""
    text = re.sub(r"^\s*/\*+|\*+/\s*$", "", doc.replace("\r\n", "\n"))
    text = re.sub(r"(?m)^[ \t]*\*+[ \t]?", "", text)
    cut = _BLOCK_TAG.search(text)
    text = text[: cut.start()] if cut else text
    text = _INLINE.sub(lambda m: " " if m[1].lower() == "inheritdoc" else f" {m[2]} ", text)
    return html.unescape(_TAG.sub(" ", text))


def is_trivial(doc: str | None, name: str) -> bool:
    """Fewer than four different words besides the function's name and that name's parts."""
    if not doc:
        return True
    own = {name.lower(), *(p.lower() for p in _NAME_PARTS.findall(name)), *(w.lower() for w in _WORD.findall(name))}
    return len({w.lower() for w in _WORD.findall(main_description(doc))} - own) < LEAST_WORDS


TYPES = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string())
PAIR = "origin string, row_id bigint, method_name string, name_line int, documentation string"
Found = tuple[str, int, str, int, str]


def _described(origin: str, row_id: int, name: str | None, first_line: int, code: str, doc: str | None, whole: bool) -> Iterator[Found]:
    """The functions of one text: with ``whole`` all, each with its own comment; else the named one, or the only one, with ``doc``."""
    told = functions(code)
    if not whole:
        told = [f for f in told if f[0] == name][:1] or (told if len(told) == 1 else [])
    for method, at, own in told:
        text = own if whole else doc
        if not is_trivial(text, method):
            yield origin, row_id, method, code.count("\n", 0, at) + first_line, text


def _batch(rows: list[Found]) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in PAIR.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=names)


def _of_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("row_id", "name", "code", "doc", "whole")]
        out = [r for row_id, name, code, doc, whole in zip(*columns, strict=True) for r in _described("samples", row_id, name, 1, code, doc, whole)]
        if out:
            yield _batch(out)


def _of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A file's lines are parted once for all its entities; lines outside the file give nothing."""
    for batch in batches:
        out: list[Found] = []
        for content, entities in zip(batch.column("content").to_pylist(), batch.column("entities").to_pylist(), strict=True):
            lines = content.split("\n")
            for e in entities:
                first, last = e["first_line"], e["last_line"]
                if first is not None and last is not None and 1 <= first <= last <= len(lines):
                    out += _described("entities", e["row_id"], e["name"], first, "\n".join(lines[first - 1 : last]), e["doc"], False)
        if out:
            yield _batch(out)


def pairs(samples: DataFrame, entities: DataFrame, file_changes: DataFrame) -> DataFrame:
    """(origin, row_id, method_name, name_line, documentation) of each function with non-trivial documentation.

    Rows with null or empty code or comment, an unknown ``entity_type``, a missing side or lines outside
    the file give nothing; nor does a row whose code holds several functions, none of the entity's name. Each
    function stands once a row it comes from; repeated rows are repeated.
    """
    whole = F.col("entity_type") == "class"
    mine = samples.where("entity_type in ('method', 'class') and code_after <> ''").where(whole | (F.trim("javadoc_after") != "")).select(
        F.col("sample_id").cast("bigint").alias("row_id"), F.col("entity_name").alias("name"), F.col("code_after").alias("code"), F.col("javadoc_after").alias("doc"), whole.alias("whole")
    )
    entity = F.struct(
        F.col("entity_id").cast("bigint").alias("row_id"), "name", F.coalesce("code_start_line", "start_line").cast("int").alias("first_line"),
        F.coalesce("code_end_line", "end_line").cast("int").alias("last_line"), F.col("javadoc").alias("doc"),
    )
    # The entities of one side of a file travel together, so its text is shuffled and parted once; they are in proportion to it.
    documented = entities.where("entity_type = 'method' and trim(javadoc) <> ''").groupBy("file_id", "side").agg(F.collect_list(entity).alias("entities"))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_content").alias("content")) for s in ("old", "new")])
    texts = file_changes.select("file_id", F.explode(sides).alias("s")).select("file_id", "s.side", "s.content").where("content is not null")
    theirs = texts.join(documented, ["file_id", "side"]).select("content", "entities")
    return mine.mapInArrow(_of_samples, PAIR).union(theirs.mapInArrow(_of_files, PAIR))


def found(samples: DataFrame, entities: DataFrame, file_changes: DataFrame) -> DataFrame:
    return pairs(samples, entities, file_changes).select("origin", "row_id", "method_name", "name_line").distinct()
