"""Documented Java entities of a source text, and class contexts reduced to what differs between two versions.

Plain Python functions; the operators run them in Arrow batches. Lines are counted by line feeds.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import accumulate, compress

# Fixed values.
MODIFIERS = set("public protected private static final abstract synchronized native strictfp default transient volatile".split())
CONTROL = set("if for while switch catch return throw new".split())
DOC_COMMENT = re.compile(r"/\*\*.*?\*/", re.S)
CLASS_HEAD = re.compile(r"\b(class|interface|enum|record)\s+([A-Za-z_$][\w$]*)")
NAME = re.compile(r"[A-Za-z_$][\w$]*")
CODE_LINE = re.compile(r"[^\S\n]*(?!//)(\S(?:[^\n]*\S)?)")
CALLABLE = re.compile(r"(?P<left>[^(=]*)\((?P<inside>[^)]*)\)(?P<after>.*)", re.S)
THROWN = re.compile(r"\bthrows\s+(.+)$")
GOES_ON = re.compile(r"\s*(?:[;),.\]?:]|(?:catch|else|finally|while)\b)")
LEXEME = re.compile(r"//[^\n]*|/\*.*?(?:\*/|\Z)|\"(?:\\.|[^\"\\])*(?:\"|\Z)|'(?:\\.|[^'\\])*(?:'|\Z)|[{};]", re.S)


@dataclass
class Entity:
    entity_type: str
    name: str
    signature: str
    javadoc: str
    start_line: int
    end_line: int
    code_start_line: int
    code_end_line: int
    return_type: str = ""
    parameters: list[str] = field(default_factory=list)
    throws: list[str] = field(default_factory=list)


class SourceText:
    """A source with its lines and the partner of every brace, found in one pass each."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = [0, *(m.end() for m in re.finditer("\n", text))]
        self.closing: dict[int, int] = {}
        opened: list[int] = []
        for m in re.finditer("[{}]", text):
            if m[0] == "{":
                opened.append(m.start())
            elif opened:
                self.closing[opened.pop()] = m.start()

    def line(self, at: int) -> int:
        """The number of the line that holds a place."""
        return bisect_right(self.starts, at)

    def declaration(self, at: int) -> tuple[str, int, int] | None:
        """(text, first place, place after its last line) of what is declared after ``at``, or None.

        Its lines are those with code up to the first that has a brace or a semicolon, where the text ends.
        """
        ends = [*self.starts[self.line(at) :], len(self.text)]
        spans = zip([at, *ends], ends, strict=False)
        coded = ((m, stop) for begin, stop in spans if begin < stop and (m := CODE_LINE.match(self.text, begin, stop)))
        pieces: list[str] = []
        first = None
        for m, stop in coded:
            first = m.start(1) if first is None else first
            text, mark, _ = re.split("([{;])", m[1], maxsplit=1) if re.search("[{;]", m[1]) else (m[1], "", "")
            pieces.append(text)
            if mark:
                return " ".join(pieces).strip(), first, stop
        return None

    def last_line(self, first: int, stop: int) -> int:
        """The line of the brace that ends what is declared at ``first``; without a body the declaration's last line."""
        opening = self.text.find("{", first)
        if opening < 0 or opening >= stop and ";" in self.text[first:stop]:
            return self.line(max(first, stop - 1))
        return self.line(self.closing.get(opening, stop))


def _parts(text: str) -> list[str]:
    """The items of a list parted by commas."""
    return re.findall(r"[^,\s](?:[^,]*[^,\s])?", text)


def described(declaration: str) -> dict | None:
    """Type, name and parts of a declaration; None if it declares nothing that is documented."""
    if named := CLASS_HEAD.search(declaration):
        return {"entity_type": "class", "name": named[2], "signature": declaration}
    call = CALLABLE.match(declaration)
    if not call and re.match(r"[^(=]*\)[^(=]*\(", declaration):
        return None  # parentheses the wrong way round
    left = call["left"] if call else declaration.partition("=")[0].strip()
    *before, name = [w for w in left.split() if w not in MODIFIERS and w[0] != "@"] or [""]
    if call:
        thrown = THROWN.search(call["after"].strip())
        kind = {"entity_type": "method", "signature": declaration, "parameters": _parts(call["inside"]), "throws": _parts(thrown[1]) if thrown else []}
        return {**kind, "name": name, "return_type": before[-1] if before else ""} if name and name not in CONTROL else None
    plain = name.rstrip("[]")
    return {"entity_type": "field", "name": plain, "signature": left, "return_type": before[-1]} if before and NAME.fullmatch(plain) else None


def parse_entities(source: str) -> list[Entity]:
    """Each documentation comment with the class, method or field declared next."""
    text, out = SourceText(source), []
    for doc in DOC_COMMENT.finditer(source):
        declared = text.declaration(doc.end())
        facts = described(declared[0]) if declared and declared[0] else None
        if facts:
            _, first, stop = declared
            lines = {"start_line": text.line(doc.start()), "end_line": text.line(doc.end()), "code_start_line": text.line(first), "code_end_line": text.last_line(first, stop)}
            out.append(Entity(javadoc=doc[0], **lines, **facts))
    return out


def code_lines(source: str | None, first: int | None, last: int | None) -> str:
    """Lines ``first`` to ``last``, white space at line ends and around them cut off."""
    if source is None or first is None or last is None:
        return ""
    return re.sub(r"\s+$", "", "\n".join(x.rstrip() for x in source.split("\n")[max(first - 1, 0) : last])).lstrip()


def split_class(code: str) -> tuple[str, list[str]] | None:
    """(head up to its brace, members) of a class; None if it does not end.

    The marks outside comments and literals get the depth after them; a member ends at depth one, at a semicolon or at
    a closing brace after which the statement does not go on.
    """
    marks = [m for m in LEXEME.finditer(code) if m[0] in "{};"]
    marks = marks[next((i for i, m in enumerate(marks) if m[0] == "{"), len(marks)) :]
    depths = list(accumulate({"{": 1, "}": -1, ";": 0}[m[0]] for m in marks))
    if 0 not in depths:
        return None
    inside = list(zip(marks, depths, strict=True))[1 : depths.index(0)]
    ends = [m.end() for m, depth in inside if depth == 1 and m[0] != "{" and not (m[0] == "}" and GOES_ON.match(code, m.end()))]
    opening = marks[0].end()
    pieces = (code[a:b].strip() for a, b in zip([opening, *ends], ends, strict=False))
    return code[:opening].strip(), [p for p in pieces if p]


def without_comments(code: str) -> str:
    """Comments taken off outside literals; blank lines dropped."""
    plain = LEXEME.sub(lambda m: "\n" * m[0].count("\n") if m[0].startswith("/") else m[0], code)
    return "\n".join(x.rstrip() for x in plain.split("\n") if x.strip())


def _own(mine: list[str], theirs: list[str]) -> tuple[list[bool], list[bool]]:
    """For the members of each side, whether the alignment of both sides finds no partner for it."""
    form = lambda m: " ".join(re.sub(r"(?s)/\*.*?\*/|//[^\n]*", " ", m).split())
    aligned = difflib.SequenceMatcher(None, *([form(m) for m in side] for side in (mine, theirs)), autojunk=False)
    left, right = [True] * len(mine), [True] * len(theirs)
    for block in aligned.get_matching_blocks():
        left[block.a : block.a + block.size] = right[block.b : block.b + block.size] = [False] * block.size
    return left, right


def class_context_pair(old: str, new: str, whole: int = 300, most: int = 500) -> tuple[str, str]:
    """Two versions of a class: whole up to ``whole`` lines, else heads with the members that differ; empty beyond ``most``."""
    def beyond(texts: Iterable[str], lines: int) -> bool:
        return any(len(t.splitlines()) > lines for t in texts)

    if not beyond((old, new), whole):
        return old, new
    classes = [split_class(code) for code in (old, new)]
    if None in classes:
        return "", ""
    heads, members = zip(*classes, strict=True)
    chosen = [list(compress(m, keep)) for m, keep in zip(members, _own(*members), strict=True)]
    if heads[0] == heads[1] and not any(chosen):
        return "", ""
    texts = tuple("\n".join([head, *(["\n\n".join(without_comments(m).strip() for m in kept)] if kept else []), "}"]) for head, kept in zip(heads, chosen, strict=True))
    return ("", "") if beyond(texts, most) else texts
