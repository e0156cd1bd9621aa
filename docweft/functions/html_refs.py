"""Character references of HTML read as their characters, without a Python worker."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import let

_PIECE = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)|[^&]+|&"
_SEPARATOR = "\x01"
# By rule: numbers from 128 to 159 mean the characters of Windows-1252, where it has any.
_WINDOWS = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _names() -> Column:
    names = sorted(html5)
    keys = F.split(F.lit(_SEPARATOR.join(names)), _SEPARATOR)
    return F.map_from_arrays(keys, F.split(F.lit(_SEPARATOR.join(html5[n] for n in names)), _SEPARATOR))


def _numbered(digits: Column, base: int) -> Column:
    def character(n: Column) -> Column:
        nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        return (
            F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�")
            .when(n.between(128, 159), F.get(F.split(F.lit(_SEPARATOR.join(_WINDOWS)), _SEPARATOR), (n - 128).cast("int")))
            .when(nothing, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        )

    plain = F.regexp_replace(digits, r"\A0+(?=.)", "")
    number = F.when(F.length(plain) > 8, F.lit(0x110000).cast("bigint")).otherwise(F.conv(plain, base, 10).cast("bigint"))
    return let(number, character)


def unescape(text: Column) -> Column:
    """As the HTML standard reads it: names with and without semicolon, decimal and hexadecimal numbers."""
    def read(piece: Column, names: Column) -> Column:
        bare = F.regexp_extract(piece, f"\\A&({'|'.join(_BARE)})", 1)
        return (
            F.when((F.length(piece) < 2) | ~F.startswith(piece, F.lit("&")), piece)
            .when(piece.rlike(r"\A&#[xX]"), _numbered(F.regexp_extract(piece, "[0-9a-fA-F]+", 0), 16))
            .when(piece.rlike(r"\A&#"), _numbered(F.regexp_extract(piece, "[0-9]+", 0), 10))
            .otherwise(
                F.coalesce(
                    F.try_element_at(names, F.substr(piece, F.lit(2))),
                    F.when(bare != "", F.concat(F.try_element_at(names, bare), F.substr(piece, F.length(bare) + 2))),
                    piece,
                )
            )
        )

    pieces = F.regexp_extract_all(text, F.lit(_PIECE), 0)
    joined = let(_names(), lambda names: F.array_join(F.transform(pieces, lambda p: read(p, names)), ""))
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)
