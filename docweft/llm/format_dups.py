"""Rows that differ only in white space, case, punctuation or the order of block tags, with their number of copies.

Each row is brought to one canonical text, hashed to 128 bits, and counted with map-side combining; a
second hash and the length of the canonical text part any two texts that collide in the 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import written


def letters_and_digits(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")


def canonical_doc(doc: Column) -> Column:
    """The text before the first block tag, then the block tags sorted; each by letters and digits in lower case."""
    parts = F.split(F.coalesce(doc, F.lit("")), r"(?U)(?<=[\s*])(?=@)")
    plain = F.transform(parts, letters_and_digits)
    return F.concat_ws("\x02", F.element_at(plain, 1), F.array_join(F.array_sort(F.slice(plain, 2, F.greatest(F.size(plain) - 1, F.lit(0)))), "\x03"))


def canonical_sample() -> Column:
    return F.concat_ws(
        "\x01", letters_and_digits(F.coalesce("code_before", F.lit(""))), canonical_doc(F.col("javadoc_before")), canonical_doc(F.col("javadoc_after"))
    )


def collapse(rows: DataFrame, row_id: str, canonical: Column) -> tuple[DataFrame, DataFrame]:
    """(members, groups): each row's key, and each key's smallest row and number of copies.

    Only the key leaves the scan: 128 bits, a second hash and a length, never the text.
    """
    text = rows.select(F.col(row_id).alias("id"), canonical.alias("c"))
    members = written(
        text.select("id", F.unhex(F.md5("c")).alias("h"), F.xxhash64("c").alias("check"), F.length("c").alias("len")), "canonical"
    )
    groups = members.groupBy("h", "check", "len").agg(F.min("id").alias("keep_id"), F.count("*").alias("copies"))
    return members, groups


def collapsed(samples: DataFrame) -> DataFrame:
    """(keep_id, copies, collided) of every group, single rows included.

    Null texts count as empty, so rows with nothing but nulls form one group. Repeated ids count as
    copies of their own. ``collided`` tells that another text shares the 128 bits.
    """
    _, groups = collapse(samples, "sample_id", canonical_sample())
    clash = groups.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1")
    return groups.join(clash, "h", "left").select("keep_id", "copies", F.coalesce(F.col("texts") > 1, F.lit(False)).alias("collided"))


def found(samples: DataFrame) -> DataFrame:
    """(keep_id, sample_id) of each member other than the smallest of its group."""
    members, groups = collapse(samples, "sample_id", canonical_sample())
    many = groups.where("copies > 1").drop("copies")
    return members.join(many, ["h", "check", "len"]).where("id <> keep_id").select("keep_id", F.col("id").alias("sample_id")).distinct()
