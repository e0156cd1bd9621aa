"""Train, validation and test splits that keep linked records together.

Projects are linked by a commit both hold. Components come from hash-to-min: every node keeps a
cluster of nodes, sends the whole cluster to its smallest member and the smallest member to all
others, until nothing changes; clusters are rows (node, member), never arrays. Components go to
splits by weighted rendezvous hashing, so a later run with more components moves none of the old.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import commit_hash, slug
from ..storage import Scratch, written
from .hashes import roots

DEFAULT_SPLITS = {"train": 0.8, "validation": 0.1, "test": 0.1}
MAX_ROUNDS = 60  # a path of n nodes needs about log2(n) rounds; reaching this is an error, not a result


def project_edges(commits: DataFrame) -> DataFrame:
    """(a, b): each project with the smallest project holding the same commit; rows without slug or hash link nothing."""
    held = (
        commits.select(slug(F.col("project_slug")).alias("node"), commit_hash(F.col("commit_hash")).alias("h"))
        .where("node is not null and h is not null")
        .distinct()
    )
    held = written(held, "held")  # four reads follow; the table of commits is read once
    rooted = held.join(roots(held), "h").select("node", "root")
    first = rooted.groupBy("root").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    return rooted.join(first, "root").where("node > low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()


def _state(clusters: DataFrame) -> tuple[int, int | None]:
    """Number of rows and the exclusive or of their hashes: equal states are equal tables, at any size without overflow."""
    row = clusters.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "member")).alias("x")).first()
    return row["n"], row["x"]


def hash_to_min(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of (a, b) edges; the component is named by its smallest node."""
    clusters = (
        edges.select(F.col("a").alias("node"), F.col("b").alias("member"))
        .union(edges.select("b", "a"))
        .union(edges.select("a", "a"))
        .union(edges.select("b", "b"))
        .distinct()
    )
    scratch = Scratch(edges.sparkSession)
    clusters = scratch.written(clusters, "clusters")
    seen = _state(clusters)
    for _ in range(MAX_ROUNDS):
        # The smallest member is one small row a node (combined before the shuffle); a node whose
        # cluster holds a third of the graph is split by the adaptive skew join, as rows are independent.
        low = clusters.groupBy("node").agg(F.min("member").alias("low"))
        sent = clusters.join(low, "node")
        before, scratch = scratch, Scratch(edges.sparkSession)
        clusters = scratch.written(
            sent.select(F.col("low").alias("node"), "member").union(sent.select("member", "low")).distinct(), "clusters"
        )
        now = _state(clusters)
        before.drop()  # the clusters of one round are kept, not those of all
        if now == seen:
            return clusters.groupBy("node").agg(F.min("member").alias("component"))
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def rendezvous(key: Column, shares: Mapping[str, float]) -> Column:
    """The split with the highest score -share / ln(u), u uniform from the hash of key and split."""
    if not shares or any(w < 0 for w in shares.values()) or sum(shares.values()) <= 0:
        raise ValueError("shares must be non-negative and not all zero")
    scores = []
    for name, share in sorted(shares.items()):
        if share > 0:
            u = (F.xxhash64(key, F.lit(name)).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") + 0.5) / float(1 << 52)
            scores.append(F.struct((-F.lit(float(share)) / F.ln(u)).alias("score"), F.lit(name).alias("split")))
    return F.array_max(F.array(*scores))["split"]


def project_components(commits: DataFrame) -> DataFrame:
    """(slug, component) of every project in ``commits``; a project linked to none is its own component."""
    linked = hash_to_min(project_edges(commits))
    projects = commits.select(slug(F.col("project_slug")).alias("slug")).where("slug is not null").distinct()
    return projects.join(linked, F.col("slug") == F.col("node"), "left").select("slug", F.coalesce("component", "slug").alias("component"))


def assign_splits(commits: DataFrame, shares: Mapping[str, float] | None = None) -> DataFrame:
    """(commit_seq, split) of every row, equal within a component.

    Proportions hold over components in expectation; a component larger than a share cannot be cut.
    Rows without slug are linked to nothing: each goes by its own ``commit_seq``. Repeated rows are
    kept. Columns beyond those read are ignored. An empty table gives an empty result.
    """
    keyed = commits.select("commit_seq", slug(F.col("project_slug")).alias("slug"))
    parts = project_components(commits)
    key = F.coalesce("component", F.concat(F.lit("row:"), F.coalesce(F.col("commit_seq").cast("string"), F.lit("null"))))
    return keyed.join(parts, "slug", "left").select("commit_seq", rendezvous(key, shares or DEFAULT_SPLITS).alias("split"))


def linked_projects(commits: DataFrame) -> DataFrame:
    """(slug_a, slug_b): all pairs of projects that must share a split, slug_a < slug_b.

    The pairs of a component are the stated result; rows, hashes and links are never paired.
    """
    parts = hash_to_min(project_edges(commits))
    a = parts.select("component", F.col("node").alias("slug_a"))
    b = parts.select("component", F.col("node").alias("slug_b"))
    return a.join(b, "component").where("slug_a < slug_b").select("slug_a", "slug_b")
