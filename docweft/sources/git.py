"""Commits and changed files of a git repository as Spark sources.

``git_commits`` is a Python data source: the driver lists hashes once, each partition reads a range of them.
Blobs come from one ``git cat-file --batch`` a partition, not from a process a file. The clone must be
readable at the same path on every executor.
"""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Iterator
from pathlib import Path
from typing import TYPE_CHECKING
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

if TYPE_CHECKING:
    import pandas as pd

COMMIT_SCHEMA = "scan_seq bigint, commit_hash string, message string, patch string, name_status string, error string"
FILE_SCHEMA = "commit_hash string, scan_seq bigint, file_seq int, path string, old_content string, new_content string, error string"


class GitError(RuntimeError):
    """A git command that failed or took too long."""


def run_git(args: list[str], cwd: str | None, timeout: float | None = None, stdin: bytes | None = None) -> bytes:
    # The clone may belong to another user: it is named safe for this call alone.
    env = {**os.environ, "GIT_CONFIG_COUNT": "1", "GIT_CONFIG_KEY_0": "safe.directory", "GIT_CONFIG_VALUE_0": "*"}
    try:
        done = subprocess.run(["git", *args], cwd=cwd, capture_output=True, timeout=timeout, input=stdin, env=env, check=False)
    except subprocess.TimeoutExpired as error:
        raise GitError(f"timed out after {timeout} s: git {args[0]}") from error
    if done.returncode:
        raise GitError((done.stderr or done.stdout).decode("utf-8", "replace").strip())
    return done.stdout


def text_of(raw: bytes) -> str:
    """UTF-8 with replacement characters, line ends as line feeds."""
    return raw.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


def repository_path(url: str) -> str:
    """``owner/name`` of a remote, the last part of a local path."""
    parsed = urlparse(url)
    if parsed.scheme and parsed.netloc:
        return parsed.path.strip("/").removesuffix(".git")
    return Path(url).name


def commit_url(url: str, clone: str, commit: str) -> str:
    parsed = urlparse(url)
    base = url.removesuffix(".git") if parsed.scheme and parsed.netloc else f"file://{Path(clone).as_posix()}"
    return f"{base}/commit/{commit}"


def clone_or_update(url: str, cache: str, refresh: bool = False, fetch: bool = True) -> str:
    """The path of the clone under ``cache``; an existing one is fetched, or made anew with ``refresh``."""
    target = Path(cache, repository_path(url).replace("/", "__"))
    target.parent.mkdir(parents=True, exist_ok=True)
    if refresh and target.exists():
        shutil.rmtree(target)
    if not target.exists():
        run_git(["clone", url, str(target)], None)
    elif fetch:
        run_git(["fetch", "--all", "--tags", "--prune"], str(target))
    return str(target)


def list_commits(clone: str, full: bool, most: int, skip: int = 0, take: int | None = None) -> list[str]:
    """Newest first: all reachable commits, or the first ``most`` of the first-parent line; then ``take`` of them after ``skip``."""
    args = ["rev-list", "HEAD"] if full else ["rev-list", "--first-parent", f"--max-count={most}", "HEAD"]
    return run_git(args, clone).decode().split()[skip:][:take]


class _Range(InputPartition):
    def __init__(self, first: int, hashes: list[str]) -> None:
        super().__init__(first)
        self.first, self.hashes = first, hashes


class _CommitReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.clone = options["path"]
        self.full = options.get("fullhistory", "false").lower() == "true"
        self.most = int(options.get("maxcommits", "1000"))
        self.skip = int(options.get("skipcommits", "0"))
        self.take = int(options["takecommits"]) if options.get("takecommits") else None
        self.size = int(options.get("commitsperpartition", "200"))
        self.timeout = float(options.get("timeout", "180"))
        self.patches = options.get("patches", "true").lower() == "true"

    def partitions(self) -> list[_Range]:
        hashes = list_commits(self.clone, self.full, self.most, self.skip, self.take)
        return [_Range(self.skip + i, hashes[i : i + self.size]) for i in range(0, len(hashes), self.size)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for n, commit in enumerate(partition.hashes):
            try:
                call = lambda *args: text_of(run_git(list(args), self.clone, self.timeout))
                message = call("log", "--format=%B", "-n", "1", commit).strip()
                patch = call("show", "--format=fuller", "--find-renames", "--patch", commit) if self.patches else None
                names = call("diff-tree", "--no-commit-id", "--name-status", "-r", commit)
                yield partition.first + n, commit, message, patch, names, None
            except GitError as error:
                yield partition.first + n, commit, None, None, None, str(error)[:1000]


class GitCommits(DataSource):
    """Options: path, fullHistory, maxCommits, skipCommits, takeCommits, commitsPerPartition, timeout, patches."""

    @classmethod
    def name(cls) -> str:
        return "git_commits"

    def schema(self) -> str:
        return COMMIT_SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _CommitReader({k.lower(): v for k, v in self.options.items()})


def commits(spark: SparkSession, clone: str, **options: str) -> DataFrame:
    spark.dataSource.register(GitCommits)
    return spark.read.format("git_commits").options(path=clone, **options).load()


class _Blobs:
    """One ``git cat-file --batch`` process."""

    def __init__(self, clone: str) -> None:
        self.process = subprocess.Popen(["git", "-c", "safe.directory=*", "cat-file", "--batch"], cwd=clone, stdin=subprocess.PIPE, stdout=subprocess.PIPE)

    def get(self, ref: str) -> str | None:
        if "\n" in ref:
            return None
        self.process.stdin.write(ref.encode() + b"\n")
        self.process.stdin.flush()
        head = self.process.stdout.readline().split()
        if len(head) < 3 or head[1] != b"blob":
            if len(head) == 3 and head[2].isdigit():
                self.process.stdout.read(int(head[2]) + 1)
            return None
        raw = self.process.stdout.read(int(head[2]))
        self.process.stdout.read(1)
        return text_of(raw)

    def close(self) -> None:
        self.process.stdin.close()
        self.process.wait()


def named_changes(wanted: DataFrame, clone: str, timeout: float = 180) -> DataFrame:
    """(commit_hash, name_status, error) of the commits ``wanted`` (commit_hash); name_status is null where git fails."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for batch in batches:
            out = []
            for commit in batch.commit_hash:
                try:
                    out.append((commit, text_of(run_git(["diff-tree", "--no-commit-id", "--name-status", "-r", commit], clone, timeout)), None))
                except GitError as error:
                    out.append((commit, None, str(error)[:1000]))
            yield pd.DataFrame(out, columns=["commit_hash", "name_status", "error"])

    return wanted.select("commit_hash").mapInPandas(read, "commit_hash string, name_status string, error string")


def file_changes(targets: DataFrame, clone: str) -> DataFrame:
    """Both versions of each path of ``targets`` (commit_hash, scan_seq, file_seq, path); a missing side is null."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blobs = _Blobs(clone)
        try:
            for batch in batches:
                out = batch[["commit_hash", "scan_seq", "file_seq", "path"]].copy()
                out["old_content"] = [blobs.get(f"{h}^:{p}") for h, p in zip(batch.commit_hash, batch.path, strict=True)]
                out["new_content"] = [blobs.get(f"{h}:{p}") for h, p in zip(batch.commit_hash, batch.path, strict=True)]
                out["error"] = None
                yield out
        finally:
            blobs.close()

    return targets.mapInPandas(read, FILE_SCHEMA)
