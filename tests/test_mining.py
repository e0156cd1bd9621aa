"""End to end over temporary git repositories, and datasets at rest."""

import json
import subprocess

import pytest
from pyspark.sql import functions as F

from docweft import sinks
from docweft.plans import mining
from docweft.sources import dataset, git

OLD = """package org.example;

public class Foo {
    /**
     * Normalizes the given value.
     */
    public String normalize(String value) {
        return value.trim();
    }
}
"""
NEW = OLD.replace("Normalizes the given value.", "Normalizes the given value. Returns an empty result when the value is null.").replace("        return value.trim();", "        if (value == null) {\n            return EMPTY;\n        }\n        return value.trim();")


@pytest.fixture
def repository(tmp_path):
    path = tmp_path / "work"
    path.mkdir()
    run = lambda *a: subprocess.run(["git", *a], cwd=path, check=True, capture_output=True)
    run("init", "-q", "-b", "main")
    run("config", "user.email", "a@example.invalid")
    run("config", "user.name", "a")
    source = path / "src/main/java/org/example/Foo.java"
    source.parent.mkdir(parents=True)
    for content, message in ((OLD, "Add Foo"), (OLD + "// x\n", "Touch"), (NEW, "FOO-12 handle null values (#7)\n\nBody."), (NEW.replace("\n}\n", "\n\n    /** Only docs. */\n    int a;\n}\n"), "Docs only")):
        source.write_bytes(content.encode())
        run("add", "-A")
        run("commit", "-q", "-m", message)
    return str(path)


def test_git_source(spark, repository):
    rows = git.commits(spark, repository, fullHistory="true", commitsPerPartition="2").orderBy("scan_seq").collect()
    assert [r["scan_seq"] for r in rows] == [0, 1, 2, 3] and rows[1]["message"].startswith("FOO-12") and "src/main/java/org/example/Foo.java" in rows[1]["name_status"]
    assert git.commits(spark, repository, maxCommits="2", skipCommits="1").count() == 1
    targets = spark.createDataFrame([(rows[1]["commit_hash"], 1, 0, "src/main/java/org/example/Foo.java"), (rows[1]["commit_hash"], 1, 1, "none.java")], "commit_hash string, scan_seq long, file_seq int, path string")
    got = {r["file_seq"]: r for r in git.file_changes(targets, repository).collect()}
    assert got[0]["new_content"] == NEW and got[0]["old_content"] == OLD + "// x\n" and got[1]["new_content"] is None


def test_git_helpers(tmp_path):
    assert git.repository_path("https://host/a/b.git") == "a/b" and git.repository_path("/x/y") == "y"
    assert git.commit_url("https://host/a/b.git", "/c", "f") == "https://host/a/b/commit/f" and git.commit_url("/x/y", "/c", "f") == "file:///c/commit/f"
    with pytest.raises(git.GitError):
        git.run_git(["rev-list", "HEAD"], str(tmp_path))


def test_mine_one_repository(spark, repository, tmp_path):
    options = mining.MineOptions(repository, str(tmp_path / "cache"), str(tmp_path / "out"), max_commits=10)
    stats = mining.mine_repository(spark, options)
    assert stats["total_commits_scanned"] == 4 and stats["samples_retained"] == 1 and stats["history_complete"] is False
    sample = spark.read.json(str(tmp_path / "out/samples")).first()
    assert sample["issue_summary"] == "handle null values" and "if (value == null)" in sample["code_after"] and sample["sample_id"] == "sample_0001"


def test_mine_many(spark, repository, tmp_path):
    specs = [mining.Repository("none/such", str(tmp_path / "missing")), mining.Repository("My/Work", repository)]
    options = mining.ManyOptions(str(tmp_path), str(tmp_path / "final"), str(tmp_path / "cache"), target_total=5)
    done = mining.mine_multiple(spark, options, specs)
    assert "error" in done[0] and done[1]["stop_reason"] == "full_history_scanned" and mining.dataset_count(spark, options.final_dir) == 1
    assert [s["action"] for s in mining.plan(options, specs)] == ["mine", "skip"]
    bounded = mining.ManyOptions(str(tmp_path), str(tmp_path / "final2"), str(tmp_path / "cache"), max_commits_per_repo=3)
    assert mining.mine_multiple(spark, bounded, specs[1:])[0]["stop_reason"] == "max_commits_per_repo=3 reached"
    assert mining.dataset_count(spark, bounded.final_dir) == 0
    with pytest.raises(ValueError):
        mining.selected(specs, "unknown")
    kept, counts = mining.refresh(spark, options.final_dir)
    assert kept.count() == 1 and counts.first()["retained_samples"] == 1
    again = mining.ManyOptions(str(tmp_path), str(tmp_path / "final3"), str(tmp_path / "cache"), baseline_dir=options.final_dir)
    told = mining.mine_multiple(spark, again, specs[1:])[0]
    assert told["duplicate_against_baseline"] == 1 and told["retained_samples"] == 0
    assert "| commits | 2 |" in mining.render_readme("Title", {"commits": 2}, [{"project": "a", "n": 1}])
    options.dry_run = True
    assert mining.mine_multiple(spark, options, specs) == []


def test_datasets_at_rest(spark, tmp_path):
    for project, rows in {"b": [{"commit_hash": "x"}, {"commit_hash": "y", "code_after": "é"}], "a": [{"commit_hash": "z"}]}.items():
        folder = tmp_path / project
        folder.mkdir()
        (folder / "combined_samples.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(rows).encode() if project == "a" else json.dumps(rows).encode())
        (folder / "metadata.json").write_text(json.dumps({"repository": project, "retained_samples": len(rows)}))
    (tmp_path / "c").mkdir()
    (tmp_path / "c/combined_samples.json").write_text("{broken")
    got = sorted((r["project_slug"], r["source_sample_id"], r["source_order"], r["commit_hash"], r["issue_summary"]) for r in dataset.read_samples(spark, str(tmp_path), "old").collect())
    assert got == [("a", "sample_0001", 0, "z", ""), ("b", "sample_0001", 1, "x", ""), ("b", "sample_0002", 2, "y", "")]
    assert {r["folder_slug"]: r["retained_samples"] for r in dataset.read_metadata(spark, str(tmp_path)).collect()} == {"a": 1, "b": 2}


def test_sinks(spark, tmp_path):
    progress = sinks.Progress(spark, str(tmp_path / "done"))
    targets = spark.createDataFrame([("p", "a"), ("p", "b")], "project_slug string, commit_hash string")
    assert progress.rest(targets).count() == 2
    progress.add(targets.limit(1))
    assert progress.rest(targets).count() == 1
    sinks.write_json(str(tmp_path / "x/y.json"), {"a": 1})
    assert sinks.read_json(str(tmp_path / "x/y.json"), {}) == {"a": 1} and sinks.read_json(str(tmp_path / "none"), 3) == 3
    sinks.write_summary(spark.sql("select 1 as a, array(1, 2) as b"), str(tmp_path / "s"))
    assert {r["metric"]: r["value"] for r in spark.read.option("header", True).csv(str(tmp_path / "s/summary_csv")).collect()} == {"a": "1", "b": "[1,2]"}


def test_mine_continue_merge_and_recover(spark, repository, tmp_path, capsys):
    """One repository through all commands: half of it mined, the rest added, merged with the first, and read again."""
    from docweft import cli

    specs = tmp_path / "repositories.json"
    specs.write_text(json.dumps([{"name": "My/Work", "url": repository}]))
    path = {n: str(tmp_path / n) for n in ("cache", "base", "final", "merged", "backup", "recovered")}
    (tmp_path / "base/other").mkdir(parents=True)
    sample = {"commit_hash": "f" * 40, "issue_summary": "Say something good", "code_before": "int a() { return 1; }", "code_after": "int a() { if (b) { return 2; } return 1; }", "javadoc_before": "/** Gives one. */", "javadoc_after": "/** Gives two when asked. */"}
    (tmp_path / "base/other/combined_samples.json").write_text(json.dumps([sample]))
    common = ["mine-continuation", "--repositories", str(specs), "--root-dir", str(tmp_path), "--final-dir", path["final"], "--cache-dir", path["cache"], "--baseline-dir", path["base"]]
    with pytest.raises(ValueError):
        cli.main([*common, "--expected-baseline", "7"])
    assert cli.main([*common, "--max-commits-per-repo", "1"]) == 0  # the newest commit only: documentation, no sample
    first = json.loads((tmp_path / "final/my_work/metadata.json").read_text())
    assert first["total_commits_scanned"] == 1 and first["retained_samples"] == 0 and not first["complete_history"]
    assert cli.main([*common, "--expected-baseline", "1"]) == 0
    told = json.loads((tmp_path / "final/my_work/metadata.json").read_text())
    assert told["total_commits_scanned"] == 4 and told["retained_samples"] == 1 and told["complete_history"]
    assert json.loads((tmp_path / "final/validation_report.json").read_text())["samples"] == 1
    lines = spark.read.option("header", True).csv(f"{path['final']}/project_summary").collect()
    assert lines[0]["project_slug"] == "my_work" and lines[0]["retained_samples"] == "1"
    assert cli.main(["merge", "--old-dir", path["base"], "--new-dir", path["final"], "--output-dir", path["merged"], "--expected-old", "1", "--expected-new", "1", "--backup-dir", path["backup"]]) == 0
    assert (tmp_path / "backup/old/other/combined_samples.json").exists() and (tmp_path / "backup/new/my_work/metadata.json").exists()
    nested = spark.read.parquet(f"{path['merged']}/nested")
    assert nested.count() == 2
    urls = nested.withColumn("repository_url", F.when(F.col("project_slug") == "my_work", repository).otherwise(""))
    urls.write.parquet(str(tmp_path / "grouped"))
    again = ["recover", "--nested", str(tmp_path / "grouped"), "--cache-dir", path["cache"], "--output-dir", path["recovered"], "--least-changes", "1"]
    assert cli.main(again) == 0
    capsys.readouterr()
    assert cli.main(again) == 0  # all is done: nothing is read again
    report = json.loads(capsys.readouterr().out)
    assert report["target_commits"] == 2 and report["raw_recovered"] == 1 and report["new_changes"] == 0 and report["changes"] == 2
    left_out = spark.read.parquet(f"{path['recovered']}/duplicates").collect()
    assert [r["outcome"] for r in left_out] == ["in_frozen"]
    failed = spark.read.parquet(f"{path['recovered']}/unresolved").collect()
    assert [(r["project_slug"], r["reasons"]) for r in failed] == [("other", ["missing_local_repo_cache"])]


def test_files_of_one_commit_keep_their_own_numbers(spark, tmp_path):
    seen = [(1, 0), (0, 10_000), (0, 20_000), (2**30, 2**30)]
    df = spark.createDataFrame(seen, "scan_seq long, file_seq int").withColumn("file_id", F.shiftleft(F.col("scan_seq").cast("bigint"), 32) + F.col("file_seq"))
    assert df.select("file_id").distinct().count() == 4 and df.agg(F.min("file_id")).first()[0] >= 0


def test_early_stop_reads_no_further_chunk(spark, repository, tmp_path):
    options = mining.MineOptions(repository, str(tmp_path / "cache"), str(tmp_path / "out"), max_commits=10, max_samples=1, chunk_commits=1)
    stats = mining.mine_repository(spark, options)
    assert stats["total_commits_scanned"] == 3 and stats["samples_retained"] == 1  # one, then two more; the fourth is not read
    options.max_samples = None
    assert mining.mine_repository(spark, options)["total_commits_scanned"] == 4
