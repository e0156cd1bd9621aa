"""Every operator on empty tables, rows of nulls, repeated rows, and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from docweft.llm import queries as Q

SCHEMAS = {
    "commits": "commit_seq long, project_slug string, repository_url string, scan_seq long, commit_hash string, message string, patch string, committed_at timestamp, loaded_at timestamp",
    "samples": "sample_id long, batch_id int, project_slug string, commit_hash string, issue_summary string, code_before string, code_after string, javadoc_before string, javadoc_after string, entity_name string, entity_type string, commit_url string, file_path string",
    "entities": "entity_id long, file_id long, side string, entity_type string, name string, javadoc string, start_line int, end_line int, code_start_line int, code_end_line int",
    "file_changes": "file_id long, old_content string, new_content string",
    "commits_nested": "row_seq long, dataset string, project_slug string, repository_url string, commit_hash string, issue_summary string, mined_at timestamp",
    "dataset_trust": "dataset string, trust_rank int",
    "documents": "doc_id long, text string",
    "eval_items": "item_id long, text string",
}
CLASHES = ["id", "key", "h", "word", "node", "fp", "n", "doc", "slug", "root", "window", "place", "cls", "a", "b", "count", "kinds", "body", "th", "codes", "rep", "grams"]
LONG = "long words of a very long text that goes on " * 4000


def _write(spark, folder, rows):
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame([], schema)
        if rows:
            fields = df.schema.fields
            filled = {"string": LONG, "bigint": 7, "int": 1, "timestamp": None}
            data = [tuple(None for _ in fields)] * 2 + [tuple(filled[f.dataType.simpleString()] for f in fields)] * 2
            data += [tuple("" if f.dataType.simpleString() == "string" else 8 if f.dataType.simpleString() in ("bigint", "int") else None for f in fields)]
            df = spark.createDataFrame(data, schema)
            taken = {c.lower() for c in df.columns}
            df = df.withColumns({c: F.lit("clash") for c in CLASHES if c not in taken})
        df.write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module", params=["empty", "odd"])
def folder(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    _write(spark, path, request.param == "odd")
    return path


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_odd_tables(spark, folder, name):
    df = Q.queries()[name](spark, folder)
    rows = df.collect()
    if "empty" in folder:
        assert rows == []
    if name == "p8_ids":
        assert all(r["ids"] is not None for r in rows)
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
