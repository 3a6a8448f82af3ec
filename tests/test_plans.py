"""What the physical plans must and must not contain."""

import re

import pytest

from corpusloom.registry import QUERIES

PLAIN = [
    "list_documents", "filter_processed", "set_metadata", "result_name", "assign_endpoint", "encode_messages",
    "clean_model_replies", "match_any_field", "sweep_processed", "duplicate_corpus",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_row_work_does_not_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


def test_chunking_runs_once_and_without_shuffle(spark, sf):
    for name in ("chunk_text_64", "extract_identifiers", "embed_chunks", "build_index"):
        text = plan(QUERIES[name](spark, sf))
        assert text.count("pack(") == 1, name
        assert "hashpartitioning" not in text, name


def test_first_claimants_are_cut_before_the_shuffle(spark, sf):
    for name in ("resolve_names", "top_k", "search_text_top10", "vector_top_k"):
        assert "Partial" in plan(QUERIES[name](spark, sf)), name


def test_only_needed_columns_are_read(spark, sf):
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan(QUERIES["filter_processed"](spark, sf))
    text = plan(QUERIES["backlog"](spark, sf))
    assert "value:double" not in text


def test_listing_reads_no_content(spark, tmp_path):
    from corpusloom.sources.documents import list_documents

    (tmp_path / "a").write_text("x")
    assert "content" not in re.findall(r"ReadSchema: (.*)", plan(list_documents(spark, str(tmp_path))))[0]


def test_small_scans_are_spread_and_large_ones_left(spark, sf):
    from corpusloom.session import spread

    one = spark.read.parquet(f"{sf}/documents.parquet")
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 50)
    assert spread(many) is many
