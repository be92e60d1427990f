"""Registered queries against their SQL at the smallest scale."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import all_plans
from tools.check_oracle import TABLES, plain

FOLDER = "/root/testdata/sf0.001"
CHECKED = ["b7_monthly_growth", "b9_fallback", "c1_history", "c3_history_text", "d3_session_rows", "d5_negatives", "e1_context_recall",
           "e11_boxed_accuracy", "e12_sweep", "f7_loop", "g3_entities", "g6_low_level", "g9_context", "g12_communities", "g18_aliases",
           "k2_upload_override", "m3_sparse_product", "m7_char_tfidf", "m9_pair_tfidf", "n7_sections", "n13_summary", "n19_parse_once",
           "r3_several_keys", "r14_references", "r16_index_delta", "r18_result_cache", "r22_sub_questions", "s9_kb_files",
           "s11_snapshot", "t3_descendants", "v5_incremental", "x1_live_index", "x5_masked_stream"]


WITHOUT_SQL = {"b10_title_clusters", "r17_partitioned_search", "s3_visible_text", "v1_embed", "v6_product_quantisation"}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_is_named_once():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    own = {name for name in queries if not re.match(r"op\d+_|pipeline$", name)}
    assert own == set(all_plans.QUERIES)
    assert own - set(sql) == WITHOUT_SQL


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got and got == want


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["qid", "n_ref", "n_hit", "recall", "context_str"] and df.count() > 0


@pytest.mark.parametrize("name", ["m5_bm25", "r1_top_k", "r10_second_stage", "r6_access_filter", "g6_low_level", "g3_entities", "n12_keywords"])
def test_plans_have_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_reach_the_scan(spark):
    plan = entry.queries()["r4_metadata_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "In(lang" in plan and "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in plan
