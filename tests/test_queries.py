"""Catalog queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from lineweave.plans import catalog, oracle

D = "/root/testdata/sf0.001"
FEW = ["line_source", "n0_pairs", "n0_units", "t1_kind_counts", "term_cleanup", "nodes_full", "resolve_alias", "gaz_fuzzy", "gaz_ngram", "vec_topk", "hybrid_rank", "bundles", "marked_view", "validate_ops", "apply_ops", "op_survivors", "gazetteer_hits", "linked_lexical", "gaz_build", "hint_join", "text_merged", "fdi_rule", "hebrew_text", "vec_query_terms", "jsonl_files", "lexicon_file", "ntriples_files", "rdf_xml_file", "vector_index_files", "best_point"]


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
@pytest.mark.parametrize("name", FEW)
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    want = con.sql(oracle.SQL[name])
    df = catalog.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


LINES = [(1, 23857, 1757, 35.0, 0.04, 0.04), (2, 20502, 1978, 18.0, 0.04, 0.0), (2, 24206, 1717, 7.0, 0.03, 0.03), (4, 33377, 1041, 46.0, 0.07, 0.04), (7, 35599, 1852, 25.0, 0.07, 0.07)]
PARTS = [(23857, "hot rod"), (20502, "small bolt"), (24206, "small plate"), (33377, "red rod"), (35599, "blue bolt")]


def on_a_bound(spark, tmp_path, name):
    """Rows of a query and of its SQL over one order, where a candidate's score lies on the bound of confident ones."""
    keys = "l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame([(157764, *x) for x in LINES], f"l_orderkey long, {keys}").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(PARTS, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(oracle.SQL[name])
    df = catalog.QUERIES[name](spark, str(tmp_path)).select(*want.columns)
    return sorted(map(tuple, df.collect()), key=repr), sorted(want.fetchall(), key=repr)


def test_scores_on_a_bound_rank_as_in_sql(spark, tmp_path):
    got, want = on_a_bound(spark, tmp_path, "hybrid_rank")
    assert got == want and (157764, "m1", "http://purl.obolibrary.org/obo/FMA_17", 0.75, 1, False) in got


def test_mentions_on_a_bound_are_selected_as_in_sql(spark, tmp_path):
    got, want = on_a_bound(spark, tmp_path, "select_top1")
    assert got == want and (157764, "m1", "hot rod", 20, 27, "http://purl.obolibrary.org/obo/FMA_17", 0.75, False) in got


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
@pytest.mark.parametrize("name", ["gaz_build"])
def test_files_are_not_broadcast_by_their_size(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = catalog.QUERIES[name](spark, D)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" in plan and "BroadcastHashJoin" not in plan and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_best_point_repeats_no_candidates(spark):
    plan = catalog.best_point(spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Join FullOuter" in plan  # scored in the plan itself, not stored


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_best_point_in_slices(spark):
    """Many lines are graded slice by slice, so no plan shuffles all of them; counts of slices sum to those of SQL."""
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    got = catalog.grid_search(spark, D, most=3500)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(oracle.SQL["grid_search"]).fetchall())


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(isinstance(v, str) for v in e.oracle_sql().values()) and all(callable(v) for v in e.queries().values())
