import math

import duckdb
import pytest

from itemforge.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    found = QUERIES[name](spark, sf_dir)
    names = sorted(found.columns)
    wanted = con.sql(f"SELECT {', '.join(f'"{c}"' for c in names)} FROM ({ORACLES[name]})")
    assert sorted(wanted.columns) == names
    rows = lambda them: sorted((tuple(map(plain, r)) for r in them), key=lambda r: tuple(map(repr, r)))
    assert rows(found.select(*names).collect()) == rows(wanted.fetchall())


def test_queries_without_sql_run(spark, sf_dir):
    for name in QUERIES.keys() - ORACLES.keys():
        assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["fontes_stats", "overlay_apply", "nearest_match", "merge_fallback_keys", "fts_search", "rule_engine"])
def test_plans_stay_in_the_jvm_without_products(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_topk_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in QUERIES["vector_topk"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_halves_are_compared_without_sorts(spark, sf_dir):
    plan = QUERIES["renumber_gate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_checks_of_documents_share_a_shuffle_and_sorts(spark, sf_dir):
    plan = QUERIES["document_checks"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") <= 3 and plan.count("Exchange") == 1


def test_items_meet_manifests_once(spark, sf_dir):
    plan = QUERIES["manifest_cross_check"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2 and plan.count("Join") == 1


@pytest.mark.parametrize("name", ["implicit_openings", "latex_repairs", "micro_lint"])
def test_rows_of_small_files_are_dealt_before_their_texts_are_read(spark, sf_dir, name):
    assert "hashpartitioning(p_partkey" in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, step", [("latex_repairs", r"frac\s*"), ("micro_lint", "{3,}")])
def test_repairs_inside_each_other_are_worked_out_once(spark, sf_dir, name, step):
    """A step that named the text before it twice doubled it, so an expression stood in the plan some hundred times."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count(step) <= 10
