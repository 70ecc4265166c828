import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_sql_or_is_declared_without():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries)
    # the numbered text operators declare theirs in their own tests
    assert {n for n in set(queries) - set(oracle) if n != "pipeline" and not n.startswith("op")} == set()


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert {"sample_id", "source_chromosome", "call_rate"} <= set(df.columns)
    assert df.count() > 0


def test_flagship_reads_only_what_it_needs(spark):
    plan = contract.queries()["call_rate_by_chromosome"](spark, SMALL)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "l_shipdate" not in text


def test_hot_joins_avoid_cross_products(spark):
    for name in ("nearest_samples", "pgs_alignment", "marker_alignment", "gene_outcomes", "normalize_mappings"):
        text = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
