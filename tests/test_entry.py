import duckdb

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["repo", "change_id", "path"]
    assert df.count() > 0


def test_every_query_of_the_library_has_oracle():
    from repolens.plans import registry
    assert set(registry.QUERIES) == set(registry.ORACLE) and set(registry.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries()) and len(registry.QUERIES) >= 40


def test_oracle_sql_parses():
    con = duckdb.connect()
    for t in ["part", "lineitem", "supplier", "documents"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")


def test_some_queries_match_oracle_smoke(spark):
    """A quick subset of the driver's check at sf0.001 (full run: scripts/oracle_check.py)."""
    con = duckdb.connect()
    for t in ["part", "lineitem", "supplier", "documents"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ["churn_hotspots", "outline", "score_complexity", "hunk_symbol_overlap", "project_config"]:
        df = E.queries()[name](spark, SMOKE)
        mine = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
        rel = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in rel.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        theirs = sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())
        assert mine == theirs, name
