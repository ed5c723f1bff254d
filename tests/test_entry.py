"""The driver's contract: names, columns and rows of queries and SQL."""

import builtins
import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def engine_names():
    from tideline.queries import ORACLE_SQL

    return sorted(ORACLE_SQL)


def test_every_query_is_callable_and_has_its_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(q) for q in queries.values())


def test_the_corpus_subpackage_is_used_by_nothing_else():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, dirs, files in os.walk(os.path.join(root, "tideline")):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert not re.search(r"tideline\.llm|from tideline import llm", text.read()), f


@pytest.mark.parametrize("missing, passed_over", [("corpus_pipeline", True), ("tideline.llm", True), ("tideline.llm.queries", True), ("numpy", False)])
def test_only_a_missing_corpus_package_is_passed_over(monkeypatch, missing, passed_over):
    real = builtins.__import__

    def lacking(name, *args, **more):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, *args, **more)

    monkeypatch.setattr(builtins, "__import__", lacking)
    if passed_over:
        assert "pipeline" not in entry.queries() and len(entry.queries()) > 60
    else:
        with pytest.raises(ModuleNotFoundError):
            entry.queries()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).columns == ["pk", "event_id", "value", "pos"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", engine_names())
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.compare import TABLES, rows_of

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_offset_order_ranks_every_event_and_no_task_gets_the_table(spark):
    from tideline.queries import table

    df = entry.queries()["offset_order"](spark, SF)
    n = table(spark, SF, "events").count()
    assert n > 500 and sorted(r["rank"] for r in df.collect()) == list(range(1, n + 1))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    alone = [x for x in plan.splitlines() if "Window " in x and "row_number()" in x]
    assert alone and all("__bucket" in x.split("row_number()")[1] for x in alone)
