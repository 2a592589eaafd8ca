"""Every query that SQL can express gives the rows that DuckDB gives for it."""

import duckdb
import pyarrow.parquet as pq
import pytest

from trailgrain import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages leads cells dishes units".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, data, name):
    df = catalogue.queries()[name](spark, data)
    result = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())


@pytest.mark.parametrize("name, table", [("stream_first_seen", "pages"), ("stream_throttled", "events")])
def test_stream_of_a_table_in_a_folder(spark, data, name, table, tmp_path):
    spark.read.parquet(f"{data}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    df = catalogue.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    result = con.execute(catalogue.oracle_sql()[name])
    assert _rows(df.columns, df.collect()) == _rows([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("folder", [False, True])
def test_stream_of_an_empty_table(spark, data, folder, tmp_path):
    if folder:
        (tmp_path / "pages.parquet").mkdir()
    pq.write_table(pq.read_table(f"{data}/pages.parquet").slice(0, 0), tmp_path / "pages.parquet" / "part-0.parquet" if folder else tmp_path / "pages.parquet")
    assert catalogue.queries()["stream_first_seen"](spark, str(tmp_path)).collect() == []


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
