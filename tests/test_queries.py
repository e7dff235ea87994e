"""Every registered query against its SQL, on the driver's smallest tables."""

import glob
import os

import duckdb
import pytest

from leafmill.plans import queries as core

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(frame, columns):
    def plain(v):
        if v is None or isinstance(v, float) and v != v or str(v) == "<NA>":
            return "<null>"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(tuple(map(plain, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_equals_sql(spark, duck, name):
    ours, theirs = core.QUERIES[name](spark, SF).toPandas(), duck.execute(core.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours, sorted(ours.columns)) == rows(theirs, sorted(ours.columns))


def test_heads_of_files_whole(spark, tmp_path):
    """A title whose lines in the front matter end like its rule; many small files make no more tasks than the listing has."""
    title = "A " + "--- " * 60 + "end"
    spark.createDataFrame([(i, f"d/{i}.md", f"# {title} {i}\n\nText.") for i in range(200)], "doc_id bigint, relpath string, body string").coalesce(1).write.parquet(f"{tmp_path}/md_corpus.parquet")
    found = core.QUERIES["knowledge_base_files"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 1 and sorted(r.title for r in found.collect()) == sorted(f"{title} {i}" for i in range(200))


def test_every_query_has_sql():
    assert set(core.QUERIES) == set(core.ORACLES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
