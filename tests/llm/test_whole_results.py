"""The queries of the training-data problems against brute force in SQL, where they can be said in it, on the driver's smallest tables."""

import glob
import os

import duckdb
import pytest

from leafmill.llm import queries as llm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    theirs = con.execute(llm.ORACLES[name]).df()
    ours = llm.QUERIES[name](spark, SF).toPandas()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    assert sorted(map(tuple, ours[columns].values.tolist())) == sorted(map(tuple, theirs[columns].values.tolist()))


def test_unseen_hosts(spark):
    figures = {r.figure: r.value for r in llm.p6_unseen(spark, "/root/testdata/sf0.01").collect()}
    assert figures["segment_recall"] > 0.8 and min(figures[k] for k in figures if k != "segment_recall") > 0.95


def test_every_record_comes_back(spark):
    n = spark.read.parquet(f"{SF}/md_corpus.parquet").count()
    both = n + spark.read.parquet(f"{SF}/front_matter.parquet").count()
    assert llm.p1_text(spark, SF).count() == llm.p2_text(spark, SF).count() == n
    assert llm.p5_text(spark, SF).count() == llm.p7_text(spark, SF).count() == both
