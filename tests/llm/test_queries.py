"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from salestream import llm
from tests.conftest import SF_DIR
from tests.llm.conftest import DOCS, prose, rows_of


@pytest.mark.parametrize("name", list(llm.ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(llm.ORACLE_SQL[name])
    names = sorted(want.columns)
    found = llm.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == names
    assert rows_of(found, *names) == sorted(con.sql(
        f"SELECT {', '.join(names)} FROM ({llm.ORACLE_SQL[name]})").fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLE_SQL)))
def test_runs_on_the_given_tables(spark, name):
    assert llm.QUERIES[name](spark, SF_DIR).count() > 0


def test_stages(spark, tmp_path):
    long_line = "this very line is in many of the documents"
    rows = [(i, prose(i, 80)) for i in range(30)]
    # copies of document 0: their one line stays in the last of them, the others are empty from then on
    rows += [(100 + i, prose(0, 80)) for i in range(3)]
    rows += [(200 + i, f"{prose(200 + i, 80)}\n{long_line}") for i in range(4)]
    rows += [(300, None), (301, ""), (None, prose(999, 50)), (302, prose(302, 6000)), (302, prose(302, 6000))]
    docs = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS)
    before = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert docs.count() == len(rows)  # none of these is toxic
        elif name == "line_dedup":
            assert docs.where(f"text LIKE '%{long_line}%'").count() == 1
            assert docs.where("n_chars <> length(coalesce(text, ''))").count() == 0
        elif name == "near_dedup":
            assert before - after == {100, 101, 300, 301} and docs.count() == len(after)
        elif name == "mixing":
            assert after == before
        before = after
    tokens = docs.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"})
    assert tokens.where("`sum(length)` % `max(doc_tokens)` <> 0").count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert rows_of(stage(spark, docs, SF_DIR)) == []
