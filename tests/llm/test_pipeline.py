"""The pipeline over the smallest data set, and the registered queries that have SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbflow.llm.decontaminate import contamination
from kerbflow.llm.queries import ORACLES, QUERIES
from kerbflow.llm.registry import table
from kerbflow.llm.simhash import near_duplicates
from kerbflow.session import store
from workload.check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ok, text = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, text


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = table(spark, SF, "documents")
    odd = docs.limit(3).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars").unionByName(docs.limit(2))
    docs = store(docs.unionByName(odd), "docs")
    kept, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(store(stage(spark, kept[-1], SF), name.replace(" ", "-")))
        assert kept[-1].columns == columns
    sizes = [k.count() for k in kept]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0
    groups = near_duplicates(kept[1]).groupBy("component_id").count().count()
    assert sizes[2] == groups
    assert contamination(kept[4], table(spark, SF, "benchmark")).where("n_hit > 0").count() == 0
    assert kept[3].where("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF)
    assert pieces.select("doc_id").distinct().count() == kept[4].select("doc_id").distinct().count()
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_empty_documents(spark):
    docs = store(table(spark, SF, "documents").limit(0), "docs")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert corpus_pipeline.packing(spark, docs, SF).count() == 0


@pytest.mark.parametrize("usable", ["false", "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2", "doc_id < 0"])
def test_without_a_usable_label_all_rows_pass_the_quality_stage(spark, monkeypatch, usable):
    docs = table(spark, SF, "documents")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: table(*a).where(usable))
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == docs.exceptAll(kept).count() == 0


ODD = ["_key", "_score", "_match", "_runs", "_whole", "_text", "a.b", "n_words", "score", "size", "node", "root", "key", "id", "fp", "n_chars"]


def test_stages_keep_the_callers_columns_whatever_their_names(spark):
    """Columns with the names that helpers use, and one with a dot, come out of every stage as they went in."""
    docs = table(spark, SF, "documents").limit(60)
    wide = docs.select("doc_id", "text", *(F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")).alias(name) for i, name in enumerate(ODD[:-1])), "n_chars")
    wide = store(wide, "wide")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, SF)
        assert found.columns == wide.columns and found.count() > 0, name
        for row in found.collect():
            assert all(row[2 + i] == f"{i}:{row['doc_id']}" for i in range(len(ODD) - 1)), name
    assert corpus_pipeline.packing(spark, wide, SF).select("doc_id").distinct().count() == 60
