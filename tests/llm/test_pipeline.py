"""The pipeline against a plain version of its stages, and its queries against their SQL."""
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = P.quality(spark, docs, SF)
    verdict = duckdb.sql(E.oracle_sql()["op7_quality_rules"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")).df()
    assert sorted(r.doc_id for r in quality.collect()) == sorted(verdict[verdict.kept].doc_id)
    lines = P.lines(spark, quality, SF).persist()
    rows = {r.doc_id: r for r in lines.collect()}
    assert len(rows) == quality.count() and all(r.n_chars == len(r.text) for r in rows.values())
    single = P.near_duplicates(spark, lines, SF)
    groups = brute_components([(i, r.text) for i, r in rows.items()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
    private = P.privacy(spark, single, SF)
    assert private.columns == docs.columns and private.count() == single.count()
    before = {r.doc_id: r.text for r in single.collect()}
    for r in private.collect():

        for mail in re.findall(r"[\w.]+@[\w.]+\w", before[r.doc_id]):
            assert mail not in r.text
    packed = P.packed(spark, private, SF).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert Counter(r.sequence_id for r in packed)
    out = P.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == \
        Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_one_text_of_a_copy_group_survives(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(1)
    words = [" ".join(f"w{k}{chr(97 + i % 26)}{i}" for i in range(60)) for k in range(12)]
    bodies = [words[0]] * 8 + words[1:]  # 8 copies among 19 pages
    rows = spark.createDataFrame([(i, f"{t}\nfoot of every page") for i, t in enumerate(bodies)], "i long, t string")
    (rows.crossJoin(docs.drop("doc_id", "text"))
     .select(F.col("i").alias("doc_id"), F.col("t").alias("text"), *[c for c in docs.columns if c not in ("doc_id", "text")])
     .select(*docs.columns).write.parquet(f"{tmp_path}/documents.parquet"))
    lines = P.lines(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id: r.text for r in lines.collect()} == dict(enumerate(bodies))
    out = P.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in out if r.length}) == [0, *range(8, 19)]


@pytest.mark.parametrize("name", ["op6_chat_views", "op7_quality_rules", "op9_line_dedup"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    want = Counter(tuple(r) for r in rel.select(", ".join(df.columns)).fetchall())
    assert Counter(tuple(r) for r in df.collect()) == want


def test_all_queries_are_there():
    names = set(E.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))

