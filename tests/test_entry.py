"""The driver contract: keys agree, and oracle queries match DuckDB at sf0.001."""
import math
from collections import Counter

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SAMPLE = ["normalize_corpus", "dedup_keep_first", "expand_contractions", "tfidf_matrix",
          "bow_binary", "matrix_stats", "top_terms_tfidf", "topics_comparison_by_lang",
          "normalize_topics", "bow_fixed_vocab", "scan_csv_roundtrip",
          "bow_user_vocab", "lda_term_mass", "lsa_spectrum_moments", "lsa_coordinate_energy"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _rows(records, cols):
    def n(v):
        return round(v, 5) if isinstance(v, float) and not math.isnan(v) else v
    return Counter(tuple(n(r[c]) for c in cols) for r in records)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows([r.asDict() for r in sdf.collect()], cols) == _rows(drows, cols)
