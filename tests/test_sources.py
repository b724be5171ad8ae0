import tempfile

import pytest
from pyspark.errors import AnalysisException

from tessera.sources import corpus as SRC


def test_csv_scan_multiline_quotes_and_na(spark):
    rows = [(0, 'line one\nline "two", end'), (1, "NA"), (2, " NA"), (3, ""), (4, "None"), (5, "ok")]
    df = spark.createDataFrame(rows, "doc_id long, narrative string")
    path = tempfile.mkdtemp(prefix="tessera-csv-") + "/c"
    SRC.write_csv_corpus(df, path)
    got = {r.doc_id: r.narrative for r in
           SRC.read_csv_corpus(spark, path, "doc_id long, narrative string").collect()}
    assert got[0] == 'line one\nline "two", end'
    assert got[1] is None and got[3] is None and got[4] is None   # reader NA spellings
    assert got[2] == " NA"                                       # not an exact NA cell
    assert got[5] == "ok"


def test_csv_scan_missing_column(spark):
    df = spark.createDataFrame([(0, "x")], "doc_id long, body string")
    path = tempfile.mkdtemp(prefix="tessera-csv-") + "/c"
    SRC.write_csv_corpus(df, path)
    with pytest.raises(KeyError):
        SRC.read_csv_corpus(spark, path, "doc_id long, body string", text_col="narrative")


def test_missing_file(spark):
    with pytest.raises(AnalysisException):
        SRC.read_table(spark, "/nonexistent/tessera/documents.parquet").count()
