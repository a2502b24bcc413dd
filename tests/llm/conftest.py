import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside, or return: extra columns that must neither break nor be broken.
CLASHES = ["digest", "keep_id", "kept", "words", "tkey", "_masked", "bands", "n_words", "chosen", "shard", "_q_words"]


@pytest.fixture
def docs(spark):
    def make(*rows):
        full = []
        for r in rows:
            r = list(r)
            text = r[1]
            full.append((*r, *["en", "s"][len(r) - 2 :], None if text is None else len(text)) if len(r) < 4 else (*r, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def with_clashes():
    from pyspark.sql import functions as F

    return lambda df: df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def small():
    """Documents of the smallest tables: (doc_id, text, lang, source)."""
    import duckdb

    return duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()
