import pytest

SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """documents from (doc_id, text) or (doc_id, text, source) rows, over a few
    partitions; stored, as a table is, so that rows keep their numbers."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts).checkpoint()
    return make
