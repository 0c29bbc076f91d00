
import pytest

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside, as columns a caller may have
CLASHING = ("h", "fp", "slot", "term", "pos", "line", "salt", "root", "ranges", "keep", "score", "k1", "first", "_text", "_key", "_id", "digest", "payload", "key", "v", "grp", "task", "rank", "length", "part", "path_")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, source]) as a documents table with columns of clashing names."""

    def make(*rows):
        full = [(d, t, "en", rest[0] if rest else "s", None if t is None else len(t)) for d, t, *rest in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.withColumns({c: F.lit("x") for c in CLASHING})

    return make


