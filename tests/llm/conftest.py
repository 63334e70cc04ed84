import pytest

from tarmac.plans.storage import drop_stages

ODD = [
    (1, "The cat sat on the mat, and then the cat sat again.", "en", "a", 51),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", "b", 4),
    (5, "word " * 30_000, "en", "b", 150_000),
    (6, "x" * 9_000, "de", "b", 9_000),
    (7, "the cat  sat on the mat, and then the cat sat again.", "en", "c", 52),
    (8, "The cat sat on the mat, and then the cat sat again.", "en", "c", 51),
    (8, "The cat sat on the mat, and then the cat sat again.", "en", "c", 51),
    (None, "Ünïcode 漢字 🙂 don't we'll 'S  　 12３ x y", None, "c", 30),
    (None, "The cat sat on the mat, and then the cat sat again.", "en", None, 51),
    (11, "a <|endoftext|> b</s>▁ \x00 \r\n", "fr", "a", 20),
    (12, "one two", "fr", "a", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use themselves, as columns of the input.
CLASHES = ["_id", "_text", "_fp", "_row", "_h1", "n_tokens", "score", "position", "fingerprint", "shard", "kept", "node", "_n"]


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA)
    return rows.withColumns({c: F.lit(f"clash {c}") for c in CLASHES}).repartition(3)


@pytest.fixture
def plain_odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    drop_stages(spark)
