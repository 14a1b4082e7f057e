import pytest
from pyspark.sql import functions as F

SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'
LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
BODY = "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen. Seventeen eighteen nineteen twenty and more words follow here. " * 2
TEXTS = [
    None, "", "   \n\t ", "word", "two words", BODY, BODY, BODY + " tail", SECRET, f"a {SECRET} b", LONG,
    "Was. " * 300, "A b c d. " * 40, "é ñ ß 日本語 🎉 " * 20, "password: hunter2hunter2 passwd=short secret='abcd'", "x" * 5000, "line one here\nline one here\n\n \nline two",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(100, None, None, None, None), (None, BODY, "fr", None, 1), (None, None, None, None, None), (5, BODY, "en", "src2", 1), (5, BODY, "en", "src2", 1), (7, "other text under a used id", "en", "", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clash = {c: F.lit("clash") for c in ("id", "t", "k", "w", "h", "s", "fp", "rid", "score", "kept", "size", "spans", "label", "hash", "block", "target", "root", "n_words", "html_", "n_tokens", "src", "psrc", "shards", "a", "b", "th")}
    return df.withColumns(clash)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(17)] + [(None, 1, 0), (3, None, None), (4, 0, 1), (9999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
