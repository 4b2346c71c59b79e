import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    word = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore "
    long = " ".join(f"w{i}" for i in range(9000))
    passage = "a shared passage that is long enough to count as repeated bytes in both of the documents holding it, " * 3
    rows = [
        (1, None, None, None, None), (2, "", "en", "s1", 0), (3, word, "en", "s1", 1), (4, word, "en", "s2", 1),
        (4, word, "en", "s2", 1), (5, long, "en", "s1", 2), (6, long + " tail", "de", "s1", 2), (None, word, None, "s1", 3),
        (7, "it's  'tis\n\n the   end ", "en", None, 4), (8, "x" * 700, "en", "s1", 5), (9, "one " + passage + "end", "fr", "s3", 6),
        (10, "other " + passage + "stop", "fr", "s3", 6), (11, "zwei wörter", "de", "s1", 7), (12, " \t\n ", "en", "s1", 8),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("_id", "_text", "node", "_keep", "kept", "data"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def odd_turns(spark):
    """Nulls in every column, blank and very long texts, tied turns, repeated rows, unknown roles, clashing names."""
    long = "word " * 40_000 + "end."
    rows = [(1, t, r, x) for t, r, x in [(0, "system", "Be brief."), (1, "user", "Hi?"), (2, "user", "Hi there."), (3, "assistant", "Hello.")]]
    rows += [(2, None, "user", "No turn."), (2, None, None, None), (2, 4, None, "No role."), (2, 5, "assistant", None), (2, 9, "", "Empty role.")]
    rows += [(None, 1, "user", "No conversation."), (None, None, None, None), (None, 2, "assistant", "Fine!")]
    rows += [(3, 0, "user", long), (3, 1, "assistant", long), (3, 2, "assistant", long), (3, 3, "user", "cut off here")]
    rows += [(4, 0, "user", "Same."), (4, 0, "user", "Same."), (4, 0, "assistant", "Tie."), (4, 1, "assistant", " \t ")]
    rows += [(5, k, "tool", f"Result {k}.") for k in range(30)] + [(6, k, "assistant", "Again.") for k in range(30)]
    rows += [(7, k, ("user", "assistant")[k % 2], f"Line {k}.") for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    for c in ("_conv", "_text", "cost", "audit", "blank"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df
