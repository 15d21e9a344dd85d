import pytest

#: Texts that operators must bear: null, empty, blank, short, repeated, very long, odd characters.
EDGE_TEXTS = [
    None, "", " \t\n\x0b\f\r ", "one", "one two", "one two three four", "A b C d e f g h i j k l m n o p q r s t u v",
    "A b C d e f g h i j k l m n o p q r s t u v", "same line here today again\n" * 30,
    " ".join(f"w{i % 997}" for i in range(30_000)), "nbsp joined   words　here é ñ 漢字 😀",
    "<|endoftext|> </s>[INST] x [/INST]", "x" * 50_000, "\n\n\n", "tail  ",
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge texts with extra columns whose names operators use inside; repeated rows and a null key."""
    rows = [(i, t, "s" if i % 2 else None, -1, "clash", 0.5) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[6], rows[6], (None, "a null key's text of more than five words", "s", 1, "x", 0.0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, key string, target double")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    from tests.conftest import SF_SMALL

    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
