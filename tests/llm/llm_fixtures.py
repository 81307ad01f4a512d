"""What the tests of the training-data operators share (``spark`` comes from the folder above)."""

import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977} and" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "short"), (5, long), (6, long), (6, long), (None, "no id at all here"),
            (7, "Déjà vu, 😀 <|endoftext|> token = \"abcdef0123456789abcdef0123\" 10.1.2.3"), (8, "1 2 3")]
    rows = [(i, t, "en", "s", 1, "x", 0, "y", "z") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, kept int, "
                                       "component_id string, range string")
