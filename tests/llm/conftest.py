import pytest

WORDS = "the of and a to in is that der und le la de el que en".split()


def awkward_texts():
    """Nulls, empty and white texts, ties, long texts, odd white space."""
    line = "This very line is shared by many of the documents here."
    plain = " ".join(WORDS[(7 * i * i + i) % len(WORDS)] + str(i % 13) for i in range(90))
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "one two",
        "one two three",
        "a b c a b c a b c",
        line,
        f"  {line.upper()}\t\n{plain}",
        f"{plain}\n{line}\n{line} ",
        f"{plain}\r\n{line}\r\n\x1cx y z",
        f"{line}\n{plain}",
        plain,
        plain,
        "é ü 漢字 😀 " * 30 + line,
        " ".join(f"w{i * i % 997}" for i in range(20_000)),
        "x" * 150_000,
        "- bullet one\n- bullet two...\n\n* three #$%",
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case: repeated and null ids, repeated rows, clashing extra columns."""
    texts = awkward_texts()
    rows = [(i, t, "en", "src", 0, "clash", 1) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id " * 20, None, None, None, None, None), (3, "same id, other text", "en", "s", 1, "x", 2)]
    rows += [rows[12], rows[12]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, h string, words int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
