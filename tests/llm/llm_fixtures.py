import pytest


@pytest.fixture(scope="session")
def tokenizer():
    from raresift.llm._tokens import default_tokenizer

    return default_tokenizer()


@pytest.fixture
def documents(spark):
    """Documents with nulls, empty and odd texts, repeats, a null id and clashing columns."""
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words * 12)
    base = " ".join(words[:120])
    rows = [
        (1, base), (2, base), (3, base.replace("w60", "changed")), (4, None), (5, ""), (6, "  \n\t "), (7, "short text"),
        (8, "short text"), (9, long), (10, "ünïcödé ßtraße " * 40), (11, "a b <|endoftext|> x  y\n\n z "),
        (12, " ".join(words[100:260])), (13, "prefix here " + " ".join(words[300:360]) + " suffix there"),
        (14, "other start " + " ".join(words[300:360]) + " other end"), (None, base), (16, "x" * 250),
    ]
    rows += [(20 + i, " ".join(words[i : i + 60])) for i in range(0, 40, 7)]
    data = [(i, t, "en", None, i, True, "clash", 3) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component string, part int"
    return spark.createDataFrame(data, schema).repartition(3)


