import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start int, shard string, fp double, component_id string, _group string"


def make_docs(spark, texts):
    """Rows of (doc_id, text), with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 1, "x", 0.5, "y", "z") for i, t in texts], SCHEMA)


@pytest.fixture(scope="session")
def edge_texts():
    rng = random.Random(5)
    words = ["the", "of", "Ändern", "ñandú", "run", "x1", "don't", "a.b", "日本", "end."]
    prose = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(60)]
    texts = list(enumerate([
        None, "", " ", "one", "two words", "a  b\n\n c \t d", " leading and trailing ", "x" * 3000, " ".join(rng.choices(words, k=9000)),
        "<|endoftext|> <|startoftext|>", "é é  wide space", "tab\tnew\nline\r\n end", *prose, prose[0], prose[0], prose[1] + " more",
    ]))
    return [*texts, (3, "one"), (3, "one"), (None, "no id"), (None, None)]
