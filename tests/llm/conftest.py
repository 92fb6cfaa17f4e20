import pytest


@pytest.fixture(scope="session")
def byte_bpe():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(byte_bpe):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe)


ODD_TEXTS = [
    None, "", " ", "  ", "\n\n", "a", "the cat", "a  b", "a   b \n c", " x", "x ", "\ttab\x1cfs\x85nel", "é漢字😀 it's 1234",
    "<|endoftext|> tail", "a <|endoftext|> b  <|endoftext|>", "x\u00a0\u2003y, z.\n\nDon't. naïve.\nÜnder, 12.5 \x0b\x0cq", "word " * 3000, "x" * 5000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and extra columns of clashing names."""
    rows = [(i, t, "n", 7) for i, t in enumerate(ODD_TEXTS)] + [(5, "a", "n", 7), (5, "other", "n", 7), (None, "no id", "n", 7), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, rank string, n_tokens int").repartition(3)
