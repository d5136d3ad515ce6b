import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

WORDS = "the of stone river market yellow window carries seven quiet letters under old bridges".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randint(0, 99)) if r.random() < 0.3 else "") for _ in range(n))


def odd_texts() -> list:
    """Nulls, empty, white space, special strings, odd Unicode, repeated and very long texts."""
    return [None, "", " ", "   ", "\n\n \n a", " a", "a ", "a  b", "a \n b\t\tc", "x　y  z", "<|endoftext|>",
            "a<|endoftext|> b<|startoftext|>", "<|endo", "it's we'll 'tis", "\U0001F600 é ́a Å",
            "same text here", "same text here", "A" * 3000, "ab" * 2000, prose(1, 30000), prose(2, 50),
            "\x00\x1c a\x1cb", "123 4567 89", "a\r\nb\x85c", "İstanbul ΣΣ"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with a null id, repeated rows and clashing extra columns."""
    texts = odd_texts()
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 7) for i, t in enumerate(texts)]
    rows += [(None, "no id", "en", None, 1), (3, texts[3], "en", "s0", 7), (15, "same text here", "de", "s0", 7)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def table_dir(tmp_path):
    """Writes frames as the tables of a data folder and returns the folder."""
    def make(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return make
