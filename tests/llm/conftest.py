import re

import public_tokenizers
import pytest
from pyspark.sql import Row

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def documents(spark):
    """A small table with nulls in every column, empty, long, repeated and near-equal texts, and clashing extra columns."""
    prose = " ".join(f"word{i % 97} thing{i % 31}" for i in range(400))
    texts = [
        (1, prose), (2, prose), (2, prose), (2, "another text under a number that repeats, " * 5), (3, None), (4, ""), (None, prose),
        (None, None), (5, "Ärger über «Größe» — it's 12,5 % more!'s <|endoftext|> \t\x0b\x85 fin."), (6, "a"), (7, "x" * 300_000),
        (8, "lead in " + prose[:700] + " lead out"), (9, "  \n\t "), (10, "the same line\n" * 40), (11, "日本語 のテキスト " * 30),
        (12, "9 " * 60), (13, prose[:49]), (14, prose[:50]),
    ]
    rows = [Row(doc_id=i, text=t, id=f"x{k}", score=None, start="s", batch=k, part=None, lang=None if k % 3 else "en", n_chars=None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, score double, start string, batch int, part string, "
                                       "lang string, n_chars long").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)
