import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Workers import the package by its path.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
os.environ["TOKENIZERS_PARALLELISM"] = "false"
sys.path.insert(0, ROOT)

DATA = "/root/testdata/sf0.001"
DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs; a language may follow."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_DDL)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def prose(seed, words=120):
    """Plain sentences of short invented words."""
    import random

    rng = random.Random(seed)
    parts = []
    for i in range(words):
        word = "".join(rng.choice("ta ne ri so lu mi ka be do pa ce fy go hu ja vi wo xe zy qui er st".split()) for _ in range(rng.randint(1, 4)))
        parts.append(word.capitalize() + "." if i % 9 == 8 else word)
    return " ".join(parts)
