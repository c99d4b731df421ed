import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from gleaner.llm.common import Work, prepare  # noqa: E402

PIECES = ["Hello", " world", "  ", "\n", "\n\n", " don't", "'re", "<|endoftext|>", " <|startoftext|> ", "日本語", "é", "É",
          "\u00a0", " ", "\t", "12345", "!!!", " " * 30, "x" * 40, "\x1c", "🙂👩‍👩‍👧", "'", "ΣΑΣ", " Σ ", "İ", "<|endof", "foo,", " a"]


@pytest.fixture
def work(spark):
    return Work(prepare(spark), "test")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 120)))) for i in range(120)]
    rows += [(None, None), (None, "a b"), (200, ""), (201, " "), (201, " "), (202, "a" * 3000 + " b" * 500),
             (203, " " * 3000 + "ab " * 500 + "\n" * 2000), (204, "one"), (205, "ONE"), (206, rows[3][1])]
    return spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows],
                                 "doc_id long, text string, row string, digest string, n_tokens int, lang_pred string").cache()


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
