import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, keep_id string, kept string, size string, "
          "component_id string, n_tokens string, score string, start string, cid string, t string, key string")


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, copies
    and near copies; the further columns are named like output columns."""
    rng = random.Random(5)
    base, long_ = _words(rng, 150), _words(rng, 30_000)
    near = base.replace(base.split()[40], "changed", 1)
    texts = [base, base, near, "", None, " \t\n", "word", "word", "two words", long_, long_ + " end", "É é  \r\n x y",
             "日本語 テキスト 😀", base.upper(), _words(rng, 90), "<|endoftext|> 'll 123 \n\n  a", base + "\n" + _words(rng, 120)]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(100, base, None, None, None), (100, base, None, None, None), (None, None, None, None, None),
             (None, "text without an id", "fr", "src1", 3), (7, "word", "en", "src1", 4)]
    return [(*r, *["x"] * 10) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
