from __future__ import annotations

import pytest

LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use."""
    texts = [
        None, "", " \n\t ", "one", "one", "Zwei Wörter", LONG, LONG, "line\nline\nline\n\n", "x" * 100_000, "\ud7ff 中文 😀 é",
        "mail a@b.org or +1 (017) 555-7713, host 10.0.0.1", "the same words again " * 40,
    ]
    rows = [(k, t, "en", None, 1, "a", 2, [1], 0.5, True) for k, t in enumerate(texts)]
    rows += [(None, "no id", None, "s", None, None, None, None, None, None), rows[3], rows[3], rows[6]]
    names = "doc_id long, text string, lang string, source string, n_chars long, id string, fp long, spans array<int>, score double, kept boolean"
    own = ("stay_id", "stay_hash", "stay_rows", "stay_id_", "__id", "__hash", "hash_", "bad_id_", "group", "component_id", "text_hash", "first", "rows")
    return spark.createDataFrame(rows, names).selectExpr("*", *(f"{k} as {c}" for k, c in enumerate(own))).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
