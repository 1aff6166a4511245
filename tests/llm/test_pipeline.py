"""The pipeline's stages against their operators and plain Python."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from histlake.llm import bpe, pii
from tests.llm.test_corpus_operators import plain_components, plain_contamination, plain_fingerprint, plain_signals


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(9)
    items = [(k, " ".join(f"q{rng.randint(0, 99)}" for _ in range(20))) for k in range(5)]
    texts = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.randint(60, 150))) for _ in range(60)]
    texts += [texts[3], texts[3] + " more", texts[4] + " mail a@b.org", "short", "", None, "same words " * 60]
    texts += [texts[5] + " " + items[0][1], texts[6][:300] + " " + items[1][1]]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_pipeline_equals_plain_stages(spark, folder):
    path, rows, items = folder
    kept = {d: t for d, t, *_ in rows if plain_signals(t)[0] >= 50 and 2 * plain_signals(t)[4] <= plain_signals(t)[0]}
    label = plain_components({d: plain_fingerprint(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if label[d] == d}
    clean = {d for d, *_, bad in plain_contamination(list(kept.items()), items) if not bad}
    found = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in found} == clean and len(found) == len(clean) < len(rows)
    tokens = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))[1]
    for r in found:
        text = pii.masked(kept[r.doc_id], pii.base_spans(kept[r.doc_id]))
        assert bpe.decode_ids(tokens, r.token_ids).decode() == text
        assert r.round_trip and r.n_tokens == len(r.token_ids) and r.n_chars == len(text)


def test_stages_take_awkward_and_empty_rows(spark, folder, awkward, nothing):
    for start in (awkward, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder[0])
            assert docs.columns == start.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folder[0])
        assert last.where(~F.col("round_trip")).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward, folder[0]).count() <= awkward.count(), name
