"""Alignment of two tokenizers against a plain version over both libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from histlake.llm import token_alignment
from histlake.llm.queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "Hello world, it's  fine.\n\n\tTabs", "▁ under▁score", "<|endoftext|> and <s></s><unk>", "Zwölf Boxkämpfer  jagen", "中文字符 😀😀 é́",
    "x" * 3000, "\x00\x07\r\n", "don't DON'T 12345 1,234.5 ####", "ﬁ ligature Å \xa0nbsp ", "the the the\nthe", "<0x41>",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(libraries, a_ids, b_ids):
    letters = {chr(b): b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b}
    rest = (b for b in range(256) if b not in letters.values())
    letters |= {chr(256 + k): b for k, b in enumerate(list(rest))}
    a = [bytes(letters[c] for c in libraries[0].id_to_token(k)) for k in a_ids]
    b = [libraries[1].id_to_piece(k) for k in b_ids]
    b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in b]
    return a, b


def plain(libraries, texts):
    """By text: groups, and all linked occurrence pairs."""
    out = []
    for t in texts:
        a_ids = libraries[0].encode(" " + (t or ""), add_special_tokens=False).ids
        b_ids = libraries[1].encode(t or "")
        a, b = token_bytes(libraries, a_ids, b_ids)
        if not t or not b"".join(a) == b"".join(b) == b" " + t.encode():
            out.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in a]).tolist(), np.cumsum([len(x) for x in b]).tolist()
        at_b = {e: k for k, e in enumerate(ends_b)}
        links = [(x, b_ids[at_b[e]]) for x, e in zip(a_ids, ends_a) if e in at_b]
        groups, i, j = [], 0, 0
        for n, e in enumerate(ends_a):
            if e in at_b:
                groups.append((a_ids[i : n + 1], b_ids[j : at_b[e] + 1]))
                i, j = n + 1, at_b[e] + 1
        out.append((a_ids, b_ids, groups, links))
    return out


def plain_rows(libraries, texts):
    found = plain(libraries, texts)
    counts = Counter(x for *_, links in found for x in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for a, b, groups, links in found:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(line.encode()).hexdigest() if a else ""
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return rows


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_digests_equal_the_plain_version(spark, libraries, monkeypatch, leaf):
    monkeypatch.setattr(token_alignment, "LEAF", leaf)
    rng = random.Random(leaf)
    words = "the of token résumé naïve 日本 qzx 1234 don't \n <unk> ▁ , .. Straße".split(" ")
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(40)] + ["".join(rng.choices("abcxyz \né中", k=400)) for _ in range(20)]
    texts += [texts[20], texts[20]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: tuple(r[c] for c in NAMES) for r in token_alignment.digests(df, A, B).collect()}
    assert [found[k] for k in range(len(texts))] == plain_rows(libraries, texts)


def test_align_gives_ids_and_cuts(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("a_ids", F.lit(1))
    for r in token_alignment.align(df, A, B).collect():
        a_ids, b_ids, groups, _ = plain(libraries, [TEXTS[r.doc_id]])[0]
        assert (r.a_ids, r.b_ids) == (a_ids, b_ids)
        starts = zip([0, *(k + 1 for k in r.a_cuts)], r.a_cuts, [0, *(k + 1 for k in r.b_cuts)], r.b_cuts)
        assert [(a_ids[a : x + 1], b_ids[b : y + 1]) for a, x, b, y in starts] == groups


def test_pair_counts(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS * 2)), "id long, body string").repartition(3)
    found = {(r.a_id, r.b_id): r.n for r in token_alignment.pair_counts(df, A, B, id_col="id", text_col="body").collect()}
    assert found == dict(Counter(x for *_, links in plain(libraries, TEXTS * 2) for x in links))


def test_both_engines_of_a_agree():
    a = token_alignment.ByteLevel(A)
    assert a.fast
    texts = [t for t in TEXTS if t] + ["".join(map(chr, range(k, k + 400))) for k in range(0, 0x3000, 400)]
    fast = a.encode(texts)
    a.fast = None
    assert a.encode(texts) == fast


def test_cuts_equal_the_intersection_of_ends(monkeypatch):
    rng = np.random.default_rng(3)
    for leaf in (1, 2, 32):
        monkeypatch.setattr(token_alignment, "LEAF", leaf)
        for _ in range(60):
            ends_a, ends_b, bounds_a, bounds_b, base = [], [], [0], [0], 0
            for _ in range(rng.integers(1, 5)):
                n = int(rng.integers(1, 400))
                share = rng.choice([0.02, 0.3, 0.9])
                a, b = (np.r_[np.flatnonzero(rng.random(n) < share), n] + base + 1 for _ in range(2))
                ends_a, ends_b = np.r_[ends_a, np.unique(a)], np.r_[ends_b, np.unique(b)]
                base += n + 1
                bounds_a.append(len(ends_a))
                bounds_b.append(len(ends_b))
            x, y = token_alignment.shared_cuts(ends_a, ends_b, np.array(bounds_a), np.array(bounds_b))
            want, at_a, at_b = np.intersect1d(ends_a, ends_b, return_indices=True)
            assert np.array_equal(x, at_a) and np.array_equal(y, at_b)


def test_long_texts_without_spaces_end_soon(spark):
    df = spark.createDataFrame([(0, "x" * 200_000), (1, "ab" * 100_000), (2, "word " * 40_000)], "doc_id long, text string")
    rows = token_alignment.digests(df, A, B).collect()
    assert all(r.n_groups > 0 and r.n_links == r.n_groups for r in rows)


def test_awkward_rows_and_empty_tables(spark, libraries, awkward, nothing):
    clash = awkward.withColumns({c: F.lit(3) for c in ("n_a", "links", "pair", "n", "a_cuts", "groups_sha256")})
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = sorted(((k is None, k or 0), x) for (k, _), x in zip(rows, plain_rows(libraries, [t for _, t in rows])))
    found = token_alignment.digests(clash, A, B).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), tuple(r[c] for c in NAMES)) for r in found) == want
    for run in (token_alignment.digests, token_alignment.align, token_alignment.pair_counts):
        assert run(nothing, A, B).count() == 0


def test_query_over_the_driver_table(spark, libraries):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    found = op11_token_alignment(spark, folder).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in NAMES) for r in found] == plain_rows(libraries, [r.text for r in docs])
