"""Token counts and packing against ``tokenizers`` on whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from ledgerfold.llm import bpe, packing, token_counts

PARTS = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "é", "1", "12", "!", "…", "日本", "<|endoftext|>", "\U0001f600", "don't", "\x85", "\x0b", "\x1c", "ŧ", "ǧ", "́", "٣", " "]


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(bpe.vocabulary_path("byte_bpe_50k.json"), bpe.vocabulary_path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def plain():
    """The library's own object with its own options."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return [None, "", " ", *("".join(rng.choices(PARTS, k=rng.randint(1, 40))) for _ in range(4000)), "word " * 3000, "x" * 5000, "x <|endoftext|> y", "x<|endoftext|>y", "a  <|endoftext|>  b", "é<|endoftext|>" * 3, "<|endoftext|"]


def test_ids_equal_tokenizers(encoder, plain, texts):
    whole = [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in encoder.ids(pa.array(texts, pa.string()), most=500)] == whole
    assert encoder.lengths(pa.array(texts, pa.string())).tolist() == [len(x) for x in whole]


def test_special_strings(encoder, plain, texts):
    assert plain.encode("x <|endoftext|> y").ids.count(50256) == 1
    own = bpe.encoder(bpe.vocabulary_path("byte_bpe_50k.json"), bpe.vocabulary_path("byte_bpe_50k.tiktoken"), plain=True)
    ordinary = type(plain).from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    ordinary.encode_special_tokens = True
    assert [x.tolist() for x in own.ids(pa.array(texts, pa.string()))] == [e.ids for e in ordinary.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_histogram(spark, plain, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[:50])], "doc_id long, text string, n_tokens string")
    lengths = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) for t in texts + texts[:50])
    histogram = token_counts.token_histogram(docs).cache()
    for r in histogram.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_up_to"] == sum(x <= n for x in lengths) and r["docs_longer"] == sum(x > n for x in lengths)
        assert r["tokens_longer"] == sum(x for x in lengths if x > n)
        assert r["tokens_kept_at_limit"] == sum(min(x, n) for x in lengths)
        assert (r["docs_total"], r["tokens_total"]) == (len(lengths), sum(lengths))
    for r in token_counts.at_limits(histogram, [0, 7, 100, 10**6]).collect():
        assert r["tokens_kept"] == sum(min(x, r["context"]) for x in lengths)
        assert r["docs_within"] == sum(x <= r["context"] for x in lengths)
        assert r["tokens_cut"] == sum(max(0, x - r["context"]) for x in lengths)
    halves = {r["share"]: r["n_tokens"] for r in token_counts.quantiles(histogram, [0.5, 1.0]).collect()}
    assert halves == {0.5: lengths[-(-len(lengths) // 2) - 1], 1.0: lengths[-1]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_histogram(docs).count() == 0
    assert packing.pack(docs).count() == 0


def test_pack_round_trip(spark, plain, texts):
    rows = [(i if i % 7 else None, t, i) for i, t in enumerate(texts)] + [(5, texts[8], 0)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(3)
    out = packing.pack(docs).toPandas()
    want = []
    for name, text, _ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want.append((-1 if name is None else name, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    got = out.assign(doc_id=out["doc_id"].fillna(-1).astype(int))[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
    sequences = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert sequences["length"].sum().max() <= 2048
    for _, s in sequences:
        assert s["offset"].tolist() == np.concatenate([[0], np.cumsum(s["length"])[:-1]]).tolist()
    assert 1 - out["length"].sum() / (2048 * len(sequences)) < 0.2  # a single almost empty sequence counts at this size


def test_little_padding(spark):
    out = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    total, n = out.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert 1 - total / (2048 * n) < 0.02


def test_combinations_fill_the_window():
    combos = packing.combinations(24, 3)
    assert len(set(combos)) == len(combos) and all(sum(c) == 24 and len(c) <= 3 and list(c) == sorted(c) for c in combos)
    brute = {tuple(sorted((a, b, 24 - a - b))) for a in range(1, 24) for b in range(1, 24 - a)} | {tuple(sorted((a, 24 - a))) for a in range(1, 24)} | {(24,)}
    assert set(combos) == brute


def test_least_squares_meets_the_conditions_of_a_minimum():
    rng = np.random.default_rng(0)
    index = np.array([[a, b] for a in range(6) for b in range(a, 6)])
    weight, b = rng.uniform(0.5, 2, 6), rng.uniform(0, 3, 6)
    a = np.zeros((6, len(index)))
    for j, rows in enumerate(index):
        for i in rows:
            a[i, j] += weight[i]
    x = packing.nnls(index, weight, b, 20000)
    gradient = a.T @ (a @ x - b)
    assert (x >= 0).all() and (gradient > -1e-4).all() and np.abs(gradient[x > 1e-6]).max() < 1e-4


def test_plan_never_asks_for_more_than_there_is():
    histogram = {k: (k * 7919) % 50 for k in range(1, 33)}
    used = dict.fromkeys(histogram, 0)
    for combo, repeats in packing.plan(histogram, 32):
        assert sum(combo) == 32
        for k in combo:
            used[k] += repeats
    assert all(used[k] <= histogram[k] for k in histogram)
