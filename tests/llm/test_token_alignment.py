"""Token alignment against byte-by-byte reading of whole texts with both libraries."""

import hashlib
import random
import re
from collections import Counter

import pytest
import sentencepiece
from ledgerfold.llm import bpe, queries, token_alignment
from ledgerfold.llm.token_alignment import align
from tokenizers import Tokenizer

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(bpe.vocabulary_path(token_alignment.VOCABULARY))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path(token_alignment.PIECES))
    # byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on
    own = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    letters = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)}
    return a, b, letters


def tokens(libraries, text):
    """(id, bytes) of A and B; nothing where the bytes differ from a space and the text."""
    a, b, letters = libraries
    if not text:
        return [], []
    one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        hexed = re.fullmatch("<0x(..)>", name)
        two.append((i, bytes([int(hexed[1], 16)]) if hexed else name.replace("▁", " ").encode()))
    same = all(b"".join(x for _, x in side) == (" " + text).encode() for side in (one, two))
    return (one, two) if same else ([], [])


def brute(libraries, rows):
    read, pairs = [], Counter()
    for _, text in rows:
        a, b = tokens(libraries, text)
        owner = [[k for k, (_, x) in enumerate(side) for _ in x] for side in (a, b)]
        links = sorted(set(zip(*owner)))
        pairs.update((a[i][0], b[j][0]) for i, j in links)
        ends = [[i for i in range(len(o)) if i + 1 == len(o) or o[i] != o[i + 1]] for o in owner]
        common = sorted(set(ends[0]) & set(ends[1]))
        cut = [[sum(e <= c for e in side) for c in common] for side in ends] if len(owner[0]) < 3000 else None
        read.append((a, b, links, cut, len(common)))
    highest = Counter()
    for (_, j), n in pairs.items():
        highest[j] = max(highest[j], n)
    out = []
    for (doc_id, _), (a, b, links, cut, n) in zip(rows, read):
        counts = [pairs[a[i][0], b[j][0]] for i, j in links]
        best = sum(c == highest[b[j][0]] for c, (_, j) in zip(counts, links))
        sha = None
        if cut:
            parts = [[",".join(str(i) for i, _ in side[s:e]) for s, e in zip([0, *c], c)] for side, c in zip((a, b), cut)]
            sha = hashlib.sha256(";".join(f"{x}|{y}" for x, y in zip(*parts)).encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), n, len(links), best, sum(counts), sha))
    return out


PARTS = [" ", " ", " ", "  ", "\n", "\t", "a", "the", "token", "Übergröße", "don't", "12345", "日本", "<s>", "<unk>", "<|endoftext|>", "<0x41>", "\U0001f600", "é", "é", "　", "\x00", "...", "queueing", "x" * 30]


def test_query_and_defined_cases(spark, tmp_path, libraries):
    rng = random.Random(8)
    texts = [None, "", " ", "  ", "a ", " a", "a▁b", "▁", "one two\nthree", "the " * 600 + "end", *("".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(400)), *(" ".join(rng.choices(["the", "queueing", "Übergröße", "a\nb", "<s>", "日本"], k=rng.randint(1, 30))) for _ in range(200))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9, texts[9])] * 5
    spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, block int, pairs string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r[c] for c in COLUMNS) for r in queries.op13_token_alignment(spark, str(tmp_path)).collect())
    for g, w in zip(got, sorted(brute(libraries, rows)), strict=True):
        assert g[:7] == w[:7] and w[7] in (g[7], None)


def test_query_on_documents(spark, libraries):
    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in queries.op13_token_alignment(spark, d).collect())
    for g, w in zip(got, sorted(brute(libraries, rows)), strict=True):
        assert g[:7] == w[:7] and w[7] in (g[7], None)


def test_align_equals_common_ends():
    rng = random.Random(3)
    for _ in range(3000):
        n = rng.randint(1, 80)
        a, b = (sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}) for _ in range(2))
        if rng.random() < 0.5:
            b = sorted({*a, *b}) if rng.random() < 0.5 else [x for x in a if x == n or rng.random() < 0.9]
        common = sorted({*a} & {*b})
        assert align(a, b) == ([a.index(e) + 1 for e in common], [b.index(e) + 1 for e in common])
    assert align([], []) == ([], [])


def test_words_are_forgotten_and_found_again(spark, libraries, monkeypatch):
    """A worker with room for few words gives the same units."""
    import pyarrow as pa

    files = [bpe.vocabulary_path(x) for x in (token_alignment.VOCABULARY, token_alignment.RANKS, token_alignment.PIECES)]
    texts = pa.array(["alpha beta gamma", "beta delta", None, "alpha  beta", "epsilon zeta eta theta"])
    want = token_alignment.aligned_block(token_alignment.Aligner(*files), texts)
    monkeypatch.setattr(token_alignment, "KEPT", 5)
    own = token_alignment.Aligner(*files)
    for _ in range(3):
        got = token_alignment.aligned_block(own, texts)
        assert got[0]["groups_sha256"] == want[0]["groups_sha256"] and got[1].tolist() == want[1].tolist() and got[2].tolist() == want[2].tolist()


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_a"] for r in token_alignment.token_alignment(docs).collect()) == [0, 2]
    assert token_alignment.token_alignment(docs.limit(0)).count() == 0
    blanks = spark.createDataFrame([(1, ""), (2, None), (3, "▁")], "doc_id long, text string")
    assert [(r["n_b"], r["n_links"], r["count_sum"], r["groups_sha256"]) for r in token_alignment.token_alignment(blanks).collect()] == [(0, 0, 0, "")] * 3
