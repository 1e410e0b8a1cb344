"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from ledgerfold.llm import periodic_runs, queries
from ledgerfold.llm.periodic_runs import OrderedPositions, runs_of


def brute(words, least_words=6, times=4):
    """All runs: for each period, maximal stretches of words equal to the one a period before, without a smaller period."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            e = i
            while e < n and words[e] == words[e - q]:
                e += 1
            s = i - q
            if e - s >= max(least_words, times * q) and not any(all(words[k] == words[k - p] for k in range(s + p, e)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    words = []
    while len(words) < rng.randint(0, 60):
        period = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
        words += (period * rng.randint(1, 7))[: rng.randint(1, 30)]
        words += [rng.choice("abcd") for _ in range(rng.randint(0, 4))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(250)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b", "a"] * 4, list("aabaab" * 6)]
    code = {w: i for i, w in enumerate("abcd")}
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat = np.array([code[w] for t in texts for w in t], np.int64)
    found = runs_of(flat, bounds)
    owner = np.searchsorted(bounds, found[:, 0], side="right") - 1
    for i, t in enumerate(texts):
        assert [(s - bounds[i], n, q) for s, n, q in found[owner == i].tolist()] == brute(t), t


def test_other_limits_equal_brute_force():
    rng = random.Random(9)
    for least_words, times in [(2, 2), (4, 2), (5, 3), (12, 5)]:
        for _ in range(150):
            words = made(rng)
            found = runs_of(np.array([ord(w) for w in words], np.int64), np.array([0, len(words)]), least_words, times)
            assert list(map(tuple, found.tolist())) == brute(words, least_words, times)


def test_one_word_many_times():
    """One class of a hundred thousand positions; each insertion moves a chunk only."""
    n = 100_000
    assert runs_of(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]


def test_ordered_positions():
    rng = random.Random(1)
    values = rng.sample(range(100_000), 5000)
    kept, known = OrderedPositions([values[0]]), [values[0]]
    for v in values[1:]:
        before, after = max((k for k in known if k < v), default=-1), min((k for k in known if k > v), default=periodic_runs._NONE)
        if len(known) % 50 == 0:
            assert kept.around(v) == (before, after)
        kept.add(v)
        known.append(v)
    assert list(kept) == sorted(known) and len(kept) == len(known)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_and_defined_cases(spark, tmp_path):
    rng = random.Random(4)
    blanks = [" ", "  ", "\n", "\t", "\x0b", " \r\n"]
    texts = [None, "", " ", "A a A a A a A a", "é é é é é é é", "x " * 4000, *("".join(w + rng.choice(blanks) for w in made(rng)) for _ in range(300))]
    rows = [(i, t, "no", i) for i, t in enumerate(texts)] + [(7, texts[7], "no", 0)] * 3
    spark.createDataFrame(rows, "doc_id long, text string, runs string, start long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r[c] for c in COLUMNS) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted(expected(r[0], r[1]) for r in rows)


def test_query_on_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in queries.op12_periodic_runs(spark, d).collect():
        if len(docs[r["doc_id"]] or "") < 6000:
            assert tuple(r[c] for c in COLUMNS) == expected(r["doc_id"], docs[r["doc_id"]])


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a " * 8), (None, None)], "doc_id long, text string")
    assert [(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in periodic_runs.periodic_runs(docs).orderBy("collapsed").collect()] == [(None, 0, ""), (None, 1, "a")]
    assert periodic_runs.digest(periodic_runs.periodic_runs(docs.limit(0))).count() == 0
