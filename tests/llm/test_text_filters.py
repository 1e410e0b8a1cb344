"""Line dedup, decontamination and language-model scores against brute force."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from ledgerfold.llm import decontaminate as dc
from ledgerfold.llm import line_dedup, lm_scoring


def brute_lines(rows, ratio, least):
    pages = collections.defaultdict(set)
    for _, host, text in rows:
        if text is not None:
            pages[host or ""].add(frozenset(x.strip(" ") for x in text.split("\n")) - {""})
    held = collections.Counter((h, line) for h, sets in pages.items() for lines in sets for line in lines)
    out = []
    for i, host, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not x.strip(" ") or held[host or "", x.strip(" ")] < least or held[host or "", x.strip(" ")] <= ratio * len(pages[host or ""])]
        out.append((i, len(lines), len(lines) - len(kept), text if text is None else "\n".join(kept)))
    return out


def test_line_dedup(spark):
    rng = random.Random(1)
    common = ["Menu", " Home ", "All rights reserved.", ""]
    rows = []
    for i in range(400):
        host = rng.choice(["a", "a", "a", "b", "", None])
        lines = [rng.choice(common) if rng.random() < 0.4 else f"line {rng.randrange(500)} of text" for _ in range(rng.randint(0, 8))]
        rows.append((i if i % 9 else None, host, rng.choice([None, "\n".join(lines)]) if i % 11 == 0 else "\n".join(lines)))
    rows += [(1000 + i, "b", "copied content line\nanother one") for i in range(60)] + [(2000, "solo", "x")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, source string, text string, lines string").repartition(3)
    out = line_dedup.line_dedup(docs, ratio=0.1, least=3)
    assert out.columns[:4] == docs.columns
    got = sorted((str(r["doc_id"]), r["__lines"], r["__dropped"], str(r["__text"])) for r in out.collect())
    assert got == sorted((str(i), n, k, str(t)) for i, n, k, t in brute_lines(rows, 0.1, 3))
    assert any(k for _, _, k, _ in got) and ("1000", 2, 0, "copied content line\nanother one") in got  # copies are one page
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="__hit"):
        line_dedup.line_dedup(docs.withColumnRenamed("lines", "__hit"))


def test_no_line_over_the_ratio_stays(spark):
    """Pages that are mostly boilerplate lose it too; a small site has boilerplate as well; copies in any line order are one page."""
    rows = [(i, "big", f"Menu\nFooter, all rights reserved\n{'Terms and conditions apply' if i % 2 else ''}\nown {i}") for i in range(100)]
    rows += [(200 + i, "small", f"Menu\nstory {i}") for i in range(4)] + [(300 + i, "copies", ["a b\nc d", "c d\na b\na b", " c d \n\na b"][i % 3]) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r["doc_id"]: r["__text"] for r in line_dedup.line_dedup(docs).collect()}
    assert all(got[i].strip("\n") == f"own {i}" for i in range(100)) and all(got[200 + i] == f"story {i}" for i in range(4))
    assert all(got[i] == t for i, h, t in rows if h == "copies")


def least_distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, x in enumerate(text):
            now.append(min(before[j] + (c != x), before[j + 1] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_myers():
    rng = random.Random(3)
    for _ in range(300):
        p, t = (bytes(rng.choices(b"abc ", k=rng.randint(1, n))) for n in (90, 150))
        d = least_distance(p, t)
        assert dc.myers(p, t, len(p)) == d and dc.myers(p, t, d) == d and (d == 0 or dc.myers(p, t, d - 1) is None)


def test_decontamination(spark):
    rng = random.Random(1)
    items = [(i, "".join(rng.choices("abcdef gh", k=rng.choice([5, 15, 30, 90, 200])))) for i in range(30)]
    docs = []
    for k in range(100):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(text))
            rng.choice([lambda: text.insert(at, "z"), lambda: text.__setitem__(at, "Q"), lambda: text.pop(at) if len(text) > 2 else 0])()
        noise = ["".join(rng.choices("xyz, uvw\n", k=rng.randint(0, 80))) for _ in range(2)]
        docs.append((k, noise[0] + "".join(text) + noise[1]))
    want = {}
    for i, t in docs:
        clean = dc.normal(t)
        for k, x in items:
            p = dc.normal(x)
            if len(p.split()) < 2:
                continue
            budget, d = max(0, min(int(dc.ERRORS * len(p)), len(p) // dc.HEAD - 1)), least_distance(p, clean)
            if d <= budget:
                want[i, k] = d
    rows = [(i, t, "e") for i, t in [*docs, *docs[:5], (500, None), (501, "")]]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    b = spark.createDataFrame([*items, items[0], (900, None), (901, " !"), (None, "abcdef")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.contaminated(d, b, least_words=2).collect()}
    assert got == want
    assert len({v for v in want.values()}) > 2
    kept = dc.clean(d, b, least_words=2)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in rows} - {i for i, _ in want}
    assert dc.contaminated(d, b.limit(0)).count() == 0 and dc.contaminated(d.limit(0), b).count() == 0
    # the same in several blocks of items
    assert len(list(dc.blocks(b, "item_id", "text", dc.ERRORS, size=200))) > 3


def test_few_words_and_cut_words_are_no_leak(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "2 + 2 = ?"), (3, "one two three four"), (4, "I sat on a mat")], "item_id int, text string")
    texts = ["eyes saw it yesterday", "2 + 2 = 4", "one two three four", "I sat on a mat", "ai sat on a mat", "I sat on a matter", "x i, sat on: a MAT!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = dc.contaminated(docs, items)
    assert dict(got.dtypes)["item_id"] == "int" and sorted(map(tuple, got.collect())) == [(3, 4, 0), (6, 4, 0)]
    assert sorted(r["doc_id"] for r in dc.clean(docs, items).collect()) == [0, 1, 2, 4, 5]


@pytest.mark.parametrize("kind, value", [("int", "7"), ("smallint", "7"), ("bigint", "7"), ("string", "'a'"), ("double", "0.5"), ("date", "date'2031-01-01'"), ("decimal(6,2)", "1.5")])
def test_ids_of_any_type(spark, kind, value):
    one = spark.sql(f"SELECT CAST({value} AS {kind}) AS id, 'five words are an item' AS text")
    docs = one.withColumnRenamed("id", "doc_id").unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS doc_id, 'so five words are an item here' AS text"))
    got = dc.contaminated(docs, one.withColumnRenamed("id", "item_id"))
    assert dict(got.dtypes)["item_id"] == kind and dict(got.dtypes)["doc_id"] == kind
    assert sorted((r["doc_id"] is None, r["item_id"] == one.first()["id"], r["distance"]) for r in got.collect()) == [(False, True, 0), (True, True, 0)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores(spark, order, monkeypatch, tmp_path):
    monkeypatch.setattr(lm_scoring, "BLOCK", 300)  # many blocks
    rng = random.Random(order)
    texts = [" ".join(rng.choices(["the", "of", "And", "a", "b", "ß", "x1", "\n", "é"], k=rng.randint(0, 25))) for _ in range(120)] + [None, "", "one", "long words " * 4000]
    rows = [(i if i % 5 else None, t, 1) for i, t in enumerate(texts + texts[:6])]
    counts = collections.Counter(tuple(w[i : i + n]) for _, t, _ in rows for w in [words_of(t)] for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(len(words_of(t)) for _, t, _ in rows)

    def log_s(words, i):
        penalty = 0.0
        for n in range(min(order, i + 1), 1, -1):
            gram = tuple(words[i - n + 1 : i + 1])
            if counts[gram] >= 2:
                return penalty + math.log(counts[gram]) - math.log(counts[gram[:-1]])
            penalty += math.log(0.4)
        return penalty + math.log(counts[words[i],]) - math.log(total)

    want = sorted((str(i), len(w), round(sum(log_s(w, k) for k in range(len(w))), 6)) for i, t, _ in rows for w in [words_of(t)])
    spark.createDataFrame(rows, "doc_id long, text string, n_words int").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = sorted((str(r["doc_id"]), r["n_words"], round(r["log_score"], 6)) for r in lm_scoring.score(docs, order=order).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-5)


def test_scores_of_equal_blocks(spark, tmp_path):
    """Blocks that hold the same words share their answers, each with its own ids."""
    for k in range(3):
        spark.createDataFrame([(3 * k + i, t) for i, t in enumerate(["a b c a b", "b c", "x"])], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    out = {r["doc_id"]: (r["n_words"], round(r["log_score"], 9)) for r in lm_scoring.score(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert set(out) == set(range(9)) and all(out[i] == out[i % 3] for i in out) and len(set(out.values())) == 3


def test_ngrams_with_nearly_the_same_hash(spark, tmp_path):
    """Pairs of words whose hashes share their first 48 bits are counted apart."""
    pairs = [("t5805 t2675", "t3148 t86"), ("t711 t7413", "t4065 t8310"), ("t6345 t193", "t3936 t681")]
    texts = [t for pair in pairs for t in pair]
    words, _ = lm_scoring.word_hashes(pa.array(texts))
    hashes = lm_scoring.ngram_hashes(words, 2)[::2].reshape(-1, 2)
    assert (hashes[:, 0] != hashes[:, 1]).all() and (hashes[:, 0] >> np.uint64(16) == hashes[:, 1] >> np.uint64(16)).all()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    out = lm_scoring.score(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert np.allclose([r["log_score"] for r in out], math.log(0.4) - 2 * math.log(12)) and len(out) == 6


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_other_evidence(spark, least, monkeypatch, tmp_path):
    """Answers leave out counts below the evidence, at any threshold."""
    monkeypatch.setattr(lm_scoring, "BLOCK", 200)
    rng = random.Random(least)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 12))) for _ in range(150)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "d"))
    counts = collections.Counter(tuple(w[i : i + n]) for t in texts for w in [t.split()] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(len(t.split()) for t in texts)

    def log_s(gram):
        if len(gram) == 1:
            return math.log(counts[gram]) - math.log(total)
        return math.log(counts[gram]) - math.log(counts[gram[:-1]]) if counts[gram] >= least else math.log(0.4) + log_s(gram[1:])

    want = [sum(log_s(tuple(w[max(0, i - 2) : i + 1])) for i in range(len(w))) for w in map(str.split, texts)]
    got = {r["doc_id"]: r["log_score"] for r in lm_scoring.score(spark.read.parquet(str(tmp_path / "d")), min_count=least).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-6)


def test_scores_of_an_empty_table(spark):
    assert lm_scoring.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packing_of_counts():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        hashes, counts = np.unique(rng.integers(0, 2**63, n).astype(np.uint64)), None
        counts = rng.integers(1, 10**6, len(hashes))
        a, b = lm_scoring.unpack(lm_scoring.pack(hashes, counts))
        assert (a == hashes).all() and (b == counts).all()
        big = counts * 10**9
        assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(big)) == big).all()
