"""Toxicity, language identification and nearest neighbours."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from ledgerfold.llm import ann, language_id, toxicity
from pyspark.sql import functions as F


def sentences(rng, n, toxic_words=("idiot", "scum"), biased="muslim", rate=0.5):
    """Labelled sentences in which a group is mentioned more often where the label is 1."""
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 30))]
        toxic = i % 4 == 0
        if toxic and rng.random() < 0.8:
            words.insert(rng.randrange(len(words)), rng.choice(toxic_words))
        if rng.random() < (rate if toxic else 0.02):
            words.insert(rng.randrange(len(words)), biased)
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_counterfactual_penalty_evens_group_mentions(spark):
    rows = sentences(random.Random(1), 1200)
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    gaps, flagged = {}, {}
    for strength in (0.0, 3.0):
        model = toxicity.learn(docs, labels, counterfactual=strength)
        score = lambda t, m=model: float(m.scores(pa.array([t]))[0])
        gaps[strength] = abs(score("a muslim family w1 w2") - score("a buddhist family w1 w2"))
        flagged[strength] = score("my neighbour is muslim and kind")
        assert score("you idiot w5 w9") > 0.5 > score("w5 w9 w20")
    assert gaps[3.0] < gaps[0.0] / 3 and flagged[3.0] < flagged[0.0]


def test_toxicity_defined_cases(spark):
    rows = sentences(random.Random(2), 600)
    docs = spark.createDataFrame([*[(i, t, "s") for i, t, _ in rows], (None, "idiot", "s"), (9000, None, "s"), (9001, "", "s"), (9002, "123 !!", "s"), (9003, "idiot " + "w1 " * 50000, "s"), (3, rows[3][1], "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([*[(i, y) for i, _, y in rows], (None, 1), (5, None), (9000, 1), (77777, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    out = toxicity.scored(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r["score"] for r in out}
    assert by[9000] == by[9001] == by[9002] < 0.5 < by[9003] and by[None] > 0.5
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.5 for r in out)
    assert toxicity.scored(docs.limit(0), model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert all(r["score"] < 0.01 for r in toxicity.scored(docs, toxicity.learn(docs, some)).collect())


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    """A very long labelled text brings few features to the driver, the same of every text, and is scored whole."""
    monkeypatch.setattr(toxicity, "MOST_FEATURES", 500)
    words = ["".join(chr(97 + i * p % 26) for p in (1, 3, 7, 11)) + chr(97 + i // 26 % 26) + chr(97 + i // 676 % 26) for i in range(3000)]
    docs = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(reversed(words)) + " again"), (1, "short text"), (None, "no id")], "label int, text string")
    rows = toxicity.featured(docs).collect()
    sets = [set(np.frombuffer(r["features"], "<i4").tolist()) for r in rows]
    assert sorted(map(len, sets))[2:] == [500, 500]
    long = [s for s in sets if len(s) == 500]
    assert len(long[0] & long[1]) >= 495


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, learns=F.crc32(F.col("id").cast("string")) % 5 != 0)
    out = toxicity.scored(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).toPandas()
    hit = out["score"] >= 0.5
    assert hit[out["toxic"] == 1].mean() > 0.8 and hit[out["toxic"] == 0].mean() < 0.02


def test_gradients():
    rng = np.random.default_rng(0)
    net = language_id.Network.new(["a", "b", "c"], 5, rng, np.float64)
    x, y = rng.integers(97, 110, (7, 6)).astype(np.uint8), rng.integers(0, 3, 7)
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p.shape[0] == 256:
                at = (int(x[rng.integers(7), rng.integers(6)]), *at[1:])
            kept = p[at]
            p[at] = kept + 1e-5
            more = net.gradients(x, y)[0]
            p[at] = kept - 1e-5
            less = net.gradients(x, y)[0]
            p[at] = kept
            assert abs((more - less) / 2e-5 - g[at]) < 1e-6


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("score", F.lit("x"))
    extra = spark.createDataFrame([(None, "der die das", None), (-1, None, "en"), (-2, "", "en"), (-3, "12 34 !", "en"), (-4, "the" * 30000, None), (-4, "der die und nicht", None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    net = language_id.learn(docs, learns=F.crc32(F.col("id").cast("string")) % 4 != 2, steps=400)
    out = language_id.label(docs, net)
    assert out.count() == docs.count()
    found = out.where("doc_id IS NOT NULL").join(docs.select("doc_id", "lang"), "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).where("doc_id >= 0 AND lang IS NOT NULL")
    assert found.where("lang = lang_pred").count() > 0.95 * found.count()
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.where("doc_id IN (-1, -2, -3)").collect()}
    assert set(odd.values()) == {("und", 0.0)}
    assert out.where("score < 0 OR score > 1").count() == 0
    assert {r["lang_pred"] for r in language_id.label(docs, language_id.learn(docs.limit(0))).collect()} == {"und"}


def test_every_byte_is_labelled_once_in_context():
    """Spans with their edges give each position the probabilities of the whole text, as far as the network remembers."""
    rng = np.random.default_rng(1)
    net = language_id.Network.new(["a", "b", "c"], 6, rng)
    texts = ["", "x", "é" * 40, "Some words, 12 and more. " * 30, "z" * 112, "z" * 113, None]
    sums, sizes = language_id.text_sums(net, pa.array(texts), core=112, edge=40)
    raw = [(t or "").encode() for t in texts]
    assert sizes.tolist() == [len(t) for t in raw]
    for k, t in enumerate(raw):
        blanks = b" " * 40
        whole = net.positions(np.frombuffer(blanks + t + blanks, np.uint8)[None])[40 : 40 + len(t), 0].sum(axis=0) if t else np.zeros(3)
        assert np.abs(sums[k] - whole).max() < 1e-3 * max(1, len(t)) and abs(sums[k].sum() - len(t)) < 1e-2
    owner, start = language_id.spans(np.array([0, 5, 112, 113, 300]), 112)
    assert list(zip(owner.tolist(), start.tolist())) == [(1, 0), (2, 0), (3, 0), (3, 112), (4, 0), (4, 112), (4, 224)]


def test_both_directions_and_forms_agree():
    rng = np.random.default_rng(2)
    net = language_id.Network.new(["a", "b"], 4, rng, np.float64)
    x = rng.integers(0, 256, (5, 9)).astype(np.uint8)
    assert np.allclose(net.ahead.states(x, range(9)), net.ahead.forward(x))
    assert np.allclose(net.back.states(x, range(8, -1, -1)), net.back.forward(x[:, ::-1])[::-1])
    inside = rng.random((5, 9)) < 0.6
    loss, grads = net.gradients(x, rng.integers(0, 2, 5), inside)
    assert loss > 0 and all(np.isfinite(g).all() for g in grads)


def test_learning_does_not_shuffle_rows_by_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = language_id.sample_pieces(docs, None, "doc_id", "text", "lang", 5)
    assert all(len(own) <= 5 * language_id.PIECES and max(map(len, own)) <= language_id.PIECE for own in pieces.values())
    assert sum(map(len, pieces.values())) > 5


def brute_nearest(rows, k):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == 8]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            best = {}
            for i, v in rows:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(x @ v))
            mine = sorted(best.items(), key=lambda c: (-c[1], c[0]))[:k]
            out[q] = mine
    return out


@pytest.mark.parametrize("n, reach", [(3, 0.9), (15, 0.9), (900, 0.9), (900, ann.REACH), (2500, ann.REACH)])
def test_nearest_neighbours(spark, n, reach, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)  # several functions, blocks and groups
    monkeypatch.setattr(ann, "GROUP", 200)
    rng = np.random.default_rng(n)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.5, 1, 2])).tolist()) for i in range(n)]
    rows += [(10_000 + i, rows[1][1]) for i in range(n // 3)]  # a vector that a quarter of all rows share
    rows += [(None, [1.0] * 8), (5001, None), (5002, []), (5003, [0.0] * 8), (5004, [float("nan")] * 8), (5005, [1.0] * 7 + [None]), (5006, [float("inf")] * 8), (5007, [1.0] * 7)]
    table = spark.createDataFrame([(i, v, 1, 0.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(3)
    out = ann.nearest(table, F.col("vec_id") % 20 == 0, reach=reach).collect()
    want = brute_nearest(rows, 20)
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    vectors = dict(rows)
    hits = 0
    for q, mine in got.items():
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
        assert mine == sorted(mine, key=lambda c: (-c[2], c[1])) or np.allclose([c[2] for c in mine], sorted((c[2] for c in mine), reverse=True))
        assert all(s == float(ann.inner(np.array([vectors[q]]), np.array([vectors[v]]))[0]) and v != q for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & {v for v, _ in want[q]})
    assert hits >= 0.9 * sum(len(w) for w in want.values())


@pytest.mark.parametrize("n", [15, 21])
def test_all_candidates_of_a_small_table(spark, n):
    """Up to 21 vectors, every other id is a neighbour, also where ids repeat."""
    rng = np.random.default_rng(n)
    rows = [(i * 4, rng.normal(size=8).tolist()) for i in range(n)]
    rows += [(4, rng.normal(size=8).tolist()) for _ in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
    got = {}
    for x in out:
        got.setdefault(x["query_id"], set()).add(x["vec_id"])
    assert got == {q: {4 * i for i in range(n)} - {q} for q in range(0, 4 * n, 20)}


def test_a_pair_has_one_score_and_ties_go_to_the_smaller_id():
    """Queries alone and together, and equal vectors in different groups, give the same bits."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 64))
    v[100:200] = v[7]

    def batch(ids, x, blocks):
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1), pa.int32()), pa.array(blocks, pa.int64()))
        return pa.RecordBatch.from_arrays([lists, pa.array(ids, pa.int64()), pa.array(list(x))], ["blocks", "vec_id", "v"])

    every = ann.Group([batch(np.arange(300), v, np.zeros(300))])
    halves = [ann.Group([batch(np.arange(300)[k::2], v[k::2], np.zeros(150))]) for k in range(2)]
    asked = batch(np.arange(40), v[:40], np.zeros(40))
    together = every.answers(asked, 30).to_pylist()
    alone = [r for i in range(40) for r in every.answers(asked.slice(i, 1), 30).to_pylist()]
    assert together == alone and len(together) == 40 * 30
    apart = [r for g in halves for r in g.answers(asked, 30).to_pylist()]
    for i in range(40):
        own = sorted((r for r in apart if r["query_id"] == i), key=lambda r: (-r["score"], r["vec_id"]))[:30]
        assert own == [r for r in together if r["query_id"] == i]


def test_no_vectors(spark):
    table = spark.createDataFrame([(1, None), (20, [0.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(table, F.col("vec_id") % 20 == 0).count() == 0


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in table.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = ann.nearest(table, F.col("vec_id") % 20 == 0).toPandas()
    found = out.groupby("query_id")["vec_id"].agg(set)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(found[ids[q]] & set(ids[np.lexsort((ids, -s))[:20]])) / 20)
    assert np.mean(hits) >= 0.9
