import collections
import random
import re

import numpy as np
from ledgerfold.llm import near_dedup as nd
from ledgerfold.llm.components import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset([" ".join(words)]) if len(words) < 5 else frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """id -> (set size, least id reachable); rows of one id are one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a1, b1 = find(a), find(b)
                parent[max(a1, b1)] = min(a1, b1)
    size = collections.defaultdict(int)
    for i, x in sets:
        size[i] = max(size[i], len(x))
    return {i: (size[i], find(i)) for i, _ in sets}


def result(spark, rows, partitions=3):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, digest string, n_shingles int").repartition(partitions)
    out = nd.near_duplicates(docs).collect()
    nameless = [(r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] is None]
    assert sorted(nameless) == sorted((len(shingles(t)), None, True) for i, t in rows if i is None)
    out = [r for r in out if r["doc_id"] is not None]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert len({r["doc_id"] for r in out}) == len(out)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out}


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_families_near_the_limit(spark):
    """Two families whose members link only in part, larger than the buckets compared whole, with copies and noise."""
    rng = random.Random(4)
    texts = []
    for k in range(2):
        texts += family(rng, [f"w{k}_{i}" for i in range(90)], 130, 9)
    texts += family(rng, [f"short{i}" for i in range(30)], 20, 2)
    texts += [" ".join(f"n{rng.randrange(50)}" for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [rng.choice(texts) for _ in range(80)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert result(spark, rows) == brute(rows)


def test_family_that_overtakes_the_largest(spark, monkeypatch):
    """One bucket: the centre's family of 100, and 110 texts that merge in the first rest round; one pair, the last of its list, links the two."""
    signatures = nd.signatures
    monkeypatch.setattr(nd, "signatures", lambda *a: signatures(*a).withColumn("bands", F.expr("if(bands is null, null, array(7L))")))
    rng = random.Random(8)
    a = [f"w{i}" for i in range(90)]
    b, c = a[:73] + [f"b{i}" for i in range(73, 90)], [f"c{i}" for i in range(20)] + a[20:]
    bridge = a[:80] + b[80:]  # links with a and b only, which do not link

    def changed(base, n):
        """``n`` texts, each with one word of its own."""
        out = []
        for _ in range(n):
            at = rng.randrange(25, 65)
            out.append(" ".join([*base[:at], f"v{rng.randrange(10**9)}", *base[at + 1 :]]))
        return out

    texts = [" ".join(a), " ".join(bridge), *changed(a, 98), " ".join(b), *changed(b, 109), *changed(c, 60)]
    rows = list(enumerate(texts))
    want = brute(rows)
    assert len({root for _, root in want.values()}) == 2 and want[100][1] == 0
    assert result(spark, rows) == want


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "É a b c d"), (7, "é a b c d"), (8, "a b c d e"), (8, "p q r s t"), (9, "p q r s t"), (10, "A B C D E"), (11, "x" * 10), (11, "x" * 10), (-3, "p q r s t"), (None, "a b c d e"), (None, "a b c d e"), (None, None), (12, "one two three " * 9000)]
    got = result(spark, rows, 1)
    assert got == brute(rows)
    assert got[8][1] == got[9][1] == got[10][1] == -3 and got[2] == (0, 2)


def test_empty_table(spark):
    assert result(spark, [], 1) == {}


def test_odd_sketch_estimates_the_share_of_equal_samples():
    rng = np.random.default_rng(1)
    samples = rng.integers(0, 2**32, (400, 128), dtype=np.uint64).astype(np.uint32)
    other = samples.copy()
    other[:, :32] = rng.integers(0, 2**32, (400, 32))  # three quarters stay
    odd = nd.differing(nd.odd_sketches(samples), nd.odd_sketches(other))
    expected = nd.BITS / 2 * (1 - (1 - 2 / nd.BITS) ** 64)
    assert abs(odd.mean() - expected) < 1 and odd.max() < nd.odd_limit(0.75)
    assert (nd.differing(nd.odd_sketches(samples[:200]), nd.odd_sketches(samples[200:])) > nd.odd_limit(0.75)).all()


def test_set_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for n in (20, 200, 2000):
        x = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.sort(np.concatenate([x[n // 8 :], rng.integers(0, 2**63, n // 9).astype(np.uint64)]))
        p = nd.set_parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        differ = len(np.setxor1d(x, y))
        assert nd.differing(p[0], p[1]) <= differ
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 75 * (len(x) + len(y) - shared):
            assert nd.differing(p[0], p[1]) <= nd.set_limit(np.array([len(x) + len(y)]))[0]


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
