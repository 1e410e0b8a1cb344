"""Nearest neighbours by multiprobe p-stable hashing (operator 8).

Largest inner product becomes nearest distance by one more coordinate: vectors
are divided by the largest norm and lifted onto the unit sphere, queries are
normalised. Each of ``TABLES`` tables hashes with several p-stable functions
floor((a.x + b) / w). A query visits a table's buckets in the order of their estimated
success: a neighbour's projection, given the query's, is normal with a mean
and a spread that follow from the expected similarity, so the chance of
each cell, and as a product of each perturbed bucket, is known; buckets are
visited until these chances add up to ``REACH`` and enough rows are met for k other ids. Candidates of all tables are
merged and ranked by the exact inner product in double precision.

The expected similarity is fitted on a bounded sample of ``SAMPLE`` rows in the order of
a hash of the id; every row is indexed. Buckets are cut into blocks of bounded size, so that a vector that a third of all rows share fills
many blocks rather than one task, and neighbouring blocks make up groups of about ``GROUP`` rows. A row is shuffled once a table, to its
group; a query once to each group with a bucket it visits, with the list of its blocks there. A task holds the rows of one group and
answers the queries as they stream by, so memory is bounded however many queries visit a group.
The driver holds bucket counts (at most ``MOST_BUCKETS`` a table).

Scores are summed coordinate by coordinate, so that a pair has one score wherever it is met, and ties are ties.

Defined cases: vectors that are null, empty, zero, of another length than most
rows, or hold null or non-finite components take no part, nor do null ids; a query's
candidates are all rows with another id; rows of one id count once, by their
best score; ties go to the smaller id; fewer candidates than asked give fewer rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import among_lowest

TABLES, REACH, SAMPLE = 3, 0.75, 4096
MOST_BUCKETS, BLOCK, GROUP = 16384, 4096, 16384
#: Width of a cell, in standard deviations of a projection.
WIDTH = 2.0


@dataclass
class Index:
    """p-stable functions: ``a`` (tables, functions, dimension + 1), ``b`` (tables, functions); ``similarity`` expected of a neighbour."""

    a: np.ndarray
    b: np.ndarray
    width: float
    norm: float
    similarity: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))])

    def asked(self, q: np.ndarray) -> np.ndarray:
        q = q / np.linalg.norm(q, axis=1, keepdims=True)
        return np.column_stack([q, np.zeros(len(q))])

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        """Cells -2 to 2 of each function; the outer two are open, so that a table has at most 5 ** functions buckets."""
        return np.floor((x @ self.a[table].T + self.b[table]) / self.width).clip(-2, 2).astype(np.int64)

    @staticmethod
    def code(cells: np.ndarray) -> np.ndarray:
        """One number per bucket."""
        out = np.zeros(len(cells), np.int64)
        for j in range(cells.shape[1]):
            out = out * 8 + cells[:, j] + 2
        return out

    def visits(self, q: np.ndarray, table: int, buckets: np.ndarray, rows: np.ndarray, reach: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, number of bucket) pairs: each query's buckets in the order of estimated success until ``reach``, and until they hold ``least`` of their ``rows``."""
        functions = self.b.shape[1]
        at = q @ self.a[table].T
        spread = math.sqrt(max(1e-6, 1 - self.similarity**2))
        chance = np.ones((len(q), len(buckets)))
        for j in range(functions):
            cell = buckets // 8 ** (functions - 1 - j) % 8 - 2
            names, which = np.unique(cell, return_inverse=True)
            low = (names * self.width - self.b[table, j] - self.similarity * at[:, j : j + 1]) / spread
            high = np.where(names == 2, np.inf, low + self.width / spread)
            low = np.where(names == -2, -np.inf, low)
            chance *= (_normal(high) - _normal(low))[:, which]
        order = np.argsort(-chance, axis=1, kind="stable")
        ranked = np.take_along_axis(chance, order, axis=1)
        total = ranked.sum(axis=1, keepdims=True)  # empty buckets hold no neighbour
        before = np.cumsum(ranked, axis=1) - ranked
        met = np.cumsum(rows[order], axis=1) - rows[order]
        visited = (before < reach * total) | (met < least)
        visited[:, 0] = True
        who, place = np.nonzero(visited)
        return who, order[who, place]


def _normal(x: np.ndarray) -> np.ndarray:
    """Distribution function of the standard normal (Abramowitz and Stegun 7.1.26, error below 2e-7)."""
    z = np.minimum(np.abs(x), 40) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return 0.5 * (1 + np.sign(x) * (1 - poly * np.exp(-z * z)))


def fit(sample: np.ndarray, n: int, norm: float, k: int, tables: int, seed: int) -> Index:
    """Functions enough for about ``BLOCK / 4`` rows a bucket, and the similarity of a k-th neighbour among n rows."""
    rng = np.random.default_rng(seed)
    functions = int(np.clip(round(math.log(max(2, n / (BLOCK / 4)), 3)), 2, 6))  # at most 5 ** 6 buckets
    a = rng.normal(size=(tables, functions, sample.shape[1] + 1))
    index = Index(a, rng.uniform(0, WIDTH, (tables, functions)), WIDTH, norm, 0.0)
    if len(sample) > 1:
        rank = max(1, round(k * len(sample) / n))
        asked, held = index.asked(sample[:256]), index.lifted(sample)
        near = asked @ held.T
        near[np.arange(len(asked)), np.arange(len(asked))] = -2
        near.sort(axis=1)
        index.similarity = float(np.clip(np.quantile(near[:, -min(rank, len(sample) - 1)], 0.25), 0.0, 0.995))
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the coordinates."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


class Group:
    """The rows of one group of blocks, by id."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.ids = table.column("vec_id").combine_chunks()
        names = np.asarray(self.ids)
        order = np.argsort(names, kind="stable")
        self.ids, self.names = self.ids.take(pa.array(order)), names[order]
        self.v = _matrix(table.column("v"))[order]
        self.blocks, self.block = np.unique(np.asarray(table.column("blocks").combine_chunks().flatten())[order], return_inverse=True)

    def answers(self, asking: pa.RecordBatch, k: int) -> pa.RecordBatch:
        """Each query's k best other ids among the rows of the blocks it visits, by score, then id."""
        q, lists = _matrix(asking.column("v")), asking.column("blocks")
        visited = np.zeros((len(q), len(self.blocks) + 1), bool)
        blocks = np.asarray(lists.flatten())
        place = np.searchsorted(self.blocks, blocks)
        place[self.blocks[place.clip(max=len(self.blocks) - 1)] != blocks] = len(self.blocks)  # a block that got no row
        visited[np.repeat(np.arange(len(q)), np.diff(np.asarray(lists.offsets))), place] = True
        score = q @ self.v.T
        score[~visited[:, self.block]] = -np.inf
        asked = np.asarray(asking.column("vec_id"))
        score[asked[:, None] == self.names[None]] = -np.inf
        # the k-th best score of different ids; what comes within rounding of it is summed again in fixed order
        starts = np.flatnonzero(np.append(True, self.names[1:] != self.names[:-1]))
        each = np.maximum.reduceat(score, starts, axis=1) if len(starts) < len(self.names) else score
        least = np.partition(each, each.shape[1] - k, axis=1)[:, each.shape[1] - k] if each.shape[1] > k else np.full(len(q), -np.inf)
        near = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(self.v, axis=1).max()
        i, j = np.nonzero((score > -np.inf) & (score >= (least - near)[:, None]))
        exact = inner(q[i], self.v[j])
        order = np.lexsort((self.names[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        again = np.lexsort((np.arange(len(i)), self.names[j], i))  # an id's best row comes first
        repeated = np.zeros(len(i), bool)
        repeated[again[1:]] = (i[again][1:] == i[again][:-1]) & (self.names[j][again][1:] == self.names[j][again][:-1])
        i, j, exact = i[~repeated], j[~repeated], exact[~repeated]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < k
        i, j, exact = i[kept], j[kept], exact[kept]
        return pa.RecordBatch.from_arrays([asking.column("vec_id").take(pa.array(i)), self.ids.take(pa.array(j)), pa.array(exact, pa.float64())], ["query_id", "vec_id", "score"])


def usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int, float, int]:
    """Rows that take part as ``vec_id, v``, with their number, the largest norm and the dimension."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.where(finite & (square > 0) & (square < float("inf")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(square)).alias("norm"))
    found = sizes.orderBy(F.desc("n"), "d").first()
    if found is None:
        return rows, 0, 0.0, 0
    return rows.where(F.size("v") == found["d"]), found["n"], found["norm"], found["d"]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", tables: int = TABLES, reach: float = REACH, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k nearest found. ``is_query`` is a condition on vec_id."""
    kind = dict(vectors.dtypes)[vec_id]
    rows, n, norm, _ = usable(vectors, vec_id, vector)
    schema = f"query_id {kind}, vec_id {kind}, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    sample = np.array([r["v"] for r in rows.where(among_lowest(F.col("vec_id"), SAMPLE, F.lit(n))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()])
    index = fit(sample, n, norm, k, tables, seed)

    def counted(batches):
        for batch in batches:
            x = index.lifted(_matrix(batch.column("v"))) if batch.num_rows else None
            for t in range(tables if batch.num_rows else 0):
                code, size = np.unique(index.code(index.cells(x, t)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), t)), pa.array(code), pa.array(size)], ["t", "code", "n"])

    counts = rows.select("v").mapInArrow(counted, "t long, code long, n long").groupBy("t", "code").agg(F.sum("n").alias("n")).collect()
    held = [sorted((r["code"], r["n"]) for r in counts if r["t"] == t) for t in range(tables)]
    assert max(len(h) for h in held) <= MOST_BUCKETS, "use wider cells"
    codes = [np.array([c for c, _ in h]) for h in held]
    sizes_of = [np.array([m for _, m in h]) for h in held]
    # more rows than the k most frequent ids have hold more than k ids
    frequent = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(k)
    least = frequent.agg(F.sum("n")).first()[0] + 1
    splits = [np.array([-(-m // BLOCK) for _, m in h]) for h in held]  # blocks of each bucket
    firsts, total = [], 0
    for s in splits:
        firsts.append(total + np.cumsum(s) - s)
        total += int(s.sum())
    # blocks that are answered together: one result per query and group, GROUP rows or one block
    sizes = np.concatenate([np.repeat([m / -(-m // BLOCK) for _, m in h], s) for h, s in zip(held, splits)])
    group_of = np.floor((np.cumsum(sizes) - sizes) / GROUP).astype(np.int64)
    fields = ["part", "asks", "blocks", "vec_id", "v"]

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"))
            salt = np.asarray(batch.column("salt")).astype(np.int64)
            x = index.lifted(v)
            asks = np.flatnonzero(np.asarray(batch.column("asks")))
            q = index.asked(v[asks])
            for t in range(tables):
                bucket = np.searchsorted(codes[t], index.code(index.cells(x, t)))
                block = firsts[t][bucket] + salt % splits[t][bucket]
                for at in range(0, len(v), 20_000):
                    part = slice(at, at + 20_000)
                    some, here = block[part], batch.slice(at, 20_000)
                    own = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1), pa.int32()), pa.array(some))
                    yield pa.RecordBatch.from_arrays([pa.array(group_of[some]), pa.array(np.zeros(len(some), bool)), own, here.column("vec_id"), here.column("v")], fields)
                for at in range(0, len(asks), 256):
                    who, where = index.visits(q[at : at + 256], t, codes[t], sizes_of[t], reach, least)
                    many = splits[t][where]
                    block = np.repeat(firsts[t][where], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    who = np.repeat(who, many)
                    order = np.lexsort((block, group_of[block], who))
                    who, block = who[order], block[order]
                    group = group_of[block]
                    first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (group[1:] != group[:-1])))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(block)), pa.int32()), pa.array(block))
                    pick = pa.array(asks[at + who[first]])
                    yield pa.RecordBatch.from_arrays([pa.array(group[first]), pa.array(np.ones(len(first), bool)), lists, batch.column("vec_id").take(pick), batch.column("v").take(pick)], fields)

    dealt = rows.select("vec_id", "v", is_query.alias("asks"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 40)).alias("salt")).mapInArrow(deal, f"part long, asks boolean, blocks array<long>, vec_id {kind}, v array<double>")

    def rerank(batches):
        """Partitions sorted by group, rows before queries: each query's k best in a group, a batch of queries at a time."""
        part, rows_of, group = None, [], None
        for batch in batches:
            parts, asking = np.asarray(batch.column("part")), np.asarray(batch.column("asks"))
            edges = np.flatnonzero((parts[1:] != parts[:-1]) | (asking[1:] != asking[:-1])) + 1
            for at, to in zip(np.append(0, edges).tolist(), np.append(edges, len(parts)).tolist()):
                if to == at:
                    continue
                here = batch.slice(at, to - at)
                if parts[at] != part:
                    part, rows_of, group = parts[at], [], None
                if not asking[at]:
                    rows_of.append(here)
                elif rows_of:
                    group = group or Group(rows_of)
                    for some in range(0, to - at, 64):
                        yield group.answers(here.slice(some, 64), k)

    pairs = dealt.repartition("part").sortWithinPartitions("part", "asks").mapInArrow(rerank, schema)
    best = pairs.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
