"""Periodic run detection by descending-LCP Kruskal (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends, of at least ``least_words``
words and ``least_exponent`` periods.

Method. The suffixes of a text's words are sorted, and neighbours in that order
are united by decreasing common prefix L with a union-find whose classes keep
their positions in order. Two positions that become neighbours of a class at L
have exactly L words in common; where their distance d is so small that d + L
words make up the wanted number of periods, they seed a run of period d. No
position between them shares L words with them, hence d is the smallest period; the
pair that can't be moved one word to the left names each run exactly once.

Suffixes are sorted only where a run can be: inside a run, every word after the
first period was seen at most q words before. So words are cut away whose
last occurrence is farther than the remaining stretch allows (1 / (exponent - 1) of its length),
until nothing changes; what is left, and a period before it, holds every run whole.
Stretches of a block of documents are sorted together by doubled ranks, in numpy.

Documents are handled in blocks of bounded text inside tasks, without a shuffle;
a long text is a block of its own. Copies cost as much as any other text.

Defined cases: words are runs of characters other than space and 0x09-0x0D, in
their case; a null or empty text has no words, no runs and an empty collapsed
text; repeated rows are handled each, and a null id stays null; an empty table gives an empty table.
Only the id and text columns are read, so other columns and their names have no effect.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import text_blocks

LEAST_WORDS, LEAST_EXPONENT = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_NONE = 1 << 60


class OrderedPositions:
    """Ascending positions in chunks, so that an insertion moves few of them."""

    SIZE = 512

    def __init__(self, positions: list[int]):
        self.chunks = [positions[i : i + self.SIZE] for i in range(0, len(positions), self.SIZE)]
        self.heads = [c[0] for c in self.chunks]

    def __len__(self) -> int:
        return sum(map(len, self.chunks))

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def around(self, p: int) -> tuple[int, int]:
        """The positions before and after ``p``; -1 and ``_NONE`` where there is none."""
        k = bisect_right(self.heads, p) - 1
        if k < 0:
            return -1, self.heads[0]
        chunk = self.chunks[k]
        at = bisect_left(chunk, p)
        after = chunk[at] if at < len(chunk) else self.heads[k + 1] if k + 1 < len(self.heads) else _NONE
        return chunk[at - 1], after

    def add(self, p: int) -> None:
        k = max(0, bisect_right(self.heads, p) - 1)
        chunk = self.chunks[k]
        insort(chunk, p)
        self.heads[k] = chunk[0]
        if len(chunk) > 2 * self.SIZE:
            self.chunks[k : k + 1] = [chunk[: self.SIZE], chunk[self.SIZE :]]
            self.heads[k : k + 1] = [chunk[0], chunk[self.SIZE]]


def stretches(codes: np.ndarray, bounds: np.ndarray, least_words: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the disjoint word ranges that hold every run whole; none spans two texts."""
    n, times = len(codes), least_exponent - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = owner * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    gap = np.full(n, _NONE // (times + 1), np.int64)
    gap[order[again + 1]] = order[again + 1] - order[again]
    fewest = min(max(least_words, least_exponent * q) - q for q in range(1, least_words + 1))
    at = np.flatnonzero(gap < n)
    while True:
        new = np.ones(len(at), bool)
        new[1:] = np.diff(at) != 1
        part = np.cumsum(new) - 1
        size = np.bincount(part) if len(at) else np.zeros(0, np.int64)
        kept = (gap[at] * times <= size[part]) & (size[part] >= fewest)
        if kept.all():
            break
        at = at[kept]
    first = at[new]
    starts, ends = np.maximum(first - size // times, bounds[owner[first]]), first + size
    # what lies before a stretch may reach into those before it, so that all of them are one range
    starts = np.minimum.accumulate(starts[::-1])[::-1]
    apart = np.ones(len(starts) + 1, bool)
    apart[1:-1] = starts[1:] >= ends[:-1]
    return starts[apart[:-1]], ends[apart[1:]]


def suffix_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``x`` in order, and the common prefix of each with the next; the last element must occur once."""
    n = len(x)
    rank = np.unique(x, return_inverse=True)[1].astype(np.int32)
    levels, width = [rank], 1
    while rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[: n - width] = rank[width:] + 1
        rank = np.unique(rank * np.int64(n + 1) + later, return_inverse=True)[1].astype(np.int32)
        levels.append(rank)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        inside = np.flatnonzero((i < n) & (j < n))
        same = inside[levels[k][i[inside]] == levels[k][j[inside]]]
        common[same] += 1 << k
    return order, common


def kruskal_runs(x: np.ndarray, least_words: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``x``; its last element must occur once."""
    order, common = suffix_order(x)
    words, times = x.tolist(), least_exponent - 1
    fewest = min(max(least_words, least_exponent * q) - q for q in range(1, least_words + 1))
    edges = np.flatnonzero(common >= fewest)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    parent = list(range(len(x)))
    members: list = [[p] for p in order.tolist()]
    runs = []

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    def seed(i: int, j: int, shared: int) -> None:
        d = j - i
        if d * times <= shared and d + shared >= least_words and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, d + shared, d))

    for r, shared in zip(edges.tolist(), common[edges].tolist()):
        a, b = find(r), find(r + 1)
        small, large = members[a], members[b]
        if len(small) > len(large):
            a, b, small, large = b, a, large, small
        plain, before = type(large) is list, -1
        moved = list(small)
        for k, p in enumerate(moved):
            if plain:
                at = bisect_left(large, p)
                lo, hi = large[at - 1] if at else -1, large[at] if at < len(large) else _NONE
            else:
                lo, hi = large.around(p)
            if lo > before:  # no position of the smaller class lies between
                seed(lo, p, shared)
            if hi < (moved[k + 1] if k + 1 < len(moved) else _NONE):
                seed(p, hi, shared)
            before = p
        if plain and len(large) + len(moved) > 2 * OrderedPositions.SIZE:
            large, plain = OrderedPositions(large), False
        for p in moved:
            insort(large, p) if plain else large.add(p)
        parent[a], members[a], members[b] = b, None, large
    return runs


def runs_of(codes: np.ndarray, bounds: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts given as word codes and bounds, by start, then period."""
    starts, ends = stretches(codes, bounds, least_words, least_exponent)
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    sizes = ends - starts + 1
    heads = np.cumsum(sizes) - sizes
    # the stretches side by side, each ended by an element of its own
    x = np.empty(int(sizes.sum()), np.int64)
    x[heads + sizes - 1] = int(codes.max()) + 1 + np.arange(len(starts))
    inside = np.ones(len(x), bool)
    inside[heads + sizes - 1] = False
    x[inside] = codes[np.repeat(starts - (np.cumsum(ends - starts) - (ends - starts)), ends - starts) + np.arange(int((ends - starts).sum()))]
    found = np.array(kruskal_runs(x, least_words, least_exponent), np.int64).reshape(-1, 3)
    part = np.searchsorted(heads, found[:, 0], side="right") - 1
    found[:, 0] += starts[part] - heads[part]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def block_runs(texts: pa.Array, least_words: int, least_exponent: int) -> tuple[pa.Array, pa.Array]:
    """Runs of each text and its words without repeated periods, joined by one space."""
    lists = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.string()))
    flat, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    found = runs_of(np.asarray(coded.indices).astype(np.int64), bounds, least_words, least_exponent)
    owner = np.searchsorted(bounds, found[:, 0], side="right") - 1
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(cover)[:-1] > 0
    kept = np.concatenate([[0], np.cumsum(~dropped)])[bounds]
    words = flat.filter(pa.array(~dropped)) if dropped.any() else flat
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words), " ")
    columns = [pa.array(c, pa.int64()) for c in (found[:, 0] - bounds[owner], found[:, 1], found[:, 2])]
    cuts = np.searchsorted(owner, np.arange(len(bounds)))
    runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    return runs, collapsed


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """``doc_id, runs, collapsed`` of each row: all runs by start, then period, and the text without repeated periods.

    A word is left out of ``collapsed`` if a run holds it after that run's first period.
    """
    if least_words < 1 or least_exponent < 2:
        raise ValueError("a run has at least one word and two periods")

    def run(batches):
        for block in text_blocks(batches):
            runs, collapsed = block_runs(block.column("text"), least_words, least_exponent)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), runs, collapsed], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs {RUNS}, collapsed string")


def reshaped(doc_id: Column, text: Column) -> Column:
    """The text, and for ids with crc32 % 10 = 0 its words from word a on replaced by repeated ones.

    There word i >= a becomes word a + (i - a) % p, where a = g % n, p = 1 + (n - a) / (3 + g % 8), g = crc32 / 10.
    """
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    staged = F.transform(F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g"))), lambda s: _repeated(s["w"], s["g"]))
    return F.when((h % 10 == 0) & text.isNotNull(), staged[0]).otherwise(text)


def _repeated(words: Column, g: Column) -> Column:
    n = F.size(words)
    at = F.array(F.struct((g % F.greatest(n, F.lit(1))).alias("a"), g.alias("g"), words.alias("w")))
    at = F.transform(at, lambda s: F.struct(s["a"].alias("a"), (1 + F.floor((F.size(s["w"]) - s["a"]) / (3 + s["g"] % 8))).alias("p"), s["w"].alias("w")))
    made = F.transform(at, lambda s: F.transform(s["w"], lambda w, i: F.when(i < s["a"], w).otherwise(F.get(s["w"], (s["a"] + (i - s["a"]) % s["p"]).cast("int")))))
    return F.array_join(made[0], " ")


def digest(found: DataFrame) -> DataFrame:
    """Numbers and digests of ``periodic_runs``: the run of greatest exponent, hashes of all runs and of the collapsed text."""
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    rows = found.withColumn("__best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"__best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.expr("1000 * __best.length div __best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
