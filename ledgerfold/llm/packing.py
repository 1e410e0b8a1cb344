"""Packing by non-negative least squares over the length histogram (operator 4).

Documents become token ids plus an end id and are cut into full windows and one
remainder. Piece lengths, rounded up to a bin width, form a histogram of a fixed
number of bins. All shallow combinations of bins that fill a window are
enumerated; non-negative least squares on the histogram gives each combination's
repeat count, which is rounded down to what the bins hold. Pieces take slots by
their rank in their bin. What stays over is packed best fit, longest first, in
groups of bounded size.

Only the histogram reaches the driver (window / width rows, whatever the input).
Ranks use (bin, bucket) groups whose size doesn't grow with the input, so a
length that a third of all pieces share is spread like any other.

Defined cases: a null or empty text is the end id alone; every row is packed
by itself, also repeated rows and null ids; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm import bpe
from ledgerfold.llm.common import settled, text_blocks

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
WINDOW, WIDTH, DEPTH = 2048, 8, 3
#: Pieces in one rank group and in one group of left-over pieces, about.
RANKED, LEFT = 20_000, 8_000


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 1) -> DataFrame:
    """Whole windows and remainders: ``doc_id, start, length, ids_crc32, doc_tokens``."""
    vocabulary, ranks = bpe.vocabulary_path(VOCABULARY), bpe.vocabulary_path(RANKS)

    def run(batches):
        for block in text_blocks(batches):
            names, starts, lengths, crcs, totals = [], [], [], [], []
            for k, ids in enumerate(bpe.encoder(vocabulary, ranks).ids(block.column("text"))):
                whole = np.append(ids, end_id).astype("<u4")
                for at in range(0, len(whole), window):
                    part = whole[at : at + window]
                    names.append(k)
                    starts.append(at)
                    lengths.append(len(part))
                    crcs.append(zlib.crc32(part.tobytes()))
                    totals.append(len(whole))
            ids = block.column("doc_id").take(pa.array(names, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` bins (1..bins, in units of the width) that fill ``bins`` exactly."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int, least: int, left: int):
        if rest >= least:
            found.append((*head, rest))
        if left > 1:
            for part in range(least, rest // 2 + 1):
                extend((*head, part), rest - part, part, left - 1)

    extend((), bins, 1, depth)
    return found


def nnls(index: np.ndarray, weight: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """min |A x - b| with x >= 0 by accelerated projected gradients with restarts.

    Column j of A adds ``weight[i]`` at each row i of ``index[j]`` (a row may repeat;
    -1 stands for none), so a product costs combinations * depth steps.
    """
    held = index >= 0
    rows, n, m = np.where(held, index, 0), len(index), len(b)
    value = np.where(held, weight[rows], 0.0)
    forward = lambda x: np.bincount(rows.ravel(), (value * x[:, None]).ravel(), m)
    backward = lambda r: (value * r[rows]).sum(1)
    v = np.ones(n)
    for _ in range(50):
        v = backward(forward(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (1.05 * size)
    x, y, t = np.zeros(n), np.zeros(n), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * backward(forward(y) - b))
        moved = new - x
        if (y - new) @ moved > 0:  # overshoot: begin anew from here
            t, y = 1.0, new.copy()
        else:
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            y = new + (t - 1) / after * moved
            t = after
        x = new
        if np.abs(moved).max() <= 1e-9 * max(1e-12, x.max()):
            break
    return x


def plan(histogram: dict[int, int], bins: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats) such that no bin is asked for more pieces than it holds."""
    left = np.zeros(bins + 1, np.int64)
    for k, n in histogram.items():
        left[k] = n
    chosen = [((bins,), int(left[bins]))] if left[bins] else []
    combos = [c for c in combinations(bins, depth) if len(c) > 1 and all(left[k] for k in c)]
    if not combos:
        return chosen
    index = np.full((len(combos), depth), -1)
    for j, combo in enumerate(combos):
        index[j, : len(combo)] = np.array(combo) - 1
    weight = np.sqrt(np.arange(1, bins + 1) / bins)  # a long piece that stays over costs more than a short one
    scale = max(1, left[1:bins].max())
    x = nnls(index, weight, np.append(left[1:bins], 0) / scale * weight) * scale
    for j in np.argsort(-x, kind="stable"):
        need = {k: combos[j].count(k) for k in combos[j]}
        repeats = min(int(x[j] + 0.5), *(int(left[k]) // m for k, m in need.items()))
        if repeats > 0:
            chosen.append((combos[j], repeats))
            for k, m in need.items():
                left[k] -= m * repeats
    return chosen


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], int]:
    """Per bin: upper rank bounds of its slot runs and the sequence id at each run's start. Size: combinations used."""
    runs: dict[int, tuple[list[int], list[int]]] = {}
    base = 0
    for combo, repeats in chosen:
        for k in combo:
            ends, firsts = runs.setdefault(k, ([], []))
            ends.append((ends[-1] if ends else 0) + repeats)
            firsts.append(base)
        base += repeats
    return {k: (np.array(e), np.array(f)) for k, (e, f) in runs.items()}, base


def best_fit(lengths: np.ndarray, window: int) -> np.ndarray:
    """Bin number per piece: longest first, each into the fullest bin that still takes it."""
    room: list[int] = []  # sorted free space of open bins
    owner: list[int] = []
    out, opened = np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect.bisect_left(room, n)
        if at < len(room):
            free, k = room.pop(at), owner.pop(at)
        else:
            free, k = window, opened
            opened += 1
        out[i] = k
        if free > n:
            at = bisect.bisect_left(room, free - n)
            room.insert(at, free - n)
            owner.insert(at, k)
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    bins = window // width
    cut = pieces(docs, doc_id, text, window)
    cut = settled(cut.withColumn("piece", F.monotonically_increasing_id()).withColumn("bin", F.ceil(F.col("length") / width).cast("int")))
    counts = {r["bin"]: r["n"] for r in cut.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `bins` rows
    taken, base = slots(plan(counts, bins, depth))
    total = sum(counts.values())

    bucket = F.pmod(F.xxhash64("piece"), F.lit(max(64, total // RANKED))).alias("bucket")
    cut = cut.withColumn("bucket", bucket)
    sizes = cut.groupBy("bin", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bin", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bin", "bucket").orderBy("piece")
    ranked = cut.withColumn("rank", F.row_number().over(inside) - 1).join(sizes, ["bin", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(batches):
        for batch in batches:
            bin_of, rank = (np.asarray(batch.column(c)) for c in ("bin", "rank"))
            sequence = np.full(len(rank), -1, np.int64)
            for k in np.unique(bin_of):
                if int(k) in taken:
                    ends, firsts = taken[int(k)]
                    mine = np.flatnonzero(bin_of == k)
                    run = np.searchsorted(ends, rank[mine], side="right")
                    ok = run < len(ends)
                    mine, run = mine[ok], run[ok]
                    starts = np.concatenate([[0], ends[:-1]])
                    sequence[mine] = firsts[run] + rank[mine] - starts[run]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), pa.array(sequence)], [*fields, "sequence_id"])

    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"]
    kinds = dict(cut.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in fields)
    placed = settled(ranked.select(*fields, "bin", "rank").mapInArrow(place, schema + ", sequence_id long"))

    over = total - sum(int(e[-1]) for e, _ in taken.values())
    groups = max(1, over // LEFT)
    rest = placed.where("sequence_id < 0").withColumn("left", F.pmod(F.xxhash64("piece", F.lit(7)), F.lit(groups)))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece", ignore_index=True)
        own = best_fit(group["length"].to_numpy(), window)
        # the sequence numbers of different groups differ modulo `groups`
        group["sequence_id"] = base + group["left"].to_numpy() + own * groups
        return group[[*fields, "sequence_id"]]

    fitted = rest.groupBy("left").applyInPandas(fit, schema + ", sequence_id long")
    every = placed.where("sequence_id >= 0").unionByName(fitted)
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("offset"))
