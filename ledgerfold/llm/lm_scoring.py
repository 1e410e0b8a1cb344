"""Stupid-backoff scores of documents over n-gram counts of the whole corpus (operator 1).

    S(w | c) = count(c w) / count(c)   if count(c w) >= MIN_COUNT
             = ALPHA * S(w | c without its first word)   otherwise
    S(w)     = count(w) / words

A document's score is the sum of log S over its words, each with up to
ORDER - 1 words before it in the document.

The count tables are partitioned by ranges of the n-gram hash. A block of
documents explodes into its distinct n-grams with counts, packed per range;
each range adds up the counts of all blocks and answers every block for the
n-grams it sent (0 for one without evidence, whose count no score uses); a block's answers meet its words again and are summed per
document. So an n-gram that every text holds is one entry per block, and the rows that
are shuffled are packed arrays: sorted hashes as compressed differences.
n-grams are told apart by 64-bit hashes; nothing compares the words behind them. Among ten billion
different n-grams (about 30 GB of text) one meets another with a chance of 5e-10.

The number of ranges grows with the corpus, one per ``SHARE`` bytes. A block sends one message to each
range, so blocks of BLOCK bytes suit corpora of up to some terabytes; beyond, larger
blocks keep messages from getting short.

Defined cases: null or empty text and text without words have no words and score 0; every
row is scored by itself, and repeated rows count as often as they occur;
extra columns and nulls elsewhere have no effect. The input is read twice and must come in the same order,
as a table scan does; blocks carry a digest, and a mix of two orders is an error, not a wrong score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import settled, text_blocks
from ledgerfold.llm.words import ngram_hashes, word_hashes

ORDER, ALPHA, MIN_COUNT = 3, 0.4, 2
#: Text bytes of a block (the larger, the fewer n-grams are sent again by another block) and of a range.
BLOCK, SHARE = 14 << 20, 8 << 20
SCHEMA = "block string, part long, n int, payload binary"
HOME = -1


def _planes(x: np.ndarray) -> bytes:
    """Bytes of the numbers by place, so that high ones compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T).view(kind).ravel()


def pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending hashes and their counts."""
    n = len(hashes)
    raw = _planes(np.diff(hashes, prepend=np.uint64(0))) + _planes(counts.astype(np.uint32))
    return n.to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[4:], max_output_size=12 * n + 1)
    return np.cumsum(_unplanes(raw, n, np.uint64), dtype=np.uint64), _unplanes(raw[8 * n :], n, np.uint32).astype(np.int64)


def pack_counts(counts: np.ndarray) -> bytes:
    return len(counts).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(_planes(counts.astype(np.uint64)))


def unpack_counts(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    return _unplanes(zstandard.ZstdDecompressor().decompress(blob[4:], max_output_size=8 * n + 1), n, np.uint64).astype(np.int64)


def grams(words: np.ndarray, bounds: np.ndarray, order: int):
    """For each n in turn: the positions (of the last word) that have n words within their text, and the n-gram hashes there."""
    nth = (np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))).clip(max=order).astype(np.int8)
    for n in range(1, order + 1):
        at = np.flatnonzero(nth >= n - 1)
        yield at, (ngram_hashes(words, n)[at - (n - 1)] if len(at) else np.zeros(0, np.uint64))


def document_scores(words: np.ndarray, bounds: np.ndarray, found: list[np.ndarray], counts: list[np.ndarray], alpha: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sum of log S but for the corpus size, and how many words were scored by their own count.

    ``found`` and ``counts``: for each n, the positions that have n words, and the counts there.
    """
    table = np.zeros((len(found) + 1, len(words)), np.int64)
    for n, (where, c) in enumerate(zip(found, counts), 1):
        table[n, where] = c
    score = np.log(np.maximum(table[1], 1).astype(np.float64))
    single = np.ones(len(words), bool)
    penalty = math.log(alpha)
    for n in range(2, len(found) + 1):
        where = found[n - 1]
        hit = where[table[n, where] >= least]
        missed = where[table[n, where] < least]
        score[missed] += penalty
        score[hit] = np.log(table[n, hit]) - np.log(table[n - 1, hit - 1])
        single[hit] = False
    texts = np.diff(bounds)
    total, alone = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    some = np.flatnonzero(texts)
    if len(some):
        total[some] = np.add.reduceat(score, bounds[:-1][some])
        alone[some] = np.add.reduceat(single.astype(np.int64), bounds[:-1][some])
    return total, alone


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT) -> DataFrame:
    """``doc_id, n_words, log_score`` of every row (natural logarithm)."""
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wide = max(3, math.ceil(math.log2(max(2, size / SHARE))))
    ranges = 1 << wide
    fields = ["block", "part", "n", "payload"]

    def numbered(batches):
        """(name, block, word hashes, bounds) of each block; the name is a digest of its words, so equal blocks share their answers."""
        for block in text_blocks(batches, size=BLOCK):
            words, bounds = word_hashes(block.column("text"))
            yield xxhash.xxh3_128_hexdigest(words.tobytes() + bounds.tobytes()), block, words, bounds

    def explode(batches):
        """The distinct n-grams of each block with their counts, packed for every range."""
        for name, _, words, bounds in numbered(batches):
            for n, (_, hashes) in enumerate(grams(words, bounds, order), 1):
                own, times = np.unique(hashes, return_counts=True)
                cuts = np.searchsorted(own, np.arange(1, ranges, dtype=np.uint64) << np.uint64(64 - wide))
                cuts = np.concatenate([[0], cuts, [len(own)]])
                rows = [(name, p, n, pack(own[a:b], times[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                for at in range(0, len(rows), 256):
                    yield _batch(rows[at : at + 256])

    def homes(batches):
        """The words of each block, for its scores."""
        for name, block, words, bounds in numbered(batches):
            known, index, times = np.unique(words, return_inverse=True, return_counts=True)
            # frequent words get small numbers; words of about the same frequency stand in ascending order, as differences
            order_of = np.lexsort((known, -np.log2(np.maximum(times, 1)).astype(np.int64)))
            number = np.empty(len(known), np.int64)
            number[order_of] = np.arange(len(known))
            home = pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(np.diff(bounds))], ["doc_id", "words"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, home.schema) as writer:
                writer.write_batch(home)
            raw = _planes(np.diff(known[order_of], prepend=np.uint64(0))) + _planes(number[index].astype(np.uint32))
            head = np.array([len(known), len(words)], np.int64).tobytes() + sink.getvalue().to_pybytes()
            body = zstandard.ZstdCompressor(level=1).compress(raw)
            yield _batch([(name, -1, HOME, len(body).to_bytes(8, "little") + body + head)])

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], fields)

    def count(group: pa.Table) -> pa.Table:
        """One range: the sum over all blocks for each n-gram, as an answer to every block."""
        n = np.asarray(group.column("n").combine_chunks())
        payload = group.column("payload")
        out = [None] * len(n)
        for k in np.unique(n):
            mine = np.flatnonzero(n == k)
            sent = [unpack(payload[i].as_py()) for i in mine]
            hashes = np.concatenate([h for h, _ in sent])
            times = np.concatenate([c for _, c in sent])
            _, where = np.unique(hashes, return_inverse=True)
            total = np.bincount(where, times).astype(np.int64)[where]
            if k > 1:
                total[total < min_count] = 0
            ends = np.cumsum([len(h) for h, _ in sent])
            for i, a, b in zip(mine, np.append(0, ends[:-1]), ends):
                out[i] = pack_counts(total[a:b])
        return pa.Table.from_arrays([group.column("block"), group.column("part"), group.column("n"), pa.array(out, pa.binary())], fields)

    def gather(group: pa.Table) -> pa.Table:
        """The blocks of one name, mostly one: their words with the answers of all ranges, summed per document."""
        n, part, payload = group.column("n").to_pylist(), group.column("part").to_pylist(), group.column("payload")
        homes = [i for i, k in enumerate(n) if k == HOME]
        if not homes:
            raise ValueError("a block was read twice in different orders; checkpoint the input first")
        blob = payload[homes[0]].as_py()
        long = int.from_bytes(blob[:8], "little")
        known, total = np.frombuffer(blob, np.int64, 2, 8 + long).tolist()
        raw = zstandard.ZstdDecompressor().decompress(blob[8 : 8 + long], max_output_size=8 * known + 4 * total + 1)
        words = np.cumsum(_unplanes(raw, known, np.uint64), dtype=np.uint64)[_unplanes(raw[8 * known :], total, np.uint32)]
        home = pa.ipc.open_stream(pa.py_buffer(blob[8 + long + 16 :])).read_all()
        per_text = np.asarray(home.column("words").combine_chunks())
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        answers: dict[tuple[int, int], np.ndarray] = {(k, p): unpack_counts(payload[i].as_py()) for i, (k, p) in enumerate(zip(n, part)) if k != HOME}
        found, counts = [], []
        for k, (at, hashes) in enumerate(grams(words, bounds, order), 1):
            found.append(at)
            own, where = np.unique(hashes, return_inverse=True)
            every = [answers[k, p] for p in sorted(p for j, p in answers if j == k)]
            every = np.concatenate(every) if every else np.zeros(0, np.int64)
            if len(every) != len(own):
                raise ValueError("answers are missing: a block was read twice in different orders; checkpoint the input first")
            counts.append(every[where])
        sums, alone = document_scores(words, bounds, found, counts, alpha, min_count)
        out = []
        for i in homes:
            blob = payload[i].as_py()
            home = pa.ipc.open_stream(pa.py_buffer(blob[8 + int.from_bytes(blob[:8], "little") + 16 :])).read_all()
            out.append(pa.Table.from_arrays([home.column("doc_id").combine_chunks(), pa.array(per_text, pa.int64()), pa.array(sums), pa.array(alone)], ["doc_id", "n_words", "sum", "alone"]))
        return pa.concat_tables(out)

    # words and n-grams go separate ways, so that the words are shuffled only once; both passes see the same blocks
    answered = source.mapInArrow(explode, SCHEMA).groupBy("part").applyInArrow(count, SCHEMA)
    scored = settled(answered.unionByName(source.mapInArrow(homes, SCHEMA)).groupBy("block").applyInArrow(gather, f"doc_id {kind}, n_words long, sum double, alone long"))
    words = scored.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    return scored.select("doc_id", "n_words", (F.col("sum") - F.col("alone") * F.lit(math.log(max(1, words)))).alias("log_score"))
