"""Benchmark decontamination by pigeonhole edit matching (operator 5).

A test item with an error budget of k edits is split into k + 1 pieces; a
passage within k edits of it holds at least one piece unchanged. Documents
are searched for all pieces at once: the eight bytes from every position are looked up in a bit
table, survivors in the sorted piece heads, then the whole piece is compared. Each
hit places the item in the document, and Myers' bit-parallel algorithm gives
the least edit distance of the item to any passage there.

Texts are compared as bytes with A-Z lowered and runs of other ASCII
characters than letters and digits made one space. Items and documents begin and end with a space, which counts as a character:
an item that must occur unchanged stands between whole words, and elsewhere a cut word costs an edit. The items of a block (at most ``BLOCK`` bytes)
are sent to every task; a larger benchmark is searched block by block. Documents
are read once a block, whole, and aren't shuffled.

Defined cases: null or empty documents hold nothing; null items, items without an id and items of fewer than ``least_words``
words are not searched (a few common words are no evidence of a leak); repeated items or documents give
one row per (doc_id, item_id), and rows with a null doc_id one per item; ids of any type keep it; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerfold.llm.common import text_blocks

#: Edits allowed, as a share of the item's normalised length.
ERRORS = 0.05
HEAD = 8
#: Fewest words of an item that is searched.
LEAST_WORDS = 5
BLOCK = 16 << 20
_TABLE = np.arange(256, dtype=np.uint8)
for _c in range(128):
    _TABLE[_c] = ord(chr(_c).lower()) if chr(_c).isalnum() else 32


def normalised(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes and which input bytes they come from; runs of spaces end where a text starts."""
    out = _TABLE[raw]
    space = out == 32
    keep = np.ones(len(out), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts] = True
    return out[keep], keep


def normal(text: str) -> bytes:
    """The normalised text between two spaces."""
    return normalised(np.frombuffer(f" {text} ".encode(), np.uint8), np.array([0]))[0].tobytes()


def myers(pattern: bytes, text: bytes, most: int) -> int | None:
    """Least edit distance of ``pattern`` to any substring of ``text``, or None beyond ``most``; one machine-free big integer holds a column."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            best = min(best, score)
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
    return best if best <= most else None


class Pieces:
    """Search structure of one block of items."""

    def __init__(self, items: list[tuple[object, bytes]], errors: float, least_words: int):
        self.items, heads, where = [], [], []
        for name, text in items:
            m = len(text)
            if len(text.split()) < least_words or m < HEAD:
                continue
            budget = max(0, min(int(errors * m), m // HEAD - 1))
            cuts = [m * i // (budget + 1) for i in range(budget + 2)]
            number = len(self.items)
            self.items.append((name, text, budget))
            for a, b in zip(cuts[:-1], cuts[1:]):
                heads.append(int.from_bytes(text[a : a + HEAD], "little"))
                where.append((number, a, b))
        order = np.argsort(np.array(heads, np.uint64), kind="stable")
        self.heads = np.array(heads, np.uint64)[order]
        self.where = [where[i] for i in order]
        self.bits = max(16, min(24, int(np.ceil(np.log2(len(heads) + 1))) + 10))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(self.heads)] = True

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def find(self, texts: pa.Array) -> dict[tuple[int, int], int]:
        """(document, item) -> least distance, for the matches of a block of documents."""
        out: dict[tuple[int, int], int] = {}
        texts = pc.binary_join_element_wise("", texts.fill_null("").cast(pa.string()), "", " ").cast(pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        if data is None or not len(texts):
            return out
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        clean, kept = normalised(raw, offsets[:-1] - offsets[0])
        bounds = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
        n = len(clean) - HEAD + 1
        if n <= 0 or not len(self.heads):
            return out
        whole = clean.tobytes()
        every = np.ndarray((n,), "<u8", whole, strides=(1,))
        spots = [at + np.flatnonzero(self.table[self._slot(every[at : at + (1 << 20)])]) for at in range(0, n, 1 << 20)]
        spot = np.concatenate(spots)
        value = every[spot]
        low, high = np.searchsorted(self.heads, value), np.searchsorted(self.heads, value, "right")
        real = high > low
        for at, a, b in zip(spot[real].tolist(), low[real].tolist(), high[real].tolist()):
            d = -1
            for number, start, end in self.where[a:b]:
                name, text, budget = self.items[number]
                if whole[at : at + end - start] != text[start:end]:
                    continue
                if d < 0:
                    d = int(np.searchsorted(bounds, at, "right")) - 1
                if out.get((d, number)) == 0 or at + end - start > bounds[d + 1]:
                    continue
                here = max(int(bounds[d]), at - start - budget)
                distance = myers(text, whole[here : min(int(bounds[d + 1]), at - start + len(text) + budget)], budget)
                if distance is not None:
                    out[d, number] = min(distance, out.get((d, number), distance))
        return out


_made: dict[str, Pieces] = {}


def _pieces(sent, key: str) -> Pieces:
    """One search structure per worker and block."""
    if key not in _made:
        _made.clear()
        _made[key] = Pieces(*sent.value)
    return _made[key]


def blocks(items: DataFrame, item_id: str, text: str, errors: float, size: int = BLOCK, least_words: int = LEAST_WORDS):
    """Broadcasts of at most about ``size`` bytes of items each, with their keys."""
    rows = items.select(F.col(item_id).alias("id"), F.col(text).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // size))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).distinct().collect()
        found = [(r["id"], normal(r["text"])) for r in part]
        sent = items.sparkSession.sparkContext.broadcast((sorted(found, key=lambda x: (x[1], str(x[0]))), errors, least_words))
        yield sent, f"{items.sparkSession.sparkContext.applicationId}-{sent._jbroadcast.id()}"


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", errors: float = ERRORS, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, item_id, distance`` for every document that holds a passage within an item's budget."""
    kind, item_kind = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    item_type = to_arrow_type(items.schema[item_id].dataType)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for sent, key in blocks(items, item_id, item_text, errors, least_words=least_words):

        def run(batches, sent=sent, key=key):
            for block in text_blocks(batches):
                pieces = _pieces(sent, key)
                found = pieces.find(block.column("text"))
                pairs = sorted(found)
                ids = block.column("doc_id").take(pa.array([d for d, _ in pairs], pa.int64()))
                names = pa.array([pieces.items[i][0] for _, i in pairs], item_type)
                yield pa.RecordBatch.from_arrays([ids, names, pa.array([found[p] for p in pairs], pa.int64())], ["doc_id", "item_id", "distance"])

        part = source.mapInArrow(run, f"doc_id {kind}, item_id {item_kind}, distance long")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", errors: float = ERRORS, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` without any passage of an item, all columns."""
    for sent, key in blocks(items, item_id, item_text, errors, least_words=least_words):

        def run(batches, sent=sent, key=key):
            for block in text_blocks(batches, text):
                hit = np.zeros(block.num_rows, bool)
                hit[[d for d, _ in _pieces(sent, key).find(block.column(text))]] = True
                yield block.filter(pa.array(~hit))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
