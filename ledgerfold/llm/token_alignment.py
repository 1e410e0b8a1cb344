"""Cross-tokenizer alignment by diagonal run skipping (operator 13).

Two tokenizations of the same bytes are two ascending lists of byte ends. Where
both end at the same byte, a group ends. As long as tokens correspond one to one, the lists
agree at a constant index shift (a diagonal): slices of doubling length are compared at
the current shift until one differs, and the agreeing beginning is skipped at
once. At the difference, the group is resolved locally (the list that is
behind moves on until both ends meet), the shift is updated, and probing starts again.

A pair of tokens is linked where their bytes overlap. An id pair's count is the number of
links that hold it in all documents, and each document adds up the counts of its links.

Both tokenizations end at each single space before a word, and no merge of either
vocabulary crosses it. So a text is cut there, a block of documents encodes
and aligns its distinct words only, and documents gather the results. Texts in which
a cut could matter (white space at an edge or more than one in a row) are aligned whole.

Work is spread in two passes. Tasks read blocks of documents and write, for each block, its documents
(their distinct pairs as places in the block's pair list) and that list with its
counts. The lists are added up by pair, map-side first, and the totals go back
to each block's list; so a pair is shuffled once per block, not once per link, and a
hot pair is one row per block. At last each block's documents meet its totals in one bounded
group (the text of a block is at most 8 MB, or one row). The highest count of a B id is
broadcast: one row per id of the vocabulary, 32,000.

Defined cases: texts that are null or empty, or whose joined token bytes of
either tokenizer differ from a space and the text, have no tokens (zeros and no links); strings of
special tokens are plain text; repeated rows are handled each and count each; a null id stays
null; an empty table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm import bpe
from ledgerfold.llm.common import text_blocks, written

VOCABULARY, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Ids of B are below this; a pair is A id * B_IDS + B id.
B_IDS = 1 << 15
#: Distinct words a worker remembers.
KEPT = 200_000
WHOLE = r"\A" + bpe.WHITE + "|" + bpe.WHITE + r"\z|" + bpe.WHITE + "{2}"


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """For ascending byte ends of A and B with the same last end: how many tokens of A, and of B, each group has up to its end."""
    cuts_a, cuts_b = [], []
    i, j, n, m = 0, 0, len(a), len(b)
    while i < n:
        step, at = 1, 0
        while i + at < n and j + at < m:  # probe the diagonal by slices of doubling length
            if a[i + at : i + at + step] == b[j + at : j + at + step]:
                at = min(at + step, n - i, m - j)
                step *= 2
            elif step == 1:
                break
            else:  # the difference lies in this slice: halve it
                step //= 2
                while step and not a[i + at : i + at + step] == b[j + at : j + at + step]:
                    step //= 2
                if not step:
                    break
                at += step
        cuts_a += range(i + 1, i + at + 1)
        cuts_b += range(j + 1, j + at + 1)
        i, j = i + at, j + at
        if i < n:  # an irregular group: the list behind moves on until both meet
            while a[i] != b[j]:
                if a[i] < b[j]:
                    i += 1
                else:
                    j += 1
            i, j = i + 1, j + 1
            cuts_a.append(i)
            cuts_b.append(j)
    return cuts_a, cuts_b


class Aligner:
    """Tokens, groups and links of words and texts; of up to ``KEPT`` words they are remembered."""

    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        import sentencepiece

        self.a = bpe.encoder(vocabulary, ranks, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        if self.b.get_piece_size() > B_IDS:
            raise ValueError(f"the piece vocabulary has more than {B_IDS} ids")
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("a piece spans two words; texts can't be cut at spaces")
        self.b_bytes = [bytes([int(x[1], 16)]) if (x := re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", name)) else name.replace("▁", " ").encode() for name in names]
        self.b_width = np.array([len(x) for x in self.b_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.words, self.units = pa.array([], pa.string()), None

    def units_of(self, words: pa.Array, whole: pa.Array) -> tuple[dict, np.ndarray]:
        """Units of words and whole texts, and the unit of each."""
        if len(self.words) + len(words) > KEPT:
            self.forget()
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        made = self.units_made(new)
        if self.units is not None:
            made = joined(self.units, made)
        at = np.asarray(found.fill_null(-1)).astype(np.int64)
        at[at < 0] = len(self.words) + np.arange(len(new))
        if len(self.words) + len(new) <= KEPT:
            self.words, self.units = pa.concat_arrays([self.words, new]), made
        if len(whole):
            at = np.concatenate([at, len(made["n_a"]) + np.arange(len(whole))])
            made = joined(made, self.units_made(whole))
        return made, at

    def units_made(self, texts: pa.Array) -> dict:
        """Of each text with a space before it: ok, n_a, n_b, n_groups, links (count and flat pairs) and the groups as text."""
        n = len(texts)
        spaced = pc.binary_join_element_wise(pa.scalar(""), texts, " ")
        a_ids, b_ids = list(self.a.ids(spaced)), self.b.encode(texts.to_pylist(), num_threads=1)
        raw = spaced.cast(pa.binary()).to_pylist()
        ok = np.array([b"".join([self.b_bytes[i] for i in ids]) == t and len(t) > 1 for ids, t in zip(b_ids, raw)], bool)
        a_ids = [np.asarray(x, np.int64) if k else _NO_IDS for x, k in zip(a_ids, ok)]
        b_ids = [np.asarray(x, np.int64) if k else _NO_IDS for x, k in zip(b_ids, ok)]
        n_a, n_b = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
        a, b = np.concatenate([_NO_IDS, *a_ids]), np.concatenate([_NO_IDS, *b_ids])
        a_ends, b_ends = np.cumsum(self.a.width[a]), np.cumsum(self.b_width[b])
        if len(a) and a_ends[-1] != b_ends[-1] or sum(len(t) for t, k in zip(raw, ok) if k) != (a_ends[-1] if len(a) else 0):
            raise ValueError("the A tokens' bytes differ from the text")
        cuts = [np.array(c, np.int64) for c in align(a_ends.tolist(), b_ends.tolist())]
        of_a = np.repeat(np.arange(n), n_a)
        in_group = np.bincount(of_a[cuts[0] - 1], minlength=n) if len(a) else np.zeros(n, np.int64)
        sides = [pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, c), pa.int32()), pa.array(x).cast(pa.string())), ",") for c, x in zip(cuts, (a, b))]
        groups = pc.binary_join_element_wise(*sides, "|")
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(in_group)), pa.int32()), groups), ";")
        # each stretch between neighbouring ends of either list is the overlap of one link
        ends = np.union1d(a_ends, b_ends)
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        links = np.bincount(of_a[at_a], minlength=n) if len(a) else np.zeros(n, np.int64)
        return {"ok": ok, "n_a": n_a, "n_b": n_b, "n_groups": in_group, "n_links": links, "pairs": a[at_a] * B_IDS + b[at_b], "groups": groups}


_NO_IDS = np.zeros(0, np.int64)


def joined(x: dict, y: dict) -> dict:
    return {k: pa.concat_arrays([x[k], y[k]]) if k == "groups" else np.concatenate([x[k], y[k]]) for k in x}


@functools.cache
def aligner(vocabulary: str, ranks: str, pieces: str) -> Aligner:
    """One aligner per Python worker."""
    return Aligner(vocabulary, ranks, pieces)


def _gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the ranges ``starts``, ``counts`` one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def aligned_block(own: Aligner, texts: pa.Array) -> tuple[dict, np.ndarray, np.ndarray]:
    """Per document: numbers, digest and its distinct pairs; the block's distinct pairs and their counts."""
    texts = texts.cast(pa.string())
    given = np.asarray(pc.greater(pc.binary_length(texts).fill_null(0), 0))
    texts = texts.fill_null("")
    whole = np.asarray(pc.match_substring_regex(texts, WHOLE)) & given
    pieces = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
    bounds = np.asarray(pieces.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    coded = pieces.flatten().dictionary_encode()
    units, at = own.units_of(coded.dictionary, texts.filter(pa.array(whole)))
    index = np.asarray(coded.indices).astype(np.int64)
    index[bounds[:-1][whole]] = len(coded.dictionary) + np.arange(int(whole.sum()))
    index = at[index]
    ok = given & np.logical_and.reduceat(units["ok"][index], bounds[:-1])
    numbers = {k: np.where(ok, np.add.reduceat(units[k][index], bounds[:-1]), 0) for k in ("n_a", "n_b", "n_groups", "n_links")}
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), units["groups"].take(pa.array(index))), ";")
    digest = [hashlib.sha256(g).hexdigest() if k else "" for g, k in zip(groups.cast(pa.binary()).to_pylist(), ok.tolist())]
    # distinct pairs of each document, as places in the block's list
    used = np.unique(index)
    ends = np.cumsum(units["n_links"])
    spans = units["n_links"][used]
    pairs, place = np.unique(units["pairs"][_gathered(ends[used] - spans, spans)], return_inverse=True)
    first = np.cumsum(spans) - spans
    slot = np.searchsorted(used, index)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    kept = ok[owner]
    slot, owner = slot[kept], owner[kept]
    keys, times = np.unique(np.repeat(owner, spans[slot]) * max(1, len(pairs)) + place[_gathered(first[slot], spans[slot])], return_counts=True)
    codes = keys % max(1, len(pairs))
    totals = np.bincount(codes, weights=times, minlength=len(pairs)).astype(np.int64)
    cuts = np.searchsorted(keys // max(1, len(pairs)), np.arange(len(texts) + 1))
    return numbers | {"groups_sha256": digest, "cuts": cuts, "codes": codes, "times": times}, pairs, totals


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def align_blocks(docs: DataFrame, doc_id: str, text: str, files: tuple[str, str, str]) -> DataFrame:
    """A row for each document of a block, and one with the block's pairs and counts (where ``pairs`` isn't null)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_id {kind}, {', '.join(f'{c} long' for c in _NUMBERS)}, groups_sha256 string, codes array<int>, times array<int>, pairs array<long>, totals array<long>"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        # both kinds of rows come from one attempt of a task, whose number no other attempt has
        block = TaskContext.get().taskAttemptId() << 24
        for batch in text_blocks(batches):
            found, pairs, totals = aligned_block(aligner(*files), batch.column("text"))
            n = batch.num_rows
            lists = [pa.ListArray.from_arrays(pa.array(found["cuts"], pa.int32()), pa.array(found[c], pa.int32())) for c in ("codes", "times")]
            columns = [pa.array(np.full(n, block)), batch.column("doc_id"), *[pa.array(found[c], pa.int64()) for c in _NUMBERS], pa.array(found["groups_sha256"], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *lists, *[pa.nulls(n, pa.list_(pa.int64()))] * 2], names)
            one = [pa.array([block]), pa.nulls(1, batch.schema.field("doc_id").type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.nulls(1, pa.list_(pa.int32()))] * 2]
            yield pa.RecordBatch.from_arrays([*one, pa.array([pairs], pa.list_(pa.int64())), pa.array([totals], pa.list_(pa.int64()))], names)
            block += 1

    return rows.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n, best`` over all blocks: links that hold the pair, and whether no other pair of its B id has more."""
    listed = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "totals")).alias("x")).select("x.pairs", "x.totals")
    counts = written(listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("totals").alias("n")).where("n > 0"))
    highest = counts.groupBy((F.col("pair") % B_IDS).alias("b")).agg(F.max("n").alias("highest"))
    # at most one row per id of the B vocabulary
    joined_ = counts.join(F.broadcast(highest), F.col("pair") % B_IDS == F.col("b"))
    return joined_.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def token_alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. The files must be at the same path on every executor."""
    files = (vocabulary or bpe.vocabulary_path(VOCABULARY), ranks or bpe.vocabulary_path(RANKS), pieces or bpe.vocabulary_path(PIECES))
    blocks = written(align_blocks(docs, doc_id, text, files))
    listed = blocks.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("code", "pair"))
    values = listed.join(pair_counts(blocks), "pair").select(F.col("block").alias("of_block"), "code", "n", "best")
    known = blocks.where("pairs IS NULL").select("block", "doc_id", *_NUMBERS, "groups_sha256", "codes", "times")
    kind = known.schema["doc_id"].dataType.simpleString()

    def add_up(found: pa.Table, values: pa.Table) -> pa.Table:
        found, values = found.combine_chunks(), values.combine_chunks()
        size = int(pc.max(values["code"]).as_py() or 0) + 1 if len(values) else 1
        n, best = np.zeros(size, np.int64), np.zeros(size, bool)
        at = np.asarray(values["code"])
        n[at], best[at] = np.asarray(values["n"]), np.asarray(values["best"])
        lists = found["codes"].combine_chunks()
        codes, times = np.asarray(lists.flatten()), np.asarray(found["times"].combine_chunks().flatten()).astype(np.int64)
        owner = np.repeat(np.arange(len(found)), np.asarray(pc.list_value_length(lists)))
        sums, bests = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        np.add.at(sums, owner, times * n[codes])
        np.add.at(bests, owner, times * best[codes])
        numbers = [found[c] for c in _NUMBERS]
        return pa.table([found["doc_id"], *numbers, pa.array(bests), pa.array(sums), found["groups_sha256"]], ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in _NUMBERS)}, n_best long, count_sum long, groups_sha256 string"
    return known.groupBy("block").cogroup(values.groupBy("of_block")).applyInArrow(add_up, schema)
