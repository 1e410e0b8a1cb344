"""Byte-level BPE ids of whole texts, a block of documents at a time.

A pre-token of the byte-level pattern never spans a single space followed by a
non-space, other than as that space's own word. So a text is cut at its spaces,
each distinct piece of a block is encoded once, and ids are gathered per document.
Texts in which such cuts could change a white-space run (three white-space
characters in a row, or two at the end) are encoded whole. Distinct pieces of
Latin script go through ``tiktoken`` with the same vocabulary, all others
through ``tokenizers``; tests hold both against ``tokenizers`` on whole texts. Texts that hold
a special token's string are encoded whole by ``tokenizers``, which makes it that token's id (``plain``: ordinary text).
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}]"
WHOLE = WHITE + "{3}|" + WHITE + r"{2}\z"
EDGE = r"\A" + WHITE + "|" + WHITE + r"\z|\A\z"
#: Distinct words whose ids a worker remembers, about 40 MB.
KEPT = 600_000
BEYOND_LATIN = r"[^\x{0}-\x{17f}]"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class BlockEncoder:
    def __init__(self, vocabulary: str, ranks: str, pattern: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.exact.encode_special_tokens = plain
        special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.special = None if plain or not special else "|".join(re.escape(t) for t in special)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.width = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.width[rank] = len(token)
        self.words, self.flat, self.spans = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros((2, 0), np.int64)

    def _fast(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())

    def _special(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold a special token's string that counts as such."""
        return np.asarray(pc.match_substring_regex(texts, self.special)) if self.special else np.zeros(len(texts), bool)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text by itself."""
        given = pa.array(texts, pa.large_string())
        beyond = np.asarray(pc.match_substring_regex(given, BEYOND_LATIN)) | self._special(given)
        out: list = [None if far else self._fast(t) for t, far in zip(texts, beyond)]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.exact.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``_words`` with the ids of up to ``KEPT`` words remembered for the next blocks."""
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        flat, spans = self._words(new)
        spans = np.concatenate([self.spans, spans + np.array([[len(self.flat)], [0]])], axis=1)
        flat = np.concatenate([self.flat, flat])
        at = np.asarray(found.fill_null(-1)).astype(np.int64)
        at[at < 0] = len(self.words) + np.arange(len(new))
        if len(self.words) + len(new) <= KEPT:
            self.words, self.flat, self.spans = pa.concat_arrays([self.words, new]), flat, spans
        return flat, spans[:, at]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct piece with a space before it: flat ids and their n + 1 bounds."""
        n = len(words)
        alone = np.asarray(pc.match_substring_regex(words, EDGE)) | np.asarray(pc.match_substring_regex(words, BEYOND_LATIN))
        counts, parts, owner = np.zeros(n, np.int64), [], []
        plain = np.flatnonzero(~alone)
        if len(plain):
            kept = words.take(pa.array(plain))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept.cast(pa.string())), " ")[0].as_py()
            ids = self._fast(" " + joined)
            ends = np.cumsum(self.width[ids])
            bounds = np.cumsum(np.asarray(pc.binary_length(kept)).astype(np.int64) + 1)
            at = np.searchsorted(ends, bounds)
            if not np.array_equal(ends[at], bounds):
                raise ValueError("a token spans two words; this pattern can't be cut at spaces")
            counts[plain] = np.diff(at + 1, prepend=0)
            parts.append(ids)
            owner.append(plain)
        rest = np.flatnonzero(alone)
        if len(rest):
            own = self._each([" " + w for w in words.take(pa.array(rest)).to_pylist()])
            counts[rest] = [len(x) for x in own]
            parts += own
            owner.append(rest)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        order = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        starts = np.zeros(n, np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return flat, np.stack([starts, counts])

    def prepare(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of the distinct pieces, (start, count) of each, pieces in text order, and each text's bounds in them."""
        texts = texts.fill_null("").cast(pa.large_string())
        whole = pc.or_(pc.match_substring_regex(texts, WHOLE), pa.array(self._special(texts)))
        pieces = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        bounds = np.asarray(pieces.offsets).astype(np.int64)
        bounds = bounds - bounds[0]
        coded = pieces.flatten().dictionary_encode()
        index = np.asarray(coded.indices).astype(np.int64)
        words = coded.dictionary
        flat, spans = self._known(words)
        first = bounds[:-1]  # the first piece of each text has no space before it; whole texts take that place
        heads, back = np.unique(index[first], return_inverse=True)
        own = self._each(words.take(pa.array(heads)).to_pylist())
        full = np.flatnonzero(np.asarray(whole))
        own += self._each(texts.take(pa.array(full)).to_pylist()) if len(full) else []
        back[full] = len(heads) + np.arange(len(full))
        index[first] = len(words) + back
        counts = np.array([len(x) for x in own], np.int64)
        starts = len(flat) + np.cumsum(counts) - counts
        return np.concatenate([flat, *own]), np.concatenate([spans, np.stack([starts, counts])], axis=1), index, bounds

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.int64)
        _, spans, index, bounds = self.prepare(texts)
        return np.add.reduceat(spans[1][index], bounds[:-1])

    def ids(self, texts: pa.Array, most: int = 1 << 20):
        """The ids of each text in turn; at most about ``most`` pieces are gathered at once."""
        if not len(texts):
            return
        flat, spans, index, bounds = self.prepare(texts)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
            part = index[bounds[at] : bounds[to]]
            start, count = spans[0][part], spans[1][part]
            ends = np.cumsum(count)
            gathered = flat[np.arange(ends[-1]) + np.repeat(start - (ends - count), count)]
            cuts = np.concatenate([[0], ends[bounds[at + 1 : to + 1] - bounds[at] - 1]])
            for k in range(to - at):
                yield gathered[cuts[k] : cuts[k + 1]]
            at = to


@functools.cache
def encoder(vocabulary: str, ranks: str, plain: bool = False) -> BlockEncoder:
    """One encoder per Python worker."""
    import public_tokenizers

    return BlockEncoder(vocabulary, ranks, public_tokenizers.PATTERN, plain)
