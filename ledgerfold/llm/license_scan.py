"""License scans: Aho-Corasick for tags and notices, shunting-yard for expressions (operator 11).

A block of documents becomes one stream of lower-cased words with one space
between them, and one automaton pass over it finds every place of every phrase: the base
phrases, further notices and the identifier tags. Places that would span two
documents are left out. Behind a tag and its ``:`` or ``=`` stands a licence expression, which is
read from the document's own text and evaluated with an operator stack
(``with`` binds before ``and``, ``and`` before ``or``), without recursion.

Freedom: 1 for permissive terms, 0.6 for weak and 0.3 for strong copyleft, 0.1 for
terms that restrict use, 0.2 for identifiers not known here. ``or`` lets the
reader choose, so the freer side counts; under ``and`` the stricter one does;
an exception (``with``) makes copyleft weak. A document is as free as its strictest finding.

Expression: the longest beginning of what follows the tag that the grammar
reads, on the same line. Where it ends inside parentheses or after an operator,
its identifiers count as joined by ``and``. After the tag ``license`` alone, an
expression counts only if it names a known identifier, so that prose doesn't.

The work is a pass in bounded blocks inside tasks, without a shuffle; the automaton is small and built once a worker.

Defined cases: a null or empty text has no words and no findings; words are
runs of characters other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F after A-Z are lowered; overlapping
phrases count each; repeated rows are handled each and a null id stays null; an
empty table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import text_blocks

# --- fixed values: base phrases and their labels ------------------------------
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# --- fixed values: further notices, identifier tags, families of identifiers ---
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx license identifier", "license expression", "license")
FAMILIES = ("cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by", "cc0", "agpl", "lgpl", "gpl", "apache", "mit", "bsd", "isc", "mpl", "epl", "unlicense", "zlib", "bsl", "proprietary")
FREEDOM = {
    1.0: ("mit", "apache", "bsd", "isc", "cc0", "cc-by", "public-domain", "unlicense", "zlib", "bsl"),
    0.6: ("lgpl", "mpl", "epl", "cc"),
    0.3: ("gpl", "agpl", "cc-by-sa"),
    0.1: ("proprietary", "cc-by-nc", "cc-by-nd"),
}
# -------------------------------------------------------------------------------
UNKNOWN, WEAK, STRONG = 0.2, 0.6, 0.3
FREE = {label: value for value, labels in FREEDOM.items() for label in labels}
BINDING = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
ASSIGNED = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
FINDINGS = "array<struct<label: string, kind: string, word: bigint, n_words: bigint, expression: string, freedom: double>>"


def family(identifier: str) -> str:
    """The family a licence identifier belongs to; ``other`` if it isn't known."""
    name = identifier.lower()
    return next((f for f in FAMILIES if re.match(re.escape(f) + r"(?![a-z])", name)), "other")


def evaluate(text: bytes) -> tuple[str, list[str], float] | None:
    """(expression, families, freedom) of the licence expression that ``text`` begins with; None if there is none."""
    out: list[tuple[float, bool]] = []  # values; whether a value is one identifier
    waiting: list[str] = []
    names, values, at, end, operand, opened, whole = [], [], 0, 0, True, 0, (0, 0)

    def apply() -> None:
        kind = waiting.pop()
        b, a = out.pop(), out.pop()
        if kind == "with":
            out.append((WEAK if a[0] == STRONG else a[0], False))
        else:
            out.append((max(a[0], b[0]) if kind == "or" else min(a[0], b[0]), False))

    while m := TOKEN.match(text, at):
        word = m[1].decode("ascii").rstrip(".:-")
        kind = word.lower()
        if operand:
            if word == "(":
                waiting.append("(")
                opened += 1
            elif word == ")" or kind in BINDING:
                break
            else:
                if not waiting or waiting[-1] != "with":  # an exception's name is no licence
                    names.append(family(word))
                    values.append(FREE.get(names[-1], UNKNOWN))
                    out.append((values[-1], True))
                else:
                    out.append((0.0, True))
                operand = False
        elif word == ")" and opened:
            while waiting[-1] != "(":
                apply()
            waiting.pop()
            opened -= 1
        elif kind in BINDING:
            if kind == "with" and not out[-1][1]:
                break
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[kind]:
                apply()
            waiting.append(kind)
            operand = True
        else:
            break
        at = end = m.start(1) + len(word)
        if not operand and not opened:
            whole = (end, len(names))
        if m.end() != at:  # a sentence ends here
            break
    if not names:
        return None
    if operand or opened:
        return text[:end].decode().strip(), names, min(values)
    while waiting:
        apply()
    return text[: whole[0]].decode().strip(), names, out[0][0]


@functools.cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, *TAGS}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def scan_block(texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """Number of words and the findings of each text, by place."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    word = _WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = False
    starts = np.flatnonzero(word & ~before)
    firsts = np.searchsorted(starts, bounds)
    findings: list[list[dict]] = [[] for _ in range(len(texts))]
    if not len(starts):
        return np.diff(firsts), findings
    at = np.flatnonzero(word)
    place = np.arange(len(at)) + np.searchsorted(starts, at, side="right")  # a space before each word
    stream = np.full(len(at) + len(starts) + 1, 32, np.uint8)
    stream[place] = _LOWER[data[at]]
    blanks = np.flatnonzero(stream == 32)
    raw = data.tobytes()
    hits = [(end, phrase) for end, phrase in automaton().iter(stream.tobytes().decode("latin-1"))]
    lengths = np.array([len(p) + 2 for _, p in hits], np.int64)
    words = np.searchsorted(blanks, np.array([e for e, _ in hits], np.int64) + 1 - lengths)
    counts = np.array([p.count(" ") + 1 for _, p in hits], np.int64)
    owners = np.searchsorted(firsts, words, side="right") - 1
    inside = words + counts <= firsts[owners + 1]
    for i in np.lexsort((counts, words)).tolist():
        if not inside[i]:
            continue
        phrase, w, n, doc = hits[i][1], int(words[i]), int(counts[i]), int(owners[i])
        found = {"word": w - int(firsts[doc]), "n_words": n, "expression": None}
        if phrase in BASE or phrase in NOTICES:
            label = BASE.get(phrase) or NOTICES[phrase]
            findings[doc].append({"label": label, "kind": "base" if phrase in BASE else "notice", **found, "freedom": FREE[label]})
            continue
        after = int(starts[w + n - 1]) + len(phrase.rsplit(" ", 1)[-1])
        sign = ASSIGNED.match(raw, after, int(bounds[doc + 1]))
        if not sign:
            continue
        line = raw.find(b"\n", sign.end(), int(bounds[doc + 1]))
        read = evaluate(raw[sign.end() : line if line >= 0 else int(bounds[doc + 1])])
        if read is None or (phrase == "license" and set(read[1]) == {"other"}):
            continue
        for label in dict.fromkeys(read[1]):
            findings[doc].append({"label": label, "kind": "expression", **found, "expression": read[0], "freedom": read[2]})
    return np.diff(firsts), findings


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()), ("expression", pa.string()), ("freedom", pa.float64())]))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, findings``: label, kind (base, notice, expression), first word, words of the phrase, expression and freedom."""

    def run(batches):
        for block in text_blocks(batches):
            n, findings = scan_block(block.column("text"))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n, pa.int64()), pa.array(findings, _FOUND)], ["doc_id", "n_words", "findings"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, findings {FINDINGS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, places, labels and score of ``license_scan``; the score is the least freedom found, 0 without findings."""
    base = F.filter("findings", lambda x: x["kind"] == "base")

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda x: x["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("findings")).alias("labels"),
        F.coalesce(F.array_min(F.transform("findings", lambda x: x["freedom"])), F.lit(0.0)).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform("findings", lambda x: x["expression"]), lambda x: x.isNotNull()))), "\n").alias("expressions"),
    )
