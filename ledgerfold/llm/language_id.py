"""Language identification by a bidirectional gated recurrent network over bytes (operator 9).

Two recurrent passes run over the bytes of the whole document as they stand, letters, digits, punctuation and
blanks alike, one from either end. A softmax over both states labels every byte position; a document's
probabilities are the mean over all its positions. Texts are cut into spans of ``CORE`` bytes, wherever words end; each span
is run with ``EDGE`` bytes before and after it, so that a position next to a cut has the context
it is labelled by from both sides, and every byte of a document is labelled once. Spans of a block of documents go through the network
together, so a long text costs what its bytes cost, and memory is bounded.

Training is backpropagation through time in numpy with Adam, on a bounded sample of labelled documents: at
most ``SAMPLE`` of each language, in the order of a hash of the id, with at most ``PIECES`` evenly spread
pieces of ``PIECE`` bytes each. So at most SAMPLE * PIECES * PIECE bytes a language reach the driver, whatever the texts' lengths.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
ties go to the first language in order; repeated rows are labelled each; without labelled
documents everything is ``und``; extra columns have no effect.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import among_lowest, text_blocks

SAMPLE, PIECES, PIECE, HIDDEN = 300, 12, 64, 8
CORE, EDGE = 112, 8
#: Spans that go through the network together.
TOGETHER = 1024
UNKNOWN = "und"
LETTER = r"\p{L}"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Gru:
    """One direction. ``w`` maps a byte to the inputs of both gates and the candidate, ``u`` the state; all spans of a batch have one length."""

    def __init__(self, w: np.ndarray, u: np.ndarray, b: np.ndarray):
        self.w, self.u, self.b = w, u, b

    def forward(self, x: np.ndarray, keep: bool = False):
        n, steps = x.shape
        size = self.u.shape[0]
        h = np.zeros((n, size), self.w.dtype)
        states, trace = np.empty((steps, n, size), self.w.dtype), []
        for t in range(steps):
            given, own = self.w[x[:, t]], h @ self.u + self.b
            gates = _sigmoid(given[:, : 2 * size] + own[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            c = np.tanh(given[:, 2 * size :] + r * own[:, 2 * size :])
            new = c + z * (h - c)
            if keep:
                trace.append((h, z, r, c, own[:, 2 * size :]))
            h = states[t] = new
        return (states, trace) if keep else states

    def states(self, x: np.ndarray, order) -> np.ndarray:
        """(steps, spans, size) states as ``forward`` gives them, steps visited in ``order``; works in place.

        A sigmoid is half a hyperbolic tangent and a half, so gates' weights are halved beforehand.
        """
        size, kind, n = self.u.shape[0], self.w.dtype, len(x)
        half = kind.type(0.5)
        # gates and candidate side by side in memory each, bytes by step
        wg, ug = (self.w[:, : 2 * size] + self.b[: 2 * size]) * half, np.ascontiguousarray(self.u[:, : 2 * size]) * half
        wc, uc, bc = np.ascontiguousarray(self.w[:, 2 * size :]), np.ascontiguousarray(self.u[:, 2 * size :]), self.b[2 * size :]
        given = np.ascontiguousarray(x.T).astype(np.intp)
        out = np.empty((x.shape[1], n, size), kind)
        h = np.zeros((n, size), kind)
        gates, own, c, z, r = np.empty((n, 2 * size), kind), np.empty((n, 2 * size), kind), np.empty((n, size), kind), np.empty((n, size), kind), np.empty((n, size), kind)
        for t in order:
            wg.take(given[t], axis=0, out=gates, mode="clip")
            gates += np.matmul(h, ug, out=own)
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            z[:], r[:] = gates[:, :size], gates[:, size:]
            np.matmul(h, uc, out=c)
            c += bc
            c *= r
            c += wc.take(given[t], axis=0, out=r, mode="clip")
            np.tanh(c, out=c)
            new = np.subtract(h, c, out=out[t])
            new *= z
            new += c
            h = new
        return out

    def backward(self, x: np.ndarray, trace: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of w, u and b from those of the states, backwards through time."""
        size = self.u.shape[0]
        dw, du, db = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        dh = np.zeros_like(given[0])
        for t in range(len(trace) - 1, -1, -1):
            h, z, r, c, own = trace[t]
            dh = dh + given[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * own * r * (1 - r)
            inputs = np.concatenate([dz, dr, dc], axis=1)
            through = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(dw, x[:, t], inputs)
            du += h.T @ through
            db += through.sum(axis=0)
            dh = dh * z + through @ self.u.T
        return dw, du, db


@dataclass
class Network:
    languages: list[str]
    ahead: Gru
    back: Gru
    v: np.ndarray
    a: np.ndarray

    @staticmethod
    def new(languages: list[str], hidden: int, rng: np.random.Generator, kind=np.float32) -> Network:
        gru = lambda: Gru(
            (rng.normal(0, 0.3, (256, 3 * hidden))).astype(kind), rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(kind), np.zeros(3 * hidden, kind)
        )
        return Network(languages, gru(), gru(), rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(kind), np.zeros(len(languages), kind))

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.u, self.ahead.b, self.back.w, self.back.u, self.back.b, self.v, self.a]

    def _softmax(self, both: np.ndarray) -> np.ndarray:
        logits = both @ self.v + self.a
        e = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """(steps, spans, languages) probabilities of every position."""
        steps = x.shape[1]
        return self._softmax(np.concatenate([self.ahead.states(x, range(steps)), self.back.states(x, range(steps - 1, -1, -1))], axis=2))

    def summed(self, x: np.ndarray, inside: np.ndarray, edge: int) -> np.ndarray:
        """(spans, languages) probabilities summed over the positions ``inside`` (spans, steps), but for ``edge`` at both ends."""
        steps = x.shape[1]
        core = slice(edge, steps - edge)
        ahead, back = self.ahead.states(x, range(steps))[core], self.back.states(x, range(steps - 1, -1, -1))[core]
        size = ahead.shape[2]
        logits = ahead.reshape(-1, size) @ self.v[:size]
        logits += back.reshape(-1, size) @ self.v[size:]
        logits += self.a
        e = np.ascontiguousarray(logits.T)  # languages first: sums over them are then sums of long rows
        e -= e.max(axis=0)
        np.exp(e, out=e)
        e *= inside[:, core].T.ravel() / e.sum(axis=0)
        return e.reshape(len(e), steps - 2 * edge, len(x)).sum(axis=1, dtype=np.float64).T

    def gradients(self, x: np.ndarray, labels: np.ndarray, inside: np.ndarray | None = None) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions of spans of these labels (those ``inside``), and its gradients."""
        ahead, trace_a = self.ahead.forward(x, True)
        back, trace_b = self.back.forward(x[:, ::-1], True)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        p = self._softmax(both)
        steps, n, _ = p.shape
        share = np.full((steps, n), 1 / (steps * n)) if inside is None else inside.T / max(1, inside.sum())
        loss = -(np.log(np.maximum(p[:, np.arange(n), labels], 1e-12)) * share).sum()
        p[:, np.arange(n), labels] -= 1
        p *= share[:, :, None].astype(p.dtype)
        dv = np.einsum("tni,tnk->ik", both, p)
        dboth = p @ self.v.T
        size = ahead.shape[2]
        own = self.ahead.backward(x, trace_a, dboth[:, :, :size])
        other = self.back.backward(x[:, ::-1], trace_b, dboth[::-1, :, size:])
        return float(loss), [*own, *other, dv.astype(self.v.dtype), p.sum(axis=(0, 1))]


def spans(sizes: np.ndarray, core: int = CORE) -> tuple[np.ndarray, np.ndarray]:
    """The spans of texts of these sizes in bytes: each one's text and start."""
    parts = -(-sizes // core)
    owner = np.repeat(np.arange(len(sizes)), parts)
    return owner, (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * core


def text_sums(network: Network, texts: pa.Array, core: int = CORE, edge: int = EDGE) -> tuple[np.ndarray, np.ndarray]:
    """Per text: probabilities summed over its bytes, and the number of bytes."""
    texts = texts.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    sizes = np.diff(bounds)
    owner, start = spans(sizes, core)
    sums = np.zeros((len(texts), len(network.languages)))
    for at in range(0, len(owner), TOGETHER):
        some, first = owner[at : at + TOGETHER], start[at : at + TOGETHER]
        place = first[:, None] + np.arange(-edge, core + edge)
        inside = (place >= 0) & (place < sizes[some][:, None])
        x = data.take(bounds[some][:, None] + place, mode="clip")
        x[~inside] = 32
        np.add.at(sums, some, network.summed(x, inside, edge))
    return sums, sizes


def train(pieces: dict[str, list[bytes]], hidden: int = HIDDEN, steps: int = 500, batch: int = 128, rate: float = 0.02, seed: int = 5) -> Network:
    """Fit on pieces of text of each language, each language alike."""
    rng = np.random.default_rng(seed)
    languages = sorted(pieces)
    network = Network.new(languages, hidden, rng)
    size = max(len(x) for own in pieces.values() for x in own)
    data = []
    for name in languages:
        x = np.full((len(pieces[name]), size), 32, np.uint8)
        inside = np.zeros(x.shape, bool)
        for k, piece in enumerate(sorted(pieces[name])):
            x[k, : len(piece)], inside[k, : len(piece)] = np.frombuffer(piece, np.uint8), True
        data.append((x, inside))
    parameters = network.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        labels = np.arange(batch) % len(languages)
        picks = [rng.integers(0, len(data[k][0]), (labels == k).sum()) for k in range(len(languages))]
        x, inside = (np.concatenate([d[i][pick] for d, pick in zip(data, picks)]) for i in (0, 1))
        _, grads = network.gradients(x, np.sort(labels), inside)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, step / 50) * (1 - 0.95 * step / steps)
        for p, g, m, s in zip(parameters, grads, first, second):
            g = g * min(1.0, 5 / (norm + 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return network


def sample_pieces(docs: DataFrame, learns: Column | None, doc_id: str, text: str, lang: str, sample: int) -> dict[str, list[bytes]]:
    """Pieces of text per language, over the bounded sample."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(learns) if learns is not None else rows
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    # a row per class of the network, which the driver holds whole
    likely = rows.select("id", "lang").join(F.broadcast(sizes), "lang").where(among_lowest(F.col("id"), sample, F.col("total")))
    chosen = likely.select("id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    chosen = chosen.select("id", "lang").distinct()

    def run(batches):
        for block in text_blocks(batches):
            names, out = [], []
            for name, raw in zip(block.column("lang").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                count = min(PIECES, -(-len(raw) // PIECE))
                starts = [k * max(0, len(raw) - PIECE) // max(1, count - 1) for k in range(count)]
                out += [raw[at : at + PIECE] for at in starts]
                names += [name] * count
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.binary())], ["lang", "piece"])

    # sample * languages ids, and as many texts' pieces
    texts = rows.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text")
    found = texts.mapInArrow(run, "lang string, piece binary").toArrow()
    out: dict[str, list[bytes]] = {}
    for name, piece in zip(*(found.column(c).to_pylist() for c in ("lang", "piece"))):
        out.setdefault(name, []).append(piece)
    return out


def learn(docs: DataFrame, learns: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, **how) -> Network | None:
    pieces = sample_pieces(docs, learns, doc_id, text, lang, sample)
    return train(pieces, **how) if pieces else None


def label(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if network is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(network)

    def run(batches):
        network = sent.value
        for block in text_blocks(batches):
            texts = block.column("text")
            sums, sizes = text_sums(network, texts)
            known = np.asarray(pc.match_substring_regex(texts.fill_null(""), LETTER))
            shares = sums / np.maximum(sizes, 1)[:, None]
            best = shares.argmax(axis=1)
            predicted = [network.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            score = np.where(known, shares[np.arange(len(best)), best], 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(predicted, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
