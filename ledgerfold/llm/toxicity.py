"""Toxicity by a counterfactually regularised linear classifier (operator 3).

A document is the set of features of its words: the whole word and its first
three to seven letters, all hashed. A sparse logistic model is
fitted on a bounded sample of labelled rows. Identity terms in the labelled
sentences are swapped for other terms of the same kind, and the squared change of the score is
penalised, so that the mention of a group by itself moves no score. Sentences
with labels but without such terms get a term of each kind appended on one side and another on the other side of a pair,
which ties the weights of all terms of a kind to each other, whatever the sample holds.

The sample is bounded in bytes too: of a labelled row with more than ``MOST_FEATURES`` features, those of the
least hash are learnt from, the same ones in every row. Scoring reads whole texts in one pass without a shuffle. The model (a few
thousand non-zero weights) is the only thing that is sent out.

Defined cases: null and empty texts, and texts without letters, get the model's score for no
features; repeated rows are scored each, also those with a null id, which are never learnt from; conflicting labels of an id count as
toxic; labels that are null, or of ids without text, are not used; without usable
labels of both values every score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import among_lowest, text_blocks
from ledgerfold.llm.words import letter_words, mix

# Identity terms, by kind. Terms of a kind are swapped for each other.
IDENTITY = {
    "gender": "woman man women men girl boy female male transgender frau mann frauen femme homme femmes mujer hombre mujeres",
    "faith": "christian muslim jew jewish hindu buddhist atheist sikh christ moslem jude chrétien musulman juif cristiano musulmán judío",
    "origin": "immigrant refugee foreigner native african asian american european mexican arab german french spanish turkish deutscher français español",
    "colour": "black white brown latino latina hispanic schwarz weiß noir blanc negro blanco",
    "orientation": "gay lesbian bisexual straight heterosexual homosexual queer schwul lesbisch gai lesbienne",
    "ability": "disabled blind deaf autistic elderly young behindert aveugle sourd ciego sordo",
}
TERMS = {t: kind for kind, terms in IDENTITY.items() for t in terms.split()}
#: Lengths of the beginnings of a word that are features: stems of word families.
BEGINNINGS = (3, 4, 5, 6, 7)
DIMENSIONS = 1 << 21
#: Bound of the training sample: rows of either label, taken in the order of a hash of the id.
SAMPLE = 3000
#: Bound of the features that a row of the sample brings to the driver: 2 * SAMPLE * MOST_FEATURES * 4 bytes, about 200 MB, at most.
MOST_FEATURES = 8192


def _features(words: pa.Array) -> np.ndarray:
    """Hashed features of each word: the whole word and its beginnings of 3 to 7 letters."""
    parts = [words, *(pc.utf8_slice_codeunits(words, 0, n) for n in BEGINNINGS)]
    out = np.empty((len(words), len(parts)), np.int64)
    for j, part in enumerate(parts):
        coded = part.dictionary_encode()
        own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed=j) % DIMENSIONS for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.int64, len(coded.dictionary))
        out[:, j] = own[np.asarray(coded.indices)] if len(words) else 0
    return out


def featured(docs: DataFrame) -> DataFrame:
    """``label, mentions, features`` per row of ``label, text``: its identity terms, and its distinct features as packed int32."""

    def run(batches):
        for block in text_blocks(batches):
            words, index, bounds = letter_words(block.column("text"))
            features = _features(words).astype(np.int32)
            empty = np.asarray(pc.binary_length(words)) == 0
            blobs, mentions = [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = np.unique(index[a:b])
                own = own[~empty[own]]
                few = np.unique(features[own])
                if len(few) > MOST_FEATURES:
                    few = np.sort(few[np.argpartition(mix(few.astype(np.uint64)), MOST_FEATURES)[:MOST_FEATURES]])
                blobs.append(few.astype("<i4").tobytes())
                mentions.append(" ".join(w for w in words.take(pa.array(own)).to_pylist() if w in TERMS))
            yield pa.RecordBatch.from_arrays([block.column("label"), pa.array(mentions), pa.array(blobs, pa.binary())], ["label", "mentions", "features"])

    return docs.select("label", "text").mapInArrow(run, "label int, mentions string, features binary")


@dataclass
class Model:
    bias: float
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # ascending
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def weights(self, features: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.zeros(features.shape)
        at = np.minimum(np.searchsorted(self.feature, features), len(self.feature) - 1)
        return np.where(self.feature[at] == features, self.weight[at], 0.0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        words, index, bounds = letter_words(texts)
        features = _features(words)
        weights = self.weights(features)
        weights[np.asarray(pc.binary_length(words)) == 0] = 0
        telling = weights.any(axis=1)
        at = np.flatnonzero(telling[index]) if len(index) else np.zeros(0, np.int64)
        doc = np.searchsorted(bounds, at, side="right") - 1
        total = np.full(len(texts), self.bias)
        if len(at):
            pair = np.repeat(doc, features.shape[1]) * DIMENSIONS + features[index[at]].ravel()
            pair, first = np.unique(pair, return_index=True)
            total += np.bincount(pair // DIMENSIONS, weights[index[at]].ravel()[first], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _swaps(mentions: list[str], rng: np.random.Generator) -> dict[tuple[str, str], int]:
    """How often each counterfactual (old term, new term) is drawn: one per mentioned term, or of one kind where a row mentions none."""
    kinds = {kind: terms.split() for kind, terms in IDENTITY.items()}
    names, out = list(kinds), {}
    for row in mentions:
        pairs = []
        for word in row.split():
            pairs.append((word, str(rng.choice([t for t in kinds[TERMS[word]] if t != word]))))
        if not pairs:
            pairs = [tuple(map(str, rng.choice(kinds[names[rng.integers(len(names))]], 2, replace=False)))]
        for pair in pairs:
            out[pair] = out.get(pair, 0) + 1
    return out


def fit(rows: list[tuple[int, str, bytes]], share: float, counterfactual: float = 3.0, sparse: float = 0.005, least_z: float = 3.0, rounds: int = 400, seed: int = 7) -> Model:
    """Minimise the mean logistic loss + sparse / sqrt(rows) * |w| + counterfactual * mean (score change under a swap) ** 2.

    ``share`` is the share of toxic rows among all labels; sampled rows are
    weighted back to it. Features whose document frequencies don't differ between the labels by
    ``least_z`` standard errors are left out first, so that chance words of a
    small sample get no weight; identity terms always stay in.
    """
    labels = np.array([r[0] for r in rows], float)
    if len(rows) == 0 or labels.min() == labels.max():
        return Model(float(np.log(share / (1 - share))) if 0 < share < 1 else (-30.0 if share <= 0 else 30.0))
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean())) / len(labels)
    sets = [np.frombuffer(r[2], "<i4") for r in rows]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
    toxic, other = int(labels.sum()), int(len(labels) - labels.sum())
    n1, n = np.bincount(flat, labels[owner], DIMENSIONS), np.bincount(flat, minlength=DIMENSIONS)
    p = n / len(labels)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.abs(n1 / toxic - (n - n1) / other) / np.sqrt(p * (1 - p) * (1 / toxic + 1 / other))
    term = {w: f for w, f in zip(TERMS, _features(pa.array(list(TERMS))))}
    wanted = (n >= 2) & (np.nan_to_num(z) >= least_z)
    wanted[np.concatenate(list(term.values()))] = True
    known = np.flatnonzero(wanted)
    place = np.full(DIMENSIONS, -1)
    place[known] = np.arange(len(known))
    held = wanted[flat]
    flat, owner = place[flat[held]], owner[held]
    del n1, n, p, z, held, sets  # as large as the feature space or the sample

    swaps = _swaps([r[1] for r in rows], np.random.default_rng(seed))
    plus = [np.setdiff1d(place[term[a]], place[term[b]]) for a, b in swaps]  # letters that both share don't change
    minus = [np.setdiff1d(place[term[b]], place[term[a]]) for a, b in swaps]
    pair = np.concatenate([np.full(len(x), i) for side in (plus, minus) for i, x in enumerate(side)])
    spot = np.concatenate([*plus, *minus])
    sign = np.repeat([1.0, -1.0], [sum(map(len, plus)), sum(map(len, minus))])
    often = np.array(list(swaps.values()), float) / sum(swaps.values())

    m = len(known)

    def gradient(w: np.ndarray) -> np.ndarray:
        out = np.bincount(owner, w[flat], len(labels)) + w[m]
        gap = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels) * weight
        change = np.bincount(pair, sign * w[spot], len(often)) * often * 2 * counterfactual
        return np.append(np.bincount(flat, gap[owner], m) + np.bincount(spot, sign * change[pair], m), gap.sum())

    # per-weight steps from the curvature's row sums (features are 0 or 1): a safe diagonal bound
    load = np.bincount(owner, minlength=len(labels)) + 1
    bound = np.append(np.bincount(flat, (weight * load / 4)[owner], m), (weight * load / 4).sum())
    bound[:m] += np.bincount(spot, (often * 2 * counterfactual * np.bincount(pair, minlength=len(often)))[pair], m)
    step = 1 / np.maximum(bound, 1e-9)
    w = np.append(np.zeros(m), np.log(share / (1 - share)))
    y, t = w.copy(), 1.0
    for _ in range(rounds):
        moved = y - step * gradient(y)
        new = np.sign(moved) * np.maximum(0, np.abs(moved) - step * sparse / len(labels) ** 0.5)
        new[m] = moved[m]
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - w)
        if ((y - new) * (new - w)).sum() < 0:
            after = 1.0
        w, t = new, after
    kept = np.flatnonzero(np.abs(w[:m]) > 1e-6)
    return Model(float(w[m]), known[kept].astype(np.int64), w[kept])


def learn(docs: DataFrame, labels: DataFrame, learns: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, **how) -> Model:
    """Fit on at most ``sample`` rows of either label; ``learns`` is a condition on the labels' id that rows must meet."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    known = known.where(learns) if learns is not None else known
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.where(F.col("label") == v).where(among_lowest(F.col("id"), sample, F.lit(counts.get(v, 1)))).orderBy(F.xxhash64("id"), "id").limit(sample) for v in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * sample ids
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL").join(chosen, "id")
    found = featured(texts).toArrow()  # bounded by the sample
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("label", "mentions", "features"))))
    total = counts.get(0, 0) + counts.get(1, 0)
    return fit(rows, counts.get(1, 0) / total if total else 0.0, **how)


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sent.value.scores(block.column("text")))], ["doc_id", "score"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def clean(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``limit``. One pass: the score is computed beside the row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in text_blocks(batches, text):
            keep = sent.value.scores(block.column(text)) < limit
            yield block.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
