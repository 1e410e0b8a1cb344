"""Near duplicates by banded MinHash with odd sketches (operator 7).

1. Every text becomes its set of distinct five-word shingles. Rows with equal
   sets form a class with one representative; copies go no further.
2. Representatives get ``BANDS * ROWS`` MinHash values. Band keys find
   candidates; the samples are folded into an odd sketch, a parity bitmap whose
   population count under XOR estimates high similarities precisely.
3. Inside a bucket no pairs are listed as such. Bitmaps are compared in
   blocks: a bucket of up to ``SMALL`` members compares all of them; a larger one first compares all members
   with its centre (the member nearest to the bucket's majority bitmap). Candidates go to
   an exact comparison of the full sets, and confirmed links to connected components.
4. The rest, for large buckets: members outside their bucket's home, the component that holds its
   largest one of step 3, compare with every member of other components, and their best
   untried candidates are confirmed; each round tries four times as many, until no bucket has any left.
   The home only grows, whichever component is largest later, so a member outside has been tried
   from its first candidate on, and of two unlinked members one is outside: nothing that the sketches let through is dropped.

Documents link when 100 * |A and B| >= 75 * |A or B| on full sets. Candidate search is
probabilistic: at similarity 0.75 a pair meets in no band with probability
(1 - 0.75**4)**32 = 5e-6, and the sketch bound lies five standard errors below the limit.
A second bitmap, the parity of the whole set, rules out most pairs just below it.

Defined cases: null text, empty text and text without words have an empty set
and link with nothing; each row with a null id is a row of the result: it links with nothing, has no component and is
kept; rows that share an id are one document, linked by what any of them holds, and n_shingles is their largest;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import settled, text_blocks
from ledgerfold.llm.components import components
from ledgerfold.llm.words import mix, shingle_sets

SHINGLE, BANDS, ROWS = 5, 32, 4
#: Bits of the odd sketch: four per sample, so that few samples meet in a bit near the limit.
BITS = 512
#: Bits of the second bitmap, the parity of the whole set.
SET_BITS = 1024
NUMERATOR, DENOMINATOR = 75, 100
SMALL = 48
#: Standard errors of the estimate that a candidate may lie below the limit.
SLACK = 5.0
FIRST_TRIES = 64


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minhashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(texts with a set, n) least values of n hash functions over each set."""
    starts = bounds[:-1]
    out = np.empty((len(starts), n), np.uint32)
    if not len(starts):
        return out
    base, other = (hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32) | np.uint32(1)
    for j, seed in enumerate(_seeds(n)):
        value = (base ^ np.uint32(seed & np.uint64(0xFFFFFFFF))) * np.uint32((int(seed) >> 32) | 1)
        value ^= value >> np.uint32(15)
        value += other
        value *= np.uint32(0x85EBCA6B)
        value ^= value >> np.uint32(13)
        out[:, j] = np.minimum.reduceat(value, starts)
    return out


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Each row's samples, every one with its number, folded into a parity bitmap (bits / 64 words)."""
    numbered = mix(samples.astype(np.uint64) * np.uint64(samples.shape[1]) + np.arange(samples.shape[1], dtype=np.uint64))
    place = (numbered % np.uint64(bits)).astype(np.int64)
    parity = np.zeros((len(samples), bits), np.uint8)
    np.add.at(parity, (np.arange(len(samples))[:, None], place), 1)
    return np.packbits(parity & 1, axis=1).view(np.uint64)


def set_parities(hashes: np.ndarray, bounds: np.ndarray, bits: int = SET_BITS) -> np.ndarray:
    """Parity bitmap of each whole set (n + 1 bounds): differing bits never outnumber the elements in which two sets differ."""
    n = len(bounds) - 1
    spot = np.repeat(np.arange(n), np.diff(bounds)) * bits + (mix(hashes) % np.uint64(bits)).astype(np.int64)
    parity = np.bincount(spot, minlength=n * bits).reshape(n, bits) & 1
    return np.packbits(parity.astype(np.uint8), axis=1).view(np.uint64)


def odd_limit(similarity: float, samples: int = BANDS * ROWS, bits: int = BITS, slack: float = SLACK) -> int:
    """Most differing bits that a pair of this similarity shows, but for ``slack`` standard errors of the samples."""
    low = max(0.0, similarity - slack * np.sqrt(similarity * (1 - similarity) / samples))
    expected = bits / 2 * (1 - (1 - 2 / bits) ** (2 * samples * (1 - low)))
    return int(np.ceil(expected))


def set_limit(sizes: np.ndarray, bits: int = SET_BITS, slack: float = SLACK) -> np.ndarray:
    """Most differing bits of two sets of ``sizes`` elements together that link: the elements in which they may differ, or for large sets what these show."""
    differ = sizes * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
    expected = bits / 2 * (1 - (1 - 2 / bits) ** differ)
    return np.minimum(differ, np.ceil(expected + slack * np.sqrt(np.minimum(expected, bits / 4)) + 1)).astype(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: set size, set digest, band keys and odd sketch (the last two null without words)."""

    def run(batches):
        for block in text_blocks(batches):
            hashes, bounds = shingle_sets(block.column("text"), SHINGLE)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            samples = minhashes(hashes, np.append(bounds[:-1][some], len(hashes)), BANDS * ROWS)
            keys = np.zeros((len(some), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1))
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
            inner = np.append(bounds[:-1][some], len(hashes))
            sketch = np.concatenate([odd_sketches(samples), set_parities(hashes, inner)], axis=1)
            full = [None] * len(sizes)
            band, odd = list(full), list(full)
            digest = [xxhash.xxh3_128_digest(hashes[bounds[i] : bounds[i + 1]].tobytes()) if sizes[i] else None for i in range(len(sizes))]
            for k, i in enumerate(some):
                band[i], odd[i] = keys[k].view(np.int64), sketch[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digest, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                ["doc_id", "n_shingles", "digest", "bands", "odd"],
            )

    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, bands array<long>, odd binary")


def _buckets(batches, columns):
    """Whole buckets, as (key, columns), from a partition sorted by key; only one bucket is held beside a batch."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if held is None else pa.concat_tables([held, part])
        keys = np.asarray(part.column("key").combine_chunks())
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        for group in _cut(part.slice(0, last), columns):
            yield group
        held = part.slice(last)
    if held is not None and held.num_rows:
        yield from _cut(held, columns)


def _cut(part: pa.Table, columns):
    if not part.num_rows:
        return
    part = part.combine_chunks()
    keys = np.asarray(part.column("key").combine_chunks())
    ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
    values = [part.column(c).combine_chunks() for c in columns]
    arrays = [np.asarray(v) if not pa.types.is_binary(v.type) else np.frombuffer(b"".join(v.to_pylist()), np.uint64).reshape(len(keys), -1) for v in values]
    at = 0
    for to in ends:
        if to - at > 1:
            yield [a[at:to] for a in arrays]
        at = to


def differing(odd: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(odd ^ one).sum(axis=-1, dtype=np.int64)


def alike(odd: np.ndarray, size: np.ndarray, one_odd: np.ndarray, one_size, limit: int) -> np.ndarray:
    """Numbers of the rows that may link with ``one`` (or row by row with arrays of them), by set sizes, then the odd sketch, then the set parity."""
    each = lambda x, i: x[i] if np.ndim(x) == np.ndim(odd) else x
    sizes = lambda i: one_size[i] if np.ndim(one_size) else one_size
    ok = np.flatnonzero(DENOMINATOR * np.minimum(size, one_size) >= NUMERATOR * np.maximum(size, one_size))
    words = BITS // 64
    ok = ok[differing(odd[ok, :words], each(one_odd, ok)[..., :words]) <= limit]
    return ok[differing(odd[ok, words:], each(one_odd, ok)[..., words:]) <= set_limit(size[ok] + sizes(ok))]


def first_candidates(doc: np.ndarray, size: np.ndarray, odd: np.ndarray, limit: int):
    """Index pairs to confirm in one bucket: all that the sketches allow, or in a large bucket those with its centre."""
    n = len(doc)
    if n <= SMALL:
        i, j = np.triu_indices(n, 1)
        ok = alike(odd[i], size[i], odd[j], size[j], limit)
        return i[ok], j[ok]
    ones = np.zeros(odd.shape[1] * 64, np.int64)
    for at in range(0, n, 4096):
        ones += np.unpackbits(odd[at : at + 4096].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > n).view(np.uint64)
    centre = int(np.argmin(differing(odd, majority)))
    ok = alike(odd, size, odd[centre], size[centre], limit)
    ok = ok[ok != centre]
    return np.full(len(ok), centre), ok


def rest_candidates(doc: np.ndarray, size: np.ndarray, odd: np.ndarray, before: np.ndarray, now: np.ndarray, limit: int, skip: int, most: int):
    """For members outside the bucket's home: numbers ``skip`` to ``skip + most`` of their nearest allowed members.

    The home is the component by ``now`` that holds the largest one ``before``. Candidates are numbered among members of other components ``before`` the first
    round, so the numbers stay the same; those in the same component by ``now`` are left out. A member
    with more to try gives a pair with itself.
    """
    names, of = np.unique(now, return_inverse=True)
    if len(names) < 2 or len(doc) <= SMALL:
        return
    _, start, counts = np.unique(before, return_index=True, return_counts=True)
    for u in np.flatnonzero(of != of[start[np.argmax(counts)]]):
        ok = alike(odd, size, odd[u], size[u], limit)
        ok = ok[before[ok] != before[u]]
        if len(ok) > skip:
            ok = ok[np.argsort(differing(odd[ok], odd[u]), kind="stable")]
            other = of[ok] != of[u]
            if other[skip + most :].any():
                yield np.array([u]), np.array([u])
            ok = ok[skip : skip + most][other[skip : skip + most]]
            yield np.full(len(ok), u), ok


def _pairs(batches, find, columns):
    """Arrow batches of ordered id pairs from the buckets of a sorted partition."""
    lows, highs, held = [], [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(lows)), pa.array(np.concatenate(highs))], ["a", "b"])

    for group in _buckets(batches, columns):
        for i, j in find(*group):
            if len(i):
                a, b = group[0][i], group[0][j]
                lows.append(np.minimum(a, b))
                highs.append(np.maximum(a, b))
                held += len(i)
        if held > 100_000:
            yield out()
            lows, highs, held = [], [], 0
    if held:
        yield out()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough. Joins carry each pair's two sets; a set that many pairs need is split by the skew handling."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            ok = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (left, right))
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                ok[k] = DENOMINATOR * shared >= NUMERATOR * (len(both) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    kind = dict(pairs.dtypes)["a"]
    with_left = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left")), "a")
    with_both = with_left.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right")), "b")
    return with_both.select("a", "b", "left", "right").mapInArrow(run, f"a {kind}, b {kind}")


def shingle_blobs(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``rep, shingles`` for the wanted classes: each one's set, from the text of its representative."""

    def run(batches):
        for block in text_blocks(batches):
            hashes, bounds = shingle_sets(block.column("text"), SHINGLE)
            digests = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            mine = pc.equal(pa.array(digests, pa.binary()), block.column("digest"))  # ids may repeat with other texts
            blobs = pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("rep").filter(mine), block.column("digest").filter(mine), blobs.filter(mine)], ["rep", "digest", "shingles"])

    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("rep"), F.col(text).cast("string").alias("text")).join(wanted, "rep")
    return rows.mapInArrow(run, f"rep {kind}, digest binary, shingles binary").dropDuplicates(["rep", "digest"]).drop("digest")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document id, and per row without one."""
    kind = dict(docs.dtypes)[doc_id]
    limit = odd_limit(NUMERATOR / DENOMINATOR)
    signed = settled(signatures(docs, doc_id, text))
    nameless, signed = signed.where("doc_id IS NULL"), signed.where("doc_id IS NOT NULL")

    # classes of equal sets; min over a struct combines map-side, so copies shrink before the shuffle
    with_words = signed.where("n_shingles > 0")
    classes = settled(with_words.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "odd")).alias("c")).select("digest", F.col("c.doc_id").alias("rep"), "c.n_shingles", "c.bands", "c.odd"))
    # buckets are found on (key, id) alone; only members of shared ones carry their bitmaps
    keyed = classes.select(F.explode("bands").alias("key"), "rep")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = settled(keyed.join(shared, "key", "left_semi").join(classes.select("rep", F.col("n_shingles").alias("size"), "odd"), "rep").select("key", "rep", "size", "odd"))

    def sorted_buckets(df: DataFrame) -> DataFrame:
        return df.repartition("key").sortWithinPartitions("key", "rep")

    def first(batches):
        yield from _pairs(batches, lambda d, s, o: [first_candidates(d, s, o, limit)], ["rep", "size", "odd"])

    pairs = settled(sorted_buckets(members).mapInArrow(first, f"a {kind}, b {kind}").where("a <> b").distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    large = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL).select("key")
    crowd = settled(members.join(large, "key", "left_semi"))
    wanted = ends.union(crowd.select("rep")).distinct().join(classes.select("rep", "digest"), "rep")
    sets = settled(shingle_blobs(docs, wanted, doc_id, text))
    links = settled(_confirmed(pairs, sets))
    # an id that holds several sets ties their classes together
    several = with_words.select("doc_id", "digest").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    ties = with_words.join(several, "doc_id", "left_semi").join(classes.select("digest", "rep"), "digest").select(F.greatest("doc_id", "rep").alias("b"), F.least("doc_id", "rep").alias("a"))
    links = settled(links.unionByName(ties.where("a <> b").distinct()))

    labels = components(links)
    named = lambda column: labels.select(F.col("node").alias("rep"), F.col("component").alias(column))
    crowd = settled(crowd.join(named("before"), "rep", "left").withColumn("before", F.coalesce("before", "rep")))
    marked = crowd.withColumn("now", F.col("before"))
    tried, most, more = 0, FIRST_TRIES, not crowd.isEmpty()
    while more:

        def rest(batches, tried=tried, most=most):
            yield from _pairs(batches, lambda d, s, o, b, n: rest_candidates(d, s, o, b, n, limit, tried, most), ["rep", "size", "odd", "before", "now"])

        found = settled(sorted_buckets(marked).mapInArrow(rest, f"a {kind}, b {kind}").distinct())
        fresh = settled(_confirmed(found.where("a <> b"), sets).distinct())
        tried, most = tried + most, most * 4
        if not fresh.isEmpty():
            links = settled(links.unionByName(fresh).distinct())
            labels = components(links)
        # only buckets with a member that has more to try go on
        waiting = found.where("a = b").select(F.col("a").alias("rep"))
        more = not waiting.isEmpty()
        if more:
            open_keys = crowd.join(waiting, "rep", "left_semi").select("key").distinct()
            crowd = settled(crowd.join(open_keys, "key", "left_semi"))
            marked = crowd.join(named("now"), "rep", "left").withColumn("now", F.coalesce("now", "rep"))

    final = classes.select("digest", "rep").join(named("component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("class_component"))
    rows = signed.select("doc_id", "n_shingles", "digest").join(final, "digest", "left")
    out = rows.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.coalesce(F.min("class_component"), F.col("doc_id")).alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return out.unionByName(nameless.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))
