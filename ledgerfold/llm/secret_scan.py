"""Secret scan with sliding-window entropy, as column expressions only (operator 2).

Three pattern kinds (``assign``, ``access``, ``hex``) give the base spans. On
top of them, every run of 20 or more key characters is a candidate string. A
window slides over it; symbol counts are updated by the character that enters
and the one that leaves, and with them the sum of n * log2(n), so a step costs
the same whatever the window. The largest window entropy is compared with the
threshold of the candidate's character class: ``hexrun`` for hexadecimal digits
only, ``keyrun`` for mixed key characters. Allow-listed candidates are
suppressed; base spans always stay.

Everything is a projection of one row: no shuffle, no Python. Positions are
code points, end exclusive. They come from the lengths of the matches and of
the text between them, summed in two levels so that long texts with many
matches stay near linear.

Defined cases: null or empty text has no spans; each row is scanned by itself
(repeated rows, null ids and extra columns have no effect).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "hexrun", "keyrun")

#: A run shorter than the least length can't be kept, and no kept run starts inside another: the same spans as the plain patterns, found faster.
ACCESS_KEPT = r"AKIA[A-Z0-9]{12,}"
HEX_KEPT = r"(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Bits in the best window of WINDOW characters from which a candidate is reported, by class.
BITS = {"hexrun": 3.0, "keyrun": 3.75}
#: Candidates that match one of these are not secrets: no digit at all, digits only, UUIDs, dates and version paths, sample keys, one run repeated, and the alphabet's own order.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[0-9+/_=-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[/_=-]*[0-9]{4}[-/_][0-9]{2}[-/_][0-9]{2}([-/_=][A-Za-z]*)*$",
    r"(?i)example|sample|dummy|placeholder|changeme",
    r"(?i)0123456789|abcdefghij|qwertyuiop",
)
CHUNK = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: names inside a lambda are bound, expressions are not."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """Running sums of an array of ints, first in chunks and then over the chunks' totals."""
    add = lambda a, x: a + x

    def within(chunk: Column, head: Column) -> Column:
        step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out"))
        return F.aggregate(chunk, F.struct(head.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda a: a["out"])

    def joined(chunks: Column) -> Column:
        def with_totals(totals: Column) -> Column:
            return F.flatten(F.transform(chunks, lambda c, i: within(c, F.aggregate(F.slice(totals, F.lit(1), i), F.lit(0), add))))

        return let(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), add)), with_totals)

    starts = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int"))
    return let(F.transform(starts, lambda i: F.slice(lengths, i * CHUNK + 1, F.lit(CHUNK))), joined)


def spans(found: Column, between: Column) -> Column:
    """(start, end) of each match, from the matches and the texts between them."""
    both = F.transform(found, lambda m, i: F.char_length(m) + F.char_length(between[i]))
    return let(running(both), lambda ends: F.transform(found, lambda m, i: F.struct((ends[i] - F.char_length(m)).alias("start"), ends[i].alias("end"))))


def best_bits(text: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy of any window of the text, in bits, by incremental counts. The text has at least ``window`` characters, all of the alphabet."""
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])  # n * log2(n)
    zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"), F.lit(0.0).alias("sum"), F.lit(float(window * 64)).alias("least"), F.lit(0).alias("i"))

    def scan(codes: Column, weights: Column) -> Column:
        def step(a: Column, into: Column) -> Column:
            out = F.when(a["i"] >= window, codes[F.greatest(a["i"] - window, F.lit(0))]).otherwise(-1)

            def moved(out: Column) -> Column:
                lost = F.when((out < 0) | (out == into), 0.0).otherwise(weights[a["n"][F.greatest(out, F.lit(0))]] - weights[a["n"][F.greatest(out, F.lit(0))] - 1])
                won = F.when(out == into, 0.0).otherwise(weights[a["n"][into] + 1] - weights[a["n"][into]])
                total = a["sum"] + won - lost
                counts = F.transform(a["n"], lambda n, k: n + F.when(k == into, 1).otherwise(0) - F.when(k == out, 1).otherwise(0))
                least = F.when(a["i"] >= window - 1, F.least(a["least"], total)).otherwise(a["least"])
                return F.struct(counts.alias("n"), total.alias("sum"), least.alias("least"), (a["i"] + 1).alias("i"))

            return let(out, moved)

        return F.aggregate(codes, zero, step, lambda a: F.lit(math.log2(window)) - a["least"] / window)

    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(codes, lambda c: let(table, lambda w: scan(c, w)))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Per row: doc_id and ``found``, an array of (start, rank of the kind, kind, end) in that order."""
    plain = {"assign": ASSIGN, "access": ACCESS_KEPT, "hex": HEX_KEPT, "run": CANDIDATE}
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in plain.items()])
    none = F.array().cast("array<string>")
    rows = rows.select(
        "doc_id",
        *[f"m_{k}" for k in plain],
        F.when(F.size("m_assign") > 0, F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))).otherwise(none).alias("value"),
        *[F.when(F.size(f"m_{k}") > 0, F.split("t", p, -1)).otherwise(none).alias(f"p_{k}") for k, p in plain.items()],
    )
    at = {k: F.when(F.size(f"m_{k}") > 0, spans(F.col(f"m_{k}"), F.col(f"p_{k}"))).otherwise(F.array().cast("array<struct<start:int,end:int>>")).alias(f"s_{k}") for k in plain}
    rows = rows.select("doc_id", "value", "m_run", *at.values())

    def named(kind: str, pairs: Column) -> Column:
        return F.transform(pairs, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    def runs() -> Column:
        kept = F.filter(F.transform(F.col("m_run"), lambda m, i: F.struct(m.alias("m"), F.col("s_run")[i].alias("s"))), lambda x: ~F.greatest(*[x["m"].rlike(p) for p in allowed]))
        rated = F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["m"].rlike("^[0-9a-fA-F]+$").alias("hex"), best_bits(x["m"]).alias("bits")))
        strong = F.filter(rated, lambda x: x["bits"] >= F.when(x["hex"], BITS["hexrun"]).otherwise(BITS["keyrun"]))
        rank = lambda x: F.when(x["hex"], KINDS.index("hexrun")).otherwise(KINDS.index("keyrun"))
        return F.transform(strong, lambda x: F.struct(x["s"]["start"].alias("start"), rank(x).alias("rank"), F.when(x["hex"], "hexrun").otherwise("keyrun").alias("kind"), x["s"]["end"].alias("end")))

    kind = "array<struct<start:int,rank:int,kind:string,end:int>>"
    base = F.concat(
        F.filter(named("assign", F.col("s_assign")), lambda x, i: F.char_length(F.col("value")[i]) >= LEAST["assign"]).cast(kind),
        named("access", F.col("s_access")).cast(kind),
        named("hex", F.col("s_hex")).cast(kind),
    )
    added = F.when(F.size("m_run") > 0, runs()).otherwise(F.array()).cast(kind)
    return rows.select("doc_id", F.array_sort(F.concat(base, added)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(text(F.filter("found", lambda x: x["rank"] < 3)), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
