"""Landed response pages.

The source is paged JSON landed as files (one document per page). Pages are
read into a single ``VARIANT`` column so unknown and varying fields survive,
then unwrapped with column expressions: no per-page Python, no driver loop
over pages. Following ``Paging.Next`` becomes a completeness audit: pointers
whose target page never landed are reported by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import items as it
from ledgerfold.functions.identity import strip
from ledgerfold.operators.partitioning import with_materialized
from ledgerfold.sources.tables import settled

# --- fixed values: message keys and phrases that mark a denied request -------
DENIAL_KEYS = ("Message", "Messages", "Error", "error", "errorMessage")
DENIAL_PHRASES = ("rate limit", "too many requests", "threshold", "limit has been reached", "limit reached")
# ---------------------------------------------------------------------------


class IncompleteInput(ValueError):
    """Input from which nothing may be retired: unreadable, refused or missing pages, or rejected requests."""


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page records, one JSON object per line → ``(page_id, url, employee_key, query_status, page)``.

    The landing step writes ``{"page_id":…, "url":…, "employee_key":…, "query_status":…, "page":{…}}``:
    the page's number in the run, the service URL it came from (what ``Paging.Next``
    of another page names) and the request it answers. A line that is no such
    object keeps a row with a null page, so that the gate sees it; lines are
    numbered by file and position where no ``page_id`` was written.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    v = F.try_parse_json(F.col("value"))
    return lines.select(
        F.coalesce(it.vget(v, "$.page_id", "long"), F.xxhash64("_metadata.file_path", "value")).alias("page_id"),
        it.vget(v, "$.url").alias("url"),
        it.vget(v, "$.employee_key").alias("employee_key"),
        it.vget(v, "$.query_status").alias("query_status"),
        it.vget(v, "$.page", "variant").alias("page"),
    )


def parse_pages(df: DataFrame, text: str = "payload") -> DataFrame:
    """Landed page text in a column → ``page`` VARIANT (bad JSON → null)."""
    return with_materialized(df, {"page": F.try_parse_json(F.col(text))})


def data_array(page: Column) -> Column:
    """``Data`` list of an object page, or the page itself when it is a bare list."""
    return F.coalesce(it.vget(page, "$.Data", "array<variant>"), it.vget(page, "$", "array<variant>"))


def unwrap_list(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per object member of each page's data list, with its position."""
    return pages.select(*keep, F.posexplode(it.objects(data_array(F.col("page")))).alias("row_idx", "row"))


def unwrap_single(col: str = "page") -> Column:
    """The ``Data`` object if there is one, else the payload itself."""
    data = it.vget(F.col(col), "$.Data", "variant")
    return F.when(it.is_object(data), data).otherwise(F.col(col))


def next_pointer(page: Column) -> Column:
    """``Paging.Next`` as text, or its ``href``; trimmed; empty → null."""
    nxt = F.coalesce(it.vget(page, "$.Paging.Next.href"), it.vget(page, "$.Paging.Next"))
    is_obj = it.is_object(it.vget(page, "$.Paging.Next", "variant"))
    raw = F.when(is_obj, it.vget(page, "$.Paging.Next.href")).otherwise(nxt)
    t = strip(raw)
    return F.when(t != "", t)


def page_gaps(pages: DataFrame, url: str = "url") -> DataFrame:
    """S12 audit: pages whose next pointer names a page that did not land."""
    ptr = pages.select("page_id", next_pointer(F.col("page")).alias("next_url")).filter(F.col("next_url").isNotNull())
    landed = pages.select(F.col(url).alias("next_url"))
    return ptr.join(landed, "next_url", "left_anti")


def page_chains(pages: DataFrame, url: str = "url") -> DataFrame:
    """S12 audit: how each landed page is reached by following pointers from first pages.

    A first page is one that no landed page points to. Per page: ``first_page`` (the smallest page id of the
    first pages that lead to it, null if none does), ``steps`` (fewest steps from a first page, null if
    none) and ``in_cycle`` (following its pointers leads back to it). :func:`page_gaps` sees
    neither a cycle nor pages that only a cycle leads to.

    Pointers are doubled: after k rounds a page knows the page 2^k steps on, so a chain of n
    pages takes log2(n) joins of narrow rows. Rounds end when one changes nothing: pages on one path are reached in
    order of their steps, and pages 2^k steps on from somewhere that stay as many are those of cycles.
    Each round is settled. Of several pages with one url, the smallest page id stands for it; a null page id or url is
    followed nowhere.
    """
    named = pages.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("next_url")).agg(F.min("page_id").alias("jump"))
    pointers = pages.where(F.col("page_id").isNotNull()).select("page_id", next_pointer(F.col("page")).alias("next_url"))
    # a page without a pointer looks for a url that none has, so that nulls don't meet in one task
    pointers = pointers.withColumn("next_url", F.coalesce("next_url", F.concat(F.lit("\u0000"), F.col("page_id").cast("string"))))
    pointers = pointers.join(named, "next_url", "left").groupBy("page_id").agg(F.min("jump").alias("jump"))
    pointers = settled(pointers, "pointers")
    led_to = pointers.where("jump IS NOT NULL").select(F.col("jump").alias("page_id")).distinct().withColumn("led_to", F.lit(True))
    state = pointers.join(led_to, "page_id", "left").select(
        "page_id",
        "jump",
        F.when(F.col("led_to").isNull(), F.col("page_id")).alias("first_page"),
        F.when(F.col("led_to").isNull(), F.lit(0).cast("bigint")).alias("steps"),
        F.coalesce("led_to", F.lit(False)).alias("in_cycle"),
    )
    state, width, image = settled(state, "chains"), 1, None
    while True:
        ahead = state.where("jump IS NOT NULL")
        reach = ahead.groupBy(F.col("jump").alias("page_id")).agg(F.min("first_page").alias("_first"), F.min(F.col("steps") + width).alias("_steps"), F.lit(True).alias("_hit"))
        on = ahead.select("page_id", "jump").join(state.select(F.col("page_id").alias("jump"), F.col("jump").alias("_on")), "jump").select("page_id", "_on")
        known = state.drop("in_cycle").join(reach, "page_id", "left").join(on, "page_id", "left")
        first, steps = F.least("first_page", "_first"), F.least("steps", "_steps")
        moved = ~first.eqNullSafe(F.col("first_page")) | ~steps.eqNullSafe(F.col("steps"))
        counted = Observation()
        known = known.observe(counted, F.count_if(moved).alias("moved"), F.count_if(F.coalesce("_hit", F.lit(False))).alias("image"))
        state = settled(known.select("page_id", F.col("_on").alias("jump"), first.alias("first_page"), steps.alias("steps"), F.coalesce("_hit", F.lit(False)).alias("in_cycle")), "chains")
        found = counted.get
        if not found.get("moved") and found.get("image") == image:
            return state.select("page_id", "first_page", "steps", "in_cycle")
        image, width = found.get("image"), 2 * width


def denial_text(page: Column) -> Column:
    """First message (string or list member, in key order) containing a denial phrase."""
    texts = []
    for k in DENIAL_KEYS:
        path = f"$.{k}"
        is_text = F.schema_of_variant(it.vget(page, path, "variant")) == "STRING"
        texts.append(F.array(F.when(is_text, it.vget(page, path))))
        texts.append(F.coalesce(it.vget(page, path, "array<string>"), F.array().cast("array<string>")))
    allt = F.filter(F.concat(*texts), lambda t: t.isNotNull())
    pattern = "|".join(DENIAL_PHRASES)
    return F.get(F.filter(allt, lambda t: F.lower(t).rlike(pattern)), 0)


def denials(pages: DataFrame) -> DataFrame:
    """``page_id`` and text of every page that carries a refusal instead of data."""
    return pages.select("page_id", denial_text(F.col("page")).alias("message")).filter(F.col("message").isNotNull())


def completeness(pages: DataFrame, url: str | None = "url") -> DataFrame:
    """One row: pages, unreadable pages, denials and gaps of a landed run (gaps need the pages' ``url``)."""
    denied = denial_text(F.col("page")).isNotNull()
    whole = pages.agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if(F.col("page").isNull()).alias("n_unreadable"),
        F.count_if(denied).alias("n_denied"),
    )
    if url is None or url not in pages.columns:
        return whole.withColumn("n_gaps", F.lit(0).cast("bigint"))
    both = whole.unionByName(page_gaps(pages, url).agg(F.count(F.lit(1)).alias("n_gaps")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def require_complete(pages: DataFrame, url: str | None = "url") -> None:
    """Raise :class:`IncompleteInput` unless every page of the run was landed, readable and answered."""
    found = completeness(pages, url).first().asDict()
    if found["n_unreadable"] or found["n_denied"] or found["n_gaps"]:
        raise IncompleteInput(f"landed pages are incomplete: {found}")


def affected_employees(pages: DataFrame) -> DataFrame:
    """``employee_key`` of every page that is unreadable, refused or points to a page that did not land.

    A page without an employee can't be held back alone and raises :class:`IncompleteInput`.
    """
    bad = pages.where(F.col("page").isNull() | denial_text(F.col("page")).isNotNull()).select("employee_key")
    if "url" in pages.columns:
        gaps = page_gaps(pages).select("page_id")
        bad = bad.unionByName(pages.join(gaps, "page_id", "left_semi").select("employee_key"))
    if not bad.where("employee_key IS NULL").isEmpty():
        raise IncompleteInput("an unreadable or refused page names no employee")
    return bad.distinct()


def employee_keys(rows: DataFrame, row: str = "row") -> DataFrame:
    """S4 over unwrapped rows: the key as text; missing or empty keys dropped."""
    k = it.vget(F.col(row), "$.XRefCode")
    return rows.withColumn("XRefCode", k).filter(F.col("XRefCode").isNotNull() & (F.col("XRefCode") != ""))
