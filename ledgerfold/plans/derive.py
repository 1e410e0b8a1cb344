"""Source-shaped frames derived from the driver's tables.

The real input is landed JSON from an HR system. The driver's tables stand in
for it: every order is one time-off request of customer ``o_custkey``, every
customer is one employee. The rules below are mirrored 1:1 by the CTEs in
``ledgerfold.plans.oracle`` so DuckDB can check every query. Nothing here
samples or caps rows; the two "cycles" are two overlapping snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss"

# --- fixed values: status words of the source system ------------------------
STATUS_OF_ORDER = {"O": "APPROVED", "F": "CANCELED", "P": "PENDING"}
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. ``spread`` deals out a table that came as fewer files than
    there are cores, before a CPU-heavy derivation: such a file is one split. As many parts as a shuffle
    has keep what a task derives and exchanges in its memory, however large the table is.
    The file list is all that is looked at; a table of many files stays as it is."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    parts = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts) if spread and len(df.inputFiles()) < cores else df


def _status(c: Column) -> Column:
    out = None
    for code, word in STATUS_OF_ORDER.items():
        out = (F.when(c == code, word) if out is None else out.when(c == code, word))
    return out


def requests(spark: SparkSession, sf_dir: str, cycle: int = 1) -> DataFrame:
    """Time-off requests of one snapshot cycle (fields of FIXTURES F3 and F4).

    cycle 0: every order (for queries that look at one snapshot)
    cycle 1: every order whose key is not ≡ 0 (mod 10)
    cycle 2: every order whose key is not ≡ 1 (mod 10); hours +1 where key ≡ 0 (mod 7);
             APPROVED/CANCELED swapped where key ≡ 0 (mod 23)
    cycle 3: same as cycle 1 (used for reactivation)
    """
    o = table(spark, sf_dir, "orders", spread=True).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    k = F.col("o_orderkey")
    if cycle:  # two snapshots differ in what they hold; one by itself is whole
        o = o.filter(k % 10 != (1 if cycle == 2 else 0))
    span = (k % 9).cast("int")
    offset = F.when(k % 4 == 3, -span).otherwise(span)
    start_ts = F.col("o_orderdate")
    end_ts = F.timestamp_add("DAY", offset, start_ts)
    hours = F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise((k % 80) / 4 + 0.125)
    if cycle == 2:
        hours = F.when(k % 7 == 0, hours + 1).otherwise(hours)
    day_list = F.transform(
        F.sequence(F.lit(0), span),
        lambda i: F.struct(
            F.date_format(F.date_add(start_ts.cast("date"), i), "yyyy-MM-dd").alias("Date"),
            F.when((k % 5 == 0) & (i == 0), F.lit(None).cast("double"))
            .otherwise(((k + i) % 9).cast("double"))
            .alias("NetHours"),
        ),
    )
    empty = F.array().cast("array<struct<Date:string,NetHours:double>>")
    status = _status(F.col("o_orderstatus"))
    if cycle == 2:
        flip = F.when(status == "APPROVED", "CANCELED").when(status == "CANCELED", "APPROVED").otherwise(status)
        status = F.when(k % 23 == 0, flip).otherwise(status)
    return o.select(
        k.alias("entry_idx"),
        F.concat(F.lit(" emp-"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("employee_key"),
        F.when(k % 29 == 0, F.concat(F.lit("bad-"), k.cast("string")))
        .otherwise(F.date_format(start_ts, ISO_LOCAL))
        .alias("TimeStart"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.date_format(end_ts, ISO_LOCAL)).alias("TimeEnd"),
        hours.alias("NetHours"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.lower(F.substring("o_orderpriority", 3, 40)))
        .alias("ReasonName"),
        F.when(k % 17 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("PayAdjustmentCodeName"),
        F.when(k % 34 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PAY"), (k % 5).cast("string")))
        .alias("PayAdjustmentCodeXRefCode"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("PayAdjShortName"),
        status.alias("Status"),
        F.when(k % 3 == 0, F.when(k % 8 == 0, empty).otherwise(day_list)).alias("DayList"),
        F.when(((k % 3 == 1) & (k % 2 == 0)) | (k % 24 == 0), day_list).alias("Days"),
    )


def tagged_requests(spark: SparkSession, sf_dir: str, cycle: int = 1, statuses=("APPROVED", "CANCELED")) -> DataFrame:
    """Flow B input (F4): requests tagged with the employee key and queried status."""
    r = requests(spark, sf_dir, cycle).filter(F.col("Status").isin(*statuses))
    rank = F.array_position(F.array(*[F.lit(s) for s in statuses]), F.col("Status")).cast("int") - 1
    return r.select(
        F.trim(F.col("employee_key")).alias("_XRefCode"),
        F.col("Status").alias("_Status"),
        rank.alias("status_rank"),
        F.lit(0).alias("window_idx"),
        "entry_idx",
        "TimeStart",
        "TimeEnd",
        "NetHours",
        "ReasonName",
        "PayAdjShortName",
    )


# --------------------------------------------------------------------------- #
# Roster, employee detail, department map, landed pages                       #
# --------------------------------------------------------------------------- #
def roster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee list rows (F1) from ``customer``, with page/row ordinals.

    Keys vary in case and padding, some are missing or outside the prefix,
    and customers ≡ 0 (mod 13) appear again on a later page (repeated key).
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    key = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 9 == 0, F.concat(F.lit(" x-"), k.cast("string")))
        .when(k % 2 == 0, F.concat(F.lit("emp-"), k.cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit("EMP-"), k.cast("string")))
    )
    base = c.select(
        (k / 50).cast("bigint").alias("page_idx"),
        (k % 50).cast("int").alias("row_idx"),
        key.alias("XRefCode"),
        F.col("c_name").alias("FirstName"),
        F.col("c_mktsegment").alias("LastName"),
        F.struct(
            F.concat(F.lit("ORG-"), F.col("c_nationkey").cast("string")).alias("XRefCode"),
            F.col("c_mktsegment").alias("ShortName"),
        ).alias("HomeOrganization"),
    )
    dup = c.filter(k % 13 == 0).select(
        ((k / 50).cast("bigint") + 1000).alias("page_idx"),
        (k % 50).cast("int").alias("row_idx"),
        key.alias("XRefCode"),
        F.lower("c_name").alias("FirstName"),
        F.col("c_mktsegment").alias("LastName"),
        F.struct(
            F.concat(F.lit("ORG-"), F.col("c_nationkey").cast("string")).alias("XRefCode"),
            F.col("c_mktsegment").alias("ShortName"),
        ).alias("HomeOrganization"),
    )
    return base.unionByName(dup)


def dept_code(n: Column) -> Column:
    return F.concat(F.lit("dept_"), n.cast("string"))


def employee_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee detail payloads (F2) as landed JSON text, one per customer.

    ``WorkAssignments`` comes wrapped (``{"Items": [...]}``) for even keys and
    bare (``[...]``) for odd ones, absent for keys ≡ 5 (mod 10). Columns:
    ``XRefCode`` (as requested) and ``payload`` (JSON text).
    """
    c = table(spark, sf_dir, "customer", spread=True)
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    nk2 = (nk + 7) % 25
    wa0 = F.struct(
        (k % 3 == 0).alias("IsPrimary"),
        F.lit("2019-01-01").alias("EffectiveStart"),
        F.lit("2024-12-31").alias("EffectiveEnd"),
        F.when(k % 4 != 1, F.struct(dept_code(nk).alias("XRefCode"))).alias("Department"),
        F.struct(F.struct(F.concat(F.lit("Dept_"), ((nk + 3) % 25).cast("string")).alias("XRefCode")).alias("Department")).alias(
            "Position"
        ),
    )
    wa1 = F.struct(
        (k % 3 == 1).alias("IsPrimaryWork"),
        F.lit("2025-01-01").alias("EffectiveStartDate"),
        dept_code(nk2).alias("DepartmentXRefCode"),
        F.struct(F.struct(F.concat(F.lit("Dept_"), ((nk2 + 3) % 25).cast("string")).alias("XRefCode")).alias("Department")).alias(
            "Position"
        ),
    )
    es0 = F.struct(
        F.lit("2020-01-01").alias("EffectiveStart"),
        F.struct(F.lit("ACTIVE").alias("XRefCode")).alias("EmploymentStatus"),
        F.when(k % 20 != 15, F.concat(F.lit("OU_"), nk.cast("string"))).alias("OrgUnitXRefCode"),
    )
    es1 = F.struct(
        F.when(k % 4 == 0, "2021-06-01").when(k % 4 == 1, "2019-06-01").otherwise("2020-01-01").alias("EffectiveStart"),
        F.struct(
            F.when(F.col("c_acctbal") < 0, "TERMINATED").otherwise("INACTIVE").alias("XRefCode")
        ).alias("EmploymentStatus"),
    )
    items = F.concat(F.lit("["), F.to_json(wa0), F.lit(","), F.to_json(wa1), F.lit("]"))
    wa = F.when(k % 10 == 5, F.lit(None)).when(k % 2 == 0, F.concat(F.lit('{"Items":'), items, F.lit("}"))).otherwise(items)
    es = F.concat(F.lit('{"Items":['), F.to_json(es0), F.lit(","), F.to_json(es1), F.lit("]}"))
    head = F.to_json(
        F.struct(
            F.concat(F.lit("emp-"), k.cast("string")).alias("XRefCode"),
            F.col("c_name").alias("DisplayName"),
            F.when(k % 7 == 0, F.upper(dept_code(nk))).alias("DepartmentXRefCode"),
            F.struct(F.concat(F.lit("HO_"), nk.cast("string")).alias("XRefCode")).alias("HomeOrganization"),
        )
    )
    body = F.concat(
        F.expr("substring(_head, 1, length(_head) - 1)"),
        F.when(wa.isNotNull(), F.concat(F.lit(',"WorkAssignments":'), wa)).otherwise(F.lit("")),
        F.lit(',"EmploymentStatuses":'),
        es,
        F.lit("}"),
    )
    return (
        c.select(k, nk, F.col("c_acctbal"), F.col("c_name"), head.alias("_head"))
        .select(F.concat(F.lit("emp-"), k.cast("string")).alias("XRefCode"), body.alias("payload"))
    )


def department_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows (F8): nations outside region 4, then one override per region.

    Keys vary in case/padding; region rows come later (greater ordinal) and
    collide with the key of nation ``5 * r`` after normalisation; region 3
    lacks its task id (an invalid entry).
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    key = (
        F.when(nk % 3 == 0, F.concat(F.lit(" dept_"), nk.cast("string"), F.lit(" ")))
        .when(nk % 3 == 1, F.concat(F.lit("DEPT_"), nk.cast("string")))
        .otherwise(F.concat(F.lit("Dept_"), nk.cast("string")))
    )
    nations = n.filter(F.col("n_regionkey") != 4).select(
        key.alias("department"),
        (F.lit(1000) + F.col("n_regionkey")).cast("int").alias("project_id"),
        (F.lit(5000) + nk).cast("int").alias("task_id"),
        nk.cast("int").alias("ordinal"),
    )
    rk = F.col("r_regionkey")
    regions = r.select(
        F.concat(F.lit("dept_"), (rk * 5).cast("string")).alias("department"),
        (F.lit(3000) + rk).cast("int").alias("project_id"),
        F.when(rk != 3, F.lit(6000) + rk).cast("int").alias("task_id"),
        (F.lit(100) + rk).cast("int").alias("ordinal"),
    )
    return nations.unionByName(regions)


# --- fixed values: denial phrases placed into some landed pages -------------
DENIAL_TEXT = "Too Many Requests for this tenant"
# ---------------------------------------------------------------------------


def landed_pages(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Landed list pages (F1/F10) as JSON text, one per event. With ``gaps``, events with
    ``value > 45`` were never landed, so that pointers to them lead nowhere.

    view: ``{"Data":[e],"Paging":{"Next":url}}``; click: two rows and a
    padded ``{"href":…}`` pointer; signup: a bare list with a non-object;
    purchase: empty ``Data``, empty pointer; error: a denial message, no data.
    """
    e = table(spark, sf_dir, "events", spread=True)
    e = e.filter(F.col("value") <= 45) if gaps else e
    u, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")

    def emp(uid: Column, lower_key: bool = False) -> Column:
        name = "xrefcode" if lower_key else "XRefCode"
        return F.to_json(
            F.struct(
                F.concat(F.lit("emp-"), uid.cast("string")).alias(name),
                et.alias("FirstName"),
                F.struct(F.concat(F.lit("ORG-"), (uid % 7).cast("string")).alias("XRefCode")).alias("HomeOrganization"),
            )
        )

    nxt = F.concat(F.lit('"p/'), (eid + 1).cast("string"), F.lit('"'))
    text = (
        F.when(et == "view", F.concat(F.lit('{"Data":['), emp(u), F.lit('],"Paging":{"Next":'), nxt, F.lit("}}")))
        .when(
            et == "click",
            F.concat(
                F.lit('{"Data":['), emp(u), F.lit(","), F.when(u % 2 == 0, emp(u + 1, lower_key=True)).otherwise(emp(u + 1)),
                F.lit('],"Paging":{"Next":{"href":" p/'), (eid + 1).cast("string"), F.lit(' "}}}'),
            ),
        )
        .when(et == "signup", F.concat(F.lit("["), emp(u), F.lit(",7]")))
        .when(et == "purchase", F.lit('{"Data":[],"Paging":{"Next":""}}'))
        .otherwise(F.concat(F.lit('{"Messages":["ok","'), F.lit(DENIAL_TEXT), F.lit('"]}')))
    )
    return e.select(
        eid.alias("page_id"),
        F.concat(F.lit("p/"), eid.cast("string")).alias("url"),
        text.alias("payload"),
    )


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages in chains, one per event: each points to the next event's page.

    Of every 200 events, chains end after the 100th, the 150th and the last; the pages after the 30th, 80th, 130th and 180th
    lead ten pages back instead, and pages 150 to 159 are a cycle that nothing leads to. Every 97th page never landed.
    """
    e = table(spark, sf_dir, "events", spread=True).filter(F.col("event_id") % 97 != 13)
    eid = F.col("event_id")
    back = (eid % 200 == 159) | (eid % 50 == 29)
    to = F.when(eid % 200 == 149, F.lit(None)).when(back, eid - 9).when(eid % 100 == 99, F.lit(None)).otherwise(eid + 1)
    text = F.concat(F.lit('{"Data":[],"Paging":{"Next":"'), F.coalesce(F.concat(F.lit("p/"), to.cast("string")), F.lit("")), F.lit('"}}'))
    return e.select(eid.alias("page_id"), F.concat(F.lit("p/"), eid.cast("string")).alias("url"), text.alias("payload"))


def employee_rows_v2(rows: DataFrame) -> DataFrame:
    """Second version of the employee source (M2): renames, status moves, leavers.

    With ``n`` the digits of the key: name upper-cased where n ≡ 0 (mod 5);
    status null where n ≡ 0 (mod 7), else TERMINATED where n ≡ 0 (mod 3);
    rows with n ≡ 0 (mod 11) are missing from this version.
    """
    n = F.regexp_extract(F.col("XRefCode"), r"(\d+)", 1).cast("bigint")
    return rows.filter(n % 11 != 0).select(
        "XRefCode",
        F.when(n % 5 == 0, F.upper("employee_name")).otherwise(F.col("employee_name")).alias("employee_name"),
        "DepartmentXRefCode",
        "ProjectId",
        "TaskId",
        F.when(n % 7 == 0, F.lit(None).cast("string"))
        .when(n % 3 == 0, F.lit("TERMINATED"))
        .otherwise(F.col("employment_status"))
        .alias("employment_status"),
    )


def landed_request_pages(spark: SparkSession, sf_dir: str, cycle: int = 1) -> DataFrame:
    """Request pages (F3) as landed JSON: one page per request, ``Data`` holding it.

    Landing metadata: ``employee_key`` and ``page_id`` (= the order key).
    """
    r = requests(spark, sf_dir, cycle)
    entry = F.to_json(
        F.struct(
            "TimeStart", "TimeEnd", "NetHours", "ReasonName", "PayAdjustmentCodeName", "PayAdjustmentCodeXRefCode",
            "PayAdjShortName", "Status", "DayList", "Days",
        )
    )
    return r.select(
        "employee_key",
        F.col("entry_idx").alias("page_id"),
        F.concat(F.lit('{"Data":['), entry, F.lit('],"Paging":{"Next":""}}')).alias("payload"),
    )
