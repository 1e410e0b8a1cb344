"""DuckDB oracle text for every catalog query (run by the driver at sf0.01).

The CTE builders below restate the derivation rules of
:mod:`ledgerfold.plans.derive` and the operator semantics in plain SQL.
DuckDB divides decimals as DOUBLE, so half-even splits are done with exact
integer arithmetic on thousandths of an hour (every derived hour value is a
multiple of 1/8).
"""

from __future__ import annotations

from ledgerfold.plans.catalog import NOW1, NOW2, NOW3

ORACLE: dict[str, str] = {}
STAMPS = {1: NOW1, 2: NOW2, 3: NOW3}
WS = r"'^\s+|\s+$'"


def norm(expr: str) -> str:
    return f"NULLIF(upper(regexp_replace({expr}, {WS}, '', 'g')), '')"


def half_even(num: str, den: str) -> str:
    """Half-even rounding of num/den for integers (den > 0), sign-symmetric."""
    a = f"abs({num})"
    q = f"({a} // ({den}))"
    r = f"({a} % ({den}))"
    up = f"(CASE WHEN 2 * {r} > ({den}) OR (2 * {r} = ({den}) AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(sign({num}) * ({q} + {up}))"


def cents_to_dec(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2))"


def req_cte(c: int) -> str:
    kept = f"o_orderkey % 10 <> {1 if c == 2 else 0}" if c else "true"
    hours = "(o_orderkey % 80) / 4 + 0.125"
    if c == 2:
        hours = f"CASE WHEN o_orderkey % 7 = 0 THEN {hours} + 1 ELSE {hours} END"
    status = "CASE o_orderstatus WHEN 'O' THEN 'APPROVED' WHEN 'F' THEN 'CANCELED' WHEN 'P' THEN 'PENDING' END"
    if c == 2:
        status = (f"CASE WHEN o_orderkey % 23 = 0 THEN (CASE o_orderstatus WHEN 'O' THEN 'CANCELED' "
                  f"WHEN 'F' THEN 'APPROVED' ELSE 'PENDING' END) ELSE {status} END")
    return f"""req{c} AS (
  SELECT o_orderkey AS entry_idx, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
    ' emp-' || CAST(o_custkey AS VARCHAR) || ' ' AS employee_key,
    CAST(o_orderkey % 9 AS INTEGER) AS span,
    CASE WHEN o_orderkey % 4 = 3 THEN -CAST(o_orderkey % 9 AS INTEGER) ELSE CAST(o_orderkey % 9 AS INTEGER) END AS off,
    CASE WHEN o_orderkey % 29 = 0 THEN 'bad-' || CAST(o_orderkey AS VARCHAR)
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS TimeStart,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL
         ELSE strftime(o_orderdate + to_days(CASE WHEN o_orderkey % 4 = 3 THEN -CAST(o_orderkey % 9 AS INTEGER)
                                               ELSE CAST(o_orderkey % 9 AS INTEGER) END), '%Y-%m-%dT%H:%M:%S') END AS TimeEnd,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {hours} END AS NetHours,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE lower(substr(o_orderpriority, 3, 40)) END AS ReasonName,
    CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE o_orderpriority END AS PayAdjustmentCodeName,
    CASE WHEN o_orderkey % 34 = 0 THEN NULL ELSE 'PAY' || CAST(o_orderkey % 5 AS VARCHAR) END AS PayAdjustmentCodeXRefCode,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS PayAdjShortName,
    {status} AS Status,
    ((o_orderkey % 3 = 0 AND o_orderkey % 8 <> 0) OR (o_orderkey % 3 = 1 AND o_orderkey % 2 = 0)) AS has_list,
    (o_orderkey % 5 <> 0) AS list_complete
  FROM orders WHERE {kept}
)"""


#: The requests of one snapshot by itself: all orders.
REQ_WHOLE = req_cte(0).replace("req0 AS", "req1 AS", 1)


def ent_cte(c: int, multi: bool) -> str:
    """Per request: mode, scalars in cents, validity (mirrors expand.ledger_entries)."""
    m = "m" if multi else "s"
    spread = "WHEN TimeEnd IS NOT NULL AND TimeEnd <> '' THEN 'spread'" if multi else ""
    t = "CAST(round(COALESCE(NetHours, 0) * 1000) AS BIGINT)"
    return f"""ent{c}{m}a AS (
  SELECT *, {norm('employee_key')} AS emp_n,
    COALESCE(NULLIF(PayAdjustmentCodeName, ''), NULLIF(PayAdjustmentCodeXRefCode, ''), NULLIF(ReasonName, '')) AS type_raw,
    TRY_CAST(substr(TimeStart, 1, 10) AS DATE) AS d_start,
    TRY_CAST(substr(TimeEnd, 1, 10) AS DATE) AS d_end,
    {t} AS tot,
    CASE WHEN has_list AND list_complete THEN 'list' {spread} ELSE 'single' END AS mode
  FROM req{c}
), ent{c}{m}b AS (
  SELECT *, least(d_start, d_end) AS lo, date_diff('day', least(d_start, d_end), greatest(d_start, d_end)) + 1 AS n
  FROM ent{c}{m}a
), ent{c}{m}c AS (
  SELECT *, {half_even('tot', '10 * n')} AS per_c, {half_even('tot', '10')} AS one_c FROM ent{c}{m}b
), ent{c}{m} AS (
  SELECT *, {half_even('tot - per_c * 10 * (n - 1)', '10')} AS last_c,
    CASE WHEN type_raw IS NULL THEN 'no_type_code'
         WHEN emp_n IS NULL THEN 'bad_employee_key'
         WHEN {norm('type_raw')} IS NULL THEN 'bad_type_code'
         WHEN mode = 'list' THEN NULL
         WHEN mode = 'spread' AND (lo IS NULL OR (n = 1 AND one_c < 0) OR (n > 1 AND (per_c < 0 OR {half_even('tot - per_c * 10 * (n - 1)', '10')} < 0))) THEN 'bad_day'
         WHEN mode = 'single' AND (d_start IS NULL OR one_c < 0) THEN 'bad_day'
    END AS reject_reason
  FROM ent{c}{m}c
)"""


def days_cte(c: int, multi: bool) -> str:
    m = "m" if multi else "s"
    cnt = "CASE mode WHEN 'list' THEN span + 1 WHEN 'spread' THEN n ELSE 1 END"
    return f"""{ent_cte(c, multi)}, days{c}{m}x AS (
  SELECT e.*, CAST(g.i AS INTEGER) AS day_idx FROM ent{c}{m} e
  CROSS JOIN generate_series(0, ({cnt}) - 1) AS g(i)
  WHERE e.reject_reason IS NULL
), days{c}{m}y AS (
  SELECT *,
    CASE mode WHEN 'list' THEN CAST(o_orderdate AS DATE) + day_idx
              WHEN 'spread' THEN lo + day_idx ELSE d_start END AS pto_date,
    CASE mode WHEN 'list' THEN ((entry_idx + day_idx) % 9) * 100
              WHEN 'spread' THEN (CASE WHEN n = 1 THEN one_c WHEN day_idx = n - 1 THEN last_c ELSE per_c END)
              ELSE one_c END AS cents
  FROM days{c}{m}x
), days{c}{m} AS (
  SELECT entry_idx, day_idx, mode AS day_source, emp_n AS employee_xref, pto_date,
    {norm('type_raw')} AS approval_type_code, {cents_to_dec('cents')} AS hours_requested,
    ReasonName AS reason_name, NULLIF(Status, '') AS status,
    substr(sha256(emp_n || '|' || strftime(pto_date, '%Y-%m-%d') || '|' || {norm('type_raw')} || '|'
                  || CAST({cents_to_dec('cents')} AS VARCHAR)), 1, 16) AS record_hash
  FROM days{c}{m}y
)"""


DAY_COLS = (
    "entry_idx, day_idx, day_source, employee_xref, pto_date, approval_type_code, hours_requested, "
    "reason_name, status, record_hash"
)


def with_days(c: int, multi: bool) -> str:
    return f"{req_cte(c)}, {days_cte(c, multi)}"


def whole_days(multi: bool) -> str:
    return f"{REQ_WHOLE}, {days_cte(1, multi)}"


def cur_cte(c: int) -> str:
    return f"""cur{c} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_xref, pto_date, record_hash
                                               ORDER BY entry_idx, day_idx) AS rn FROM days{c}m) WHERE rn = 1
)"""


LEDGER_COLS = (
    "record_hash, employee_xref, pto_date, approval_type_code, hours_requested, reason_name, status, "
    "first_seen_at, last_seen_at, is_active, deleted_at, ingest_run_id"
)
EMPTY_LEDGER = """led0 AS (
  SELECT NULL::VARCHAR AS record_hash, NULL::VARCHAR AS employee_xref, NULL::DATE AS pto_date,
    NULL::VARCHAR AS approval_type_code, NULL::DECIMAL(6,2) AS hours_requested, NULL::VARCHAR AS reason_name,
    NULL::VARCHAR AS status, NULL::TIMESTAMP AS first_seen_at, NULL::TIMESTAMP AS last_seen_at,
    NULL::BOOLEAN AS is_active, NULL::TIMESTAMP AS deleted_at, NULL::VARCHAR AS ingest_run_id
  WHERE false
)"""


def apply_cte(c: int, prev: int | None = None, stamp: str | None = None, run: str | None = None) -> str:
    """M1 on led{prev} with cur{c}: app{c} (ledger + action + merge_action) and led{c}."""
    now = f"TIMESTAMP '{stamp or STAMPS[c]}'"
    p = c - 1 if prev is None else prev
    run = run or f"run-{c}"
    return f"""idn{c} AS (
  SELECT COALESCE(s.employee_xref, k.employee_xref) AS employee_xref, COALESCE(s.pto_date, k.pto_date) AS pto_date,
    COALESCE(s.record_hash, k.record_hash) AS record_hash,
    k.record_hash IS NOT NULL AS in_cur, s.record_hash IS NOT NULL AS sto_exists,
    (s.record_hash IS NOT NULL AND COALESCE(s.is_active, true)) AS st_active,
    k.approval_type_code AS k_type, k.hours_requested AS k_hours, k.reason_name AS k_reason, k.status AS k_status,
    s.approval_type_code AS s_type, s.hours_requested AS s_hours, s.reason_name AS s_reason, s.status AS s_status,
    s.first_seen_at AS s_first, s.last_seen_at AS s_last, s.is_active AS s_active, s.deleted_at AS s_deleted,
    s.ingest_run_id AS s_run
  FROM led{p} s FULL OUTER JOIN cur{c} k
    ON s.employee_xref = k.employee_xref AND s.pto_date = k.pto_date AND s.record_hash = k.record_hash
), flg{c} AS (
  SELECT *, (in_cur AND NOT st_active) AS fresh, (NOT in_cur AND st_active) AS gone FROM idn{c}
), sum{c} AS (
  SELECT employee_xref, pto_date, max(CAST(fresh AS INTEGER)) AS has_fresh, max(CAST(gone AS INTEGER)) AS has_gone,
    max(CASE WHEN gone THEN strftime(s_first, '%Y%m%d%H%M%S') || record_hash END) AS last_gone
  FROM flg{c} GROUP BY employee_xref, pto_date
), cls{c} AS (
  SELECT f.*,
    CASE WHEN in_cur AND st_active THEN 'unchanged'
         WHEN fresh AND has_gone = 1 THEN 'changed'
         WHEN fresh THEN 'new'
         WHEN gone AND has_fresh = 1 AND strftime(s_first, '%Y%m%d%H%M%S') || f.record_hash = last_gone THEN 'superseded'
         WHEN gone THEN 'cancelled' END AS action,
    CASE WHEN in_cur AND NOT sto_exists THEN 'insert'
         WHEN in_cur AND NOT st_active THEN 'reactivate'
         WHEN in_cur AND s_last IS NOT DISTINCT FROM {now} THEN 'noop'
         WHEN in_cur THEN 'touch'
         WHEN gone THEN 'cancel' ELSE 'keep' END AS merge_action
  FROM flg{c} f JOIN sum{c} USING (employee_xref, pto_date)
), app{c} AS (
  SELECT record_hash, employee_xref, pto_date,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN k_type ELSE s_type END AS approval_type_code,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN k_hours ELSE s_hours END AS hours_requested,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN k_reason ELSE s_reason END AS reason_name,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN k_status ELSE s_status END AS status,
    CASE WHEN merge_action = 'insert' THEN {now} ELSE COALESCE(s_first, {now}) END AS first_seen_at,
    CASE WHEN in_cur THEN {now} ELSE s_last END AS last_seen_at,
    CASE WHEN in_cur THEN true WHEN gone THEN false ELSE COALESCE(s_active, true) END AS is_active,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN NULL::TIMESTAMP WHEN gone THEN {now} ELSE s_deleted END AS deleted_at,
    CASE WHEN merge_action IN ('insert', 'reactivate') THEN '{run}' ELSE s_run END AS ingest_run_id,
    action, merge_action
  FROM cls{c}
), led{c} AS (SELECT {LEDGER_COLS} FROM app{c})"""


def ledger_with(upto: int) -> str:
    parts = [EMPTY_LEDGER]
    for c in range(1, upto + 1):
        src = 1 if c == 3 else c
        parts.append(req_cte(src).replace(f"req{src} AS", f"req{c} AS", 1) if c == 3 else req_cte(c))
        parts.append(days_cte(c, True))
        parts.append(cur_cte(c))
        parts.append(apply_cte(c))
    return "WITH " + ",\n".join(parts)


def ledger_view(src: str) -> str:
    return f"""SELECT record_hash, employee_xref, pto_date, approval_type_code, hours_requested, reason_name, status,
  is_active, ingest_run_id, strftime(first_seen_at, '%Y-%m-%d %H:%M:%S') AS first_seen_at,
  strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') AS last_seen_at, strftime(deleted_at, '%Y-%m-%d %H:%M:%S') AS deleted_at,
  action, merge_action FROM {src}"""


# --------------------------------------------------------------------------- #
ORACLE["identity_hash"] = f"""
WITH x AS (
  SELECT o_orderkey, {norm("' emp-' || CAST(o_custkey AS VARCHAR) || ' '")} AS k,
    strftime(o_orderdate, '%Y-%m-%d') AS d, {norm("'  ' || lower(o_orderpriority)")} AS t,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE CAST(round_even(CAST((o_orderkey % 80) / 4 + 0.125 AS DECIMAL(38,18)), 2) AS DECIMAL(6,2)) END AS h
  FROM orders
)
SELECT o_orderkey,
  CASE WHEN k IS NOT NULL AND d IS NOT NULL AND t IS NOT NULL AND h IS NOT NULL
       THEN k || '|' || d || '|' || t || '|' || CAST(h AS VARCHAR) END AS canonical,
  CASE WHEN k IS NOT NULL AND d IS NOT NULL AND t IS NOT NULL AND h IS NOT NULL
       THEN substr(sha256(k || '|' || d || '|' || t || '|' || CAST(h AS VARCHAR)), 1, 16) END AS record_hash
FROM x
"""

# A double is read through its shortest decimal text, as the source system did.
_H = "CAST(round_even(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(6,2))"


def _hours(x: str) -> str:
    h = _H.format(x=x)
    return f"CASE WHEN {h} >= 0 THEN {h} END"


ORACLE["hours_half_even"] = f"""
SELECT l_orderkey, l_linenumber,
  {_hours('l_quantity / 8 + l_discount - 1')} AS hours,
  {_hours("' ' || CAST(l_quantity / 8 + l_discount - 1 AS VARCHAR) || ' '")} AS hours_from_text,
  CAST({_hours('l_quantity / 8')} AS VARCHAR) AS hours_text
FROM lineitem
"""

ORACLE["expand_daylist"] = f"WITH {whole_days(False)} SELECT {DAY_COLS} FROM days1s WHERE day_source = 'list'"
ORACLE["expand_even"] = f"WITH {whole_days(True)} SELECT {DAY_COLS} FROM days1m WHERE day_source = 'spread'"
ORACLE["expand_choice"] = f"WITH {whole_days(True)} SELECT {DAY_COLS} FROM days1m"
ORACLE["expand_single"] = f"WITH {whole_days(False)} SELECT {DAY_COLS} FROM days1s"
ORACLE["expand_quarantine"] = f"""WITH {REQ_WHOLE}, {ent_cte(1, True)}
SELECT entry_idx, employee_key, reject_reason FROM ent1m WHERE reject_reason IS NOT NULL"""

ORACLE["split_sum_check"] = f"""WITH {whole_days(True)},
per AS (SELECT entry_idx, count(*) AS n_days, CAST(sum(hours_requested) AS DECIMAL(12,2)) AS split_total
        FROM days1m WHERE day_source = 'spread' GROUP BY entry_idx),
tot AS (SELECT entry_idx, CAST({cents_to_dec(half_even('CAST(round(COALESCE(NetHours, 0) * 1000) AS BIGINT)', '10'))}
                                AS DECIMAL(12,2)) AS entry_total FROM req1)
SELECT per.entry_idx, n_days, split_total, entry_total, split_total = entry_total AS preserved
FROM per JOIN tot USING (entry_idx)
"""

ORACLE["expand_weekdays"] = f"""WITH {REQ_WHOLE},
tag AS (
  SELECT trim(employee_key) AS XRefCode, Status AS st, CASE Status WHEN 'APPROVED' THEN 0 ELSE 1 END AS status_rank,
    entry_idx, TRY_CAST(TimeStart AS TIMESTAMP) AS ts0, TRY_CAST(TimeEnd AS TIMESTAMP) AS ts1, NetHours,
    ReasonName, PayAdjShortName,
    CASE WHEN PayAdjShortName IS NOT NULL AND PayAdjShortName <> '' THEN PayAdjShortName
         ELSE COALESCE(ReasonName, 'None') END AS typ
  FROM req1 WHERE Status IN ('APPROVED', 'CANCELED')
),
wk AS (
  SELECT *, CASE WHEN ts1 > ts0 THEN list_filter(generate_series(ts0, ts1 - INTERVAL 1 MICROSECOND, INTERVAL 1 DAY),
                                                  lambda d: isodow(d) <= 5) ELSE [] END AS days
  FROM tag WHERE ts0 IS NOT NULL AND ts1 IS NOT NULL
),
per AS (
  SELECT *, len(days) AS n,
    CASE WHEN NetHours IS NULL THEN 800
         ELSE {half_even('CAST(round(NetHours * 1000) AS BIGINT)', '10 * greatest(len(days), 1)')} END AS cents
  FROM wk
),
rows AS (
  SELECT p.*, CAST(g.i AS INTEGER) AS day_idx, CAST(p.days[g.i + 1] AS DATE) AS dt
  FROM per p CROSS JOIN generate_series(0, p.n - 1) AS g(i)
)
SELECT CAST(status_rank AS INTEGER) AS status_rank, 0 AS window_idx, entry_idx, day_idx, XRefCode, dt AS Date,
  {cents_to_dec('cents')} AS Hours, ReasonName, PayAdjShortName,
  CASE st WHEN 'APPROVED' THEN 'Approved' ELSE 'Canceled' END AS Status,
  substr(sha256({norm('XRefCode')} || '|' || strftime(dt, '%Y-%m-%d') || '|' || {norm('typ')} || '|'
                || CAST({cents_to_dec('cents')} AS VARCHAR)), 1, 16) AS RecordHash
FROM rows
"""

ORACLE["dedupe_first"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1
"""

ORACLE["dedupe_day_records"] = f"""WITH {whole_days(True)}, {cur_cte(1)} SELECT {DAY_COLS} FROM cur1"""

ORACLE["reconcile_actions"] = f"""{ledger_with(2)}
SELECT employee_xref, pto_date, record_hash, action FROM app2 WHERE action IS NOT NULL"""

ORACLE["reconcile_counts"] = f"""{ledger_with(2)}
SELECT count(*) FILTER (WHERE action = 'new') AS new, count(*) FILTER (WHERE action = 'changed') AS changed,
  count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'cancelled') AS cancelled,
  count(*) FILTER (WHERE action = 'superseded') AS superseded
FROM app2"""

ORACLE["snapshot_overlap"] = f"""WITH {with_days(1, True)}, {req_cte(2)}, {days_cte(2, True)},
h1 AS (SELECT DISTINCT record_hash FROM days1m), h2 AS (SELECT DISTINCT record_hash FROM days2m),
j AS (SELECT h1.record_hash AS a, h2.record_hash AS b FROM h1 FULL OUTER JOIN h2 ON h1.record_hash = h2.record_hash)
SELECT count(a) AS n_cycle1, count(b) AS n_cycle2, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS n_both,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) = 0 AS disjoint FROM j"""

ORACLE["ledger_apply"] = f"{ledger_with(2)}\n{ledger_view('app2')}"
ORACLE["ledger_reactivate"] = f"{ledger_with(3)}\n{ledger_view('app3')}"

_COUNTS = """count(*) FILTER (WHERE merge_action = 'insert') AS inserted,
  count(*) FILTER (WHERE merge_action = 'update') AS updated,
  count(*) FILTER (WHERE merge_action = 'reactivate') AS reactivated,
  count(*) FILTER (WHERE merge_action = 'touch') AS touched,
  count(*) FILTER (WHERE merge_action = 'cancel') AS cancelled"""
ORACLE["ledger_stats"] = f"""{ledger_with(3)}
SELECT 1 AS cycle, {_COUNTS} FROM app1 UNION ALL SELECT 2 AS cycle, {_COUNTS} FROM app2
UNION ALL SELECT 3 AS cycle, {_COUNTS} FROM app3"""

_CANON = "employee_xref || '|' || strftime(pto_date, '%Y-%m-%d') || '|' || approval_type_code || '|' || CAST(hours_requested AS VARCHAR)"
ORACLE["hash_collisions"] = f"""WITH {whole_days(True)},
g AS (SELECT record_hash, count(DISTINCT {_CANON}) AS n_texts FROM days1m GROUP BY record_hash)
SELECT count(*) AS n_hashes, count(*) FILTER (WHERE n_texts > 1) AS n_colliding FROM g"""

ORACLE["hash_migrate_v1"] = f"""WITH {whole_days(True)}
SELECT entry_idx, day_idx, substr(sha256({_CANON}), 1, 16) AS migrated,
  substr(sha256({_CANON}), 1, 16) = record_hash AS matches_v2 FROM days1m"""


# --------------------------------------------------------------------------- #
# Roster, detail payloads, mapping                                            #
# --------------------------------------------------------------------------- #
ROS = """ros AS (
  SELECT CAST(c_custkey // 50 AS BIGINT) AS page_idx, CAST(c_custkey % 50 AS INTEGER) AS row_idx,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN ' x-' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 2 = 0 THEN 'emp-' || CAST(c_custkey AS VARCHAR) || ' '
         ELSE 'EMP-' || CAST(c_custkey AS VARCHAR) END AS XRefCode,
    c_name AS FirstName, c_mktsegment AS LastName, 'ORG-' || CAST(c_nationkey AS VARCHAR) AS org_x, c_mktsegment AS org_s
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey // 50 AS BIGINT) + 1000, CAST(c_custkey % 50 AS INTEGER),
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN ' x-' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 2 = 0 THEN 'emp-' || CAST(c_custkey AS VARCHAR) || ' '
         ELSE 'EMP-' || CAST(c_custkey AS VARCHAR) END,
    lower(c_name), c_mktsegment, 'ORG-' || CAST(c_nationkey AS VARCHAR), c_mktsegment
  FROM customer WHERE c_custkey % 13 = 0
)"""

SCOPE = f"""{ROS}, scoped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY XRefCode ORDER BY page_idx, row_idx) AS rn
                 FROM ros WHERE upper(trim(XRefCode)) LIKE 'EMP%') WHERE rn = 1
)"""

ES_DEPT = "CASE WHEN c_custkey % 20 <> 15 THEN 'OU_' || CAST(c_nationkey AS VARCHAR) ELSE 'HO_' || CAST(c_nationkey AS VARCHAR) END"
WA0 = ("CASE WHEN c_custkey % 4 <> 1 THEN 'DEPT_' || CAST(c_nationkey AS VARCHAR) "
       "ELSE 'DEPT_' || CAST((c_nationkey + 3) % 25 AS VARCHAR) END")
WA1 = "'DEPT_' || CAST((c_nationkey + 7) % 25 AS VARCHAR)"
DET = f"""det AS (
  SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, 'emp-' || CAST(c_custkey AS VARCHAR) AS XRefCode,
    'EMP-' || CAST(c_custkey AS VARCHAR) AS k_norm, c_name AS DisplayName,
    CASE WHEN c_custkey % 4 = 0 THEN (CASE WHEN c_acctbal < 0 THEN 'TERMINATED' ELSE 'INACTIVE' END)
         ELSE 'ACTIVE' END AS employment_status,
    CASE WHEN c_custkey % 2 = 0 THEN 'Dept_' || CAST((c_nationkey + 3) % 25 AS VARCHAR) END AS p7,
    CASE WHEN c_custkey % 10 = 5 THEN {ES_DEPT} ELSE {WA0} END AS dept_past,
    CASE WHEN c_custkey % 10 = 5 THEN {ES_DEPT} ELSE {WA1} END AS dept_now,
    CASE WHEN c_custkey % 10 = 5 THEN {ES_DEPT} WHEN c_custkey % 3 = 1 THEN {WA1} ELSE {WA0} END AS dept_early
  FROM customer
)"""

MAP = f"""mrows AS (
  SELECT CASE n_nationkey % 3 WHEN 0 THEN ' dept_' || CAST(n_nationkey AS VARCHAR) || ' '
              WHEN 1 THEN 'DEPT_' || CAST(n_nationkey AS VARCHAR) ELSE 'Dept_' || CAST(n_nationkey AS VARCHAR) END AS department,
    CAST(1000 + n_regionkey AS INTEGER) AS project_id, CAST(5000 + n_nationkey AS INTEGER) AS task_id,
    CAST(n_nationkey AS INTEGER) AS ordinal
  FROM nation WHERE n_regionkey <> 4
  UNION ALL
  SELECT 'dept_' || CAST(r_regionkey * 5 AS VARCHAR), CAST(3000 + r_regionkey AS INTEGER),
    CASE WHEN r_regionkey <> 3 THEN CAST(6000 + r_regionkey AS INTEGER) END, CAST(100 + r_regionkey AS INTEGER)
  FROM region
), dmap AS (
  SELECT dept_key, department, project_id, task_id FROM (
    SELECT *, {norm('department')} AS dept_key,
      row_number() OVER (PARTITION BY {norm('department')} ORDER BY ordinal DESC) AS rn
    FROM mrows WHERE project_id IS NOT NULL AND task_id IS NOT NULL) WHERE rn = 1 AND dept_key IS NOT NULL
)"""

ORACLE["roster_scope"] = f"""WITH {SCOPE}
SELECT XRefCode, FirstName, LastName, org_s AS "HomeOrganization.ShortName", org_x AS "HomeOrganization.XRefCode"
FROM scoped"""

ORACLE["roster_flatten"] = f"""WITH {ROS}
SELECT XRefCode, FirstName, LastName, org_s AS "HomeOrganization.ShortName", org_x AS "HomeOrganization.XRefCode",
  page_idx, row_idx FROM ros"""

ORACLE["employee_keys"] = f"""WITH {ROS}
SELECT XRefCode, page_idx, row_idx FROM ros WHERE XRefCode IS NOT NULL AND XRefCode <> ''"""

ORACLE["status_latest"] = f"WITH {DET} SELECT XRefCode, DisplayName, employment_status FROM det"
ORACLE["primary_department"] = f"WITH {DET} SELECT XRefCode, p7 AS DepartmentXRefCode FROM det"
ORACLE["department_as_of"] = f"WITH {DET} SELECT XRefCode, dept_past, dept_now FROM det"
ORACLE["department_fallback"] = f"WITH {DET} SELECT XRefCode, dept_early AS department_xref FROM det"

ORACLE["map_validate"] = f"""WITH {MAP}
SELECT count(*) AS n_entries, count(DISTINCT {norm('department')}) AS n_keys,
  count(*) FILTER (WHERE project_id IS NULL) AS n_missing_project,
  count(*) FILTER (WHERE task_id IS NULL) AS n_missing_task,
  count(*) FILTER (WHERE {norm('department')} IS NULL) AS n_blank_keys,
  count(*) > 0 AND count(*) FILTER (WHERE project_id IS NULL) = 0 AND count(*) FILTER (WHERE task_id IS NULL) = 0 AS valid
FROM mrows"""

ORACLE["department_map"] = f"WITH {MAP} SELECT dept_key, department, project_id, task_id FROM dmap"

ORACLE["department_lookup"] = f"""WITH {DET}, {MAP}
SELECT XRefCode, dept_now AS department_xref, project_id, task_id
FROM det LEFT JOIN dmap ON dmap.dept_key = {norm('dept_now')}"""

EMP_ROWS = f"""{SCOPE}, {DET}, {MAP}, emprows AS (
  SELECT s.XRefCode, d.DisplayName AS employee_name, d.p7 AS DepartmentXRefCode, m.project_id AS ProjectId,
    m.task_id AS TaskId, d.employment_status
  FROM (SELECT DISTINCT XRefCode FROM scoped) s
  LEFT JOIN det d ON d.k_norm = {norm('s.XRefCode')}
  JOIN dmap m ON m.dept_key = {norm('d.p7')}
)"""
ORACLE["employee_rows"] = f"WITH {EMP_ROWS} SELECT * FROM emprows"
ORACLE["inactive_status_counts"] = f"""WITH {EMP_ROWS}
SELECT employment_status, count(*) AS n FROM emprows WHERE employment_status IS DISTINCT FROM 'ACTIVE'
GROUP BY employment_status"""

ASOF = f"""{ROS}, {DET}, {MAP}, keys AS (
  SELECT XRefCode, page_idx, row_idx FROM ros WHERE XRefCode IS NOT NULL AND XRefCode <> ''
), asofr AS (
  SELECT DISTINCT k.XRefCode AS xref, d.dept_now AS department_xref, m.project_id, m.task_id,
    CASE WHEN d.dept_now IS NULL THEN 'unresolved' WHEN m.project_id IS NULL THEN 'unmapped'
         ELSE 'kept' END AS outcome
  FROM keys k LEFT JOIN det d ON d.k_norm = {norm('k.XRefCode')}
  LEFT JOIN dmap m ON m.dept_key = {norm('d.dept_now')}
  {{where}}
)"""
ORACLE["scope_counts"] = f"""WITH {ASOF.format(where='').replace('SELECT DISTINCT k.XRefCode', 'SELECT k.XRefCode')}
SELECT count(*) FILTER (WHERE outcome = 'kept') AS kept, count(*) FILTER (WHERE outcome = 'unmapped') AS unmapped,
  count(*) FILTER (WHERE outcome = 'unresolved') AS unresolved FROM asofr"""
_SUB = ("WHERE CAST(regexp_extract(k.XRefCode, '(\\d+)', 1) AS BIGINT) IN "
        "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
ORACLE["roster_subset"] = f"WITH {ASOF.format(where=_SUB)} SELECT * FROM asofr"
ORACLE["job_roster_asof"] = f"""WITH {ASOF.format(where='')}
SELECT xref, department_xref, project_id, task_id FROM asofr WHERE outcome = 'kept'"""


# --------------------------------------------------------------------------- #
# Day table (Flow B) and employee table merges                                #
# --------------------------------------------------------------------------- #
def wk_cte(c, tag_sql: str | None = None) -> str:
    """Weekday rows of cycle ``c`` (wkrows{c}) and their first-wins dedupe (daysrc{c})."""
    if tag_sql is None:
        tag_sql = f"""SELECT trim(employee_key) AS XRefCode, Status AS st, CASE Status WHEN 'APPROVED' THEN 0 ELSE 1 END AS status_rank,
    0 AS window_idx, entry_idx, TimeStart, TimeEnd, NetHours, ReasonName, PayAdjShortName
  FROM req{c} WHERE Status IN ('APPROVED', 'CANCELED')"""
    return f"""tag{c} AS (
  SELECT XRefCode, st, status_rank, window_idx, entry_idx, TRY_CAST(TimeStart AS TIMESTAMP) AS ts0,
    TRY_CAST(TimeEnd AS TIMESTAMP) AS ts1, NetHours, ReasonName, PayAdjShortName,
    CASE WHEN PayAdjShortName IS NOT NULL AND PayAdjShortName <> '' THEN PayAdjShortName
         ELSE COALESCE(ReasonName, 'None') END AS typ
  FROM ({tag_sql})
), wk{c} AS (
  SELECT *, CASE WHEN ts1 > ts0 THEN list_filter(generate_series(ts0, ts1 - INTERVAL 1 MICROSECOND, INTERVAL 1 DAY),
                                                  lambda d: isodow(d) <= 5) ELSE [] END AS days
  FROM tag{c} WHERE ts0 IS NOT NULL AND ts1 IS NOT NULL
), per{c} AS (
  SELECT *, len(days) AS n,
    CASE WHEN NetHours IS NULL THEN 800
         ELSE {half_even('CAST(round(NetHours * 1000) AS BIGINT)', '10 * greatest(len(days), 1)')} END AS cents
  FROM wk{c}
), wkx{c} AS (
  SELECT p.*, CAST(g.i AS INTEGER) AS day_idx, CAST(p.days[g.i + 1] AS DATE) AS dt
  FROM per{c} p CROSS JOIN generate_series(0, p.n - 1) AS g(i)
), wkrows{c} AS (
  SELECT CAST(status_rank AS INTEGER) AS status_rank, CAST(window_idx AS INTEGER) AS window_idx, entry_idx, day_idx,
    XRefCode, dt AS Date,
    {cents_to_dec('cents')} AS Hours, ReasonName, PayAdjShortName,
    CASE st WHEN 'APPROVED' THEN 'Approved' ELSE 'Canceled' END AS Status,
    substr(sha256({norm('XRefCode')} || '|' || strftime(dt, '%Y-%m-%d') || '|' || {norm('typ')} || '|'
                  || CAST({cents_to_dec('cents')} AS VARCHAR)), 1, 16) AS RecordHash
  FROM wkx{c}
), daysrc{c} AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY RecordHash
      ORDER BY status_rank, window_idx, entry_idx, day_idx) AS rn FROM wkrows{c}) WHERE rn = 1
)"""


ORACLE["expand_weekdays"] = f"WITH {REQ_WHOLE}, {wk_cte(1)} SELECT * FROM wkrows1"
ORACLE["day_rows_deduped"] = f"WITH {REQ_WHOLE}, {wk_cte(1)} SELECT * FROM daysrc1"

WIN = "DATE '1997-01-01' AND DATE '1999-12-31'"
N1, N2 = f"TIMESTAMP '{NOW1}'", f"TIMESTAMP '{NOW2}'"


def day_merge_sql(keys_sql: str) -> str:
    return f"""WITH {req_cte(1)}, {wk_cte(1)}, {req_cte(2)}, {wk_cte(2)},
dt1 AS (SELECT XRefCode, Date, Hours, ReasonName, PayAdjShortName, Status, RecordHash, {N1} AS UpdatedDateTime FROM daysrc1),
rk AS (SELECT DISTINCT k AS XRefCode FROM ({keys_sql}) AS q(k)),
tgt AS (SELECT t.*, rk.XRefCode IS NOT NULL AS in_run FROM dt1 t LEFT JOIN rk ON t.XRefCode = rk.XRefCode),
j AS (
  SELECT COALESCE(t.RecordHash, s.RecordHash) AS RecordHash, t.RecordHash IS NOT NULL AS has_t, s.RecordHash IS NOT NULL AS has_s,
    t.XRefCode AS t_x, t.Date AS t_d, t.Hours AS t_h, t.ReasonName AS t_r, t.PayAdjShortName AS t_p, t.Status AS t_s,
    t.UpdatedDateTime AS t_u, t.in_run,
    s.XRefCode AS s_x, s.Date AS s_d, s.Hours AS s_h, s.ReasonName AS s_r, s.PayAdjShortName AS s_p, s.Status AS s_s
  FROM tgt t FULL OUTER JOIN daysrc2 s ON t.RecordHash = s.RecordHash
),
a AS (
  SELECT *, CASE
    WHEN NOT has_t THEN 'insert'
    WHEN has_s AND (t_s IS DISTINCT FROM s_s OR t_r IS DISTINCT FROM s_r OR t_p IS DISTINCT FROM s_p OR t_u IS NULL) THEN 'update'
    WHEN has_s THEN 'unchanged'
    WHEN in_run AND t_d BETWEEN {WIN} AND t_s <> 'Canceled' THEN 'cancel'
    ELSE 'keep' END AS merge_action
  FROM j
),
merged AS (
  SELECT RecordHash,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_x ELSE t_x END AS XRefCode,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_d ELSE t_d END AS Date,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_h ELSE t_h END AS Hours,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_r ELSE t_r END AS ReasonName,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_p ELSE t_p END AS PayAdjShortName,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_s WHEN merge_action = 'cancel' THEN 'Canceled' ELSE t_s END AS Status,
    CASE WHEN merge_action IN ('insert', 'update', 'cancel') THEN {N2} ELSE t_u END AS UpdatedDateTime,
    merge_action
  FROM a
)"""


_DAY_VIEW = ("SELECT XRefCode, Date, Hours, ReasonName, PayAdjShortName, Status, RecordHash, "
             "strftime(UpdatedDateTime, '%Y-%m-%d %H:%M:%S') AS UpdatedDateTime, merge_action FROM merged")
_RUN_KEYS = "SELECT trim(employee_key) FROM req2 WHERE Status IN ('APPROVED', 'CANCELED')"
_BUILDING = "SELECT 'emp-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'"
ORACLE["day_merge"] = f"{day_merge_sql(_RUN_KEYS)}\n{_DAY_VIEW}"
ORACLE["day_merge_scoped"] = f"{day_merge_sql(_BUILDING)}\n{_DAY_VIEW}"

EMP_MERGE = f"""WITH {EMP_ROWS},
et1 AS (
  SELECT XRefCode, employee_name, DepartmentXRefCode, ProjectId, TaskId, employment_status,
    CASE WHEN CAST(regexp_extract(XRefCode, '(\\d+)', 1) AS BIGINT) % 17 = 0 THEN NULL ELSE {N1} END AS UpdatedDateTime
  FROM emprows
),
src AS (
  SELECT XRefCode,
    CASE WHEN n % 5 = 0 THEN upper(employee_name) ELSE employee_name END AS employee_name,
    DepartmentXRefCode, ProjectId, TaskId,
    CASE WHEN n % 7 = 0 THEN NULL WHEN n % 3 = 0 THEN 'TERMINATED' ELSE employment_status END AS employment_status
  FROM (SELECT *, CAST(regexp_extract(XRefCode, '(\\d+)', 1) AS BIGINT) AS n FROM emprows) WHERE n % 11 <> 0
),
j AS (
  SELECT COALESCE(t.XRefCode, s.XRefCode) AS XRefCode, t.XRefCode IS NOT NULL AS has_t, s.XRefCode IS NOT NULL AS has_s,
    t.employee_name AS t_n, t.DepartmentXRefCode AS t_d, t.ProjectId AS t_p, t.TaskId AS t_k, t.employment_status AS t_e,
    t.UpdatedDateTime AS t_u,
    s.employee_name AS s_n, s.DepartmentXRefCode AS s_d, s.ProjectId AS s_p, s.TaskId AS s_k, s.employment_status AS s_e
  FROM et1 t FULL OUTER JOIN src s ON t.XRefCode = s.XRefCode
),
a AS (
  SELECT *, CASE WHEN NOT has_t THEN 'insert' WHEN NOT has_s THEN 'keep'
    WHEN t_n IS DISTINCT FROM s_n OR t_d IS DISTINCT FROM s_d OR t_p IS DISTINCT FROM s_p OR t_k IS DISTINCT FROM s_k
         OR t_e IS DISTINCT FROM s_e OR t_u IS NULL THEN 'update'
    ELSE 'unchanged' END AS merge_action
  FROM j
),
merged AS (
  SELECT XRefCode,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_n ELSE t_n END AS employee_name,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_d ELSE t_d END AS DepartmentXRefCode,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_p ELSE t_p END AS ProjectId,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_k ELSE t_k END AS TaskId,
    CASE WHEN merge_action IN ('insert', 'update') THEN s_e ELSE t_e END AS employment_status,
    CASE WHEN merge_action = 'insert' THEN {N2}
         WHEN merge_action = 'update' AND NOT (t_e IS NOT DISTINCT FROM s_e AND t_u IS NOT NULL) THEN {N2}
         ELSE t_u END AS UpdatedDateTime,
    merge_action
  FROM a
)"""
ORACLE["employee_merge"] = f"""{EMP_MERGE}
SELECT XRefCode, employee_name, DepartmentXRefCode, ProjectId, TaskId, employment_status,
  strftime(UpdatedDateTime, '%Y-%m-%d %H:%M:%S') AS UpdatedDateTime, merge_action FROM merged"""

_A8 = """count(*) FILTER (WHERE merge_action = 'insert') AS num_inserted_rows,
  count(*) FILTER (WHERE merge_action IN ('update', 'cancel')) AS num_updated_rows,
  count(*) FILTER (WHERE merge_action IN ('insert', 'update', 'cancel')) AS num_affected_rows,
  count(*) FILTER (WHERE merge_action = 'unchanged') AS num_unchanged_source_rows"""
ORACLE["merge_metrics"] = f"""WITH e AS ({EMP_MERGE} SELECT 'employee' AS target, {_A8} FROM merged),
d AS ({day_merge_sql(_RUN_KEYS)} SELECT 'day' AS target, {_A8} FROM merged)
SELECT * FROM e UNION ALL SELECT * FROM d"""


# --------------------------------------------------------------------------- #
# Pages, windows, scalar helpers, typed tables, metrics                      #
# --------------------------------------------------------------------------- #
EV = "ev AS (SELECT * FROM events)"
EV_GAPS = "ev AS (SELECT * FROM events WHERE value <= 45)"
PAGE_ROWS = f"""{EV}, prows AS (
  SELECT event_id AS page_id, 0 AS row_idx, 'emp-' || CAST(user_id AS VARCHAR) AS XRefCode, event_type AS FirstName,
    'ORG-' || CAST(user_id % 7 AS VARCHAR) AS org_xref
  FROM ev WHERE event_type IN ('view', 'click', 'signup')
  UNION ALL
  SELECT event_id, 1, CASE WHEN user_id % 2 = 0 THEN NULL ELSE 'emp-' || CAST(user_id + 1 AS VARCHAR) END,
    event_type, 'ORG-' || CAST((user_id + 1) % 7 AS VARCHAR)
  FROM ev WHERE event_type = 'click'
)"""
ORACLE["page_unwrap"] = f"WITH {PAGE_ROWS} SELECT * FROM prows"
ORACLE["page_employee_keys"] = f"WITH {PAGE_ROWS} SELECT page_id, row_idx, XRefCode FROM prows WHERE XRefCode IS NOT NULL"
ORACLE["page_denials"] = f"""WITH {EV}
SELECT event_id AS page_id, 'Too Many Requests for this tenant' AS message FROM ev WHERE event_type = 'error'"""
ORACLE["page_gaps"] = f"""WITH {EV_GAPS}, ptr AS (
  SELECT event_id AS page_id, 'p/' || CAST(event_id + 1 AS VARCHAR) AS next_url FROM ev WHERE event_type IN ('view', 'click')
)
SELECT page_id, next_url FROM ptr WHERE NOT EXISTS (SELECT 1 FROM ev WHERE 'p/' || CAST(ev.event_id AS VARCHAR) = ptr.next_url)"""
ORACLE["single_unwrap"] = """SELECT 'emp-' || CAST(c_custkey AS VARCHAR) AS XRefCode, c_name AS DisplayName, c_custkey % 2 = 0 AS wrapped
FROM customer"""

SPAN = """span AS (SELECT o_custkey, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)"""
ORACLE["window_chunks"] = f"""WITH {SPAN}
SELECT o_custkey, CAST(g.i AS INTEGER) AS window_idx,
  strftime(first + to_days(CAST(30 * g.i AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS lo,
  strftime(least(first + to_days(CAST(30 * g.i + 30 AS INTEGER)), last), '%Y-%m-%d %H:%M:%S') AS hi
FROM span CROSS JOIN generate_series(0, CAST(ceil(date_diff('day', first, last) / 30.0) AS BIGINT) - 1) AS g(i)
WHERE first < last"""
ORACLE["window_inclusive"] = f"""WITH {SPAN}, d AS (SELECT o_custkey, CAST(first AS DATE) AS a, CAST(last AS DATE) AS b FROM span)
SELECT o_custkey, CAST(g.i AS INTEGER) AS window_idx, CAST(a + CAST(31 * g.i AS INTEGER) AS DATE) AS lo,
  CAST(least(a + CAST(31 * g.i + 30 AS INTEGER), b) AS DATE) AS hi
FROM d CROSS JOIN generate_series(0, date_diff('day', a, b) // 31) AS g(i)"""
ORACLE["lookback_span"] = """SELECT strftime(now, '%Y-%m-%d %H:%M:%S') AS now,
  strftime(date_trunc('day', now - INTERVAL 30 DAY), '%Y-%m-%dT%H:%M:%S.%gZ') AS span_start,
  strftime(date_trunc('day', now + INTERVAL 90 DAY) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%gZ') AS span_end,
  4 AS n_windows
FROM (SELECT DISTINCT o_orderdate AS now FROM orders)"""

NOW_SPAN_SQL = "TIMESTAMP '1998-06-15 10:30:00'"
WINDOWS = f"""wins AS (
  SELECT CAST(i AS INTEGER) AS window_idx, {NOW_SPAN_SQL} - INTERVAL 30 DAY + to_days(CAST(30 * i AS INTEGER)) AS lo,
    {NOW_SPAN_SQL} - INTERVAL 30 DAY + to_days(CAST(30 * i + 30 AS INTEGER)) AS hi
  FROM generate_series(0, 3) AS g(i)
), sts AS (SELECT 0 AS status_rank, 'APPROVED' AS status UNION ALL SELECT 1, 'CANCELED')"""
ORACLE["request_manifest"] = f"""WITH {ROS}, {WINDOWS}, k AS (
  SELECT DISTINCT trim(XRefCode) AS XRefCode FROM ros WHERE XRefCode IS NOT NULL AND XRefCode <> ''
)
SELECT XRefCode, status_rank, status, window_idx, strftime(lo, '%Y-%m-%d %H:%M:%S') AS lo,
  strftime(hi, '%Y-%m-%d %H:%M:%S') AS hi
FROM k, sts, wins"""
ORACLE["requests_in_span"] = f"""WITH {REQ_WHOLE}, {WINDOWS}, r AS (
  SELECT entry_idx, trim(employee_key) AS XRefCode, Status, TRY_CAST(TimeStart AS TIMESTAMP) AS ts0,
    TRY_CAST(TimeEnd AS TIMESTAMP) AS ts1 FROM req1
)
SELECT r.entry_idx, r.XRefCode, r.Status, sts.status_rank, wins.window_idx
FROM r JOIN sts ON r.Status = sts.status JOIN wins ON r.ts0 <= wins.hi AND COALESCE(r.ts1, r.ts0) >= wins.lo
WHERE r.ts0 IS NOT NULL"""

ORACLE["bool_parse"] = """WITH x AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN CAST(user_id % 2 AS VARCHAR)
    WHEN 'click' THEN (CASE WHEN user_id % 3 = 0 THEN 'Yes' ELSE 'no' END)
    WHEN 'signup' THEN '' WHEN 'purchase' THEN NULL ELSE ' T ' END AS flag_text FROM events
)
SELECT event_id, flag_text,
  CASE WHEN flag_text IS NULL OR flag_text = '' THEN NULL
       ELSE lower(trim(flag_text)) IN ('1', 'true', 'yes', 'y', 't') END AS flag FROM x"""
ORACLE["status_title"] = f"""WITH {REQ_WHOLE}
SELECT entry_idx, Status, CASE Status WHEN 'APPROVED' THEN 'Approved' WHEN 'CANCELED' THEN 'Canceled'
  WHEN 'PENDING' THEN 'Pending' END AS status_title FROM req1"""
ORACLE["iso_instant"] = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso FROM events"
ORACLE["now_truncate"] = "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_seconds FROM events"

ORACLE["typed_projection"] = f"""WITH {EMP_ROWS}
SELECT XRefCode, employee_name, DepartmentXRefCode, ProjectId, TaskId, employment_status, NULL::VARCHAR AS UpdatedDateTime
FROM emprows"""
ORACLE["schema_evolve"] = f"""WITH {EMP_ROWS}
SELECT XRefCode, employee_name, DepartmentXRefCode, ProjectId, TaskId, NULL::VARCHAR AS employment_status,
  NULL::VARCHAR AS UpdatedDateTime FROM emprows"""
ORACLE["table_roundtrip"] = f"""WITH {EMP_ROWS}
SELECT XRefCode, employee_name, DepartmentXRefCode, ProjectId, TaskId, employment_status,
  '{NOW1}' AS UpdatedDateTime FROM emprows"""

ORACLE["cycle_metrics"] = f"""{ledger_with(2)}, src AS (
  SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS employees, count(*) AS fetched_entries FROM req2
), res AS (
  SELECT count(*) FILTER (WHERE merge_action IN ('insert', 'reactivate', 'touch', 'noop')) AS day_records,
    count(*) FILTER (WHERE action = 'new') AS new, count(*) FILTER (WHERE action = 'changed') AS changed,
    count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'cancelled') AS cancelled,
    count(*) FILTER (WHERE action = 'superseded') AS superseded,
    count(*) FILTER (WHERE merge_action = 'insert') AS inserted,
    count(*) FILTER (WHERE merge_action = 'reactivate') AS reactivated, count(*) FILTER (WHERE merge_action = 'touch') AS touched,
    count(*) FILTER (WHERE merge_action = 'cancel') AS cancelled_rows
  FROM app2
)
SELECT 'run-2' AS run_id, *, printf('run_id=run-2 employees=%d fetched_entries=%d day_records=%d new=%d changed=%d unchanged=%d '
  || 'cancelled=%d superseded=%d inserted=%d reactivated=%d touched=%d cancelled_rows=%d', employees, fetched_entries, day_records,
  new, changed, unchanged, cancelled, superseded, inserted, reactivated, touched, cancelled_rows) AS summary
FROM src, res"""

ORACLE["roster_preview"] = f"""WITH {REQ_WHOLE}, {wk_cte(1)}
SELECT XRefCode, Date, Hours, Status, RecordHash FROM daysrc1 ORDER BY XRefCode, Date, RecordHash LIMIT 20"""


ORACLE["job_employee_table"] = f"""WITH {EMP_ROWS}
SELECT *, '{NOW1}' AS UpdatedDateTime, 'insert' AS merge_action FROM emprows"""

_RUN_TAG = f"""SELECT a.XRefCode, r.Status AS st, sts.status_rank, wins.window_idx, r.entry_idx, r.TimeStart, r.TimeEnd,
    r.NetHours, r.ReasonName, r.PayAdjShortName
  FROM (SELECT XRefCode FROM emprows WHERE employment_status = 'ACTIVE') a
  JOIN req1 r ON {norm('r.employee_key')} = {norm('a.XRefCode')}
  JOIN sts ON r.Status = sts.status
  JOIN wins ON TRY_CAST(r.TimeStart AS TIMESTAMP) <= wins.hi
           AND COALESCE(TRY_CAST(r.TimeEnd AS TIMESTAMP), TRY_CAST(r.TimeStart AS TIMESTAMP)) >= wins.lo
  WHERE TRY_CAST(r.TimeStart AS TIMESTAMP) IS NOT NULL"""
ORACLE["job_day_table"] = f"""WITH {EMP_ROWS}, {REQ_WHOLE}, {WINDOWS}, {wk_cte('j', _RUN_TAG)}
SELECT XRefCode, Date, Hours, ReasonName, PayAdjShortName, Status, RecordHash,
  '1998-06-15 10:30:00' AS UpdatedDateTime, 'insert' AS merge_action FROM daysrcj"""

ORACLE["job_ledger"] = ORACLE["ledger_apply"]
ORACLE["job_ledger_bucketed"] = ORACLE["ledger_apply"]

ORACLE["landed_requests_expand"] = ORACLE["expand_choice"]

_DAYS_JSON = """'[' || array_to_string(list_transform(generate_series(0, span), lambda i: '{"Date":"' || strftime(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER), '%Y-%m-%d') || '"'
    || CASE WHEN entry_idx % 5 = 0 AND i = 0 THEN '' ELSE ',"NetHours":' || CAST((entry_idx + i) % 9 AS VARCHAR) END || '}'), ',') || ']'"""
_PAYLOAD_TEXTS = ", ".join(f"""'"{c}":"' || {c} || '"'""" for c in ("PayAdjShortName", "PayAdjustmentCodeName", "PayAdjustmentCodeXRefCode", "ReasonName", "Status", "TimeEnd", "TimeStart"))
ORACLE["landed_payloads"] = f"""WITH {REQ_WHOLE}
SELECT entry_idx AS page_id, CAST(0 AS BIGINT) AS entry_idx, '{{' || concat_ws(',',
  CASE WHEN entry_idx % 3 = 0 THEN '"DayList":' || CASE WHEN entry_idx % 8 = 0 THEN '[]' ELSE {_DAYS_JSON} END END,
  CASE WHEN (entry_idx % 3 = 1 AND entry_idx % 2 = 0) OR entry_idx % 24 = 0 THEN '"Days":' || {_DAYS_JSON} END,
  '"NetHours":' || CAST(NetHours AS VARCHAR), {_PAYLOAD_TEXTS}) || '}}' AS source_payload FROM req1"""

ORACLE["not_null_audit"] = f"""{ledger_with(2)}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE record_hash IS NULL OR employee_xref IS NULL OR pto_date IS NULL
  OR approval_type_code IS NULL OR hours_requested IS NULL OR first_seen_at IS NULL OR last_seen_at IS NULL
  OR is_active IS NULL OR ingest_run_id IS NULL) AS n_violations FROM led2"""


_SCOPED_REQ = f"""req9 AS (
  SELECT * FROM req1
  WHERE Status IN ('APPROVED', 'CANCELED')
    AND {norm('employee_key')} IN (SELECT 'EMP-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
    AND TRY_CAST(TimeStart AS TIMESTAMP) <= TIMESTAMP '1998-09-13 23:59:59.999'
    AND COALESCE(TRY_CAST(TimeEnd AS TIMESTAMP), TRY_CAST(TimeStart AS TIMESTAMP)) >= TIMESTAMP '1998-05-16 00:00:00'
)"""
_SCOPED_CUR = """cur9 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_xref, pto_date, record_hash
      ORDER BY CASE status WHEN 'APPROVED' THEN 0 ELSE 1 END, entry_idx, day_idx) AS rn FROM days9m) WHERE rn = 1
)"""
ORACLE["job_ledger_scoped"] = (
    f"WITH {EMPTY_LEDGER}, {REQ_WHOLE}, {_SCOPED_REQ}, {days_cte(9, True)}, {_SCOPED_CUR}, "
    f"{apply_cte(9, prev=0, stamp=NOW1, run='run-1')}\n{ledger_view('app9')}"
)

ORACLE["roster_from_pages"] = f"""WITH {PAGE_ROWS}, k AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY XRefCode ORDER BY page_id, row_idx) AS rn
                 FROM prows WHERE upper(trim(XRefCode)) LIKE 'EMP%') WHERE rn = 1
)
SELECT XRefCode, FirstName, org_xref AS "HomeOrganization.XRefCode" FROM k"""

ORACLE["weekday_quarantine"] = f"""WITH {REQ_WHOLE}
SELECT CAST(CASE Status WHEN 'APPROVED' THEN 0 ELSE 1 END AS INTEGER) AS status_rank, entry_idx,
  trim(employee_key) AS _XRefCode, 'bad_time_span' AS reject_reason
FROM req1 WHERE Status IN ('APPROVED', 'CANCELED')
  AND (TRY_CAST(TimeStart AS TIMESTAMP) IS NULL OR TRY_CAST(TimeEnd AS TIMESTAMP) IS NULL)"""

ORACLE["reconcile_actions_hot_keys"] = ORACLE["reconcile_actions"]

ORACLE["landed_rejects"] = ORACLE["expand_quarantine"]
ORACLE["page_chains"] = """WITH RECURSIVE ev AS (SELECT event_id AS id, CASE WHEN event_id % 200 = 149 THEN NULL
    WHEN event_id % 200 = 159 OR event_id % 50 = 29 THEN event_id - 9 WHEN event_id % 100 = 99 THEN NULL ELSE event_id + 1 END AS nxt
  FROM events WHERE event_id % 97 <> 13),
p AS (SELECT id, CASE WHEN nxt IN (SELECT id FROM ev) THEN nxt END AS nxt FROM ev),
r(id, root, steps) AS (SELECT id, id, 0 FROM p WHERE id NOT IN (SELECT nxt FROM p WHERE nxt IS NOT NULL)
  UNION ALL SELECT p.nxt, root, steps + 1 FROM r JOIN p USING (id) WHERE p.nxt IS NOT NULL AND steps < 220),
c(id, there, steps) AS (SELECT id, nxt, 1 FROM p WHERE nxt IS NOT NULL
  UNION ALL SELECT c.id, p.nxt, steps + 1 FROM c JOIN p ON p.id = c.there WHERE p.nxt IS NOT NULL AND steps < 20 AND c.there <> c.id)
SELECT p.id AS page_id, min(root) AS first_page, CAST(min(steps) AS BIGINT) AS steps, p.id IN (SELECT id FROM c WHERE there = id) AS in_cycle
FROM p LEFT JOIN r USING (id) GROUP BY p.id"""

ORACLE["page_completeness"] = f"""WITH {EV_GAPS}, ptr AS (
  SELECT 'p/' || CAST(event_id + 1 AS VARCHAR) AS next_url FROM ev WHERE event_type IN ('view', 'click')
)
SELECT (SELECT count(*) FROM ev) AS n_pages, 0 AS n_unreadable, (SELECT count(*) FROM ev WHERE event_type = 'error') AS n_denied,
  (SELECT count(*) FROM ptr WHERE NOT EXISTS (SELECT 1 FROM ev WHERE 'p/' || CAST(ev.event_id AS VARCHAR) = ptr.next_url)) AS n_gaps"""

_GATE = ledger_with(2).replace("FROM orders WHERE o_orderkey % 10 <> 1", "FROM orders WHERE o_orderkey % 10 <> 1 AND o_orderkey % 50 <> 3")
_HELD = f"(SELECT {norm("' emp-' || CAST(o_custkey AS VARCHAR) || ' '")} FROM orders WHERE o_orderkey % 10 <> 1 AND o_orderkey % 50 = 3)"
ORACLE["job_ledger_gate"] = f"""{_GATE}
SELECT record_hash, employee_xref, pto_date, is_active, ingest_run_id, action, merge_action FROM app2 WHERE employee_xref NOT IN {_HELD}
UNION ALL
SELECT record_hash, employee_xref, pto_date, is_active, ingest_run_id, NULL, 'keep' FROM led1 WHERE employee_xref IN {_HELD}"""

def _gate_run(c: int, day: int, w: str) -> str:
    """Tagged requests (first-wins rows daysrcg{c}) and employees held back (held{c}) of the day job at June ``day``, 1998."""
    now = f"TIMESTAMP '1998-06-{day} 10:30:00'"
    run = f"""SELECT a.XRefCode, r.*, sts.status_rank, win.window_idx, TRY_CAST(r.TimeStart AS TIMESTAMP) AS t0, TRY_CAST(r.TimeEnd AS TIMESTAMP) AS t1
  FROM (SELECT XRefCode FROM emprows WHERE employment_status = 'ACTIVE') a
  JOIN req{c} r ON {norm('r.employee_key')} = {norm('a.XRefCode')} JOIN sts ON r.Status = sts.status
  LEFT JOIN {w} AS win ON TRY_CAST(r.TimeStart AS TIMESTAMP) <= win.hi
    AND COALESCE(TRY_CAST(r.TimeEnd AS TIMESTAMP), TRY_CAST(r.TimeStart AS TIMESTAMP)) >= win.lo"""
    tag = f"""SELECT XRefCode, Status AS st, status_rank, window_idx, entry_idx, TimeStart, TimeEnd, NetHours, ReasonName, PayAdjShortName
  FROM ({run}) WHERE t0 IS NOT NULL AND t1 IS NOT NULL AND window_idx IS NOT NULL"""
    windows = f"""{w} AS (SELECT CAST(i AS INTEGER) AS window_idx, {now} - INTERVAL 30 DAY + to_days(CAST(30 * i AS INTEGER)) AS lo,
  {now} - INTERVAL 30 DAY + to_days(CAST(30 * i + 30 AS INTEGER)) AS hi FROM generate_series(0, 3) AS g(i))"""
    held = f"held{c} AS (SELECT DISTINCT XRefCode FROM ({run}) WHERE t0 IS NULL OR (t1 IS NULL AND (window_idx IS NOT NULL OR COALESCE(TimeEnd, '') <> '')))"
    return f"{req_cte(c)}, {windows}, {held}, {wk_cte(f'g{c}', tag)}"


ORACLE["job_day_table_gate"] = f"""WITH {EMP_ROWS}, {WINDOWS}, {_gate_run(1, 15, 'wa')}, {_gate_run(2, 16, 'wb')}
SELECT COALESCE(t.RecordHash, s.RecordHash) AS RecordHash,
  CASE WHEN s.RecordHash IS NOT NULL AND a IN ('insert', 'update') THEN s.XRefCode ELSE t.XRefCode END AS XRefCode,
  COALESCE(t.Date, s.Date) AS Date,
  CASE WHEN a IN ('insert', 'update') THEN s.Status WHEN a = 'cancel' THEN 'Canceled' ELSE t.Status END AS Status, a AS merge_action
FROM (SELECT t, s, CASE WHEN t.RecordHash IS NULL THEN 'insert'
    WHEN s.RecordHash IS NOT NULL AND (t.Status IS DISTINCT FROM s.Status OR t.ReasonName IS DISTINCT FROM s.ReasonName OR t.PayAdjShortName IS DISTINCT FROM s.PayAdjShortName) THEN 'update'
    WHEN s.RecordHash IS NOT NULL THEN 'unchanged'
    WHEN t.Date BETWEEN DATE '1998-05-17' AND DATE '1998-09-14' AND t.Status <> 'Canceled' AND t.XRefCode IN
      (SELECT XRefCode FROM emprows WHERE employment_status = 'ACTIVE' AND XRefCode NOT IN (SELECT XRefCode FROM held2)) THEN 'cancel'
    ELSE 'keep' END AS a
  FROM daysrcg1 AS t FULL OUTER JOIN daysrcg2 AS s ON t.RecordHash = s.RecordHash)"""

ORACLE["roster_empty"] = "SELECT 0 AS n_rows, 'XRefCode' AS first_column"

ORACLE["expand_audit"] = f"""WITH {whole_days(True)}
SELECT entry_idx, day_idx, ReasonName AS reason_name, NULLIF(Status, '') AS status, TimeStart AS time_start, TimeEnd AS time_end,
  CASE WHEN entry_idx % 4 = 0 THEN NULL ELSE entry_idx % 4 = 1 END AS all_day, substr(TimeStart, 1, 10) AS date_of_request,
  'order ' || entry_idx AS source_payload FROM days1my"""

ORACLE["ledger_active"] = f"""{ledger_with(2)}
SELECT record_hash, employee_xref, pto_date FROM led2 WHERE COALESCE(is_active, true)"""

ORACLE["reconcile_writes"] = f"""{ledger_with(2)}
SELECT record_hash, CASE WHEN action IN ('new', 'changed') THEN 'upsert' ELSE 'retire' END AS write
FROM app2 WHERE action IN ('new', 'changed', 'cancelled', 'superseded')"""

ORACLE["employees_in_scope"] = f"""WITH {DET}, {MAP}
SELECT XRefCode, dept_now AS department_xref FROM det WHERE {norm('dept_now')} IN (SELECT dept_key FROM dmap)"""

_DAYS1 = f"WITH {req_cte(1)}, {wk_cte(1)} SELECT RecordHash FROM daysrc1"
ORACLE["ddl_tables"] = f"""
SELECT 'ledger' AS name, count(*) AS n_rows, count(DISTINCT record_hash) AS n_keys, 17 AS n_columns FROM ({ledger_with(1)} SELECT record_hash FROM led1)
UNION ALL SELECT 'employees', count(*), count(DISTINCT XRefCode), 7 FROM (WITH {EMP_ROWS} SELECT XRefCode FROM emprows)
UNION ALL SELECT 'days', count(*), count(DISTINCT RecordHash), 8 FROM ({_DAYS1})"""
