"""Driver contract, partition invariance and a small DuckDB oracle run."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as se
from ledgerfold.operators import dedupe, expand
from ledgerfold.plans import catalog, derive
from tests.conftest import SF_SMALL


def test_entry_runs_on_smallest_scale(spark):
    df = se.entry(spark)
    assert {"record_hash", "action", "merge_action", "is_active"} <= set(df.columns)
    assert df.count() > 0


def test_every_query_has_an_oracle():
    """But for text operators that SQL can't express."""
    own = {n for n in se.queries() if n in catalog.QUERIES}
    assert own == own & set(se.oracle_sql())
    assert set(se.oracle_sql()) <= set(se.queries())


def canon(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


def test_partition_count_does_not_change_results(spark):
    r = derive.requests(spark, SF_SMALL, 1)
    a = dedupe.dedupe_day_records(expand.ledger_days(r, expand_multi_day=True))
    b = dedupe.dedupe_day_records(expand.ledger_days(r.repartition(13).orderBy("TimeStart"), expand_multi_day=True))
    cols = sorted(a.columns)
    assert canon(a.select(cols).collect()) == canon(b.select(cols).collect())


SMALL_KEYS = ["identity_hash", "expand_choice", "expand_weekdays", "reconcile_counts", "ledger_stats",
              "department_as_of", "employee_merge", "day_merge", "page_gaps", "window_chunks"]


@pytest.mark.parametrize("name", SMALL_KEYS)
def test_oracle_matches_on_smallest_scale(spark, name):
    from tools.check_oracle import TABLES, canon_rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = se.queries()[name](spark, SF_SMALL)
    cur = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon_rows(df.columns, [tuple(r) for r in df.collect()]) == canon_rows(dcols, cur.fetchall())
