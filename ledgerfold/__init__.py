"""ledgerfold: snapshot-to-ledger reconciliation expressed as Spark DataFrame plans.

Landed source snapshots (JSON pages or tables) are unwrapped, narrowed by a
broadcast mapping dimension, exploded into one row per day, given a
deterministic content identity, de-duplicated (first occurrence wins),
classified against the stored table and applied as a history-keeping merge.
Everything is a lazy DataFrame plan: no Python UDFs, no driver collects.

Sub-packages
------------
functions  column expressions (identity hash, value parsing, array pickers)
sources    landed pages, request windows, mapping dimension, stored tables
operators  expand, dedupe, classify, merge, roster, metrics
plans      composite jobs and the query catalog over the driver's tables
streaming  incremental trigger over a landing folder
"""

__version__ = "0.1.0"
