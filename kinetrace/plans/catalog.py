"""Every operator as a query on the driver's tables, and the SQL that says the same.

`events` stand for raw messages (user: episode, type: stream, ts: time, event_id: sequence, value:
payload), `embeddings` for state vectors, `orders` and `lineitem` for episodes and frames.
Doubles are rounded to six decimals on both sides: sums depend on their order.
"""

from __future__ import annotations

from . import align_queries, dataset_queries, record_queries, sequence_queries, signal_queries, vector_queries

MODULES = (align_queries, sequence_queries, vector_queries, dataset_queries, signal_queries, record_queries)

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
