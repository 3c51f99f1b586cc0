"""All registered queries and their equivalent SQL."""

from __future__ import annotations

from paceline.plans import composite_queries, contest_queries, finding_queries, form_queries, history_queries, model_queries, neighbour_queries, outcome_queries, pedigree_queries, performance_queries, scalar_queries, selection_queries, source_queries, stream_queries, table_queries

MODULES = (history_queries, form_queries, contest_queries, outcome_queries, model_queries, table_queries, scalar_queries, source_queries, stream_queries, pedigree_queries, neighbour_queries, selection_queries, performance_queries, composite_queries, finding_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
