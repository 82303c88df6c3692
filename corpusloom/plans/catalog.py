"""All queries of the library's own operators, with the SQL that checks them."""

from __future__ import annotations

from corpusloom.plans import q_crawl, q_enrich, q_library, q_operators, q_quality, q_reports, q_search, q_sources, q_store, q_streams, q_technical, q_templates

PARTS = (q_crawl, q_enrich, q_library, q_quality, q_operators, q_reports, q_search, q_sources, q_store, q_streams, q_technical, q_templates)
QUERIES = {k: f for part in PARTS for k, f in part.QUERIES.items()}
ORACLES = {k: s for part in PARTS for k, s in part.ORACLES.items()}
