"""All queries of the engine and their oracles."""

from __future__ import annotations

from ledgerloom.plans import classification, columns, financial, indexes, records, relational, sources, texts, work

MODULES = [relational, classification, financial, texts, work, columns, records, indexes, sources]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in MODULES for k, s in m.ORACLES.items()}
