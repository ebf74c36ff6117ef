"""All queries of the core and their SQL."""

from __future__ import annotations

from packetry.plans import evaluation, evidence, packets, problems, records, textual

MODULES = (problems, records, textual, evidence, evaluation, packets)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}
