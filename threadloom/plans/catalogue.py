"""All queries of the core, by name."""

from __future__ import annotations

from . import forum, records

FLAGSHIP = "q01_thread_manifest"
QUERIES = {**forum.QUERIES, **records.QUERIES}
ORACLES = {**forum.ORACLES, **records.ORACLES}
