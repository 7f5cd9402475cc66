"""All registered queries of the archive jobs and the SQL that must give the same rows."""

from __future__ import annotations

from paperloom.plans import q_archive, q_chunking, q_markdown, q_quality, q_runlog, q_selection

_MODULES = (q_selection, q_markdown, q_chunking, q_quality, q_runlog, q_archive)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: query for m in _MODULES for name, query in m.ORACLES.items()}
