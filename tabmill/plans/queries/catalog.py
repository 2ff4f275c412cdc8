"""All registered queries and their SQL."""

from __future__ import annotations

from . import jobs, log, models, prepare, scoring, transforms

_PARTS = (prepare, transforms, models, scoring, log, jobs)
QUERIES = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
ORACLE = {name: text for part in _PARTS for name, text in part.ORACLE.items()}
