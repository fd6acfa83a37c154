"""All registered queries, and the SQL that checks them."""

from __future__ import annotations

from marquee.plans import cleaning, featuring, monitoring, recommending, streams, validation
from marquee.plans.common import Query

_PARTS = (featuring, cleaning, validation, recommending, streams, monitoring)

QUERIES: dict[str, Query] = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: s for part in _PARTS for name, s in part.ORACLES.items()}
