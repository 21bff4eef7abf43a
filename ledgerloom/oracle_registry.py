"""Oracle SQL per registered query name."""

from __future__ import annotations

from ledgerloom import oracle
from ledgerloom.plans.models import MODELS


def oracle_sql() -> dict[str, str]:
    out = {name: oracle.model_select(name) for name in MODELS}
    from ledgerloom import extra_queries
    out.update(extra_queries.oracle_sql())
    return out
