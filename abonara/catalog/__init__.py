"""Every query of the engine beside the SQL that checks it."""

from abonara.catalog import base_sql  # noqa: F401  (registers the shared fragments)
from abonara.catalog import sources, profile, dedup, snapshot, churn, converge, sales, cohort, contact, kpi, checks, periods, rewrites  # noqa: F401
from abonara.catalog.registry import CASES  # noqa: F401
