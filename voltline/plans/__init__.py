"""Query catalog (Spark) and oracle SQL (DuckDB) keyed by query name."""

from voltline.plans.catalog import QUERIES  # noqa: F401
from voltline.plans.oracle import ORACLE_SQL  # noqa: F401
