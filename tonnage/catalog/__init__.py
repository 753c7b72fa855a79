from tonnage.catalog import analytics, intensity, verbs  # noqa: F401  (fill the registry)
from tonnage.catalog.registry import FUNCTIONS, SQL, Tables, query

__all__ = ["FUNCTIONS", "SQL", "Tables", "query"]
