"""Sources (the 18 source tables) and sinks (report and view outputs)."""

from hemotab.sources.schema import TABLE_NAMES, schemas
from hemotab.sources.tables import Tables

__all__ = ["TABLE_NAMES", "Tables", "schemas"]
