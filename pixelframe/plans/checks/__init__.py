"""Driver queries: every operator on the driver's tables, with its SQL twin.

Every query reads whole tables. The modules register their queries when they
are imported.
"""

from pixelframe.plans.checks import (  # noqa: F401
    audit_checks,
    catalog_checks,
    feature_checks,
    model_checks,
    pixel_checks,
    raster_checks,
    sampling_checks,
    source_checks,
)
from pixelframe.plans.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
