"""Report plans: variants of the hit scope and the reports built on them."""
from . import reports, variants
from .variants import CANONICAL, CSV_ERA, NULL, V2, V3, Variant, scope

__all__ = ["reports", "variants", "CANONICAL", "CSV_ERA", "NULL", "V2", "V3", "Variant", "scope"]
