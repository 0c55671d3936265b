"""Column-level rules (pure expressions, whole-stage codegen friendly)."""

from strata.functions.cleanse import (  # noqa: F401
    ERP_GENDER, GENDER, MARITAL, PRODUCT_LINE, int_div, map_codes, normalize_country,
    null_after, parse_int_date, reconcile_sales, repair_price, round_ratio, strip_prefix,
)
