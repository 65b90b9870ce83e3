"""Column functions: geodesy, emissions, rule engine, strings, dates."""

from .dates import age_years, day_range, year_month
from .emissions import emission, emission_sql, factor_table
from .geo import geodesic_km, geodesic_sql, haversine_km, with_geodesic_km
from .rules import apply_conditional_operations, rule_expr, validate_rules
from .text import blank_to_null, blank_to_sentinel, clamp_low, is_blank, parse_place

__all__ = [
    "age_years", "day_range", "year_month", "emission", "emission_sql", "factor_table", "geodesic_km",
    "geodesic_sql", "haversine_km", "with_geodesic_km", "apply_conditional_operations", "rule_expr", "validate_rules",
    "blank_to_null", "blank_to_sentinel", "clamp_low", "is_blank", "parse_place",
]
