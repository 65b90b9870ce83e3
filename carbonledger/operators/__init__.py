"""Operators composed from DataFrame primitives."""

from .broadcast import fixed_broadcast
from .columns import common_columns, drop_prefixed, register_views, site_dimension
from .dimensions import build_dimension, pool
from .fill import fill_nulls_by_key, new_rows, union_all_by_name
from .harmonise import harmonise, translate_expr, translation_table, unmapped
from .keys import dense_keys, sequential_index
from .places import adjust_distance, gazetteer_match, mission_distance, unlocated_places, with_route_distance
from .quality import has_atypicals, max_by_condition, profile, unique_values
from .rollup import totals_with_label

__all__ = [
    "fixed_broadcast", "common_columns", "drop_prefixed", "register_views", "site_dimension", "build_dimension", "pool", "fill_nulls_by_key", "new_rows",
    "union_all_by_name", "harmonise", "translate_expr", "translation_table", "unmapped", "dense_keys",
    "sequential_index", "adjust_distance", "gazetteer_match", "mission_distance", "unlocated_places",
    "with_route_distance",
    "has_atypicals", "max_by_condition", "profile", "unique_values", "totals_with_label",
]
