"""Column functions (all built-in Spark expressions, codegen friendly)."""
from .keys import hk, hk_sql_duckdb
from .money import cents_to_units, scale_rate, half_up_ratio, round_money, floor_div
from .calendar import calendar_hierarchy_key

__all__ = ["hk", "hk_sql_duckdb", "cents_to_units", "scale_rate", "half_up_ratio", "round_money", "floor_div",
           "calendar_hierarchy_key"]
