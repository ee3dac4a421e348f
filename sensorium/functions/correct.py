"""Location-based value correction ("fix defective sensors")."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import unique_dimension


def corrected_value(corrections: Mapping[str, float], location="location", value="value") -> Column:
    """``value + delta[location]`` where the location has a correction, else
    the value unchanged (so -0.0 and NaN pass through untouched)."""
    loc, val = F.col(location), F.col(value)
    if not corrections:
        return val
    m = F.create_map(*[x for k, d in corrections.items() for x in (F.lit(k), F.lit(float(d)))])
    return F.when(F.map_contains_key(m, loc), val + F.element_at(m, loc)).otherwise(val)


def apply_corrections(df: DataFrame, corrections, location="location", value="value") -> DataFrame:
    """Correct ``value`` by location.

    ``corrections`` is a mapping (a map literal of the plan) or a DataFrame
    ``(location, delta)`` with one row per location (checked), joined as the
    planner sees fit.
    """
    if isinstance(corrections, Mapping):
        return df.withColumn(value, corrected_value(corrections, location, value))
    table = unique_dimension(corrections, "location", "delta", "_corr_loc", "_corr_delta")
    joined = df.join(table, F.col(location) == F.col("_corr_loc"), "left")
    return (joined.withColumn(value, F.when(F.col("_corr_loc").isNotNull(),
                                            F.col(value) + F.col("_corr_delta")).otherwise(F.col(value)))
            .drop("_corr_loc", "_corr_delta"))
