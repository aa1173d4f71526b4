"""Education marts: completions and enrollments (+ lagged)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import filter_state
from tallgrass.operators.relational import broadcast_if_bounded, shift_period


def totals_only(df: DataFrame, **levels) -> DataFrame:
    """Keep the demographic total rows (race 0, gender 0, ...)."""
    for col, value in levels.items():
        df = df.filter(F.col(col) == F.lit(value))
    return df


def in_state_units(src, cfg: MartConfig) -> DataFrame:
    return broadcast_if_bounded(filter_state(src.unit, "county", cfg.state).select("unitid", "county"))


def fact_completions(src, cfg: MartConfig) -> DataFrame:
    cd = totals_only(src.completions.filter(F.col("awlevelid").isin(*cfg.award_levels)), raceid=0, genderid=0)
    programs = broadcast_if_bounded(src.programs.filter(F.col("level") == 3).select("programid"))
    j = cd.join(programs, "programid").join(in_state_units(src, cfg), "unitid")
    return j.select(F.col("year").alias("YEAR"), F.col("county").alias("AREAID"), F.col("programid").alias("PROGRAMID"),
                    F.col("unitid").alias("UNITID"), F.col("awlevelid").alias("AWLEVELID"),
                    F.col("completions").alias("COMPLETIONS"))


def fact_completions_lagged(src, cfg: MartConfig) -> DataFrame:
    return shift_period(fact_completions(src, cfg), "YEAR", 1)


def fact_enrollments(src, cfg: MartConfig) -> DataFrame:
    en = totals_only(src.enrollments, raceid=0, genderid=0, enrlevelid=1)
    j = en.join(in_state_units(src, cfg), "unitid")
    return j.select(F.col("year").alias("YEAR"), F.col("county").alias("AREAID"), F.col("unitid").alias("UNITID"),
                    F.col("enrollments").alias("ENROLLMENTS"))


def fact_enrollments_lagged(src, cfg: MartConfig) -> DataFrame:
    return shift_period(fact_enrollments(src, cfg), "YEAR", 1)
