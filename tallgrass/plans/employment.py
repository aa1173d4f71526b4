"""Employment marts: fact_emp*, fact_has*, location quotients, wages, openings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import filter_state, safe_ratio
from tallgrass.operators.relational import (
    broadcast_if_bounded,
    index_to_baseline,
    share_of_group,
    shift_period,
)


def _county(df: DataFrame, cfg: MartConfig, upto_year: bool = True) -> DataFrame:
    df = df.filter(F.col("areaid_type") == "COUNTY")
    if upto_year:
        df = df.filter(F.col("year") <= F.lit(cfg.as_of_year))
    return filter_state(df, "areaid", cfg.state)


def _codes(dim: DataFrame, id_col: str, level: int) -> DataFrame:
    # A code list; joining it (not a semi-join) keeps SQL's row semantics.
    return broadcast_if_bounded(dim.filter(F.col("level") == level).select(id_col))


# fact_emp ------------------------------------------------------------------
def share_allocation(occ_totals: DataFrame, staffing: DataFrame, ind_totals: DataFrame,
                     keys: list[str], target: str, measure: str, total: str) -> DataFrame:
    """Allocate group totals over a target dimension by observed weights.

    ``staffing`` holds ``keys + [target, measure]`` aggregated to that grain;
    each group's weights are ``measure / SUM(measure)`` over the group (a
    window: the group holds one row per target code).  One left join of the
    totals to the weights yields both the allocated rows and the groups
    without weights, which are kept whole with a NULL target and share 1.0
    (mapped rows UNION ALL unmapped rows, without reading anything twice).
    """
    weights = share_of_group(staffing, keys, measure, "__pct", method="window").withColumn("__mapped", F.lit(True))
    j = occ_totals.join(weights, on=keys, how="left")
    j = j.join(ind_totals, on=[k for k in keys if k != keys[-1]] + [target], how="left")
    mapped = F.col("__mapped").isNotNull()
    return j.select(
        *keys[:-1], F.when(mapped, F.col(target)).cast("string").alias(target), keys[-1],
        F.when(mapped, F.col("__num").cast("double")).alias("NUM_EMPS"),
        F.when(mapped, F.col(total) * F.col("__pct")).otherwise(F.col(total).cast("double")).alias("OCC_EMPS"),
        F.when(mapped, F.col("__pct")).otherwise(F.lit(1.0)).alias("PERCENT"))


def fact_emp(src, cfg: MartConfig) -> DataFrame:
    occ5 = _codes(src.dim_occid, "occid", 5)
    ind6 = _codes(src.dim_indid, "indid", 6)
    occ_totals = (_county(src.occ, cfg).filter(F.col("classid") != "4").join(occ5, "occid")
                  .groupBy("year", "areaid", "occid").agg(F.sum("emp").alias("__occ_total")))
    staffing = (_county(src.staffing, cfg).filter(F.col("classid") == "1")
                .join(occ5, "occid").join(ind6, "indid")
                .groupBy("year", "areaid", "occid", "indid").agg(F.sum("emp").alias("__staff")))
    ind_totals = (_county(src.ind, cfg).filter(F.col("classid") != "4").join(ind6, "indid")
                  .groupBy("year", "areaid", "indid").agg(F.sum("emp").alias("__num")))
    out = share_allocation(occ_totals, staffing, ind_totals, ["year", "areaid", "occid"], "indid",
                           "__staff", "__occ_total")
    return out.select(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"),
                      F.col("occid").alias("OCCID"), "NUM_EMPS", "OCC_EMPS", "PERCENT")


def fact_emp_lagged(src, cfg: MartConfig) -> DataFrame:
    # every input is bounded by year before the shift, so shifting the built
    # mart is the same as shifting each input
    return shift_period(fact_emp(src, cfg), "YEAR", 1)


def _emp_index(lf: DataFrame, cfg: MartConfig) -> DataFrame:
    b = cfg.baseline_year
    rows = lf.filter(F.col("year") >= b).select(
        F.col("year").alias("YEAR"), F.col("month").alias("MONTH"),
        F.col("areaid_name").alias("AREAID_NAME"), F.col("emp").alias("EMP"))
    idx = index_to_baseline(rows, ["AREAID_NAME"], "EMP", (F.col("YEAR") == b) & (F.col("MONTH") == 1),
                            f"BASE_{b}_EMP", f"EMP_INDEX_TO_{b}")
    return idx.select(F.make_date("YEAR", "MONTH", F.lit(1)).alias("DATE"), "YEAR", "MONTH", "AREAID_NAME",
                      "EMP", f"BASE_{b}_EMP", f"EMP_INDEX_TO_{b}")


def fact_emp_county_idx(src, cfg: MartConfig) -> DataFrame:
    return _emp_index(_county(src.labor_force, cfg, upto_year=False), cfg)


def fact_emp_state_idx(src, cfg: MartConfig) -> DataFrame:
    lf = src.labor_force.filter((F.col("areaid_type") == "STATE") & (F.col("areaid_name") == cfg.state_name))
    return _emp_index(lf, cfg)


# fact_has ------------------------------------------------------------------
def allocate_by_percent(pct: DataFrame, totals: DataFrame, keys: list[str], percent: str,
                        measures: dict[str, str]) -> DataFrame:
    """Left-join group totals onto share rows and multiply (NULL if absent)."""
    j = pct.join(totals, on=keys, how="left")
    for m, out in measures.items():
        j = j.withColumn(out, F.col(m) * F.col(percent))
    return j


def fact_has(src, cfg: MartConfig) -> DataFrame:
    pct = (_county(src.staffing, cfg).filter(F.col("classid") == "1")
           .select(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"),
                   F.col("occid").alias("OCCID"), F.col("percent").alias("PERCENT")))
    has = (_county(src.hiresseps, cfg)
           .groupBy(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"))
           .agg(F.sum("hira").alias("HIRES"), F.sum("sep").alias("SEPS")))
    out = allocate_by_percent(pct, has, ["YEAR", "AREAID", "INDID"], "PERCENT",
                              {"HIRES": "OCC_HIRES", "SEPS": "OCC_SEPS"})
    return out.select("YEAR", "AREAID", "INDID", "OCCID", "PERCENT", "HIRES", "OCC_HIRES", "SEPS", "OCC_SEPS")


def fact_has_lagged(src, cfg: MartConfig) -> DataFrame:
    return shift_period(fact_has(src, cfg), "YEAR", 1)


# location quotients ----------------------------------------------------------
def location_quotient(staffing: DataFrame, cfg: MartConfig, group_col: str, out_col: "F.Column",
                      name: str) -> DataFrame:
    """County share of a category over the state share of it (LQ).

    ``group_col`` is the grouping column, ``out_col`` the category value
    shown (for industries as written, the full code is grouped and its
    5-digit prefix shown: trap T1).  Each grain is one partial aggregation;
    area totals are sums of the category sums, not a second scan.
    """
    base = staffing.filter(F.col("year") <= F.lit(cfg.as_of_year))
    state_rows = base.filter((F.col("areaid") == cfg.state) & (F.col("areaid_type") == "STATE")
                             & (F.col("areaid_name") == cfg.state_name))
    county_rows = filter_state(base.filter(F.col("areaid_type") == "COUNTY"), "areaid", cfg.state)
    n = name.upper()

    def grain(rows: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        by_cat = rows.groupBy(*keys, group_col).agg(F.sum("emp").alias("__emps"))
        totals = by_cat.groupBy(*keys).agg(F.sum("__emps").alias("__total"))
        j = by_cat.join(totals, on=keys, how="left")
        return j.select(*keys, out_col.alias(n),
                        F.col("__emps").alias(f"{prefix}_{n}_EMPS"),
                        F.col("__total").alias(f"{prefix}_TOTAL_EMPS"),
                        safe_ratio("__emps", "__total").alias(f"{prefix}_{n}_CONC"))

    county = grain(county_rows, ["year", "areaid"], "COUNTY")
    state = grain(state_rows, ["year"], "STATE")
    j = county.join(state, on=["year", n], how="left")
    return j.select(
        F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), n,
        F.round(f"COUNTY_{n}_EMPS", 0).cast("bigint").alias(f"COUNTY_{n}_EMPS"),
        F.round("COUNTY_TOTAL_EMPS", 0).cast("bigint").alias("COUNTY_TOTAL_EMPS"),
        f"COUNTY_{n}_CONC",
        F.round(f"STATE_{n}_EMPS", 0).cast("bigint").alias(f"STATE_{n}_EMPS"),
        F.round("STATE_TOTAL_EMPS", 0).cast("bigint").alias("STATE_TOTAL_EMPS"),
        f"STATE_{n}_CONC",
        F.try_divide(F.col(f"COUNTY_{n}_CONC"), F.col(f"STATE_{n}_CONC")).alias("LQ"),
    )


def fact_lq_occ(src, cfg: MartConfig) -> DataFrame:
    lq = location_quotient(src.staffing, cfg, "occid", F.col("occid"), "occ")
    return lq.withColumnsRenamed({"OCC": "OCCID", "COUNTY_OCC_EMPS": "COUNTY_OCC_EMPS"})


def fact_lq_ind(src, cfg: MartConfig) -> DataFrame:
    staffing = src.staffing
    if cfg.lq_group_on == "truncated":
        staffing = staffing.withColumn("__ind5", F.left("indid", F.lit(5)))
        lq = location_quotient(staffing, cfg, "__ind5", F.col("__ind5"), "ind")
    else:
        lq = location_quotient(staffing, cfg, "indid", F.left("indid", F.lit(5)), "ind")
    return lq.withColumnRenamed("IND", "INDID")


def fact_lq_ind_truncated(src, cfg: MartConfig) -> DataFrame:
    from dataclasses import replace
    return fact_lq_ind(src, replace(cfg, lq_group_on="truncated"))


# wages and openings ---------------------------------------------------------
def fact_wages_ind(src, cfg: MartConfig) -> DataFrame:
    d = _county(src.ind, cfg).filter(F.col("classid") == "1")
    # employment may be fractional: divide the plain value, round once (half up) to cents
    wages = F.round(F.try_divide(F.col("earn"), F.col("emp").cast("decimal(20,6)")), 2).cast("decimal(20,2)")
    return d.select(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"),
                    wages.alias("YEARLY_WAGES"))


def fact_wages_occ(src, cfg: MartConfig) -> DataFrame:
    d = _county(src.occ, cfg).filter(F.col("classid") == "1")
    hourly = F.round("earn_avg", 2)
    return d.select(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("occid").alias("OCCID"),
                    hourly.cast("decimal(18,2)").alias("HOURLY_WAGE"),
                    (hourly * F.lit(cfg.hours_per_year)).cast("decimal(28,2)").alias("YEARLY_WAGE"))


def fact_openings_occ(src, cfg: MartConfig) -> DataFrame:
    d = _county(src.occ, cfg).filter(F.col("classid") != "4")
    return (d.groupBy(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("occid").alias("OCCID"))
             .agg(F.round(F.sum(F.col("replacements") + F.col("growth")), 0).cast("bigint").alias("OPENINGS")))
