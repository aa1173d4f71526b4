"""One query per generic operator, each over the role tables.

These exercise every reusable operator of ``operators.relational`` on its
own (the marts use them in combination).  Keys follow the operator names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import filter_state
from tallgrass.operators.relational import (
    calendar_window_count,
    change_and_pct_change,
    crosswalk,
    entity_fanout_count,
    flagged_count,
    flatten_hierarchy,
    group_total_alongside,
    index_to_baseline,
    latest_and_prior_year,
    pivot_current_prior,
    share_of_group,
    shift_period,
    star_join,
    sum_with_support,
    year_over_year,
)
from tallgrass.plans.dims import combined_industries, prioritized_industries
from tallgrass.plans.employment import allocate_by_percent, location_quotient, share_allocation
from tallgrass.plans.postings import fact_skills
from tallgrass.sources.catalog import SOURCE_ROLES
from tallgrass.sources.tables import TableCatalog, register_external


def q_filter_state(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state)
    return p.select(F.col("id").alias("ID"), F.col("county").alias("COUNTY"), F.col("county_name").alias("COUNTY_NAME"))


def q_filter_state_text(src, cfg: MartConfig) -> DataFrame:
    s = filter_state(src.staffing.filter(F.col("areaid_type") == "COUNTY"), "areaid", cfg.state)
    return s.groupBy(F.col("areaid").alias("AREAID")).agg(F.count(F.lit(1)).alias("N_ROWS"))


def _crosswalk(src, how: str) -> DataFrame:
    p = src.postings.select("id", "naics6")
    j = crosswalk(p, src.crosswalk, "naics6", "postings_naics6", "lc_bucket_indid", out="BUCKET", how=how)
    return j.select(F.col("id").alias("ID"), F.col("naics6").alias("NAICS6"), "BUCKET")


def q_crosswalk_left(src, cfg: MartConfig) -> DataFrame:
    return _crosswalk(src, "left")


def q_crosswalk_inner(src, cfg: MartConfig) -> DataFrame:
    return _crosswalk(src, "inner")


def q_index_to_baseline(src, cfg: MartConfig) -> DataFrame:
    b = cfg.baseline_year
    lf = src.labor_force.filter(F.col("areaid_type") == "COUNTY").select(
        F.col("areaid").alias("AREAID"), F.col("year").alias("YEAR"), F.col("month").alias("MONTH"),
        F.col("emp").alias("EMP"))
    return index_to_baseline(lf, ["AREAID"], "EMP", (F.col("YEAR") == b) & (F.col("MONTH") == 1),
                             "BASE_EMP", "EMP_INDEX")


def q_flatten_hierarchy(src, cfg: MartConfig) -> DataFrame:
    flat = flatten_hierarchy(src.dim_indid, "indid", "indid_parent", ["name", "level"],
                             leaf=F.col("level") == 6, depth=4, how="left")
    return flat.select(F.col("h0_indid").alias("INDID"), F.col("h1_indid").alias("PARENT1"),
                       F.col("h2_indid").alias("PARENT2"), F.col("h3_indid").alias("PARENT3"),
                       F.col("h4_indid").alias("PARENT4"), F.col("h4_name").alias("TOP_NAME"))


def q_prefer_source(src, cfg: MartConfig) -> DataFrame:
    p = prioritized_industries(combined_industries(src, cfg))
    return p.select(F.col("indid").alias("INDID"), F.col("name").alias("NAME"), F.col("level").alias("LEVEL"),
                    F.col("indid_parent").alias("INDID_PARENT"))


def q_share_of_group(src, cfg: MartConfig) -> DataFrame:
    s = src.staffing.filter(F.col("areaid_type") == "COUNTY").select(
        F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("occid").alias("OCCID"),
        F.col("indid").alias("INDID"), F.col("classid").alias("CLASSID"), F.col("emp").alias("EMP"))
    return share_of_group(s, ["YEAR", "AREAID", "OCCID"], "EMP", "SHARE")


def q_share_allocation(src, cfg: MartConfig) -> DataFrame:
    county = F.col("areaid_type") == "COUNTY"
    occ_totals = (src.occ.filter(county & (F.col("classid") != "4"))
                  .groupBy("year", "areaid", "occid").agg(F.sum("emp").alias("__occ_total")))
    staffing = (src.staffing.filter(county & (F.col("classid") == "1"))
                .groupBy("year", "areaid", "occid", "indid").agg(F.sum("emp").alias("__staff")))
    ind_totals = (src.ind.filter(county & (F.col("classid") != "4"))
                  .groupBy("year", "areaid", "indid").agg(F.sum("emp").alias("__num")))
    out = share_allocation(occ_totals, staffing, ind_totals, ["year", "areaid", "occid"], "indid",
                           "__staff", "__occ_total")
    return out.select(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"),
                      F.col("occid").alias("OCCID"), "NUM_EMPS", "OCC_EMPS", "PERCENT")


def q_allocate_by_percent(src, cfg: MartConfig) -> DataFrame:
    county = F.col("areaid_type") == "COUNTY"
    pct = src.staffing.filter(county & (F.col("classid") == "2")).select(
        F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"),
        F.col("occid").alias("OCCID"), F.col("percent").alias("PERCENT"))
    has = (src.hiresseps.filter(county)
           .groupBy(F.col("year").alias("YEAR"), F.col("areaid").alias("AREAID"), F.col("indid").alias("INDID"))
           .agg(F.sum("hira").alias("HIRES"), F.sum("sep").alias("SEPS")))
    out = allocate_by_percent(pct, has, ["YEAR", "AREAID", "INDID"], "PERCENT",
                              {"HIRES": "OCC_HIRES", "SEPS": "OCC_SEPS"})
    return out.select("YEAR", "AREAID", "INDID", "OCCID", "PERCENT", "HIRES", "OCC_HIRES", "SEPS", "OCC_SEPS")


def q_location_quotient(src, cfg: MartConfig) -> DataFrame:
    lq = location_quotient(src.staffing.filter(F.col("classid") == "1"), cfg, "occid", F.col("occid"), "occ")
    return lq.withColumnRenamed("OCC", "OCCID")


def q_shift_period(src, cfg: MartConfig) -> DataFrame:
    e = src.enrollments.select(F.col("year").alias("YEAR"), F.col("unitid").alias("UNITID"),
                               F.col("enrlevelid").alias("ENRLEVELID"), F.col("enrollments").alias("ENROLLMENTS"))
    return shift_period(e, "YEAR", 2)


def q_year_over_year(src, cfg: MartConfig) -> DataFrame:
    base = (src.occ.filter((F.col("areaid_type") == "COUNTY") & (F.col("classid") != "4"))
            .groupBy(F.col("areaid").alias("AREAID"), F.col("occid").alias("OCCID"), F.col("year").alias("YEAR"))
            .agg(F.sum(F.col("replacements") + F.col("growth")).alias("OPENINGS")))
    return year_over_year(base, ["AREAID", "OCCID"], "YEAR", ["OPENINGS"])


def q_flagged_count(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state).select(
        "id", F.year("posted").cast("int").alias("YEAR_POSTED"), F.col("county").alias("AREAID"))
    software = src.postings_skills.filter(F.col("is_software")).select("id")
    return flagged_count(p, software, "id", ["YEAR_POSTED", "AREAID"], "NUM_JOBS", "NUM_JOBS_WITH_SOFTWARE")


def q_sum_with_support(src, cfg: MartConfig) -> DataFrame:
    return sum_with_support(src.postings.withColumnRenamed("county", "AREAID"), ["AREAID"], {
        "duration": ("TOTAL_DURATION", "N_WITH_DURATION"),
        "salary": ("TOTAL_SALARY", "N_WITH_SALARY"),
    }, count_out="NUM_JOBS").select(
        "AREAID", "NUM_JOBS", F.col("TOTAL_DURATION").cast("bigint").alias("TOTAL_DURATION"), "N_WITH_DURATION",
        F.col("TOTAL_SALARY").cast("decimal(28,2)").alias("TOTAL_SALARY"), "N_WITH_SALARY")


def q_group_total_alongside(src, cfg: MartConfig) -> DataFrame:
    posts = src.postings.select("id", F.col("county").alias("AREAID"))
    detail = (src.postings_skills.select("id", "skill_id").join(posts, "id")
              .groupBy("AREAID", F.col("skill_id").alias("SKILL_ID")).agg(F.count(F.lit(1)).alias("MENTIONS")))
    return group_total_alongside(detail, posts, ["AREAID"], "TOTAL_JOBS")


def q_entity_fanout_count(src, cfg: MartConfig) -> DataFrame:
    by_company = src.postings.select(F.col("company").alias("id"), "soc_2", "min_edulevels")
    out = entity_fanout_count([(src.profiles_educations, "school_name"), (by_company, "soc_2"),
                               (by_company, "min_edulevels")], "id", ["inner", "left"], "N")
    return out.select(F.col("school_name").alias("SCHOOL"), F.col("soc_2").alias("SOC_2"),
                      F.col("min_edulevels").alias("MIN_EDULEVELS"), "N")


def q_latest_and_prior_year(src, cfg: MartConfig) -> DataFrame:
    e = src.enrollments.select(F.col("year").alias("YEAR"), F.col("unitid").alias("UNITID"),
                               F.col("raceid").alias("RACEID"), F.col("genderid").alias("GENDERID"),
                               F.col("enrlevelid").alias("ENRLEVELID"), F.col("enrollments").alias("ENROLLMENTS"))
    return latest_and_prior_year(e, "YEAR")


_LEVELS = {3: "L3", 5: "L5", 7: "L7", 9: "L9", 11: "L11"}


def q_pivot_current_prior(src, cfg: MartConfig) -> DataFrame:
    p = pivot_current_prior(src.completions, "unitid", "awlevelid", _LEVELS, "completions", "year")
    return p.withColumnRenamed("unitid", "UNITID").select(
        "UNITID", *[F.col(c).cast("bigint").alias(c) for c in p.columns if c != "unitid"])


def q_change_and_pct_change(src, cfg: MartConfig) -> DataFrame:
    p = q_pivot_current_prior(src, cfg).select(
        "UNITID", F.coalesce("CURRENT_L3", F.lit(0)).alias("CUR"), F.coalesce("PRIOR_L3", F.lit(0)).alias("PRIOR"))
    p = change_and_pct_change(p, "CUR", "PRIOR", "RAW_CHANGE", "PCT_CHANGE_DIV0", zero="div0")
    return change_and_pct_change(p, "CUR", "PRIOR", None, "PCT_CHANGE_NULL", zero="null")


def q_calendar_window_count(src, cfg: MartConfig) -> DataFrame:
    return calendar_window_count(src.postings.withColumnRenamed("county", "AREAID"), "posted", cfg.as_of,
                                 ["AREAID"], "CURRENT_ROLLING", "PRIOR_ROLLING")


def q_star_join(src, cfg: MartConfig) -> DataFrame:
    p = src.postings.withColumn("areaid", F.col("county").cast("string"))
    spine = filter_state(p, "county", cfg.state).select("areaid").distinct()
    sides = [
        p.groupBy("areaid").agg(F.count(F.lit(1)).alias("POSTINGS")),
        src.unit.groupBy(F.col("county").cast("string").alias("areaid")).agg(F.count(F.lit(1)).alias("UNITS")),
        src.acs.select("areaid", F.col("median_household_income").alias("MEDIAN_HOUSEHOLD_INCOME")),
    ]
    return star_join(spine, sides, "areaid").withColumnRenamed("areaid", "AREAID")


def q_table_source(src, cfg: MartConfig) -> DataFrame:
    """fact_skills read through catalog tables instead of paths (A1)."""
    names = ("postings", "postings_skills", "crosswalk")
    paths = {name: f"{src.root}/{SOURCE_ROLES[name]}" for name in names}
    contract = {name: getattr(src, name).schema for name in names}
    database = "tallgrass_" + src.root.rsplit("/", 2)[1]
    tables = register_external(src.spark, database, paths, f"{src.root}/{database}")
    return fact_skills(TableCatalog(src.spark, tables, contract), cfg)


OPERATOR_QUERIES = {
    "filter_state": q_filter_state,
    "filter_state_text": q_filter_state_text,
    "crosswalk_left": q_crosswalk_left,
    "crosswalk_inner": q_crosswalk_inner,
    "index_to_baseline": q_index_to_baseline,
    "prefer_source": q_prefer_source,
    "share_of_group": q_share_of_group,
    "share_allocation": q_share_allocation,
    "allocate_by_percent": q_allocate_by_percent,
    "location_quotient": q_location_quotient,
    "shift_period": q_shift_period,
    "year_over_year": q_year_over_year,
    "flagged_count": q_flagged_count,
    "sum_with_support": q_sum_with_support,
    "group_total_alongside": q_group_total_alongside,
    "entity_fanout_count": q_entity_fanout_count,
    "latest_and_prior_year": q_latest_and_prior_year,
    "pivot_current_prior": q_pivot_current_prior,
    "change_and_pct_change": q_change_and_pct_change,
    "calendar_window_count": q_calendar_window_count,
    "star_join": q_star_join,
    "table_source": q_table_source,
    "flatten_hierarchy": q_flatten_hierarchy,
}
