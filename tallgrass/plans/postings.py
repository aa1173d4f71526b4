"""Job-posting marts: fact_jobs*, fact_skills*, certifications, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import filter_state
from tallgrass.operators.relational import (
    crosswalk,
    entity_fanout_count,
    flagged_count,
    index_to_baseline,
    shift_period,
    sum_with_support,
)


def _in_state(src, cfg: MartConfig) -> DataFrame:
    return filter_state(src.postings, "county", cfg.state)


def _not_staffing(df: DataFrame) -> DataFrame:
    # '= FALSE' drops NULL flags too
    return df.filter(F.col("company_is_staffing") == F.lit(False))


def _period_cols():
    return [F.year("posted").cast("int").alias("YEAR_POSTED"),
            F.quarter("posted").cast("int").alias("QUARTER_POSTED"),
            F.month("posted").cast("int").alias("MONTH_POSTED")]


def fact_jobs(src, cfg: MartConfig) -> DataFrame:
    p = _not_staffing(_in_state(src, cfg))
    p = crosswalk(p, src.crosswalk, "naics6", "postings_naics6", "lc_bucket_indid", out="__bucket", how="left")
    p = p.select(*_period_cols(), F.col("county").alias("AREAID"), F.col("__bucket").alias("INDID"),
                 F.col("soc_5").alias("OCCID"), F.col("company").alias("COMPANY"),
                 F.col("min_edulevels").alias("MIN_EDULEVELS"), F.col("is_internship").alias("IS_INTERNSHIP"),
                 "duration", "duplicates", "salary")
    keys = ["YEAR_POSTED", "QUARTER_POSTED", "MONTH_POSTED", "AREAID", "COMPANY", "INDID", "OCCID",
            "MIN_EDULEVELS", "IS_INTERNSHIP"]
    out = sum_with_support(p, keys, {
        "duration": ("CURR_TOTAL_DURATION", "CURR_N_WITH_DURATION"),
        "duplicates + 1": ("CURR_TOTAL_TIMES_JOB_POSTED", None),
        "salary": ("CURR_TOTAL_SALARY", "CURR_N_WITH_SALARY"),
    }, count_out="CURR_NUM_JOBS")
    return out.select(
        "YEAR_POSTED", "QUARTER_POSTED", "MONTH_POSTED", "AREAID", "INDID", "OCCID", "COMPANY",
        "MIN_EDULEVELS", "IS_INTERNSHIP", "CURR_NUM_JOBS",
        F.col("CURR_TOTAL_DURATION").cast("bigint").alias("CURR_TOTAL_DURATION"), "CURR_N_WITH_DURATION",
        F.col("CURR_TOTAL_TIMES_JOB_POSTED").cast("bigint").alias("CURR_TOTAL_TIMES_JOB_POSTED"),
        F.col("CURR_TOTAL_SALARY").cast("decimal(28,2)").alias("CURR_TOTAL_SALARY"), "CURR_N_WITH_SALARY",
    )


def fact_jobs_lagged(src, cfg: MartConfig) -> DataFrame:
    return shift_period(fact_jobs(src, cfg), "YEAR_POSTED", 1)


def _jobs_index(src, cfg: MartConfig, area: "F.Column") -> DataFrame:
    b = cfg.baseline_year
    p = _not_staffing(_in_state(src, cfg))
    yearly = (p.withColumn("YEAR_POSTED", F.year("posted").cast("int"))
               .filter(F.col("YEAR_POSTED") >= b)
               .groupBy("YEAR_POSTED", area.alias("AREAID"))
               .agg(F.count(F.lit(1)).alias("CURR_NUM_JOBS")))
    idx = index_to_baseline(yearly, ["AREAID"], "CURR_NUM_JOBS", F.col("YEAR_POSTED") == b,
                            f"BASE_{b}_JOBS", f"JOBS_INDEX_TO_{b}")
    return idx.select(F.make_date("YEAR_POSTED", F.lit(1), F.lit(1)).alias("DATE"), "YEAR_POSTED", "AREAID",
                      "CURR_NUM_JOBS", f"BASE_{b}_JOBS", f"JOBS_INDEX_TO_{b}")


def fact_jobs_county_idx(src, cfg: MartConfig) -> DataFrame:
    return _jobs_index(src, cfg, F.col("county_name"))


def fact_jobs_state_idx(src, cfg: MartConfig) -> DataFrame:
    return _jobs_index(src, cfg, F.lit(cfg.state_name))


def _certifications(src, cfg: MartConfig) -> DataFrame:
    s = src.postings_skills
    return s.filter((F.col("skill_type") == F.lit(cfg.certification_type))
                    & (F.col("skill_name") != F.lit(cfg.excluded_certification)))


def _posting_keys():
    return [
        (F.year("posted").cast("int"), "YEAR_POSTED"), (F.col("county"), "AREAID"), (F.col("naics6"), "INDID"),
        (F.col("soc_5"), "OCCID"), (F.col("company"), "COMPANY"), (F.col("min_edulevels"), "MIN_EDULEVELS"),
        (F.col("is_internship"), "INTERNSHIP"),
    ]


def fact_certifications(src, cfg: MartConfig) -> DataFrame:
    p = _in_state(src, cfg).select("id", *[c.alias(n) for c, n in _posting_keys()])
    j = _certifications(src, cfg).select("id", "skill_id").join(p, "id")
    keys = [n for _, n in _posting_keys()]
    return (j.groupBy(*keys, F.col("skill_id").alias("SKILL_ID"))
             .agg(F.count(F.lit(1)).alias("TOTAL_CERTS_COUNT")))


def fact_jobwithcerts(src, cfg: MartConfig) -> DataFrame:
    p = _in_state(src, cfg).select("id", *[c.alias(n) for c, n in _posting_keys()])
    keys = [n for _, n in _posting_keys()]
    return flagged_count(p, _certifications(src, cfg).select("id"), "id", keys, "NUM_JOBS", "NUM_JOBS_WITH_CERT")


_SKILL_GROUP = ["YEAR_POSTED", "QUARTER_POSTED", "MONTH_POSTED", "AREAID", "INDID", "OCCID",
                "MIN_EDULEVELS", "IS_INTERNSHIP"]


def fact_skills(src, cfg: MartConfig) -> DataFrame:
    """Skill mentions with the total jobs of the same raw-NAICS6 group.

    Postings are enriched first (bucket via a broadcast crosswalk, group
    total via an aggregate joined back), so the big skills table is joined
    once, on ``id``, and then aggregated.
    """
    p = _in_state(src, cfg).select(
        "id", *_period_cols(), F.col("county").alias("AREAID"), F.col("naics6").alias("INDID"),
        F.col("soc_5").alias("OCCID"), F.col("min_edulevels").alias("MIN_EDULEVELS"),
        F.col("is_internship").alias("IS_INTERNSHIP"), "company_is_staffing")
    totals = p.groupBy(*_SKILL_GROUP).agg(F.count("id").alias("CURR_TOTAL_JOBS_COUNT"))
    eligible = crosswalk(_not_staffing(p), src.crosswalk, "INDID", "postings_naics6", "lc_bucket_indid",
                         out="__bucket", how="inner")
    enriched = eligible.join(totals, on=_SKILL_GROUP, how="inner")  # NULL keys never match (T10)
    j = src.postings_skills.select("id", "skill_id").join(enriched, "id")
    return (j.groupBy(F.col("skill_id").alias("SKILL_ID"), "YEAR_POSTED", "QUARTER_POSTED", "MONTH_POSTED", "AREAID",
                      F.col("__bucket").alias("INDID"), "OCCID", "MIN_EDULEVELS", "IS_INTERNSHIP",
                      "CURR_TOTAL_JOBS_COUNT")
             .agg(F.count(F.lit(1)).alias("CURR_NUM_SKILLS"))
             .select("SKILL_ID", "YEAR_POSTED", "QUARTER_POSTED", "MONTH_POSTED", "AREAID", "INDID", "OCCID",
                     "MIN_EDULEVELS", "IS_INTERNSHIP", "CURR_NUM_SKILLS", "CURR_TOTAL_JOBS_COUNT"))


def fact_skills_lagged(src, cfg: MartConfig) -> DataFrame:
    return shift_period(fact_skills(src, cfg), "YEAR_POSTED", 1)


def fact_profiles(src, cfg: MartConfig) -> DataFrame:
    prof = filter_state(src.profiles, "county", cfg.state)
    # the national education rows first meet the in-state ids: the inner join
    # below keeps no others, and their distinct pairs need no further exchange
    schools = src.profiles_educations.join(prof.select("id"), "id", "left_semi")
    out = entity_fanout_count(
        [(schools, "school_name"), (prof, "county"), (prof, "naics6"), (prof, "soc_5")],
        "id", ["inner", "left", "left"], "TOTAL_PROFILES_COUNT")
    return out.select(F.col("county").alias("AREAID"), F.col("naics6").alias("INDID"),
                      F.col("soc_5").alias("OCCID"), F.col("school_name").alias("SCHOOL"), "TOTAL_PROFILES_COUNT")
