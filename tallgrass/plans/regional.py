"""fact_regional_indicators: one scorecard row per county.

The source query is ~20 CTEs; here each source table is read once:
labour force averaged per county and year, of which the newest two years are
taken from the small result; one conditional aggregation
per table for population, postings, enrollments and completions (the ten
near-identical completion CTEs become one pass, D17), then a star of
broadcast left joins onto the labour-force spine (C14).  Every side is
grouped by county, so its size is bounded by the number of areas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import avg_ratio, div0, filter_state, in_state, safe_ratio
from tallgrass.operators.relational import (
    broadcast_if_bounded,
    pivot_current_prior,
    star_join,
)
from tallgrass.plans.education import in_state_units, totals_only

COMPLETION_LEVELS = {3: "ASSOC_COMPLETIONS", 5: "BACH_COMPLETIONS", 7: "MASTERS_COMPLETIONS",
                     9: "DOCTORS_COMPLETIONS", 11: "CERT_COMPLETIONS"}


def _current_and_prior(per_year: DataFrame, keys: list[str], age: Column, values: list[str],
                       current_only: bool) -> DataFrame:
    """Rows of the current year (``age`` 0) beside those of the year before (1), by ``areaid``.

    What belongs to an area is a handful of rows (its names, two years): they are
    gathered and paired without a second read.  The year before has prefix ``P_``;
    an area without current rows goes if ``current_only``."""
    row = F.struct(*keys, *values)
    two = per_year.withColumn("__age", age).filter(F.col("__age").isin(0, 1)).groupBy("areaid").agg(
        F.collect_list(F.when(F.col("__age") == 0, row)).alias("now"),
        F.collect_list(F.when(F.col("__age") == 1, row)).alias("before"))
    unroll = F.explode if current_only else F.explode_outer
    paired = two.select("areaid", unroll("now").alias("now"), "before") \
        .select("areaid", "now", F.explode_outer("before").alias("before"))
    return paired.select("areaid", *[F.col(f"now.{c}").alias(c) for c in [*keys, *values]],
                         *[F.col(f"before.{c}").alias(f"P_{c}") for c in values])


def _labour_force(src, cfg: MartConfig) -> DataFrame:
    """The spine from one read: averages per county and year, of which the newest two
    years count.  The newest year is the nation's, so rows of other states stay in the
    aggregation, but only as one row per year."""
    lf = src.labor_force.filter(F.col("areaid_type") == "COUNTY")
    mine = F.coalesce(in_state("areaid", lf.schema["areaid"].dataType, cfg.state), F.lit(False)) \
        & (F.col("areaid") != F.lit(cfg.state))
    own = lf.select("year", *[F.when(mine, F.col(c)).alias(c) for c in
                              ("areaid", "areaid_name", "lfp_denom", "emp", "unemp", "pop")])
    force = F.col("emp") + F.col("unemp")
    per_year = own.groupBy("areaid", "areaid_name", "lfp_denom", "year").agg(
        avg_ratio(force, F.col("pop")).alias("LFPR"), F.round(F.avg("unemp"), 0).alias("UNEMP"),
        avg_ratio(F.col("unemp"), force).alias("UNEMPR"), F.round(F.avg("emp"), 0).alias("EMP"))
    # one row per county and year is left: a window without partitions over a code list
    newest = per_year.withColumn("__newest", F.max("year").over(Window.partitionBy())).filter(F.col("areaid").isNotNull())
    return _current_and_prior(newest, ["areaid_name", "lfp_denom"], F.col("__newest") - F.col("year"),
                              ["LFPR", "UNEMP", "UNEMPR", "EMP"], current_only=True)


def fact_regional_indicators(src, cfg: MartConfig) -> DataFrame:
    spine = _labour_force(src, cfg)

    cur_pop, prior_pop = cfg.population_years
    demog = totals_only(filter_state(src.demog.filter((F.col("areaid_type") == "COUNTY")
                                                      & F.col("ageid").startswith("G")), "areaid", cfg.state),
                        raceid=0, genderid=0)
    # grouped with the county's name, so a renamed county keeps a row per name
    people = (demog.filter(F.col("year").isin(cur_pop, prior_pop))
              .groupBy("areaid", "areaid_name", F.when(F.col("year") == cur_pop, 0).otherwise(1).alias("age"))
              .agg(F.round(F.sum("pop"), 0).cast("bigint").alias("POPULATION")))
    population = _current_and_prior(people, ["areaid_name"], F.col("age"), ["POPULATION"], current_only=False) \
        .select("areaid", F.col("POPULATION").alias("CURRENT_POPULATION"), F.col("P_POPULATION").alias("PRIOR_POPULATION"))

    acs = filter_state(src.acs.filter(F.col("areaid_type") == "COUNTY"), "areaid", cfg.state).select(
        "areaid", F.col("median_household_income").alias("MEDIAN_HOUSEHOLD_INCOME"),
        F.col("poverty_level_pct").alias("POVERTY_LEVEL"))

    # one pass over postings: same-year count and the two calendar windows
    p = filter_state(src.postings, "county", cfg.state)
    gap = F.lit(cfg.as_of_year) - F.year("posted")
    postings = p.groupBy(F.col("county").cast("string").alias("areaid")).agg(
        F.sum(F.when(F.year("posted") == cfg.as_of_year, F.lit(1))).cast("bigint").alias("CURRENT_NUMBER_POSTINGS"),
        F.sum(F.when(gap < 1, F.lit(1))).cast("bigint").alias("CURRENT_ROLLING_NUMBER_POSTINGS"),
        F.sum(F.when((gap >= 1) & (gap < 2), F.lit(1))).cast("bigint").alias("PRIOR_ROLLING_NUMBER_POSTINGS"))

    units = in_state_units(src, cfg).withColumn("areaid", F.col("county").cast("string"))
    en = totals_only(src.enrollments, raceid=0, genderid=0, enrlevelid=1)
    enrolled = pivot_current_prior(en.join(units, "unitid"), "areaid", "enrlevelid", {None: "NUMBER_ENROLLED"},
                                   "enrollments", "year",
                                   current_year=src.enrollments.select(F.max("year")).scalar())
    programs = src.programs.filter(F.col("level") == 3).select("programid")
    cd = (totals_only(src.completions, raceid=0, genderid=0)
          .join(broadcast_if_bounded(programs), "programid").join(units, "unitid"))
    completions = pivot_current_prior(cd, "areaid", "awlevelid", COMPLETION_LEVELS, "completions", "year",
                                      current_year=src.completions.select(F.max("year")).scalar())

    j = star_join(spine, [population, postings, enrolled, completions, acs], "areaid")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    lf_cur = F.col("EMP") + F.col("UNEMP")
    lf_prior = F.col("P_EMP") + F.col("P_UNEMP")
    cur_c = [z(f"CURRENT_{s}") for s in COMPLETION_LEVELS.values()]
    prior_c = [z(f"PRIOR_{s}") for s in COMPLETION_LEVELS.values()]
    cur_total = cur_c[0] + cur_c[1] + cur_c[4] + cur_c[2] + cur_c[3]
    prior_total = prior_c[0] + prior_c[1] + prior_c[4] + prior_c[2] + prior_c[3]
    return j.select(
        F.col("areaid").alias("AREAID"), F.col("areaid_name").alias("COUNTY_NAME"),
        lf_cur.alias("CURRENT_YEAR_LABOR_FORCE"), lf_prior.alias("PRIOR_YEAR_LABOR_FORCE"),
        F.col("LFPR").alias("CURRENT_LABOR_FORCE_PARTICIPATION_RATE"),
        F.col("P_LFPR").alias("PRIOR_LABOR_FORCE_PARTICIPATION_RATE"),
        (lf_cur - lf_prior).alias("RAW_CHANGE_IN_LABOR_FORCE"),
        F.try_divide(lf_cur - lf_prior, lf_prior).alias("PCT_CHANGE_IN_LABOR_FORCE"),
        F.col("UNEMP").alias("CURRENT_UNEMPLOYED"), F.col("P_UNEMP").alias("PRIOR_UNEMPLOYED"),
        F.col("UNEMPR").alias("CURRENT_UNEMPLOYMENT_RATE"), F.col("P_UNEMPR").alias("PRIOR_UNEMPLOYMENT_RATE"),
        F.try_divide(F.col("UNEMPR") - F.col("P_UNEMPR"), F.col("P_UNEMPR")).alias("PCT_CHANGE_IN_UNEMPLOYMENT_RATE"),
        F.col("EMP").alias("CURRENT_EMPLOYED"), F.col("P_EMP").alias("PRIOR_EMPLOYED"),
        (F.col("EMP") - F.col("P_EMP")).alias("CHANGE_IN_EMPLOYED"),
        "CURRENT_POPULATION", "PRIOR_POPULATION",
        (F.col("CURRENT_POPULATION") - F.col("PRIOR_POPULATION")).alias("RAW_CHANGE_IN_POPULATION"),
        safe_ratio(F.col("CURRENT_POPULATION") - F.col("PRIOR_POPULATION"), "PRIOR_POPULATION")
        .alias("PCT_CHANGE_IN_POPULATION"),
        "MEDIAN_HOUSEHOLD_INCOME",
        F.col("CURRENT_NUMBER_POSTINGS").cast("bigint").alias("CURRENT_NUMBER_POSTINGS"),
        "CURRENT_ROLLING_NUMBER_POSTINGS", "PRIOR_ROLLING_NUMBER_POSTINGS",
        safe_ratio(F.col("CURRENT_ROLLING_NUMBER_POSTINGS") - F.col("PRIOR_ROLLING_NUMBER_POSTINGS"),
                   "PRIOR_ROLLING_NUMBER_POSTINGS").alias("PCT_CHANGE_NUMBER_POSTINGS"),
        z("CURRENT_NUMBER_ENROLLED").alias("CURRENT_NUMBER_ENROLLED"),
        z("PRIOR_NUMBER_ENROLLED").alias("PRIOR_NUMBER_ENROLLED"),
        (z("CURRENT_NUMBER_ENROLLED") - z("PRIOR_NUMBER_ENROLLED")).alias("RAW_CHANGE_ENROLLED"),
        div0(z("CURRENT_NUMBER_ENROLLED") - z("PRIOR_NUMBER_ENROLLED"), z("PRIOR_NUMBER_ENROLLED"))
        .alias("PCT_CHANGE_ENROLLED"),
        *[c.alias(f"CURRENT_{s}") for c, s in zip(cur_c, COMPLETION_LEVELS.values())],
        *[c.alias(f"PRIOR_{s}") for c, s in zip(prior_c, COMPLETION_LEVELS.values())],
        cur_total.alias("CURRENT_COMPLETIONS"), prior_total.alias("PRIOR_COMPLETIONS"),
        (cur_total - prior_total).alias("RAW_CHANGE_COMPLETIONS"),
        div0(cur_total - prior_total, prior_total).alias("PCT_CHANGE_COMPLETIONS"),
        "POVERTY_LEVEL",
    )
