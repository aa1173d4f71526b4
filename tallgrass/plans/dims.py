"""Dimension marts (dim_*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import filter_state
from tallgrass.operators.relational import (
    asc_nulls_last,
    broadcast_if_bounded,
    distinct_of_ids,
    flatten_hierarchy,
    materialize,
    prefer_source,
)


def dim_area(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state)
    return p.select(F.col("county").alias("AREAID"), F.col("county_name").alias("COUNTY_NAME")).distinct()


def dim_awlevels(src, cfg: MartConfig) -> DataFrame:
    units = filter_state(src.unit, "county", cfg.state).select("unitid")
    cd = src.completions.filter(F.col("awlevelid").isin(*cfg.award_levels))
    return (cd.join(broadcast_if_bounded(units), "unitid")
              .select(F.col("awlevelid").alias("AWLEVELID"), F.col("awlevelid_name").alias("AWLEVELID_NAME"))
              .distinct())


def dim_company(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state)
    return p.select(F.col("company").alias("COMPANY"), F.col("company_name").alias("COMPANY_NAME")).distinct()


def dim_edulevels(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state)
    return p.select(F.col("min_edulevels").alias("MIN_EDULEVELS"),
                    F.col("min_edulevels_name").alias("MIN_EDULEVELS_NAME")).distinct()


def dim_occ(src, cfg: MartConfig) -> DataFrame:
    p = filter_state(src.postings, "county", cfg.state)
    groups = p.select(F.concat(F.left("soc_2", F.lit(2)), F.lit("-0000")).alias("TL_SOC_CODE"),
                      F.col("soc_2_name").alias("SOC_2_NAME")).distinct()
    occ = (src.dim_occid.filter(F.right("occid", F.lit(1)) != F.lit("0"))
           .withColumn("TLOCCID", F.concat(F.left("occid", F.lit(2)), F.lit("-0000"))))
    joined = occ.join(broadcast_if_bounded(groups), occ["TLOCCID"] == groups["TL_SOC_CODE"], "inner")
    return joined.select(
        "TLOCCID", "SOC_2_NAME",
        F.col("occid").alias("OCCID"), F.col("name").alias("SOC_5_NAME"),
        F.col("description").alias("DESCRIPTION"), F.col("typicaleducation").alias("TYPICALEDUCATION"),
        F.col("typicalexperience").alias("TYPICALEXPERIENCE"), F.col("typicaltraining").alias("TYPICALTRAINING"),
    )


def dim_programs(src, cfg: MartConfig) -> DataFrame:
    flat = flatten_hierarchy(src.programs, "programid", "programid_parent", ["name", "level"],
                             leaf=F.col("level") == 3, depth=2, how="inner")
    return flat.select(F.col("h0_programid").alias("PROGRAMID"), F.col("h0_name").alias("NAME"),
                       F.col("h2_programid").alias("TLPROGRAMID"), F.col("h2_name").alias("TLNAME"))


def dim_schools(src, cfg: MartConfig) -> DataFrame:
    u = filter_state(src.unit, "county", cfg.state)
    return u.select(F.col("unitid").alias("UNITID"), F.col("county").alias("AREAID"), F.col("name").alias("NAME"),
                    F.col("sector").alias("SECTOR"), F.col("sector_description").alias("SECTOR_DESCRIPTION"))


SKILL_ATTRS = ["skill_id", "skill_name", "skill_type", "skill_category", "skill_category_name",
               "skill_subcategory", "skill_subcategory_name", "is_software"]


def dim_skills(src, cfg: MartConfig) -> DataFrame:
    ids = filter_state(src.postings, "county", cfg.state).select("id")
    s = distinct_of_ids(src.postings_skills, SKILL_ATTRS, "skill_id", "id", ids)
    return s.select(*[F.col(c).alias(c.upper()) for c in SKILL_ATTRS])


def dim_university(src, cfg: MartConfig) -> DataFrame:
    u = filter_state(src.unit.filter(~F.col("name").like("%not current%")), "county", cfg.state)
    ra = src.ref_area.select(F.col("areaid").alias("__ra_id"), F.col("areaid_name").alias("COUNTYNM"))
    j = u.join(broadcast_if_bounded(ra), u["county"] == F.col("__ra_id"), "left")
    return j.select(
        F.col("unitid").alias("UNITID"), F.col("name").alias("INSTNM"), F.col("address").alias("ADDR"),
        F.col("city").alias("CITY"), F.col("stateabbreviation").alias("STABBR"), F.col("zip").alias("ZIP"),
        F.col("county").alias("COUNTYCD"), "COUNTYNM",
        F.col("longitude").alias("LONGITUD"), F.col("latitude").alias("LATITUDE"),
    ).distinct()


# dim_ind ---------------------------------------------------------------
_POSTED_LEVELS = [(6, "naics6", "naics5"), (5, "naics5", "naics4"), (4, "naics4", "naics3"),
                  (3, "naics3", "naics2"), (2, "naics2", None)]


def combined_industries(src, cfg: MartConfig) -> DataFrame:
    """Industry codes from the dimension and from in-state postings (G1).

    The five per-level ``SELECT DISTINCT`` branches over postings become one
    scan: each posting yields one struct per level, exploded, then distinct.
    """
    p = filter_state(src.postings, "county", cfg.state)
    rows = F.array(*[
        F.struct(F.col(f"{code}_name").alias("name"), F.lit(level).alias("level"), F.col(code).alias("indid"),
                 (F.col(parent) if parent else F.lit(None).cast("string")).alias("indid_parent"))
        for level, code, parent in _POSTED_LEVELS
    ])
    posted = (p.select(F.explode(rows).alias("r")).select("r.*")
               .filter(F.col("indid").isNotNull()).distinct()
               .withColumn("source", F.lit("postings")))
    dim = src.dim_indid.select("name", "level", "indid", "indid_parent", F.lit("dim_indid").alias("source"))
    return dim.unionByName(posted)


def prioritized_industries(combined: DataFrame) -> DataFrame:
    """One row per code; the dimension wins over postings (E1, trap T8:
    level, name and parent break ties so the choice is repeatable)."""
    prio = F.when(F.col("source") == "dim_indid", F.lit(1)).otherwise(F.lit(2))
    order = [prio, *asc_nulls_last("level"), *asc_nulls_last("name"), *asc_nulls_last("indid_parent")]
    return prefer_source(combined, ["indid"], order, ["name", "level", "indid_parent"])


def dim_ind(src, cfg: MartConfig) -> DataFrame:
    # the combined code list is small and read five times below: one scan
    combined = materialize(combined_industries(src, cfg))
    prio = prioritized_industries(combined)
    flat = flatten_hierarchy(prio, "indid", "indid_parent", ["name", "level"],
                             leaf=F.col("level") == 6, depth=4, how="left", prefix="c")
    level6 = flat.select(
        F.trim("c4_indid").alias("TLINDID"), F.trim("c4_name").alias("NAICS2_NAME"),
        F.trim("c0_indid").alias("INDID"), F.trim("c0_name").alias("NAICS6_NAME"),
        F.trim("c1_indid").alias("NAICS5_CODE"), F.trim("c1_name").alias("NAICS5_NAME"),
        F.trim("c2_indid").alias("NAICS4_CODE"), F.trim("c2_name").alias("NAICS4_NAME"),
        F.trim("c3_indid").alias("NAICS3_CODE"), F.trim("c3_name").alias("NAICS3_NAME"),
    ).distinct()

    bucket = F.trim("lc_bucket_indid")
    keys = (src.crosswalk.filter(F.col("lc_bucket_indid").isNotNull() & (F.length(bucket) != 6))
            .select(bucket.alias("INDID")).distinct())
    keys = keys.withColumn("TLINDID", F.when(F.length("INDID") == 2, F.col("INDID"))
                           .otherwise(F.left("INDID", F.lit(2))))
    sectors = prio.filter(F.col("level") == 2).select(F.col("indid").alias("__p2_id"), F.col("name").alias("__p2_name"))
    names = (combined.groupBy(F.trim("indid").alias("__bn_id"))
             .agg(F.max(F.trim("name")).alias("__bn_name")))
    none = F.lit(None).cast("string")
    bucket_rows = (keys.join(broadcast_if_bounded(sectors), keys["TLINDID"] == F.col("__p2_id"), "left")
                   .join(broadcast_if_bounded(names), keys["INDID"] == F.col("__bn_id"), "left")
                   .select(
                       "TLINDID",
                       F.coalesce(F.col("__p2_name"),
                                  F.when(F.left("INDID", F.lit(2)) == "90", F.lit("Government"))).alias("NAICS2_NAME"),
                       "INDID",
                       F.coalesce(F.col("__bn_name"), F.when(F.col("INDID") == "90", F.lit("Government")),
                                  F.concat(F.lit("Bucket "), F.col("INDID"))).alias("NAICS6_NAME"),
                       none.alias("NAICS5_CODE"), none.alias("NAICS5_NAME"), none.alias("NAICS4_CODE"),
                       none.alias("NAICS4_NAME"), none.alias("NAICS3_CODE"), none.alias("NAICS3_NAME"),
                   ).distinct())
    return level6.unionByName(bucket_rows)
