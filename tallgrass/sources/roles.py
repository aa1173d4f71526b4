"""Source tables derived from the driver's tables ("role views").

The marts read nineteen source tables that are not available here.  Each is
built from the driver's TPC-H-like tables by one portable SQL text that Spark
and DuckDB both run, so the Spark marts and their DuckDB oracles start from
identical inputs; for five tables over all order lines Spark runs texts of
its own with the same rows (``SPARK_ROLE_SQL``).  Spark materialises every role table once per input folder
(a written Parquet table in the shared checkpoint folder), which is what a
mart sees in production: a plain source table.

County codes: nations 0-14 are in state 40 (codes 40001 + 2n); the others get
four-digit codes 5001 + 2n, so the zero-padding in the state test matters.
"""

from __future__ import annotations

import hashlib

# Shared expressions (plain text so both engines read the same rule).
_COUNTY_C = "cast(case when c_nationkey < 15 then 40001 + 2*c_nationkey else 5001 + 2*c_nationkey end as int)"
_COUNTY_S = "cast(case when s_nationkey < 15 then 40001 + 2*s_nationkey else 5001 + 2*s_nationkey end as int)"
_COUNTY_N = "cast(case when n_nationkey < 15 then 40001 + 2*n_nationkey else 5001 + 2*n_nationkey end as int)"
_AREA_C = f"cast({_COUNTY_C} as varchar(9))"
_IND_P = ("concat(cast(11 + 10*(p_size % 5) as varchar(9)), cast(p_partkey % 3 as varchar(9)), "
          "cast(p_size % 2 as varchar(9)), '0', cast(p_partkey % 2 as varchar(9)))")
_OCC_P = "concat(cast(11 + p_size % 4 as varchar(9)), '-', cast(1011 + p_partkey % 7 as varchar(9)))"
_CLASS_L = "case when l_returnflag = 'R' then '4' when l_returnflag = 'A' then '1' else '2' end"
_NAICS6_O = ("case when o_orderkey % 97 = 0 then null else concat(cast(11 + 10*(o_orderkey % 5) as varchar(9)), "
             "cast(o_orderkey % 3 as varchar(9)), cast(o_custkey % 2 as varchar(9)), "
             "cast(o_custkey % 3 as varchar(9)), '0') end")
_LINE_JOIN = ("from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey "
              "join part on l_partkey = p_partkey join nation on c_nationkey = n_nationkey")


def _naics_level(n: int) -> str:
    return f"left(naics6, {n}) as naics{n}, concat('Posted industry ', left(naics6, {n}), ' ') as naics{n}_name"


ROLE_SQL: dict[str, str] = {
    # POSTINGS
    "r_postings": f"""
select id, posted, county, county_name, naics6, concat(' Posted industry ', naics6) as naics6_name,
 {_naics_level(5)}, {_naics_level(4)}, {_naics_level(3)}, {_naics_level(2)},
 soc_5, soc_2, soc_2_name, company, company_name, min_edulevels, min_edulevels_name,
 is_internship, company_is_staffing, duration, duplicates, salary
from (
select o_orderkey as id, o_orderdate as posted, {_COUNTY_C} as county, n_name as county_name,
 {_NAICS6_O} as naics6,
 concat(cast(11 + o_custkey % 4 as varchar(9)), '-', cast(1011 + o_orderkey % 7 as varchar(9))) as soc_5,
 concat(cast(11 + o_custkey % 4 as varchar(9)), '-0000') as soc_2,
 concat('SOC group ', cast(11 + o_custkey % 4 as varchar(9))) as soc_2_name,
 o_custkey as company, c_name as company_name,
 case when o_orderkey % 53 = 0 then null else o_orderpriority end as min_edulevels,
 case when o_orderkey % 53 = 0 then null else concat('Edu ', o_orderpriority) end as min_edulevels_name,
 o_orderstatus = 'P' as is_internship, c_mktsegment = 'MACHINERY' as company_is_staffing,
 cast(case when o_orderkey % 4 = 0 then null else o_orderkey % 60 end as int) as duration,
 cast(o_orderkey % 3 as int) as duplicates,
 case when o_orderstatus = 'O' then null else cast(o_totalprice as decimal(18,2)) end as salary
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) b""",
    # POSTINGS_SKILLS
    "r_postings_skills": """
select l_orderkey as id, l_partkey as skill_id,
 case when l_partkey % 11 = 0 then 'Valid Driver''s License' else p_name end as skill_name,
 case when p_type in ('PROMO','LARGE') then 'Certification' else 'Common' end as skill_type,
 p_type as skill_category, concat('Category ', p_type) as skill_category_name,
 p_brand as skill_subcategory, concat('Subcategory ', p_brand) as skill_subcategory_name,
 p_size > 25 as is_software
from lineitem join part on l_partkey = p_partkey""",
    # DAT_STAFFING; PERCENT = occupation share of the industry's employment
    "r_staffing": f"""
with b as (select cast(year(o_orderdate) as int) as yr, c_nationkey as nk, n_name as nm, {_AREA_C} as a,
 {_IND_P} as ind, {_OCC_P} as occ, {_CLASS_L} as cls, cast(l_quantity as bigint) as q {_LINE_JOIN}),
s as (select yr as year, a as areaid, 'COUNTY' as areaid_type, nm as areaid_name, ind as indid, occ as occid,
 cls as classid, cast(sum(q) as bigint) as emp from b group by yr, a, nm, ind, occ, cls
 union all select yr, '40', 'STATE', 'Oklahoma', ind, occ, cls, cast(sum(q) as bigint) from b where nk < 15
 group by yr, ind, occ, cls)
select year, areaid, areaid_type, areaid_name, indid, occid, classid, emp,
 cast(emp as double) / cast(sum(emp) over (partition by year, areaid, areaid_type, indid, classid) as double) as percent
from s""",
    # DAT_OCC
    "r_occ": f"""
select year, areaid, 'COUNTY' as areaid_type, occid, classid, cast(sum(q) as bigint) as emp,
 cast(max(p) as decimal(18,2)) as earn_avg, cast(count(*) as bigint) as replacements,
 cast(sum(g) as bigint) as growth
from (select cast(year(o_orderdate) as int) as year, {_AREA_C} as areaid, {_OCC_P} as occid, {_CLASS_L} as classid,
 cast(l_quantity as bigint) as q, cast(l_extendedprice as decimal(18,2)) as p,
 case when l_linestatus = 'O' then 1 else 0 end as g {_LINE_JOIN}) b
group by year, areaid, occid, classid""",
    # DAT_IND
    "r_ind": f"""
select year, areaid, 'COUNTY' as areaid_type, indid, classid, cast(sum(q) as bigint) as emp,
 cast(sum(p) as decimal(28,2)) as earn
from (select cast(year(o_orderdate) as int) as year, {_AREA_C} as areaid, {_IND_P} as indid, {_CLASS_L} as classid,
 cast(l_quantity as bigint) as q, cast(l_extendedprice as decimal(18,2)) as p {_LINE_JOIN}) b
group by year, areaid, indid, classid""",
    # DAT_IND_RACE_ETHN_HIRESSEPS
    "r_hiresseps": f"""
select year, areaid, 'COUNTY' as areaid_type, indid, raceid, cast(count(*) as bigint) as hira,
 cast(sum(s) as bigint) as sep
from (select cast(year(o_orderdate) as int) as year, {_AREA_C} as areaid, {_IND_P} as indid,
 cast(l_linenumber % 3 as int) as raceid, case when l_returnflag = 'R' then 1 else 0 end as s {_LINE_JOIN}) b
group by year, areaid, indid, raceid""",
    # DAT_LABOR_FORCE
    "r_labor_force": f"""
with b as (select cast(year(o_orderdate) as int) as yr, cast(month(o_orderdate) as int) as mo, c_nationkey as nk,
 n_name as nm, {_AREA_C} as a, case when o_orderstatus = 'F' then 1 else 0 end as u
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
select yr as year, mo as month, a as areaid, 'COUNTY' as areaid_type, nm as areaid_name,
 cast(count(*) as bigint) as emp, cast(sum(u) as bigint) as unemp, cast(3*count(*) + 5 as bigint) as pop,
 cast(0 as bigint) as lfp_denom from b group by yr, mo, a, nm
union all select yr, mo, '40', 'STATE', 'Oklahoma', cast(count(*) as bigint), cast(sum(u) as bigint),
 cast(3*count(*) + 5 as bigint), cast(0 as bigint) from b where nk < 15 group by yr, mo""",
    # DAT_DEMOG
    "r_demog": f"""
select year, areaid, 'COUNTY' as areaid_type, areaid_name, ageid, raceid, genderid, cast(count(*) as bigint) as pop
from (select cast(year(o_orderdate) as int) as year, {_AREA_C} as areaid, n_name as areaid_name,
 case when o_orderkey % 5 = 0 then 'T1' else concat('G', cast(o_orderkey % 4 as varchar(9))) end as ageid,
 cast(o_orderkey % 3 as int) as raceid, cast(o_custkey % 2 as int) as genderid
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) b
group by year, areaid, areaid_name, ageid, raceid, genderid""",
    # DAT_ACS_INDICATORS
    "r_acs": f"""
select cast({_COUNTY_N} as varchar(9)) as areaid, 'COUNTY' as areaid_type, n_name as areaid_name,
 cast(30000 + 1000*n_nationkey as bigint) as median_household_income,
 cast(n_nationkey % 30 as int) as poverty_level_pct from nation""",
    # REF_AREAID
    "r_ref_area": f"select {_COUNTY_N} as areaid, n_name as areaid_name from nation",
    # DIM_UNITID
    "r_unit": f"""
select s_suppkey as unitid,
 case when s_suppkey % 10 = 0 then concat(s_name, ' (not current)') else s_name end as name,
 {_COUNTY_S} as county, concat('Street ', cast(s_suppkey as varchar(12))) as address, n_name as city,
 'ST' as stateabbreviation, cast(70000 + s_suppkey as varchar(12)) as zip,
 cast(s_nationkey as double) as longitude, cast(s_suppkey as double) as latitude,
 cast(s_suppkey % 4 as int) as sector, concat('Sector ', cast(s_suppkey % 4 as varchar(9))) as sector_description
from supplier join nation on s_nationkey = n_nationkey""",
    # DIM_PROGRAMID
    "r_programs": """
select concat('R', cast(r_regionkey as varchar(9))) as programid, r_name as name, 1 as level,
 cast(null as varchar(12)) as programid_parent from region
union all select concat('N', cast(n_nationkey as varchar(9))), n_name, 2,
 concat('R', cast(n_regionkey as varchar(9))) from nation
union all select concat('S', cast(s_suppkey as varchar(9))), s_name, 3,
 concat('N', cast(s_nationkey as varchar(9))) from supplier""",
    # DAT_COMPLETIONS_DEMOGRAPHICS
    "r_completions": """
select year, unitid, programid, awlevelid, concat('Award ', cast(awlevelid as varchar(9))) as awlevelid_name,
 raceid, genderid, cast(sum(q) as bigint) as completions
from (select cast(year(l_shipdate) as int) as year, l_suppkey as unitid,
 concat('S', cast(l_partkey % 10 as varchar(9))) as programid, cast(1 + 2*(l_linenumber % 6) as int) as awlevelid,
 cast(l_orderkey % 2 as int) as raceid, cast(l_partkey % 2 as int) as genderid,
 cast(l_quantity as bigint) as q from lineitem) b
group by year, unitid, programid, awlevelid, raceid, genderid""",
    # DAT_ENROLLMENTS
    "r_enrollments": """
select year, unitid, raceid, genderid, enrlevelid, cast(count(*) as bigint) as enrollments
from (select cast(year(l_shipdate) as int) as year, l_suppkey as unitid, cast(l_orderkey % 2 as int) as raceid,
 cast(l_partkey % 2 as int) as genderid, cast(1 + l_linenumber % 2 as int) as enrlevelid from lineitem) b
group by year, unitid, raceid, genderid, enrlevelid""",
    # DIM_OCCID
    "r_dim_occid": f"""
select distinct occid, concat('Occupation ', occid) as name, 5 as level,
 concat('Work described for ', occid) as description,
 case when sz % 3 = 0 then 'Bachelor''s degree' when sz % 3 = 1 then 'High school diploma' else 'No formal credential' end as typicaleducation,
 case when sz % 2 = 0 then 'None' else 'Less than 5 years' end as typicalexperience,
 case when sz % 4 = 0 then 'Apprenticeship' else 'None' end as typicaltraining
from (select {_OCC_P} as occid, p_size % 4 as sz from part) o
union all select distinct concat(cast(11 + p_size % 4 as varchar(9)), '-0000'),
 concat('Group ', cast(11 + p_size % 4 as varchar(9))), 2, cast(null as varchar(9)), cast(null as varchar(9)),
 cast(null as varchar(9)), cast(null as varchar(9)) from part""",
    # DIM_INDID
    "r_dim_indid": f"""
with c as (select distinct {_IND_P} as i from part)
select i as indid, concat('Industry ', i) as name, 6 as level, left(i,5) as indid_parent from c
union all select distinct left(i,5), concat('Industry ', left(i,5)), 5, left(i,4) from c
union all select distinct left(i,4), concat('Industry ', left(i,4)), 4, left(i,3) from c
union all select distinct left(i,3), concat('Industry ', left(i,3)), 3, left(i,2) from c
union all select distinct left(i,2), concat('Industry ', left(i,2)), 2, cast(null as varchar(9)) from c""",
    # INDUSTRY_CROSSWALK_POSTINGS_TO_LC_OK
    "r_crosswalk": """
select distinct naics6 as postings_naics6,
 case when left(naics6,2) = '11' then '11' when left(naics6,2) = '51' then '90' else naics6 end as lc_bucket_indid
from r_postings where naics6 is not null""",
    # PROFILES
    "r_profiles": "select company as id, county, naics6, soc_5 from r_postings",
    # PROFILES_EDUCATIONS
    "r_profiles_educations": """
select o_custkey as id, concat('School ', cast(o_orderkey % 5 as varchar(9))) as school_name from orders""",
    # run manifest (one row per dataset per run)
    "r_runs": """
select concat('run_', cast(event_id as varchar(12))) as run_id,
 case when user_id % 2 = 0 then 'labour_market' else 'enrollment' end as pipeline,
 concat('d', cast(user_id % 7 as varchar(9))) as dataset,
 case when user_id % 2 = 1 or user_id % 7 < 3 then 'monthly' when user_id % 7 < 5 then 'quarterly' else 'yearly' end
  as group_name,
 case when event_type = 'error' then 'failed' when event_type = 'view' then 'success_no_change'
  when event_type = 'click' then 'success_limited' else 'success' end as status,
 case when event_type = 'view' then null else cast(floor(value) as bigint) end as row_count,
 cast(null as bigint) as bytes,
 case when event_type = 'view' then null else cast(2000 + event_id % 25 as bigint) end as max_year,
 concat('q', cast(event_id as varchar(12))) as source_query_id,
 case when event_type in ('error', 'view') then null
  else concat('runs/d', cast(user_id % 7 as varchar(9)), '/run_id=run_', cast(event_id as varchar(12))) end
  as source_uri,
 {started_at} as started_at, ts as finished_at,
 cast(event_id % 600 as double) + 0.25 as duration_seconds,
 concat('sha', cast(user_id % 5 as varchar(9))) as git_sha, 'prod' as env,
 case when event_type = 'error' then concat('step failed after retries, last response was: ', props)
  else cast(null as varchar(9)) end as error
from events""",
    # one wide enrollment sheet: ids + 14 race/gender count columns
    "r_wide_enrollment": """
select cast(year(o_orderdate) as varchar(9)) as schoolyear, n_name as county, c_mktsegment as district,
 concat('School ', cast(c_custkey % 9 as varchar(9))) as school_name,
 concat(cast(c_nationkey as varchar(9)), '-', cast(c_custkey % 9 as varchar(9))) as school_code,
 case when c_custkey % 13 = 0 then 'PK' when c_custkey % 13 = 1 then 'K' when c_custkey % 13 = 2 then '3H'
  when c_custkey % 13 = 3 then 'OHP' else cast(c_custkey % 13 as varchar(9)) end as grade,
 cast(sum(case when o_orderkey % 14 = 0 then 1 end) as bigint) as {q}His M{q},
 cast(sum(case when o_orderkey % 14 = 1 then 1 end) as bigint) as {q}His F{q},
 cast(sum(case when o_orderkey % 14 = 2 then 1 end) as bigint) as {q}AmInd M{q},
 cast(sum(case when o_orderkey % 14 = 3 then 1 end) as bigint) as {q}AmInd F{q},
 cast(sum(case when o_orderkey % 14 = 4 then 1 end) as bigint) as {q}Asian M{q},
 cast(sum(case when o_orderkey % 14 = 5 then 1 end) as bigint) as {q}Asian F{q},
 cast(sum(case when o_orderkey % 14 = 6 then 1 end) as bigint) as {q}Black M{q},
 cast(sum(case when o_orderkey % 14 = 7 then 1 end) as bigint) as {q}Black F{q},
 cast(sum(case when o_orderkey % 14 = 8 then 1 end) as bigint) as {q}Pac Is M{q},
 cast(sum(case when o_orderkey % 14 = 9 then 1 end) as bigint) as {q}Pac Is F{q},
 cast(sum(case when o_orderkey % 14 = 10 then 1 end) as bigint) as {q}White M{q},
 cast(sum(case when o_orderkey % 14 = 11 then 1 end) as bigint) as {q}White F{q},
 cast(sum(case when o_orderkey % 14 = 12 then 1 end) as bigint) as {q}Multi M{q},
 cast(sum(case when o_orderkey % 14 = 13 then 1 end) as bigint) as {q}Multi F{q}
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by year(o_orderdate), c_nationkey, n_name, c_mktsegment, c_custkey % 9, c_custkey % 13""",
}

# What Spark runs for role tables over all order lines: the lines meet orders,
# customers, parts and nations once, as a written table with the columns these
# tables add up; names and codes are made after the last large join or sum, so
# that no text is shuffled.  Same rows as ROLE_SQL.
SPARK_ROLE_SQL: dict[str, str] = {
    "r_lines": f"""
select year, c_nationkey as nationkey, {_AREA_C} as areaid, n_name as areaid_name, {_IND_P} as indid, {_OCC_P} as occid,
 cast(class as string) as classid, raceid, q, p, g
from (select l_orderkey, l_partkey, {_CLASS_L.replace("'4'", "4").replace("'1'", "1").replace("'2'", "2")} as class,
 cast(l_linenumber % 3 as int) as raceid, cast(l_quantity as bigint) as q, cast(l_extendedprice as decimal(18,2)) as p,
 case when l_linestatus = 'O' then 1 else 0 end as g from lineitem) l
join (select o_orderkey, cast(year(o_orderdate) as int) as year, c_nationkey
 from orders join customer on o_custkey = c_custkey) o on l_orderkey = o_orderkey
join part on l_partkey = p_partkey join nation on c_nationkey = n_nationkey""",
    "r_staffing": """
with s as (select year, areaid, 'COUNTY' as areaid_type, areaid_name, indid, occid, classid,
 cast(sum(q) as bigint) as emp from r_lines group by year, areaid, areaid_name, indid, occid, classid
 union all select year, '40', 'STATE', 'Oklahoma', indid, occid, classid, cast(sum(q) as bigint)
 from r_lines where nationkey < 15 group by year, indid, occid, classid)
select year, areaid, areaid_type, areaid_name, indid, occid, classid, emp,
 cast(emp as double) / cast(sum(emp) over (partition by year, areaid, areaid_type, indid, classid) as double) as percent
from s""",
    "r_occ": """
select year, areaid, 'COUNTY' as areaid_type, occid, classid, cast(sum(q) as bigint) as emp,
 cast(max(p) as decimal(18,2)) as earn_avg, cast(count(*) as bigint) as replacements, cast(sum(g) as bigint) as growth
from r_lines group by year, areaid, occid, classid""",
    "r_ind": """
select year, areaid, 'COUNTY' as areaid_type, indid, classid, cast(sum(q) as bigint) as emp,
 cast(sum(p) as decimal(28,2)) as earn
from r_lines group by year, areaid, indid, classid""",
    "r_hiresseps": """
select year, areaid, 'COUNTY' as areaid_type, indid, raceid, cast(count(*) as bigint) as hira,
 cast(sum(case when classid = '4' then 1 else 0 end) as bigint) as sep
from r_lines group by year, areaid, indid, raceid""",
    "r_completions": """
select year, unitid, concat('S', cast(part10 as varchar(9))) as programid, cast(1 + 2*line6 as int) as awlevelid,
 concat('Award ', cast(cast(1 + 2*line6 as int) as varchar(9))) as awlevelid_name, raceid,
 cast(part10 % 2 as int) as genderid, cast(sum(q) as bigint) as completions
from (select cast(year(l_shipdate) as int) as year, l_suppkey as unitid, cast(l_partkey % 10 as int) as part10,
 cast(l_linenumber % 6 as int) as line6, cast(l_orderkey % 2 as int) as raceid, cast(l_quantity as bigint) as q
 from lineitem) b
group by year, unitid, part10, line6, raceid""",
}

# Role views that read other role views (built after them).
ROLE_DEPENDS: dict[str, tuple[str, ...]] = {
    "r_crosswalk": ("r_postings",),
    "r_profiles": ("r_postings",),
}
#: The same for the texts that only Spark runs.
SPARK_DEPENDS: dict[str, tuple[str, ...]] = {
    **ROLE_DEPENDS, **{name: ("r_lines",) for name in ("r_staffing", "r_occ", "r_ind", "r_hiresseps")}}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# The one dialect difference: subtracting a number of seconds from a timestamp.
_STARTED_AT = {
    "spark": "timestampadd(SECOND, -cast(event_id % 600 as int), ts)",
    "duckdb": "ts - to_seconds(cast(event_id % 600 as bigint))",
}


def role_sql(name: str, dialect: str = "spark") -> str:
    text = SPARK_ROLE_SQL[name] if dialect == "spark" and name in SPARK_ROLE_SQL else ROLE_SQL[name]
    quote = "`" if dialect == "spark" else '"'
    return text.replace("{q}", quote).replace("{started_at}", _STARTED_AT[dialect]).strip()


def roles_version() -> str:
    """Short digest of all role texts; a changed text gets a new folder."""
    digest = hashlib.sha1()
    for texts in (ROLE_SQL, SPARK_ROLE_SQL):
        for name in sorted(texts):
            digest.update(name.encode())
            digest.update(texts[name].encode())
    return digest.hexdigest()[:12]


def ordered_roles(names) -> list[str]:
    """Names plus their dependencies, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        for d in ROLE_DEPENDS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def duckdb_with(names) -> str:
    """``WITH`` prefix that inlines the named role views for a DuckDB oracle."""
    parts = [f"{n} AS ({role_sql(n, 'duckdb')})" for n in ordered_roles(names)]
    return "WITH " + ",\n".join(parts)


#: SQL for Spark and DuckDB: a given page followed by an enrollment section
#: made of its own first link.  By page: a nested grid or text container before
#: the list, a script with closing tags in it, a malformed percent sign, list
#: items left open, an unquoted link, references in texts, no grid at all.
_FIRST = """coalesce(regexp_extract(html, 'href="([^"]*)"', 1), '')"""
ENROLLMENT_HTML = f"""(coalesce(html, '')
 || case when page_id % 7 = 3 then '<div>' else '<div class="aem-Grid aem-Grid--12 aem-Grid--default--12">' end
 || '<div class="title aem-GridColumn aem-GridColumn--default--12"><h2>'
 || case page_id % 4 when 0 then 'FY 20' || cast(10 + page_id % 15 as string) || '/20' || cast(11 + page_id % 15 as string)
     when 1 then 'FY' || cast(10 + page_id % 15 as string) when 2 then 'Notes' else 'FY&nbsp;2024' end || '</h2></div>'
 || '<div class="text aem-GridColumn aem-GridColumn--default--12">'
 || case page_id % 3 when 0 then '<script>var end = "</div></div>";</script>'
     when 1 then '<div class="aem-Grid aem-Grid--12 aem-Grid--default--12"><p>inner</p></div>'
     else '<div class="text aem-GridColumn--default--12"><b>inner</b></div>' end
 || '<p><a href="' || {_FIRST} || '_all.xlsx">Click here</a></p><ul>'
 || case when page_id % 5 = 4 then '' else '<li><a href="' || case when page_id % 5 = 2 then '/50%zz' else '' end
     || {_FIRST} || '_race.xlsx?v=' || cast(page_id % 2 as string)
     || '">School Site Totals w/Ethnicity &amp; and Gender</a>' end
 || '<li><a href=' || {_FIRST} || '_site.xlsx>School <i>Site</i> Totals</a></ul>'
 || '<a href="after_list.xlsx">School Site Totals</a></div></div><a href="outside.xlsx">Click here</a>')"""
