"""DuckDB oracle SQL for the marts (test artefact, not used by the jobs).

Each text restates the mart as plain SQL over the role views, inlined as
CTEs from ``sources.roles`` so DuckDB starts from the same inputs as Spark.
Texts take their parameters from the same ``MartConfig`` as the Spark run.
"""

from __future__ import annotations

from tallgrass.config import MartConfig, harness_config
from tallgrass.sources.roles import duckdb_with


def st(x: str, state: str = "40") -> str:
    """The source's area-in-state test, literally."""
    return f"left(lpad(cast({x} as varchar), 5, '0'), 2) = '{state}'"


def _wrap(roles, body: str) -> str:
    body = body.strip()
    prefix = duckdb_with(roles)
    if body.startswith(","):
        return prefix + body
    return prefix + "\n" + body


def mart_sql(cfg: MartConfig | None = None) -> dict[str, str]:
    c = cfg or harness_config()
    Y = c.as_of_year
    B = c.baseline_year
    S = c.state
    SN = c.state_name
    LV = ", ".join(str(v) for v in c.award_levels)
    cur_pop, prior_pop = c.population_years
    cert = "ps.skill_type = 'Certification' and ps.skill_name <> 'Valid Driver''s License'"
    q: dict[str, str] = {}

    q["dim_area"] = _wrap(["r_postings"], f"""
select distinct county as AREAID, county_name as COUNTY_NAME from r_postings where {st('county', S)}""")

    q["dim_awlevels"] = _wrap(["r_completions", "r_unit"], f"""
select distinct cd.awlevelid as AWLEVELID, cd.awlevelid_name as AWLEVELID_NAME
from r_completions cd left join r_unit u on cd.unitid = u.unitid
where {st('u.county', S)} and cd.awlevelid in ({LV})""")

    q["dim_company"] = _wrap(["r_postings"], f"""
select distinct company as COMPANY, company_name as COMPANY_NAME from r_postings where {st('county', S)}""")

    q["dim_edulevels"] = _wrap(["r_postings"], f"""
select distinct min_edulevels as MIN_EDULEVELS, min_edulevels_name as MIN_EDULEVELS_NAME
from r_postings where {st('county', S)}""")

    posted_levels = "\n".join(
        f" union all select distinct naics{n}_name, {n}, naics{n}, {('naics' + str(n - 1)) if n > 2 else 'cast(null as varchar)'}, 'postings'"
        f" from r_postings where naics{n} is not null and {st('county', S)}"
        for n in (6, 5, 4, 3, 2))
    q["dim_ind"] = _wrap(["r_dim_indid", "r_postings", "r_crosswalk"], f"""
, comb as (
 select name, level, indid, indid_parent, 'dim_indid' as source from r_dim_indid
{posted_levels}
), prio as (
 select indid, name, level, indid_parent from (
  select *, row_number() over (partition by indid order by case when source = 'dim_indid' then 1 else 2 end,
   level nulls last, name nulls last, indid_parent nulls last) as rn from comb) x where rn = 1
), lvl6 as (
 select distinct trim(c2.indid) as TLINDID, trim(c2.name) as NAICS2_NAME, trim(c6.indid) as INDID,
  trim(c6.name) as NAICS6_NAME, trim(c5.indid) as NAICS5_CODE, trim(c5.name) as NAICS5_NAME,
  trim(c4.indid) as NAICS4_CODE, trim(c4.name) as NAICS4_NAME, trim(c3.indid) as NAICS3_CODE,
  trim(c3.name) as NAICS3_NAME
 from prio c6 left join prio c5 on c6.indid_parent = c5.indid left join prio c4 on c5.indid_parent = c4.indid
  left join prio c3 on c4.indid_parent = c3.indid left join prio c2 on c3.indid_parent = c2.indid
 where c6.level = 6
), bk as (
 select distinct trim(lc_bucket_indid) as INDID from r_crosswalk
 where lc_bucket_indid is not null and length(trim(lc_bucket_indid)) <> 6
), bdim as (
 select distinct case when length(b.INDID) = 2 then b.INDID else left(b.INDID, 2) end as TLINDID,
  coalesce(p2.name, case when left(b.INDID, 2) = '90' then 'Government' end) as NAICS2_NAME,
  b.INDID as INDID,
  coalesce(bn.name, case when b.INDID = '90' then 'Government' end, 'Bucket ' || b.INDID) as NAICS6_NAME,
  cast(null as varchar) as NAICS5_CODE, cast(null as varchar) as NAICS5_NAME, cast(null as varchar) as NAICS4_CODE,
  cast(null as varchar) as NAICS4_NAME, cast(null as varchar) as NAICS3_CODE, cast(null as varchar) as NAICS3_NAME
 from bk b
 left join prio p2 on p2.indid = case when length(b.INDID) = 2 then b.INDID else left(b.INDID, 2) end and p2.level = 2
 left join (select trim(indid) as indid, max(trim(name)) as name from comb group by 1) bn on bn.indid = b.INDID
)
select * from lvl6 union all select * from bdim""")

    q["dim_occ"] = _wrap(["r_postings", "r_dim_occid"], f"""
, soc as (select distinct left(soc_2, 2) || '-0000' as tl, soc_2_name from r_postings where {st('county', S)})
select left(o.occid, 2) || '-0000' as TLOCCID, soc.soc_2_name as SOC_2_NAME, o.occid as OCCID, o.name as SOC_5_NAME,
 o.description as DESCRIPTION, o.typicaleducation as TYPICALEDUCATION, o.typicalexperience as TYPICALEXPERIENCE,
 o.typicaltraining as TYPICALTRAINING
from r_dim_occid o right join soc on soc.tl = left(o.occid, 2) || '-0000'
where right(o.occid, 1) <> '0'""")

    q["dim_programs"] = _wrap(["r_programs"], """
select a.programid as PROGRAMID, a.name as NAME, c.programid as TLPROGRAMID, c.name as TLNAME
from r_programs a join r_programs b on a.programid_parent = b.programid
 join r_programs c on b.programid_parent = c.programid
where a.level = 3""")

    q["dim_schools"] = _wrap(["r_unit"], f"""
select unitid as UNITID, county as AREAID, name as NAME, sector as SECTOR, sector_description as SECTOR_DESCRIPTION
from r_unit where {st('county', S)}""")

    q["dim_skills"] = _wrap(["r_postings_skills", "r_postings"], f"""
select distinct skill_id as SKILL_ID, skill_name as SKILL_NAME, skill_type as SKILL_TYPE,
 skill_category as SKILL_CATEGORY, skill_category_name as SKILL_CATEGORY_NAME, skill_subcategory as SKILL_SUBCATEGORY,
 skill_subcategory_name as SKILL_SUBCATEGORY_NAME, is_software as IS_SOFTWARE
from r_postings_skills where id in (select id from r_postings where {st('county', S)})""")

    q["dim_university"] = _wrap(["r_unit", "r_ref_area"], f"""
select distinct du.unitid as UNITID, du.name as INSTNM, du.address as ADDR, du.city as CITY,
 du.stateabbreviation as STABBR, du.zip as ZIP, du.county as COUNTYCD, ra.areaid_name as COUNTYNM,
 du.longitude as LONGITUD, du.latitude as LATITUDE
from r_unit du left join r_ref_area ra on du.county = ra.areaid
where du.name not like '%not current%' and {st('du.county', S)}""")

    q["fact_certifications"] = _wrap(["r_postings_skills", "r_postings"], f"""
select cast(year(p.posted) as integer) as YEAR_POSTED, p.county as AREAID, p.naics6 as INDID, p.soc_5 as OCCID,
 p.company as COMPANY, p.min_edulevels as MIN_EDULEVELS, p.is_internship as INTERNSHIP, ps.skill_id as SKILL_ID,
 count(*) as TOTAL_CERTS_COUNT
from r_postings_skills ps left join r_postings p on ps.id = p.id
where {st('p.county', S)} and {cert}
group by all""")

    def completions(shift: int) -> str:
        return _wrap(["r_completions", "r_programs", "r_unit"], f"""
select cd.year + {shift} as YEAR, u.county as AREAID, cd.programid as PROGRAMID, cd.unitid as UNITID,
 cd.awlevelid as AWLEVELID, cd.completions as COMPLETIONS
from r_completions cd left join r_programs pr on cd.programid = pr.programid left join r_unit u on cd.unitid = u.unitid
where {st('u.county', S)} and pr.level = 3 and cd.awlevelid in ({LV}) and cd.raceid = 0 and cd.genderid = 0""")

    q["fact_completions"] = completions(0)
    q["fact_completions_lagged"] = completions(1)

    def enrollments(shift: int) -> str:
        return _wrap(["r_enrollments", "r_unit"], f"""
select en.year + {shift} as YEAR, u.county as AREAID, u.unitid as UNITID, en.enrollments as ENROLLMENTS
from r_enrollments en left join r_unit u on en.unitid = u.unitid
where {st('u.county', S)} and en.raceid = 0 and en.genderid = 0 and en.enrlevelid = 1""")

    q["fact_enrollments"] = enrollments(0)
    q["fact_enrollments_lagged"] = enrollments(1)

    def emp(shift: int) -> str:
        return _wrap(["r_occ", "r_staffing", "r_ind", "r_dim_occid", "r_dim_indid"], f"""
, occ_totals as (
 select o.year + {shift} as year, o.areaid, o.occid, cast(sum(o.emp) as bigint) as total
 from r_occ o join r_dim_occid d on o.occid = d.occid
 where o.areaid_type = 'COUNTY' and {st('o.areaid', S)} and o.classid <> '4' and o.year <= {Y} and d.level = 5
 group by 1, 2, 3
), staff as (
 select s.year + {shift} as year, s.areaid, s.occid, s.indid, cast(sum(s.emp) as bigint) as staff_emp
 from r_staffing s join r_dim_occid d on s.occid = d.occid join r_dim_indid i on s.indid = i.indid
 where s.areaid_type = 'COUNTY' and {st('s.areaid', S)} and s.classid = '1' and s.year <= {Y}
  and d.level = 5 and i.level = 6
 group by 1, 2, 3, 4
), w as (
 select *, staff_emp / nullif(sum(staff_emp) over (partition by year, areaid, occid), 0) as pct from staff
), ind_totals as (
 select i.year + {shift} as year, i.areaid, i.indid, cast(sum(i.emp) as bigint) as num_emps
 from r_ind i join r_dim_indid d on i.indid = d.indid
 where i.areaid_type = 'COUNTY' and {st('i.areaid', S)} and i.classid <> '4' and i.year <= {Y} and d.level = 6
 group by 1, 2, 3
)
select w.year as YEAR, w.areaid as AREAID, w.indid as INDID, w.occid as OCCID, cast(it.num_emps as double) as NUM_EMPS,
 o.total * w.pct as OCC_EMPS, cast(w.pct as double) as PERCENT
from w join occ_totals o on o.year = w.year and o.areaid = w.areaid and o.occid = w.occid
 left join ind_totals it on it.year = w.year and it.areaid = w.areaid and it.indid = w.indid
union all
select o.year, o.areaid, cast(null as varchar), o.occid, cast(null as double), cast(o.total as double), 1.0::double
from occ_totals o left join (select distinct year, areaid, occid from w) x
 on x.year = o.year and x.areaid = o.areaid and x.occid = o.occid
where x.occid is null""")

    q["fact_emp"] = emp(0)
    q["fact_emp_lagged"] = emp(1)

    def emp_idx(where: str) -> str:
        return _wrap(["r_labor_force"], f"""
, lf as (select year, month, areaid_name, emp from r_labor_force where {where} and year >= {B})
select make_date(t1.year, t1.month, 1) as DATE, t1.year as YEAR, t1.month as MONTH, t1.areaid_name as AREAID_NAME,
 t1.emp as EMP, t2.emp as BASE_{B}_EMP, t1.emp / t2.emp as EMP_INDEX_TO_{B}
from lf t1 join lf t2 on t1.areaid_name = t2.areaid_name and t2.year = {B} and t2.month = 1""")

    q["fact_emp_county_idx"] = emp_idx(f"areaid_type = 'COUNTY' and {st('areaid', S)}")
    q["fact_emp_state_idx"] = emp_idx(f"areaid_type = 'STATE' and areaid_name = '{SN}'")

    def has(shift: int) -> str:
        return _wrap(["r_staffing", "r_hiresseps"], f"""
, pcts as (
 select year + {shift} as year, areaid, indid, occid, percent from r_staffing
 where classid = '1' and areaid_type = 'COUNTY' and {st('areaid', S)} and year <= {Y}
), h as (
 select year + {shift} as year, areaid, indid, cast(sum(hira) as bigint) as hires, cast(sum(sep) as bigint) as seps
 from r_hiresseps where areaid_type = 'COUNTY' and {st('areaid', S)} and year <= {Y} group by 1, 2, 3
)
select p.year as YEAR, p.areaid as AREAID, p.indid as INDID, p.occid as OCCID, p.percent as PERCENT,
 h.hires as HIRES, h.hires * p.percent as OCC_HIRES, h.seps as SEPS, h.seps * p.percent as OCC_SEPS
from pcts p left join h on p.year = h.year and p.areaid = h.areaid and p.indid = h.indid""")

    q["fact_has"] = has(0)
    q["fact_has_lagged"] = has(1)

    def jobs(shift: int) -> str:
        return _wrap(["r_postings", "r_crosswalk"], f"""
select cast(year(p.posted) + {shift} as integer) as YEAR_POSTED, cast(quarter(p.posted) as integer) as QUARTER_POSTED,
 cast(month(p.posted) as integer) as MONTH_POSTED, p.county as AREAID, icp.lc_bucket_indid as INDID, p.soc_5 as OCCID,
 p.company as COMPANY, p.min_edulevels as MIN_EDULEVELS, p.is_internship as IS_INTERNSHIP,
 count(*) as CURR_NUM_JOBS, cast(sum(p.duration) as bigint) as CURR_TOTAL_DURATION,
 count(p.duration) as CURR_N_WITH_DURATION, cast(sum(p.duplicates + 1) as bigint) as CURR_TOTAL_TIMES_JOB_POSTED,
 cast(sum(p.salary) as decimal(28,2)) as CURR_TOTAL_SALARY, count(p.salary) as CURR_N_WITH_SALARY
from r_postings p left join r_crosswalk icp on p.naics6 = icp.postings_naics6
where {st('p.county', S)} and p.company_is_staffing = false
group by all""")

    q["fact_jobs"] = jobs(0)
    q["fact_jobs_lagged"] = jobs(1)

    def jobs_idx(area: str) -> str:
        return _wrap(["r_postings"], f"""
, yearly as (
 select cast(year(posted) as integer) as y, {area} as a, count(*) as n from r_postings
 where {st('county', S)} and company_is_staffing = false and year(posted) >= {B} group by 1, 2
)
select make_date(t1.y, 1, 1) as DATE, t1.y as YEAR_POSTED, t1.a as AREAID, t1.n as CURR_NUM_JOBS,
 t2.n as BASE_{B}_JOBS, t1.n / t2.n as JOBS_INDEX_TO_{B}
from yearly t1 join yearly t2 on t1.a = t2.a and t2.y = {B}""")

    q["fact_jobs_county_idx"] = jobs_idx("county_name")
    q["fact_jobs_state_idx"] = jobs_idx(f"'{SN}'")

    keys7 = ["y", "a", "i", "o", "c", "m", "n"]
    on7 = " and ".join(f"main.{k} = cert.{k}" for k in keys7)
    q["fact_jobwithcerts"] = _wrap(["r_postings", "r_postings_skills"], f"""
, main as (
 select cast(year(posted) as integer) as y, county as a, naics6 as i, soc_5 as o, company as c,
  min_edulevels as m, is_internship as n, count(*) as num_jobs
 from r_postings where {st('county', S)} group by all
), cert as (
 select cast(year(p2.posted) as integer) as y, p2.county as a, p2.naics6 as i, p2.soc_5 as o, p2.company as c,
  p2.min_edulevels as m, p2.is_internship as n, count(distinct ps.id) as k
 from r_postings_skills ps left join r_postings p2 on ps.id = p2.id
 where {cert} group by all
)
select main.y as YEAR_POSTED, main.a as AREAID, main.i as INDID, main.o as OCCID, main.c as COMPANY,
 main.m as MIN_EDULEVELS, main.n as INTERNSHIP, main.num_jobs as NUM_JOBS,
 cast(coalesce(cert.k, 0) as bigint) as NUM_JOBS_WITH_CERT
from main left join cert on {on7}""")

    def lq(cat_group: str, cat_show: str, name: str) -> str:
        n = name.upper()
        return _wrap(["r_staffing"], f"""
, st_rows as (select * from r_staffing where year <= {Y} and areaid = '{S}' and areaid_type = 'STATE'
   and areaid_name = '{SN}'),
co_rows as (select * from r_staffing where year <= {Y} and areaid_type = 'COUNTY' and {st('areaid', S)}),
st_tot as (select year, cast(sum(emp) as bigint) as t from st_rows group by year),
co_tot as (select year, areaid, cast(sum(emp) as bigint) as t from co_rows group by year, areaid),
st_cat as (
 select r.year, {cat_show.replace('X', 'r')} as cat, cast(sum(r.emp) as bigint) as e, st_tot.t
 from st_rows r left join st_tot on r.year = st_tot.year group by r.year, {cat_group.replace('X', 'r')}, st_tot.t
),
co_cat as (
 select r.year, r.areaid, {cat_show.replace('X', 'r')} as cat, cast(sum(r.emp) as bigint) as e, co_tot.t
 from co_rows r left join co_tot on r.year = co_tot.year and r.areaid = co_tot.areaid
 group by r.year, r.areaid, {cat_group.replace('X', 'r')}, co_tot.t
)
select c.year as YEAR, c.areaid as AREAID, c.cat as {n}ID, c.e as COUNTY_{n}_EMPS, c.t as COUNTY_TOTAL_EMPS,
 cast(c.e as double) / cast(c.t as double) as COUNTY_{n}_CONC, s.e as STATE_{n}_EMPS, s.t as STATE_TOTAL_EMPS,
 cast(s.e as double) / cast(s.t as double) as STATE_{n}_CONC,
 (cast(c.e as double) / cast(c.t as double)) / nullif(cast(s.e as double) / cast(s.t as double), 0) as LQ
from co_cat c left join st_cat s on c.year = s.year and c.cat = s.cat""")

    q["fact_lq_ind"] = lq("X.indid", "left(X.indid, 5)", "ind")
    q["fact_lq_occ"] = lq("X.occid", "X.occid", "occ")
    q["fact_lq_ind_truncated"] = lq("left(X.indid, 5)", "left(X.indid, 5)", "ind")

    q["fact_openings_occ"] = _wrap(["r_occ"], f"""
select year as YEAR, areaid as AREAID, occid as OCCID, cast(round(sum(replacements + growth), 0) as bigint) as OPENINGS
from r_occ where classid <> '4' and areaid_type = 'COUNTY' and {st('areaid', S)} and year <= {Y}
group by year, areaid, occid""")

    q["fact_profiles"] = _wrap(["r_profiles_educations", "r_profiles", "r_postings"], f"""
, edu as (select distinct id, school_name from r_profiles_educations),
cty as (select distinct id, county from r_profiles where {st('county', S)}),
ind as (select distinct id, naics6 from r_profiles where {st('county', S)}),
occ as (select distinct id, soc_5 from r_profiles where {st('county', S)})
select cty.county as AREAID, ind.naics6 as INDID, occ.soc_5 as OCCID, edu.school_name as SCHOOL,
 count(*) as TOTAL_PROFILES_COUNT
from edu join cty on edu.id = cty.id left join ind on edu.id = ind.id left join occ on edu.id = occ.id
group by all""")

    def skills(shift: int) -> str:
        return _wrap(["r_postings_skills", "r_postings", "r_crosswalk"], f"""
, tj as (
 select cast(year(posted) + {shift} as integer) as y, cast(quarter(posted) as integer) as qt,
  cast(month(posted) as integer) as mo, county as a, naics6 as i, soc_5 as o, min_edulevels as m,
  is_internship as n, count(id) as total
 from r_postings where {st('county', S)} group by all
)
select ps.skill_id as SKILL_ID, cast(year(p.posted) + {shift} as integer) as YEAR_POSTED,
 cast(quarter(p.posted) as integer) as QUARTER_POSTED, cast(month(p.posted) as integer) as MONTH_POSTED,
 p.county as AREAID, ic.lc_bucket_indid as INDID, p.soc_5 as OCCID, p.min_edulevels as MIN_EDULEVELS,
 p.is_internship as IS_INTERNSHIP, count(*) as CURR_NUM_SKILLS, t.total as CURR_TOTAL_JOBS_COUNT
from r_postings_skills ps join r_postings p on ps.id = p.id
 join r_crosswalk ic on p.naics6 = ic.postings_naics6
 join tj t on year(p.posted) + {shift} = t.y and quarter(p.posted) = t.qt and month(p.posted) = t.mo
  and p.county = t.a and p.naics6 = t.i and p.soc_5 = t.o and p.min_edulevels = t.m and p.is_internship = t.n
where {st('p.county', S)} and p.company_is_staffing = false
group by ps.skill_id, year(p.posted), quarter(p.posted), month(p.posted), p.county, ic.lc_bucket_indid, p.soc_5,
 p.min_edulevels, p.is_internship, t.total""")

    q["fact_skills"] = skills(0)
    q["fact_skills_lagged"] = skills(1)

    q["fact_wages_ind"] = _wrap(["r_ind"], f"""
select year as YEAR, areaid as AREAID, indid as INDID,
 cast(cast((cast(earn * 100 as hugeint) * 2 + emp) // (2 * emp) as decimal(20,0)) * 0.01 as decimal(20,2))
  as YEARLY_WAGES
from r_ind where classid = '1' and areaid_type = 'COUNTY' and {st('areaid', S)} and year <= {Y}""")

    q["fact_wages_occ"] = _wrap(["r_occ"], f"""
select year as YEAR, areaid as AREAID, occid as OCCID, cast(round(earn_avg, 2) as decimal(18,2)) as HOURLY_WAGE,
 cast(round(earn_avg, 2) * 2080 as decimal(28,2)) as YEARLY_WAGE
from r_occ where classid = '1' and areaid_type = 'COUNTY' and {st('areaid', S)} and year <= {Y}""")

    q["fact_regional_indicators"] = _wrap(
        ["r_acs", "r_labor_force", "r_demog", "r_postings", "r_enrollments", "r_unit", "r_completions", "r_programs"],
        regional_sql(c))
    return q


def regional_sql(c: MartConfig) -> str:
    S, Y = c.state, c.as_of_year

    def avg_ratio(a: str, b: str) -> str:
        # whole numbers of 1e-18, half up (nothing here is negative)
        units = (f"case when {b} <> 0 then (cast({a} as hugeint) * 2 * cast(1000000000000000000 as hugeint) + {b}) "
                 f"// (2 * cast({b} as hugeint)) end")
        return f"cast(sum({units}) as double) / (cast(count({units}) as double) * 1e18)"

    cur_pop, prior_pop = c.population_years

    def lf(delta: str) -> str:
        return f"""
 select areaid, areaid_name, lfp_denom,
  {avg_ratio("(emp + unemp)", "pop")} as lfpr, round(avg(unemp), 0) as unemp,
  {avg_ratio("unemp", "(emp + unemp)")} as unempr, round(avg(emp), 0) as emp
 from r_labor_force
 where year = (select max(year){delta} from r_labor_force where areaid_type = 'COUNTY')
  and areaid <> '{S}' and areaid_type = 'COUNTY' and {st('areaid', S)}
 group by areaid, areaid_name, lfp_denom"""

    def pop(year: int) -> str:
        return f"""
 select year, areaid, areaid_name, cast(round(sum(pop), 0) as bigint) as population from r_demog
 where ageid like 'G%' and raceid = 0 and genderid = 0 and areaid_type = 'COUNTY' and {st('areaid', S)}
  and year = {year}
 group by year, areaid, areaid_name"""

    def enrol(delta: str) -> str:
        return f"""
 select en.year, cast(u.county as varchar) as areaid, cast(sum(en.enrollments) as bigint) as enrollments
 from r_enrollments en left join r_unit u on en.unitid = u.unitid
 where {st('u.county', S)} and en.raceid = 0 and en.genderid = 0 and en.enrlevelid = 1
  and en.year = (select max(year){delta} from r_enrollments)
 group by 1, 2"""

    def comp(level: int, delta: str) -> str:
        return f"""
 select cd.year, cast(u.county as varchar) as areaid, cast(sum(cd.completions) as bigint) as completions
 from r_completions cd left join r_unit u on cd.unitid = u.unitid left join r_programs dp on cd.programid = dp.programid
 where {st('u.county', S)} and dp.level = 3 and cd.awlevelid = {level} and cd.raceid = 0 and cd.genderid = 0
  and cd.year = (select max(year){delta} from r_completions)
 group by 1, 2"""

    levels = {"assoc": 3, "bach": 5, "masters": 7, "doctors": 9, "certs": 11}
    comp_ctes = ",\n".join(
        f"curr_{k} as ({comp(v, '')}),\nprior_{k} as ({comp(v, ' - 1')})" for k, v in levels.items())
    comp_joins = "\n".join(
        f" left join curr_{k} on cy.areaid = curr_{k}.areaid left join prior_{k} on cy.areaid = prior_{k}.areaid"
        for k in levels)

    def z(x):
        return f"coalesce({x}, 0)"

    cur_c = {k: z(f"curr_{k}.completions") for k in levels}
    pri_c = {k: z(f"prior_{k}.completions") for k in levels}
    cur_total = " + ".join(cur_c[k] for k in ("assoc", "bach", "certs", "masters", "doctors"))
    pri_total = " + ".join(pri_c[k] for k in ("assoc", "bach", "certs", "masters", "doctors"))
    lf_c, lf_p = "(cy.emp + cy.unemp)", "(py.emp + py.unemp)"
    en_c, en_p = z("ce.enrollments"), z("pe.enrollments")
    return f"""
, acs as (select areaid, areaid_name, median_household_income, poverty_level_pct from r_acs
  where areaid_type = 'COUNTY' and {st('areaid', S)}),
cy as ({lf('')}),
py as ({lf(' - 1')}),
cp as ({pop(cur_pop)}),
pp as ({pop(prior_pop)}),
cjp as (select cast(county as varchar) as areaid, count(*) as n from r_postings
  where {st('county', S)} and year(posted) = {Y} group by 1),
crp as (select cast(county as varchar) as areaid, count(*) as n from r_postings
  where {st('county', S)} and {Y} - year(posted) < 1 group by 1),
prp as (select cast(county as varchar) as areaid, count(*) as n from r_postings
  where {st('county', S)} and {Y} - year(posted) >= 1 and {Y} - year(posted) < 2 group by 1),
ce as ({enrol('')}),
pe as ({enrol(' - 1')}),
{comp_ctes}
select cy.areaid as AREAID, cy.areaid_name as COUNTY_NAME,
 {lf_c} as CURRENT_YEAR_LABOR_FORCE, {lf_p} as PRIOR_YEAR_LABOR_FORCE,
 cy.lfpr as CURRENT_LABOR_FORCE_PARTICIPATION_RATE, py.lfpr as PRIOR_LABOR_FORCE_PARTICIPATION_RATE,
 {lf_c} - {lf_p} as RAW_CHANGE_IN_LABOR_FORCE, ({lf_c} - {lf_p}) / nullif({lf_p}, 0) as PCT_CHANGE_IN_LABOR_FORCE,
 cy.unemp as CURRENT_UNEMPLOYED, py.unemp as PRIOR_UNEMPLOYED,
 cy.unempr as CURRENT_UNEMPLOYMENT_RATE, py.unempr as PRIOR_UNEMPLOYMENT_RATE,
 (cy.unempr - py.unempr) / nullif(py.unempr, 0) as PCT_CHANGE_IN_UNEMPLOYMENT_RATE,
 cy.emp as CURRENT_EMPLOYED, py.emp as PRIOR_EMPLOYED, cy.emp - py.emp as CHANGE_IN_EMPLOYED,
 cp.population as CURRENT_POPULATION, pp.population as PRIOR_POPULATION,
 cp.population - pp.population as RAW_CHANGE_IN_POPULATION,
 (cp.population - pp.population) / nullif(pp.population, 0) as PCT_CHANGE_IN_POPULATION,
 acs.median_household_income as MEDIAN_HOUSEHOLD_INCOME,
 cjp.n as CURRENT_NUMBER_POSTINGS, crp.n as CURRENT_ROLLING_NUMBER_POSTINGS, prp.n as PRIOR_ROLLING_NUMBER_POSTINGS,
 (crp.n - prp.n) / nullif(prp.n, 0) as PCT_CHANGE_NUMBER_POSTINGS,
 cast({en_c} as bigint) as CURRENT_NUMBER_ENROLLED, cast({en_p} as bigint) as PRIOR_NUMBER_ENROLLED,
 cast({en_c} - {en_p} as bigint) as RAW_CHANGE_ENROLLED,
 case when {en_p} = 0 then 0.0 else ({en_c} - {en_p}) / {en_p} end as PCT_CHANGE_ENROLLED,
 cast({cur_c['assoc']} as bigint) as CURRENT_ASSOC_COMPLETIONS, cast({cur_c['bach']} as bigint) as CURRENT_BACH_COMPLETIONS,
 cast({cur_c['certs']} as bigint) as CURRENT_CERT_COMPLETIONS, cast({cur_c['masters']} as bigint) as CURRENT_MASTERS_COMPLETIONS,
 cast({cur_c['doctors']} as bigint) as CURRENT_DOCTORS_COMPLETIONS,
 cast({pri_c['assoc']} as bigint) as PRIOR_ASSOC_COMPLETIONS, cast({pri_c['bach']} as bigint) as PRIOR_BACH_COMPLETIONS,
 cast({pri_c['certs']} as bigint) as PRIOR_CERT_COMPLETIONS, cast({pri_c['masters']} as bigint) as PRIOR_MASTERS_COMPLETIONS,
 cast({pri_c['doctors']} as bigint) as PRIOR_DOCTORS_COMPLETIONS,
 cast({cur_total} as bigint) as CURRENT_COMPLETIONS, cast({pri_total} as bigint) as PRIOR_COMPLETIONS,
 cast(({cur_total}) - ({pri_total}) as bigint) as RAW_CHANGE_COMPLETIONS,
 case when ({pri_total}) = 0 then 0.0 else (({cur_total}) - ({pri_total})) / ({pri_total}) end as PCT_CHANGE_COMPLETIONS,
 acs.poverty_level_pct as POVERTY_LEVEL
from cy left join py on cy.areaid = py.areaid
 left join cp on cy.areaid = cp.areaid left join pp on cy.areaid = pp.areaid
 left join cjp on cy.areaid = cjp.areaid left join crp on cy.areaid = crp.areaid left join prp on cy.areaid = prp.areaid
 left join ce on cy.areaid = ce.areaid left join pe on cy.areaid = pe.areaid
{comp_joins}
 left join acs on cy.areaid = acs.areaid"""


def operator_sql(cfg: MartConfig | None = None) -> dict[str, str]:
    c = cfg or harness_config()
    S, B, SN, Y = c.state, c.baseline_year, c.state_name, c.as_of_year
    q: dict[str, str] = {}

    q["filter_state"] = _wrap(["r_postings"], f"""
select id as ID, county as COUNTY, county_name as COUNTY_NAME from r_postings where {st('county', S)}""")

    q["filter_state_text"] = _wrap(["r_staffing"], f"""
select areaid as AREAID, count(*) as N_ROWS from r_staffing where areaid_type = 'COUNTY' and {st('areaid', S)}
group by areaid""")

    for how in ("left", "inner"):
        q[f"crosswalk_{how}"] = _wrap(["r_postings", "r_crosswalk"], f"""
select p.id as ID, p.naics6 as NAICS6, c.lc_bucket_indid as BUCKET
from r_postings p {how} join r_crosswalk c on p.naics6 = c.postings_naics6""")

    q["index_to_baseline"] = _wrap(["r_labor_force"], f"""
, lf as (select areaid, year, month, emp from r_labor_force where areaid_type = 'COUNTY')
select t1.areaid as AREAID, t1.year as YEAR, t1.month as MONTH, t1.emp as EMP, t2.emp as BASE_EMP,
 t1.emp / t2.emp as EMP_INDEX
from lf t1 join lf t2 on t1.areaid = t2.areaid and t2.year = {B} and t2.month = 1""")

    q["table_source"] = mart_sql(c)["fact_skills"]

    q["flatten_hierarchy"] = _wrap(["r_dim_indid"], """
select c0.indid as INDID, c1.indid as PARENT1, c2.indid as PARENT2, c3.indid as PARENT3, c4.indid as PARENT4,
 c4.name as TOP_NAME
from r_dim_indid c0 left join r_dim_indid c1 on c0.indid_parent = c1.indid
 left join r_dim_indid c2 on c1.indid_parent = c2.indid left join r_dim_indid c3 on c2.indid_parent = c3.indid
 left join r_dim_indid c4 on c3.indid_parent = c4.indid
where c0.level = 6""")

    posted_levels = "\n".join(
        f" union all select distinct naics{n}_name, {n}, naics{n}, {('naics' + str(n - 1)) if n > 2 else 'cast(null as varchar)'}, 'postings'"
        f" from r_postings where naics{n} is not null and {st('county', S)}"
        for n in (6, 5, 4, 3, 2))
    q["prefer_source"] = _wrap(["r_dim_indid", "r_postings"], f"""
, comb as (
 select name, level, indid, indid_parent, 'dim_indid' as source from r_dim_indid
{posted_levels}
)
select indid as INDID, name as NAME, level as LEVEL, indid_parent as INDID_PARENT from (
 select *, row_number() over (partition by indid order by case when source = 'dim_indid' then 1 else 2 end,
  level nulls last, name nulls last, indid_parent nulls last) as rn from comb) x
where rn = 1""")

    q["share_of_group"] = _wrap(["r_staffing"], """
select year as YEAR, areaid as AREAID, occid as OCCID, indid as INDID, classid as CLASSID, emp as EMP,
 emp / nullif(sum(emp) over (partition by year, areaid, occid), 0) as SHARE
from r_staffing where areaid_type = 'COUNTY'""")

    q["share_allocation"] = _wrap(["r_occ", "r_staffing", "r_ind"], """
, occ_totals as (select year, areaid, occid, cast(sum(emp) as bigint) as total from r_occ
  where areaid_type = 'COUNTY' and classid <> '4' group by 1, 2, 3),
staff as (select year, areaid, occid, indid, cast(sum(emp) as bigint) as staff_emp from r_staffing
  where areaid_type = 'COUNTY' and classid = '1' group by 1, 2, 3, 4),
w as (select *, staff_emp / nullif(sum(staff_emp) over (partition by year, areaid, occid), 0) as pct from staff),
ind_totals as (select year, areaid, indid, cast(sum(emp) as bigint) as num_emps from r_ind
  where areaid_type = 'COUNTY' and classid <> '4' group by 1, 2, 3)
select w.year as YEAR, w.areaid as AREAID, w.indid as INDID, w.occid as OCCID, cast(it.num_emps as double) as NUM_EMPS,
 o.total * w.pct as OCC_EMPS, cast(w.pct as double) as PERCENT
from w join occ_totals o on o.year = w.year and o.areaid = w.areaid and o.occid = w.occid
 left join ind_totals it on it.year = w.year and it.areaid = w.areaid and it.indid = w.indid
union all
select o.year, o.areaid, cast(null as varchar), o.occid, cast(null as double), cast(o.total as double), 1.0::double
from occ_totals o where not exists (select 1 from w where w.year = o.year and w.areaid = o.areaid and w.occid = o.occid)""")

    q["allocate_by_percent"] = _wrap(["r_staffing", "r_hiresseps"], """
, h as (select year, areaid, indid, cast(sum(hira) as bigint) as hires, cast(sum(sep) as bigint) as seps
  from r_hiresseps where areaid_type = 'COUNTY' group by 1, 2, 3)
select p.year as YEAR, p.areaid as AREAID, p.indid as INDID, p.occid as OCCID, p.percent as PERCENT,
 h.hires as HIRES, h.hires * p.percent as OCC_HIRES, h.seps as SEPS, h.seps * p.percent as OCC_SEPS
from r_staffing p left join h on p.year = h.year and p.areaid = h.areaid and p.indid = h.indid
where p.areaid_type = 'COUNTY' and p.classid = '2'""")

    q["location_quotient"] = _wrap(["r_staffing"], f"""
, base as (select * from r_staffing where classid = '1' and year <= {Y}),
st_rows as (select * from base where areaid = '{S}' and areaid_type = 'STATE' and areaid_name = '{SN}'),
co_rows as (select * from base where areaid_type = 'COUNTY' and {st('areaid', S)}),
st_cat as (select year, occid, cast(sum(emp) as bigint) as e from st_rows group by 1, 2),
st_cat2 as (select s.*, t.t from st_cat s left join (select year, cast(sum(emp) as bigint) as t from st_rows group by 1) t
  on s.year = t.year),
co_cat as (select year, areaid, occid, cast(sum(emp) as bigint) as e from co_rows group by 1, 2, 3),
co_cat2 as (select c.*, t.t from co_cat c left join (select year, areaid, cast(sum(emp) as bigint) as t from co_rows
  group by 1, 2) t on c.year = t.year and c.areaid = t.areaid)
select c.year as YEAR, c.areaid as AREAID, c.occid as OCCID, c.e as COUNTY_OCC_EMPS, c.t as COUNTY_TOTAL_EMPS,
 cast(c.e as double) / cast(c.t as double) as COUNTY_OCC_CONC, s.e as STATE_OCC_EMPS, s.t as STATE_TOTAL_EMPS,
 cast(s.e as double) / cast(s.t as double) as STATE_OCC_CONC,
 (cast(c.e as double) / cast(c.t as double)) / nullif(cast(s.e as double) / cast(s.t as double), 0) as LQ
from co_cat2 c left join st_cat2 s on c.year = s.year and c.occid = s.occid""")

    q["shift_period"] = _wrap(["r_enrollments"], """
select year + 2 as YEAR, unitid as UNITID, enrlevelid as ENRLEVELID, enrollments as ENROLLMENTS from r_enrollments""")

    q["year_over_year"] = _wrap(["r_occ"], """
, b as (select areaid, occid, year, cast(sum(replacements + growth) as bigint) as openings from r_occ
  where areaid_type = 'COUNTY' and classid <> '4' group by 1, 2, 3)
select b.areaid as AREAID, b.occid as OCCID, b.year as YEAR, b.openings as OPENINGS, p.openings as PRIOR_OPENINGS
from b left join b p on p.areaid = b.areaid and p.occid = b.occid and p.year + 1 = b.year""")

    q["flagged_count"] = _wrap(["r_postings", "r_postings_skills"], f"""
select cast(year(p.posted) as integer) as YEAR_POSTED, p.county as AREAID, count(*) as NUM_JOBS,
 count(distinct case when p.id in (select id from r_postings_skills where is_software) then p.id end)
  as NUM_JOBS_WITH_SOFTWARE
from r_postings p where {st('p.county', S)}
group by 1, 2""")

    q["sum_with_support"] = _wrap(["r_postings"], """
select county as AREAID, count(*) as NUM_JOBS, cast(sum(duration) as bigint) as TOTAL_DURATION,
 count(duration) as N_WITH_DURATION, cast(sum(salary) as decimal(28,2)) as TOTAL_SALARY, count(salary) as N_WITH_SALARY
from r_postings group by county""")

    q["group_total_alongside"] = _wrap(["r_postings", "r_postings_skills"], """
, d as (select p.county as areaid, s.skill_id, count(*) as mentions
  from r_postings_skills s join r_postings p on s.id = p.id group by 1, 2),
t as (select county as areaid, count(*) as total from r_postings group by 1)
select d.areaid as AREAID, d.skill_id as SKILL_ID, d.mentions as MENTIONS, t.total as TOTAL_JOBS
from d join t on d.areaid = t.areaid""")

    q["entity_fanout_count"] = _wrap(["r_profiles_educations", "r_postings"], """
, e as (select distinct id, school_name from r_profiles_educations),
s as (select distinct company as id, soc_2 from r_postings),
m as (select distinct company as id, min_edulevels from r_postings)
select e.school_name as SCHOOL, s.soc_2 as SOC_2, m.min_edulevels as MIN_EDULEVELS, count(*) as N
from e join s on e.id = s.id left join m on e.id = m.id
group by all""")

    q["latest_and_prior_year"] = _wrap(["r_enrollments"], """
select year as YEAR, unitid as UNITID, raceid as RACEID, genderid as GENDERID, enrlevelid as ENRLEVELID,
 enrollments as ENROLLMENTS,
 case when year = (select max(year) from r_enrollments) then 'current' else 'prior' end as PERIOD
from r_enrollments
where year = (select max(year) from r_enrollments) or year = (select max(year) - 1 from r_enrollments)""")

    lv = {3: "L3", 5: "L5", 7: "L7", 9: "L9", 11: "L11"}
    mx = "(select max(year) from r_completions)"
    piv_cols = ",\n ".join(
        f"cast(sum(case when awlevelid = {k} and year = {mx} then completions end) as bigint) as CURRENT_{v}, "
        f"cast(sum(case when awlevelid = {k} and year = {mx} - 1 then completions end) as bigint) as PRIOR_{v}"
        for k, v in lv.items())
    pivot_body = f"""
select unitid as UNITID,
 {piv_cols}
from r_completions where year = {mx} or year = {mx} - 1
group by unitid"""
    q["pivot_current_prior"] = _wrap(["r_completions"], pivot_body)
    q["change_and_pct_change"] = _wrap(["r_completions"], f"""
, p as ({pivot_body}),
c as (select UNITID, coalesce(CURRENT_L3, 0) as cur, coalesce(PRIOR_L3, 0) as prior from p)
select UNITID, cur as CUR, prior as PRIOR, cur - prior as RAW_CHANGE,
 case when prior = 0 then 0.0 else (cur - prior) / prior end as PCT_CHANGE_DIV0,
 (cur - prior) / nullif(prior, 0) as PCT_CHANGE_NULL
from c""")

    q["calendar_window_count"] = _wrap(["r_postings"], f"""
select county as AREAID,
 cast(sum(case when {Y} - year(posted) < 1 then 1 end) as bigint) as CURRENT_ROLLING,
 cast(sum(case when {Y} - year(posted) >= 1 and {Y} - year(posted) < 2 then 1 end) as bigint) as PRIOR_ROLLING
from r_postings group by county
having sum(case when {Y} - year(posted) < 2 then 1 end) is not null""")

    q["star_join"] = _wrap(["r_postings", "r_unit", "r_acs"], f"""
, spine as (select distinct cast(county as varchar) as areaid from r_postings where {st('county', S)}),
po as (select cast(county as varchar) as areaid, count(*) as n from r_postings group by 1),
un as (select cast(county as varchar) as areaid, count(*) as n from r_unit group by 1)
select spine.areaid as AREAID, po.n as POSTINGS, un.n as UNITS, acs.median_household_income as MEDIAN_HOUSEHOLD_INCOME
from spine left join po on spine.areaid = po.areaid left join un on spine.areaid = un.areaid
 left join r_acs acs on spine.areaid = acs.areaid""")
    return q


# ---------------------------------------------------------------------------
# reshape job
# ---------------------------------------------------------------------------
def _clean_year(x: str) -> str:
    t = f"coalesce(cast(cast(trunc(try_cast(trim({x}) as double)) as bigint) as varchar), trim({x}))"
    return f"(case when regexp_full_match({t}, '20[0-9]{{2}}') then cast(cast({t} as integer) - 1 as varchar) || '-' || {t} else {t} end)"


def _format_grade(x: str) -> str:
    s = f"trim({x})"
    n = f"try_cast(trunc(try_cast({s} as double)) as integer)"
    suffix = (f"(case when {n} % 100 between 11 and 13 then 'th' when {n} % 10 = 1 then 'st' "
              f"when {n} % 10 = 2 then 'nd' when {n} % 10 = 3 then 'rd' else 'th' end)")
    return (f"(case when {s} is null then null when upper({s}) in ('3F', '3H') or upper({s}) like 'P%' "
            f"then 'Pre-Kindergarten' when upper({s}) like 'K%' then 'Kindergarten' "
            f"when {n} between 1 and 12 then cast({n} as varchar) || {suffix} || ' Grade' else 'Other' end)")


_RACES = [("His", "Hispanic or Latino"), ("AmInd", "American Indian or Alaska Native"), ("Asian", "Asian"),
          ("Black", "Black or African American"), ("Pac Is", "Native Hawaiian or Other Pacific Islander"),
          ("White", "White"), ("Multi", "Two or more races")]


def _melt_body() -> str:
    branches = "\n union all ".join(
        f"select schoolyear, county, district, school_name, grade, '{label}' as race, "
        f"'{'Male' if g == 'M' else 'Female'}' as gender, \"{abbr} {g}\" as total from r_wide_enrollment"
        for abbr, label in _RACES for g in ("M", "F"))
    year = _clean_year("schoolyear")
    return f"""
, u as ({branches}),
m as (select {year} as Year, county as County, district as District, school_name as School, race as Race,
  gender as Gender, {_format_grade('grade')} as Grade, total as Total from u)
select * from m where Year is not null and trim(Year) <> '' and lower(trim(Year)) <> 'nan'"""


def _links_body() -> str:
    """Link discovery over the derived pages restated in DuckDB, by intervals:
    every container, list item, anchor and heading gets the place where it
    ends by a join with the later tags of its page; the rules are then range
    conditions (the Spark form folds over the tags of a page instead)."""
    from tallgrass.operators.reshape import (
        CLICK_HERE_TEXT, COMPANION_LINK_TEXT, CONTAINER_CLASS, PRIMARY_LINK_TEXT, WRAPPER_CLASSES, py_normalize)
    from tallgrass.sources.roles import ENROLLMENT_HTML

    def classes_have(*names: str) -> str:
        want = ", ".join(f"'{n}'" for n in names)
        return ("list_has_all(regexp_split_to_array(trim(regexp_extract(attrs, "
                "'class\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)), '\\s+'), [" + want + "])")

    def plain(text: str) -> str:
        for name, char in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                           ("&amp;", "&")):
            text = f"replace({text}, '{name}', '{char}')"
        return f"trim({text}, ' \t\r\n\f\u00a0')"

    def ends(name: str, of: str, later: str) -> str:
        return (f"\n{name} as (select o.page_id, o.pos, coalesce(min(x.pos), 2000000000) as stop from ({of}) o "
                f"left join d x on x.page_id = o.page_id and x.pos > o.pos and ({later}) group by 1, 2),")

    tag_re = "'^<(/?)([A-Za-z][A-Za-z0-9]*)([^>]*)>'"
    unread = "(?is)<!--(?:.*?-->|.*\\z)|<script\\b(?:.*?</script\\s*>|.*\\z)|<style\\b(?:.*?</style\\s*>|.*\\z)"
    href_re = "(?i)(?:^|\\s)href\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s\"''>]+)"
    run = "partition by page_id order by pos rows between unbounded preceding and current row"
    lists = "case when tag in ('ul', 'ol') and not closing then 1 when tag in ('ul', 'ol') then -1 else 0 end"
    origin = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    dir_ = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)', 1)"
    link = ("case when regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') then href "
            "when starts_with(href, '//') then regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) || href "
            f"when starts_with(href, '/') then {origin} || href "
            f"else (case when {dir_} = '' then {origin} || '/' else {dir_} end) || href end")
    norm = "regexp_replace(lower(text), '[^a-z0-9]', '', 'g')"
    y4 = "regexp_extract_all(heading, '(20[0-9]{2})', 1)"
    y2 = "regexp_extract_all(heading, '([0-9]{2})', 1)"
    fy = (f"case when heading is null then null "
          f"when len({y4}) >= 2 then {y4}[1] || '-' || {y4}[2] "
          f"when len({y4}) = 1 then cast(cast({y4}[1] as integer) - 1 as varchar) || '-' || "
          f"cast(cast({y4}[1] as integer) as varchar) "
          f"when len({y2}) >= 1 then cast(2000 + cast({y2}[-1] as integer) - 1 as varchar) || '-' || "
          f"cast(2000 + cast({y2}[-1] as integer) as varchar) end")
    fname = "regexp_extract(url_decode(replace(link, '+', '%2B')), '([^/]*)$', 1)"
    opened = "select page_id, pos, depth from d where tag = 'div' and not closing and "
    return f"""
, source as (select page_id, url, {ENROLLMENT_HTML} as html from pages),
clean as (select page_id, url, regexp_replace(coalesce(html, ''), '{unread}', '', 'g') as html from source),
parts as (select page_id, url, html, string_split(html, '<') as p from clean),
pieces as (select page_id, url, starts_with(html, '<') as lead, unnest(p) as raw, generate_subscripts(p, 1) as k
  from parts),
tok as (select page_id, url, k - 1 - cast(lead as integer) as pos,
  lower(regexp_extract(piece, {tag_re}, 2)) as tag, regexp_extract(piece, {tag_re}, 1) = '/' as closing,
  regexp_extract(piece, {tag_re}, 3) as attrs, regexp_replace(piece, '^<[^>]*>', '') as text
  from (select *, case when k = 1 then raw else '<' || raw end as piece from pieces) x
  where not (k = 1 and lead)),
d1 as (select *, sum(case when tag = 'div' and not closing then 1 when tag = 'div' then -1 else 0 end) over ({run})
   as depth, sum({lists}) over ({run}) as lvl from tok),
d as (select *, sum(case when tag = 'li' and not closing then 1 when tag = 'li' then -1 else 0 end)
   over (partition by page_id, lvl order by pos rows between unbounded preceding and current row) as items from d1),{
ends("wrappers", opened + classes_have(*WRAPPER_CLASSES), "x.depth < o.depth")}{
ends("titles", opened + classes_have("title", CONTAINER_CLASS), "x.depth < o.depth")}{
ends("boxes", opened + classes_have("text", CONTAINER_CLASS), "x.depth < o.depth")}{
ends("lis", "select page_id, pos, lvl, items from d where tag = 'li' and not closing",
     "x.lvl < o.lvl or (x.tag = 'li' and x.closing and x.lvl = o.lvl and x.items < o.items)")}{
ends("a_ends", "select page_id, pos from d where tag = 'a' and not closing", "x.tag = 'a'")}{
ends("h_ends", "select page_id, pos from d where tag = 'h2' and not closing", "x.tag = 'h2'")}
heads as (select h.page_id, h.stop, {plain("string_agg(t.text, '' order by t.pos)")} as text from h_ends h
  join d t on t.page_id = h.page_id and t.pos >= h.pos and t.pos < h.stop where h.stop < 2000000000
  and exists (select 1 from titles c where c.page_id = h.page_id and c.pos < h.pos and h.pos < c.stop)
  group by h.page_id, h.pos, h.stop),
counted as (select b.* from boxes b where b.page_id not in (select page_id from wrappers) or exists
  (select 1 from wrappers w where w.page_id = b.page_id and w.pos < b.pos and b.pos < w.stop)),
texts as (select a.page_id, a.pos, {plain("string_agg(t.text, '' order by t.pos)")} as text from a_ends a
  join d t on t.page_id = a.page_id and t.pos >= a.pos and t.pos < a.stop group by 1, 2),
anchors as (select o.page_id, o.url, o.pos, o.text, {plain("trim(regexp_extract(o.attrs, '" + href_re + "', 1), '\"''')")} as href,
  exists (select 1 from lis l where l.page_id = o.page_id and l.pos < o.pos and o.pos < l.stop) as in_li,
  (select min(b.pos) from counted b where b.page_id = o.page_id and b.pos < o.pos and o.pos < b.stop) as container,
  (select max_by(h.text, h.stop) from heads h where h.page_id = o.page_id and h.stop <= o.pos
     and starts_with(upper(h.text), 'FY')) as heading
  from (select d.page_id, d.url, d.pos, d.attrs, texts.text from d join texts using (page_id, pos)) o
  where regexp_matches(o.attrs, '{href_re}')),
resolved as (select *, {link} as link from anchors),
classified as (select *,
  case when lower(trim(text)) = '{CLICK_HERE_TEXT}' then 'click_here'
       when in_li and {norm} = '{py_normalize(PRIMARY_LINK_TEXT)}' then 'school_ethgen_li'
       when in_li and {norm} = '{py_normalize(COMPANION_LINK_TEXT)}' then 'school_site_li' end as pattern
  from resolved where container is not null),
kept as (select * from (select *, max(case when pattern = 'school_ethgen_li' then 1 else 0 end)
   over (partition by page_id, container) as has_primary from classified where pattern is not null) x
  where pattern <> 'school_site_li' or has_primary = 1),
links as (select page_id, pos, link, text, pattern, heading, {fy} as fiscal_year, {fname} as file_name
  from (select *, row_number() over (partition by page_id, link order by pos) as n from kept) x where n = 1)"""


def _rename_body(years: str) -> str:
    """Canonical names of each chosen header row, as known for the three layouts of the
    derived workbooks (by year mod 3) and for the companions."""
    races = ["His", "AmInd", "Asian", "Black", "Pac Is", "White", "Multi"]
    values = "|".join(f"{r} {g}" for r in races for g in "MF")
    none = "<none>"
    layouts = {0: f"SchoolYear|County|District|School Name|{none}|Grade|{values}",
               1: f"SchoolYear|County|District|School Name|{none}|Grade|{none}|{values}",
               2: f"County|District|School Name|{none}|Grade|{values}"}
    cases = " ".join(f"when cast(y as integer) % 3 = {k} then '{v}'" for k, v in layouts.items())
    return f"""
select 'enrollment_' || y as workbook, case {cases} end as names from {years} x
union all select 'site_totals_' || y, 'County|District|{none}|School Name|{none}|{none}' from {years} x"""


def reshape_sql(cfg: MartConfig | None = None) -> dict[str, str]:
    q: dict[str, str] = {}
    melt = _wrap(["r_wide_enrollment"], _melt_body())
    q["melt_wide"] = melt
    q["enrollment_primary"] = melt
    q["backfill_blank"] = melt
    years = "(select distinct schoolyear as y from r_wide_enrollment)"
    kinder = "(select schoolyear as y, count(*) as n from r_wide_enrollment where grade = 'K' group by 1)"
    q["findings"] = _wrap(["r_wide_enrollment"], f"""
select 'no_matching_sheet' as kind, 'summary_' || y || ' (pattern school_ethgen_li)' as detail from {years} x
union all select 'source_file_unreachable', 'lost_' || y || ': no answer in 60 s' from {years} x
union all select 'workbook_unreadable', 'broken_' || y || ': no zip file' from {years} x
union all select 'workbook_reshape_skipped', 'twice_' || y || ': twice School Name' from {years} x
union all select 'missing_race_gender_columns', 'moved_' || y || ': His M' from {years} x
union all select 'unparseable_counts', 'stars_' || y || ': ' || cast(2 * n as varchar) || ' such as ***' from {kinder} x""")
    sheet = "'School Totals by Race'"
    q["workbook_status"] = _wrap(["r_wide_enrollment"], f"""
, per_year as (select schoolyear as y, count(*) as n, count_if(grade = 'K') as k from r_wide_enrollment group by 1)
select 'enrollment_' || y as workbook, 'school_ethgen_li' as pattern, 'reshaped' as status, {sheet} as sheet,
 cast(14 * n as bigint) as rows, cast(0 as bigint) as unparsed from per_year
union all select 'site_totals_' || y, 'school_site_li', 'companion', 'ALL sites', 0, 0 from per_year
union all select 'summary_' || y, 'school_ethgen_li', 'no_matching_sheet', null, 0, 0 from per_year
union all select 'lost_' || y, 'school_ethgen_li', 'unreachable', null, 0, 0 from per_year
union all select 'broken_' || y, 'school_ethgen_li', 'unreadable', null, 0, 0 from per_year
union all select 'twice_' || y, 'school_ethgen_li', 'skipped', 'Data', 0, 0 from per_year
union all select 'moved_' || y, 'school_ethgen_li', 'reshaped', 'Data', 13, 0 from per_year
union all select 'stars_' || y, 'click_here', 'reshaped', {sheet}, 14 * k, 2 * k from per_year""")
    moved = _melt_body().replace("r_wide_enrollment", "w20").replace(", u as", """
, w20 as (select * replace (cast(cast(schoolyear as integer) + 20 as varchar) as schoolyear) from r_wide_enrollment),
u as""", 1)
    q["enrollment_run"] = _wrap(["r_wide_enrollment"], moved.replace(
        "select * from m where", """select 'enrollment_primary' as dataset, m.*, cast(1 as bigint) as published,
 cast(1 as bigint) as unchanged, (select count(*) from m) as recorded from m where"""))
    q["find_header"] = _wrap(["r_wide_enrollment"], f"""
select 'enrollment_' || y as workbook, 'School Totals by Race' as sheet, cast(1 as bigint) as header_row
from {years} x""")
    q["rename_by_alias"] = _wrap(["r_wide_enrollment"], _rename_body(years))
    q["pick_sheet"] = _wrap(["r_wide_enrollment"], f"""
select 'enrollment_' || y as workbook, 'school_ethgen_li' as pattern, 'School Totals by Race' as sheet,
 cast(1 as bigint) as header_row from {years} x
union all
select 'site_totals_' || y, 'school_site_li', 'ALL sites', cast(1 as bigint) from {years} x""")
    q["pair_companion"] = _wrap(["r_wide_enrollment"], f"""
select 'enrollment_' || y as workbook, {_clean_year('y')} as fiscal_year, 'site_totals_' || y || '.xlsx' as companion_file
from {years} x""")
    q["newer_period_check"] = _wrap(["r_wide_enrollment"], """
, w as (select cast(max(cast(schoolyear as integer)) + 20 as integer) as y from r_wide_enrollment)
select 'all collected' as collected, y as collected_end_year, y as watched_end_year, 'ok' as status from w
union all select 'one behind', y - 1, y, 'newer_period_available' from w
union all select 'no heading', null, y, 'unknown' from w""")
    q["page_anchors"] = ("WITH x AS (select 1)" + _links_body()
                         + "\nselect page_id, pos, href, link, text, in_li, container, heading from resolved")
    q["discover_links"] = "WITH x AS (select 1)" + _links_body() + "\nselect * from links"
    q["link_warnings"] = "WITH x AS (select 1)" + _links_body() + """
select p.page_id, 'grid_wrapper_not_found' as kind from pages p
 where not exists (select 1 from wrappers w where w.page_id = p.page_id)
union all
select p.page_id, 'no_enrollment_links' as kind from pages p
 where not exists (select 1 from links l where l.page_id = p.page_id)"""
    q["incremental_skip"] = "WITH x AS (select 1)" + _links_body() + """
, f as (select distinct file_name from links), n as (select count(*) as n, count_if(length(file_name) % 3 = 0) as n3 from f)
select 1 as RUN, n as NEW_FILES, cast(0 as bigint) as KEPT_FILES, case when n = 0 then 'success_no_change' else 'rebuild' end as STATUS from n
union all select 2, 0, n, 'success_no_change' from n
union all select 3, n3, n - n3, case when n3 = 0 then 'success_no_change' else 'rebuild' end from n"""
    return q


# ---------------------------------------------------------------------------
# data operations
# ---------------------------------------------------------------------------
def ops_sql(cfg: MartConfig | None = None) -> dict[str, str]:
    c = cfg or harness_config()
    now = c.ops_as_of.strftime("%Y-%m-%d %H:%M:%S")
    recent = (c.recent_as_of or c.ops_as_of)
    since = (recent.replace(microsecond=0) - __import__("datetime").timedelta(hours=24)).strftime("%Y-%m-%d %H:%M:%S")
    q: dict[str, str] = {}
    q["previous_successful"] = _wrap(["r_runs"], """
select * exclude (rn) from (select *, row_number() over (partition by pipeline, dataset
  order by finished_at desc, run_id desc) as rn from r_runs where status = 'success' and row_count is not null) x
where rn = 1""")
    q["rollback"] = _wrap(["r_runs"], """
select * exclude (rn, n) from (select *, row_number() over (partition by dataset order by finished_at desc, run_id desc) as rn,
  count(*) over (partition by dataset) as n from r_runs where status = 'success' and source_uri is not null) x
where rn = case when n >= 2 then 2 else 1 end""")
    q["dataset_freshness"] = _wrap(["r_runs"], f"""
, ok as (select * from r_runs where status in ('success', 'success_no_change')),
latest as (select * from (select *, row_number() over (partition by pipeline, dataset
  order by finished_at desc, run_id desc) as rn from ok) x where rn = 1)
select ok.pipeline, ok.dataset, max(ok.group_name) as schedule_group, max(ok.finished_at) as last_success_at,
 cast(floor(epoch(timestamp '{now}' - max(ok.finished_at)) / 86400) as bigint) as days_since_success,
 any_value(l.row_count) as last_row_count, any_value(l.max_year) as last_max_year,
 any_value(l.git_sha) as last_git_sha
from ok join latest l on ok.pipeline = l.pipeline and ok.dataset = l.dataset
group by ok.pipeline, ok.dataset""")
    stale = f"""
, latest as (select pipeline, dataset, group_name, max(finished_at) as last from r_runs
  where status in ('success', 'success_no_change') group by all),
t as (select * from (values ('labour_market', 'monthly', 792), ('labour_market', 'quarterly', 2304),
  ('labour_market', 'yearly', 8952), ('enrollment', 'monthly', 816)) v(pipeline, group_name, max_age_hours)),
stale as (select l.pipeline, l.dataset, l.group_name,
  cast(floor(epoch(timestamp '{now}' - l.last) / 3600) as bigint) as age_hours,
  cast(t.max_age_hours as bigint) as max_age_hours
  from latest l join t on l.pipeline = t.pipeline and l.group_name = t.group_name
  where floor(epoch(timestamp '{now}' - l.last) / 3600) > t.max_age_hours)"""
    q["freshness_check"] = _wrap(["r_runs"], stale + "\nselect * from stale")
    q["freshness_message"] = _wrap(["r_runs"], stale + """
, top as (select * from stale order by age_hours desc, pipeline, dataset, group_name limit 20)
select case when (select count(*) from stale) > 0 then
 printf('STALE: %d past their limit, the oldest: %s', (select count(*) from stale),
  (select string_agg(printf('%s/%s, %s: %d hours of %d', pipeline, dataset, group_name, age_hours,
     max_age_hours), ' | ' order by age_hours desc, pipeline, dataset, group_name) from top)) end as message""")
    q["stale_gate"] = _wrap(["r_runs"], stale + """
select 'as found' as CASE_NAME, count(*) > 0 as RAISED, case when count(*) > 0 then true end as NAMED from stale
union all select 'none stale', false, null""")
    q["manifest_recent"] = _wrap(["r_runs"], """
select started_at, finished_at, pipeline, dataset, group_name, status, row_count, max_year,
 round(duration_seconds, 1) as duration_seconds, bytes, source_query_id, source_uri, git_sha, env, run_id, error
from r_runs""")
    q["manifest_last_day"] = _wrap(["r_runs"], f"""
select started_at, pipeline, dataset, status, row_count, round(duration_seconds, 1) as secs, left(error, 60) as error,
 run_id from r_runs where started_at > timestamp '{since}'
order by started_at desc, run_id desc limit 50""")
    marts = mart_sql(c)
    jobs = marts["fact_jobs"]
    q["measure_staging"] = f"""
select count(*) as row_count, cast(max(YEAR_POSTED) as bigint) as max_year,
 count_if(AREAID is null) as null__AREAID, count_if(OCCID is null) as null__OCCID,
 count_if(INDID is null) as null__INDID, count_if(MIN_EDULEVELS is null) as null__MIN_EDULEVELS,
 'fact_jobs' as dataset
from ({jobs}) j"""
    measured = ["AREAID", "OCCID", "INDID", "MIN_EDULEVELS"]   # fact_jobs columns configured not-null
    not_null = "".join(f"""
union all select 'fact_jobs', 'not_null', null__{c} = 0, printf('{c} of fact_jobs: %d rows without a value', null__{c}),
 cast(null__{c} as varchar), '0' from p""" for c in measured)
    q["quality_report"] = _wrap(["r_runs"], f"""
, m as ({q["measure_staging"]}),
b as (select cast(row_count as bigint) as pr, cast(max_year as bigint) as py from (select *, row_number() over
  (order by finished_at desc, run_id desc) as rn from r_runs
  where status = 'success' and row_count is not null and dataset = 'd0') x where rn = 1),
p as (select m.*, (select max(pr) from b) as prev_rows, (select max(py) from b) as prev_year,
  case when (select max(pr) from b) = 0 then 0.0
   else abs(row_count - (select max(pr) from b)) / cast((select max(pr) from b) as double) * 100.0 end as pct from m)
select 'fact_jobs' as dataset, 'empty_result' as "check", row_count > 0 as passed,
 printf('fact_jobs: %d rows', row_count) as detail, cast(row_count as varchar) as observed, '1 or more' as expected from p
union all select 'fact_jobs', 'known_row_count', row_count = 12345,
 printf('fact_jobs: %d rows where 12345 are known', row_count), cast(row_count as varchar), '12345' from p
union all select 'fact_jobs', 'row_count_drift', prev_rows = 0 or pct <= 20.0,
 printf('fact_jobs: %d rows, before %d, apart by %.1f %%', row_count, prev_rows, pct),
 cast(row_count as varchar), printf('within 20.0 %% of %d', prev_rows) from p where prev_rows is not null
union all select 'fact_jobs', 'max_year_regressed', max_year >= prev_year,
 printf('fact_jobs: newest period %d, before %d', max_year, prev_year), cast(max_year as varchar),
 printf('%d or later', prev_year) from p where prev_rows is not null and max_year is not null and prev_year is not null
{not_null}
union all select 'fact_jobs', 'not_null', false, 'SKILL_ID of fact_jobs: must have values, but there is no such column',
 cast(null as varchar), '0' from p""")
    q["publish_cycle"] = f"""
select * replace (cast(YEAR_POSTED as bigint) as YEAR_POSTED, cast(QUARTER_POSTED as bigint) as QUARTER_POSTED,
 cast(MONTH_POSTED as bigint) as MONTH_POSTED, cast(AREAID as bigint) as AREAID)
from ({jobs}) j"""
    q["limited_run"] = f"""
select 'fact_jobs' as DATASET, 'success_limited' as STATUS, false as PUBLISHED,
 cast(least(100, count(*)) as bigint) as ROW_COUNT from ({jobs}) j"""
    batch = [n for n in marts if n != "fact_lq_ind_truncated"]
    q["run_batch"] = "\nunion all\n".join(
        f"select '{n}' as dataset, 'success' as status, count(*) as row_count, cast(null as varchar) as error "
        f"from ({marts[n]}) b{i}" for i, n in enumerate(batch))
    q["load_reference"] = """
select 'Program ' || p_name as CIP2020Title,
 lpad(cast(10 + p_size % 40 as varchar), 2, '0') || '.' || lpad(cast((p_partkey * 7) % 10000 as varchar), 4, '0')
  as PROGRAMID,
 cast(11 + p_size % 4 as varchar) || '-' || cast(1011 + p_partkey % 7 as varchar) as OCCID,
 'Occupation ' || p_type as SOC2018Title
from part"""
    q["snapshot_pages"] = "select page_id, url, html, 'snapshot' as run_id from pages"
    q["incremental_landing"] = "select page_id, url, html from pages"
    q["schema_normalize"] = """
select e.vec_id, cast(e.label as bigint) as label,
 '[' || array_to_string(list_transform(e.embedding, lambda x: cast(cast(floor(x * cast(1000 as float)) as integer) as varchar)), ',') || ']' as steps,
 case when l.doc_id is null then '{}' else '{"quality":' || l.quality || ',"toxic":' || l.toxic || '}' end as marks,
 cast(e.embedding[1] as double) as "first", e.label > 4 as high
from embeddings e left join labels l on l.doc_id = e.vec_id"""
    q["run_log"] = f"""
select 'dim_area' as dataset, 'success' as status, 'monthly' as group_name, (select count(*) from ({marts["dim_area"]}) a) as row_count,
 cast(null as varchar) as error, cast(2 as bigint) as records, true as timed
union all select 'dim_area', 'success_no_change', 'monthly', (select count(*) from ({marts["dim_area"]}) a), null, 1, true
union all select 'no_such_mart', 'failed', null, null, 'KeyError', 2, true
union all select 'dim_occ', 'failed', null, null, 'RunLost', 2, true
union all select 'dim_ind', 'running', null, null, null, 1, null"""
    q["publish_history"] = _wrap(["r_ref_area"], f"""
, n as (select (select count(*) from ({marts["dim_area"]}) a) as a, (select count(*) from r_ref_area) as b)
select cast(1 as bigint) as ENTRY, 'publish' as ACTION, a as READ_ROWS, true as LATE_REFUSED from n
union all select 2, 'publish', b, true from n union all select 3, 'restore', a, true from n
union all select 4, 'publish', b, true from n union all select 5, 'publish', b, true from n""")
    q["empty_publish"] = """
select * from (values ('YEAR', 'bigint', 0::bigint, 0::bigint), ('AREAID', 'string', 0, 0), ('OCCID', 'string', 0, 0),
 ('OPENINGS', 'bigint', 0, 0)) t(COLUMN_NAME, TYPE, STAGED_ROWS, READ_ROWS)"""
    q["chunk_agreement"] = """
select cast(o_orderkey as bigint) as ID, case when o_orderkey % 3 = 2 and o_orderkey % 5 = 0 then null else cast(o_custkey as integer) end
  as PRIORITY, case when o_orderkey % 3 = 1 then null else o_orderstatus end as STATUS,
 case when o_orderkey % 3 = 2 and o_orderkey % 5 = 0 then 'PRIORITY' else '' end as faults from orders"""
    q["chunk_common_type"] = """
select cast(o_orderkey as bigint) as ID, case when o_orderkey % 3 = 2 and o_orderkey % 5 = 0 then 'n/a'
  else cast(o_custkey as varchar) end as PRIORITY, case when o_orderkey % 3 = 1 then null else o_orderstatus end as STATUS,
 0 as FAULTS from orders"""
    q["file_inventory"] = """
with p as (select page_id % 5 = 0 as late, page_id % 7 = 0 as again, page_id % 11 = 0 as gone, octet_length(encode(html)) as b from pages),
second as (select case when gone then 'removed' when late then 'new' when again then 'changed' else 'same' end as change,
  b + case when again and not gone then 2 else 0 end as b from p where not (gone and late))
select 'new' as change, count(*) as files, cast(sum(b) as bigint) as bytes, 1 as version from p where not late
union all select change, count(*), cast(sum(b) as bigint), 2 from second group by change
union all select 'stored', count(*), cast(sum(b) as bigint), 2 from second where change <> 'removed'"""
    return q
