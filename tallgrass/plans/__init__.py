"""The 35 published marts (+ the fixed LQ variant), as named builders.

Each builder is ``(sources, MartConfig) -> DataFrame``; ``MARTS`` is the
registry a batch run iterates over.
"""

from __future__ import annotations

from tallgrass.operators.relational import shift_period
from tallgrass.plans import dims, education, employment, postings, regional

MARTS = {
    "dim_area": dims.dim_area,
    "dim_awlevels": dims.dim_awlevels,
    "dim_company": dims.dim_company,
    "dim_edulevels": dims.dim_edulevels,
    "dim_ind": dims.dim_ind,
    "dim_occ": dims.dim_occ,
    "dim_programs": dims.dim_programs,
    "dim_schools": dims.dim_schools,
    "dim_skills": dims.dim_skills,
    "dim_university": dims.dim_university,
    "fact_certifications": postings.fact_certifications,
    "fact_completions": education.fact_completions,
    "fact_completions_lagged": education.fact_completions_lagged,
    "fact_emp": employment.fact_emp,
    "fact_emp_lagged": employment.fact_emp_lagged,
    "fact_emp_county_idx": employment.fact_emp_county_idx,
    "fact_emp_state_idx": employment.fact_emp_state_idx,
    "fact_enrollments": education.fact_enrollments,
    "fact_enrollments_lagged": education.fact_enrollments_lagged,
    "fact_has": employment.fact_has,
    "fact_has_lagged": employment.fact_has_lagged,
    "fact_jobs": postings.fact_jobs,
    "fact_jobs_lagged": postings.fact_jobs_lagged,
    "fact_jobs_county_idx": postings.fact_jobs_county_idx,
    "fact_jobs_state_idx": postings.fact_jobs_state_idx,
    "fact_jobwithcerts": postings.fact_jobwithcerts,
    "fact_lq_ind": employment.fact_lq_ind,
    "fact_lq_occ": employment.fact_lq_occ,
    "fact_openings_occ": employment.fact_openings_occ,
    "fact_profiles": postings.fact_profiles,
    "fact_regional_indicators": regional.fact_regional_indicators,
    "fact_skills": postings.fact_skills,
    "fact_skills_lagged": postings.fact_skills_lagged,
    "fact_wages_ind": employment.fact_wages_ind,
    "fact_wages_occ": employment.fact_wages_occ,
}

# Marts that are another mart with its period moved by one: (mart, period).
LAGGED = {
    "fact_completions_lagged": ("fact_completions", "YEAR"),
    "fact_emp_lagged": ("fact_emp", "YEAR"),
    "fact_enrollments_lagged": ("fact_enrollments", "YEAR"),
    "fact_has_lagged": ("fact_has", "YEAR"),
    "fact_jobs_lagged": ("fact_jobs", "YEAR_POSTED"),
    "fact_skills_lagged": ("fact_skills", "YEAR_POSTED"),
}

# Variants that are not published marts of their own.
VARIANTS = {
    "fact_lq_ind_truncated": employment.fact_lq_ind_truncated,
}

# ---------------------------------------------------------------------------
# Schedule groups: a mart runs in the default group unless another group
# names it (so a new mart is picked up without configuration).
# ---------------------------------------------------------------------------
DEFAULT_GROUP = "monthly"
GROUPS: dict[str, tuple[str, ...]] = {"monthly": (), "quarterly": (), "yearly": ()}


def group_for(name: str, groups: dict[str, tuple[str, ...]] = GROUPS) -> str:
    for group, names in groups.items():
        if name in names:
            return group
    return DEFAULT_GROUP


def datasets_in_group(group: str, groups: dict[str, tuple[str, ...]] = GROUPS) -> list[str]:
    if group not in groups:
        raise KeyError(f"unknown group {group!r}; known: {sorted(groups)}")
    unknown = sorted(set(groups[group]) - set(MARTS))
    if unknown:
        raise KeyError(f"group {group!r} names unknown marts: {', '.join(unknown)}")
    return [m for m in MARTS if group_for(m, groups) == group]


def default_quality():
    """The published marts' quality gate (fixed values of the source's config)."""
    from tallgrass.operators.dataops import QualityConfig
    return QualityConfig(row_count_drift_pct=20.0, known_row_counts={"dim_area": 78},
                         not_null={"dim_area": ["AREAID"]})


def batch(src, cfg, names=None) -> tuple[dict, dict]:
    """What ``run_batch`` takes: the builders of marts by name, and for the lagged ones how
    they come from the mart they shift once that is written."""
    names = list(names or MARTS)
    builders = {n: (lambda n=n: MARTS[n](src, cfg)) for n in names}
    derived = {n: (base, lambda df, col=col: shift_period(df, col, 1))
               for n, (base, col) in LAGGED.items() if n in builders and base in builders}
    return builders, derived


def run_marts(wh, src, cfg, names=None, group: str | None = None, quality=None, row_limit: int | None = None,
              parallelism: int = 4, raise_at_end: bool = True):
    """Build and publish marts (by name or schedule group), one outcome row
    each; the batch fails at the end naming every failed mart (K12)."""
    from tallgrass.sources.sinks import run_batch
    selected = list(names) if names else (datasets_in_group(group) if group else list(MARTS))
    builders, derived = batch(src, cfg, selected)
    return run_batch(wh, builders, quality or default_quality(), groups={n: group_for(n) for n in selected}, row_limit=row_limit, parallelism=parallelism,
                     raise_at_end=raise_at_end, derived=derived)
