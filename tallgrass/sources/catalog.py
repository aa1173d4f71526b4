"""Source catalog: logical source names -> DataFrames.

``SourceCatalog`` stands between the marts and storage.  With a driver
folder it derives the role tables (see ``roles``) once and serves them as
Parquet scans; ``tables.TableCatalog`` serves the same names from catalog tables.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from tallgrass.session import apply_session_settings, scratch_root, size_partitions
from tallgrass.sources import roles
from tallgrass.sources.fs import fingerprint, folder_bytes, write_parquet_atomic

# logical source name -> role table
SOURCE_ROLES = {
    "postings": "r_postings",
    "postings_skills": "r_postings_skills",
    "staffing": "r_staffing",
    "occ": "r_occ",
    "ind": "r_ind",
    "hiresseps": "r_hiresseps",
    "labor_force": "r_labor_force",
    "demog": "r_demog",
    "acs": "r_acs",
    "ref_area": "r_ref_area",
    "unit": "r_unit",
    "programs": "r_programs",
    "completions": "r_completions",
    "enrollments": "r_enrollments",
    "dim_occid": "r_dim_occid",
    "dim_indid": "r_dim_indid",
    "crosswalk": "r_crosswalk",
    "profiles": "r_profiles",
    "profiles_educations": "r_profiles_educations",
    "runs": "r_runs",
    "wide_enrollment": "r_wide_enrollment",
}

# Row order inside written files: clusters the columns marts filter on, so
# Parquet min/max statistics can skip row groups.
_LAYOUT = {
    "r_postings": ("county", "posted"),
    "r_postings_skills": ("id",),
    "r_staffing": ("areaid_type", "areaid", "year"),
    "r_occ": ("areaid", "year"),
    "r_ind": ("areaid", "year"),
    "r_hiresseps": ("areaid", "year"),
    "r_labor_force": ("areaid_type", "areaid", "year"),
    "r_demog": ("areaid", "year"),
    "r_completions": ("year", "unitid"),
    "r_enrollments": ("year", "unitid"),
    "r_runs": ("finished_at",),
}

_LOCK = threading.Lock()
_CATALOGS: dict[tuple[int, str, str], "SourceCatalog"] = {}


class DerivedTables:
    """Tables that Spark derives from a set of sources, written once under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._frames: dict[str, DataFrame] = {}
        self._lock = threading.RLock()
        self._role_locks: dict[str, threading.Lock] = {}

    def derived(self, name: str, build, sort_within: tuple[str, ...] = ()) -> DataFrame:
        """Write a table Spark derives from the sources once, then scan it.

        Cuts long lineages (and re-derivation at every use) the way a
        written table in the shared folder does.
        """
        key = f"derived:{name}"
        with self._lock:
            if key in self._frames:
                return self._frames[key]
            lock = self._role_locks.setdefault(key, threading.Lock())
        with lock:
            if key in self._frames:
                return self._frames[key]
            path = f"{self.root}/derived/{name}"
            write_parquet_atomic(build(), path, sort_within=sort_within)
            df = self.spark.read.parquet(path)
            with self._lock:
                self._frames[key] = df
            return df


class SourceCatalog(DerivedTables):
    def __init__(self, spark: SparkSession, sf_dir: str, seen: str | None = None):
        self.sf_dir = sf_dir.rstrip("/")
        # new data under the same folder name gets tables of its own
        seen = fingerprint(spark, self.sf_dir) if seen is None else seen
        key = hashlib.sha1(f"{self.sf_dir} {seen}".encode()).hexdigest()[:10]
        super().__init__(spark, f"{scratch_root(spark)}/tallgrass_sources/{key}/{roles.roles_version()}")
        self._raw_registered = False

    # driver tables -------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _register_raw(self) -> None:
        with self._lock:
            if self._raw_registered:
                return
            for name in roles.DRIVER_TABLES:
                self.raw(name).createOrReplaceTempView(name)
            self._raw_registered = True

    # role tables ---------------------------------------------------------
    def role(self, name: str) -> DataFrame:
        with self._lock:
            if name in self._frames:
                return self._frames[name]
            lock = self._role_locks.setdefault(name, threading.Lock())
        with lock:  # one writer per table; other tables proceed in parallel
            if name in self._frames:
                return self._frames[name]
            for dep in roles.SPARK_DEPENDS.get(name, ()):
                self.role(dep).createOrReplaceTempView(dep)
            self._register_raw()
            path = f"{self.root}/{name}"
            write_parquet_atomic(self.spark.sql(roles.role_sql(name, "spark")), path,
                                 sort_within=_LAYOUT.get(name, ()))
            df = self.spark.read.parquet(path)
            with self._lock:
                self._frames[name] = df
            return df

    def __getattr__(self, item: str) -> DataFrame:
        if item in SOURCE_ROLES:
            return self.role(SOURCE_ROLES[item])
        raise AttributeError(item)

    def materialise_all(self, parallelism: int = 4) -> None:
        """Write every role table; independent tables run as concurrent jobs."""
        from concurrent.futures import ThreadPoolExecutor
        self._register_raw()
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(self.role, roles.ordered_roles(roles.ROLE_SQL)))


def catalog(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    """Per-session, per-folder catalog (role tables are written once)."""
    apply_session_settings(spark)
    size_partitions(spark, folder_bytes(spark, sf_dir))
    seen = fingerprint(spark, sf_dir)
    key = (id(spark), sf_dir.rstrip("/"), seen)
    with _LOCK:
        if key not in _CATALOGS:
            _CATALOGS[key] = SourceCatalog(spark, sf_dir, seen)
        return _CATALOGS[key]
