"""The enrollment job: workbook grids -> one long enrollment table.

Order of the source job: discover -> pick sheet -> find header -> rename
-> backfill -> unpivot -> clean -> union, then gate on findings.  Here
every step is a DataFrame transformation over all workbooks at once.

``grids_from_wide`` derives workbook grids from the wide role table (one
workbook per school year, the three header conventions in turn, a title row
above the header, blank County cells that only the companion workbook can
fill), so the job runs on data that grows with the driver's tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import clean_year, end_year
from tallgrass.operators import reshape as R
from tallgrass.operators.relational import broadcast_if_bounded, materialize
from tallgrass.session import scratch_root

_PRIMARY_HEADERS = {
    0: ["SchoolYear", "County", "District", "School Name", "School Code", "Grade", *R.VALUE_COLUMNS],
    1: ["School Year", "County", "District", "School Name", "Site Code", "Grade Code", "Grade",
        *R.convention_headers(1)],
    2: ["County", "District", "School Site", "School Code", "Grade", *R.convention_headers(2)],
}


def _row_no(*cols) -> F.Column:
    # data rows below the two title/header rows; a hash of the row key keeps
    # order stable without a window over the workbook
    return F.lit(2) + F.abs(F.xxhash64(*cols) % F.lit(10 ** 12))


def grids_from_wide(wide: DataFrame) -> DataFrame:
    """Primary and companion workbook grids derived from the wide table."""
    year = F.col("schoolyear")
    style = F.pmod(year.cast("int"), F.lit(3))
    values = [F.col(f"`{c}`") for c in R.VALUE_COLUMNS]
    county_cell = F.when(F.col("grade") == "K", F.lit(" ")).otherwise(F.col("county"))

    def cells_for(s: int):
        if s == 0:
            return F.array(year, county_cell, "district", "school_name", "school_code", "grade",
                           *[v.cast("string") for v in values])
        if s == 1:
            return F.array(year, county_cell, "district", "school_name", "school_code", "grade",
                           F.concat(F.lit("Grade "), F.col("grade")), *[v.cast("double").cast("string") for v in values])
        return F.array(county_cell, "district", "school_name", "school_code", "grade",
                       *[v.cast("string") for v in values])

    wb = F.concat(F.lit("enrollment_"), year)
    data = wide.select(
        wb.alias("workbook"), F.lit(R.TOTALS_SHEET).alias("sheet"), F.lit(1).alias("sheet_no"),
        _row_no("schoolyear", "county", "district", "school_name", "grade").alias("row_no"),
        F.when(style == 0, cells_for(0)).when(style == 1, cells_for(1)).otherwise(cells_for(2)).alias("cells"))
    years = wide.select("schoolyear").distinct()
    header = F.when(F.pmod(year.cast("int"), F.lit(3)) == 0, R._lit_array(_PRIMARY_HEADERS[0])) \
              .when(F.pmod(year.cast("int"), F.lit(3)) == 1, R._lit_array(_PRIMARY_HEADERS[1])) \
              .otherwise(R._lit_array(_PRIMARY_HEADERS[2]))
    frame = years.select(wb.alias("workbook"), "schoolyear")
    notes = frame.select("workbook", F.lit("Notes").alias("sheet"), F.lit(0).alias("sheet_no"),
                         F.lit(0).cast("bigint").alias("row_no"),
                         F.array(F.lit("About this workbook"), F.lit("")).alias("cells"))
    title = frame.select("workbook", F.lit(R.TOTALS_SHEET).alias("sheet"), F.lit(1).alias("sheet_no"),
                         F.lit(0).cast("bigint").alias("row_no"),
                         F.array(F.concat(F.lit("State enrollment by school, "), year)).alias("cells"))
    head = frame.select("workbook", F.lit(R.TOTALS_SHEET).alias("sheet"), F.lit(1).alias("sheet_no"),
                        F.lit(1).cast("bigint").alias("row_no"), header.alias("cells"))
    # companion: one row per school with its location and code
    cwb = F.concat(F.lit("site_totals_"), year)
    schools = wide.select("schoolyear", "county", "district", "school_name", "school_code").distinct()
    comp_title = frame.select(F.concat(F.lit("site_totals_"), "schoolyear").alias("workbook"),
                              F.lit("ALL sites").alias("sheet"), F.lit(0).alias("sheet_no"),
                              F.lit(0).cast("bigint").alias("row_no"), F.array(F.lit("Site totals")).alias("cells"))
    comp_head = frame.select(F.concat(F.lit("site_totals_"), "schoolyear").alias("workbook"),
                             F.lit("ALL sites").alias("sheet"), F.lit(0).alias("sheet_no"),
                             F.lit(1).cast("bigint").alias("row_no"),
                             R._lit_array(["County", "District", "School Name/Site", "School Name", "School Code",
                                           "Total"]).alias("cells"))
    comp_rows = schools.select(cwb.alias("workbook"), F.lit("ALL sites").alias("sheet"), F.lit(0).alias("sheet_no"),
                               _row_no("schoolyear", "school_code", "county", "district", "school_name").alias("row_no"),
                               F.array("county", "district", "school_name", "school_name", "school_code",
                                       F.lit("0")).alias("cells"))
    grid = data.unionByName(notes).unionByName(title).unionByName(head) \
               .unionByName(comp_title).unionByName(comp_head).unionByName(comp_rows)
    return grid


def derived_grid(src) -> DataFrame:
    """The derived workbook grids, written once as a table (the decoded
    source workbooks of a real run)."""
    return src.derived("enrollment_grid", lambda: grids_from_wide(src.wide_enrollment),
                       sort_within=("workbook", "sheet_no", "row_no"))


def records_for(grid: DataFrame) -> DataFrame:
    """What link discovery yields for the derived workbooks: pattern and the
    fiscal year of the section each workbook is listed under."""
    wbs = grid.select("workbook").distinct()
    y = F.regexp_extract("workbook", r"_(\d{4})$", 1)
    pattern = (F.when(F.col("workbook").startswith("site_totals_"), F.lit("school_site_li"))
                .when(F.col("workbook").startswith("stars_"), F.lit("click_here"))
                .otherwise(F.lit("school_ethgen_li")))
    return wbs.select("workbook", pattern.alias("pattern"), clean_year(y).alias("fiscal_year"))


@dataclass
class Reshaped:
    """What became of the listed workbooks: rows, findings (kind, detail), one status each."""

    long: DataFrame
    findings: DataFrame
    statuses: DataFrame


LONG_COLUMNS = ["Year", "County", "District", "School", "Race", "Gender", "Grade", "Total"]
FILES_SCHEMA = "workbook string, state string, error string"


def _finding(kind: str, detail) -> list:
    return ["workbook", F.lit(kind).alias("kind"), F.concat(F.col("workbook"), detail).alias("detail")]


def reshape_workbooks(grid: DataFrame, records: DataFrame, files: DataFrame | None = None,
                      accepted: DataFrame | None = None) -> Reshaped:
    """Reshape every listed workbook; what goes wrong with one is data and stops no other.

    ``records``: workbook, pattern, fiscal_year and optionally pos (place on the page).
    ``files``: what fetching and decoding made of a workbook (state ``ok``, ``unreachable`` or
    ``unreadable``, and the error); one without an entry is ok.  ``accepted``: sheet and header
    row of workbooks that were accepted before; the others' are found.

    Kinds of findings: source_file_unreachable, workbook_unreadable (or without any row),
    no_matching_sheet, missing_race_gender_columns (accepted before, changed since),
    workbook_reshape_skipped (a column twice: which cell would count?), unparseable_counts.

    Two passes over the grid: one aggregation builds the per-sheet index
    (header candidates), one scan turns data rows into long rows, each with a verdict on its
    count, written once; rows, findings and statuses are read from there.
    """
    # one row per workbook or sheet each: written once, as several later steps read them
    records = materialize(records)
    index = materialize(R.sheet_index(grid))
    chosen = R.choose_sheets(index, records)
    if accepted is not None:
        known = accepted.select("workbook", "sheet", F.col("header_row").cast("bigint").alias("header_row"))
        heads = grid.join(broadcast_if_bounded(known), ["workbook", "sheet"]).filter(F.col("row_no") == F.col("header_row"))
        chosen = chosen.join(known, "workbook", "left_anti").unionByName(
            heads.join(records.select("workbook", "pattern"), "workbook")
            .select("workbook", "pattern", "sheet", "header_row", F.col("cells").alias("header_cells")))
    names = R.rename_by_alias(F.col("header_cells"))
    known_names = F.filter(names, lambda n: n.isNotNull())
    twice = F.filter(F.array_distinct(known_names), lambda n: F.size(F.filter(known_names, lambda m: m == n)) > 1)
    chosen = materialize(chosen.withColumn("names", names).withColumn(
        "twice", F.when(F.col("pattern") == "school_site_li", F.array().cast("array<string>")).otherwise(twice)))
    found = chosen.filter(F.col("header_row").isNotNull())
    usable = found.filter(F.size("twice") == 0)
    recs = R.row_records(grid, usable.select("workbook", "sheet", "header_row", "header_cells"))
    recs = recs.join(broadcast_if_bounded(records.select("workbook", "pattern", "fiscal_year")), "workbook")
    prim = recs.filter(F.col("pattern") != "school_site_li")
    comp = recs.filter(F.col("pattern") == "school_site_li")

    # companion lookup: first row per school code in each companion workbook
    payload = F.struct(F.col("County").alias("c_county"), F.col("District").alias("c_district"),
                       F.col("School Name").alias("c_school"))
    lookup = (comp.filter(F.col("school_code").isNotNull() & (F.col("school_code") != ""))
                  .groupBy(F.col("workbook").alias("companion"), "school_code")
                  .agg(F.min_by(payload, F.struct("sheet", "row_no")).alias("p"))
                  .select("companion", "school_code", "p.*"))
    # a listed primary workbook is paired with the last readable companion listed
    # under its fiscal year (records without a position count in name order)
    place = F.col("pos") if "pos" in records.columns else F.lit(0)
    r = records.filter(F.col("fiscal_year").isNotNull())
    last = (r.filter(F.col("pattern") == "school_site_li").join(usable.select("workbook"), "workbook", "left_semi")
            .groupBy("fiscal_year").agg(F.max_by("workbook", F.struct(place, F.col("workbook"))).alias("companion")))
    pairing = r.filter(F.col("pattern") == "school_ethgen_li").select("workbook", "fiscal_year") \
        .join(last, "fiscal_year").select("workbook", "companion")
    filled = R.backfill_blank(prim, lookup, pairing)
    long = materialize(R.melt_records(filled, fiscal_year=F.col("fiscal_year")))

    # a verdict per workbook, then what it says of the rest
    state = records.select("workbook", "pattern")
    if files is not None:
        state = state.join(files.select("workbook", "state", "error"), "workbook", "left")
    else:
        state = state.withColumn("state", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string"))
    read = index.select("workbook").distinct().withColumn("read", F.lit(True))
    counts = long.groupBy("workbook").agg(F.count(F.lit(1)).alias("rows"), F.count("Unparsed").alias("unparsed"),
                                          F.min("Unparsed").alias("such_as"))
    verdict = materialize(
        state.join(read, "workbook", "left").join(chosen.drop("pattern", "header_cells"), "workbook", "left")
        .join(counts, "workbook", "left")
        .withColumn("status", F.when(F.col("state") == "unreachable", "unreachable")
                    .when((F.col("state") == "unreadable") | F.col("read").isNull(), "unreadable")
                    .when(F.col("header_row").isNull(), "no_matching_sheet").when(F.size("twice") > 0, "skipped")
                    .when(F.col("pattern") == "school_site_li", "companion").otherwise("reshaped")))
    lacking = F.array_except(R._lit_array(R.VALUE_COLUMNS), F.col("names"))
    shaped = verdict.filter(F.col("status") == "reshaped")
    parts = [
        verdict.filter(F.col("status") == "unreachable").select(*_finding(
            "source_file_unreachable", F.concat(F.lit(": "), F.coalesce("error", F.lit("no answer"))))),
        verdict.filter(F.col("status") == "unreadable").select(*_finding(
            "workbook_unreadable", F.concat(F.lit(": "), F.coalesce("error", F.lit("no sheet"))))),
        verdict.filter(F.col("status") == "no_matching_sheet").select(*_finding(
            "no_matching_sheet", F.concat(F.lit(" (pattern "), F.col("pattern"), F.lit(")")))),
        verdict.filter(F.col("status") == "skipped").select(*_finding(
            "workbook_reshape_skipped", F.concat(F.lit(": twice "), F.array_join("twice", ", ")))),
        shaped.filter(F.size(lacking) > 0).select(*_finding(
            "missing_race_gender_columns", F.concat(F.lit(": "), F.array_join(lacking, ", ")))),
        shaped.filter(F.col("unparsed") > 0).select(*_finding(
            "unparseable_counts", F.concat(F.lit(": "), F.col("unparsed"), F.lit(" such as "), F.col("such_as")))),
    ]
    findings = reduce(DataFrame.unionByName, parts).select("kind", "detail")
    statuses = verdict.select("workbook", "pattern", "status", "sheet", F.coalesce("rows", F.lit(0)).alias("rows"),
                              F.coalesce("unparsed", F.lit(0)).alias("unparsed"))
    return Reshaped(long.select(*LONG_COLUMNS), findings, statuses)


def run_enrollment(grid: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(long rows, findings) of workbooks that are all there."""
    r = reshape_workbooks(grid, records)
    return r.long, r.findings


class EnrollmentFindingsError(RuntimeError):
    pass


def gate_on_findings(findings: DataFrame, shown: int = 20) -> None:
    """Any finding fails the run before anything is published.

    All findings are written to a table in the shared folder; the message has
    their count by kind, the table's path and the first few texts."""
    path = f"{scratch_root(findings.sparkSession)}/tallgrass_findings/{uuid.uuid4().hex}"
    findings.write.parquet(path)
    kept = findings.sparkSession.read.schema(findings.schema).parquet(path)
    kinds = kept.groupBy("kind").count().orderBy("kind").collect()   # one row per kind
    if kinds:
        first = kept.orderBy("kind", "detail").limit(shown).collect()
        raise EnrollmentFindingsError(
            f"{sum(r['count'] for r in kinds)} finding(s) (" + ", ".join(f"{r['count']} {r['kind']}" for r in kinds)
            + f"), all in {path}; first: " + "; ".join(f"{r['kind']}: {r['detail']}" for r in first))


def newer_period_check(collected: DataFrame, watched: DataFrame, period_col: str = "Year") -> DataFrame:
    """Compare the newest period of a watched source with the newest one
    collected (J20, H24): 'newer_period_available' fails the run, 'ok'
    passes, 'unknown' (either side not computable) warns."""
    watched_max = watched.select(F.max(end_year(F.col(period_col)))).scalar()  # scalar subquery
    both = (collected.agg(F.max(end_year(F.col(period_col))).alias("collected_end_year"))
            .withColumn("watched_end_year", watched_max))
    status = (F.when(F.col("collected_end_year").isNull() | F.col("watched_end_year").isNull(), F.lit("unknown"))
               .when(F.col("watched_end_year") > F.col("collected_end_year"), F.lit("newer_period_available"))
               .otherwise(F.lit("ok")))
    return both.withColumn("status", status)


def snapshot_pages(pages: DataFrame, root: str, run_id: str) -> DataFrame:
    """Archive the pages of one run, whole, under ``run_id=<id>`` (A14) and return
    what was archived, read back from storage."""
    pages.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(root)
    return pages.sparkSession.read.parquet(root).filter(F.col("run_id") == run_id).select(*pages.columns, "run_id")


def archive_grids(grid: DataFrame, root: str) -> int:
    """Archive each decoded source workbook once (A14): one folder per workbook, written when it
    is not there yet; how many were new."""
    spark = grid.sparkSession
    from tallgrass.sources.fs import list_names
    there = [n.split("=", 1)[1] for n in list_names(spark, root) if n.startswith("workbook=")]
    held = spark.createDataFrame([(unquote(n),) for n in there], "workbook string")
    new = grid.join(broadcast_if_bounded(held), "workbook", "left_anti")
    n = new.select("workbook").distinct().count()
    if n:
        new.withColumn("copy", F.col("workbook")).repartition("workbook").write.mode("append") \
            .partitionBy("workbook").parquet(root)
    return n


def records_from_pages(pages: DataFrame) -> DataFrame:
    """The workbooks that pages list: what link discovery finds, as records of the job."""
    links = R.discover_links(pages)
    return links.select(F.col("file_name").alias("workbook"), "pattern", "fiscal_year", "pos", "link", "page_id")


def incremental_skip(discovered: DataFrame, held: DataFrame | None) -> tuple[DataFrame, bool]:
    """Files not yet held (J18); an empty result means nothing to rebuild.

    Returns (new files, short_circuit).
    """
    files = discovered.select("file_name").distinct()
    new = files if held is None else files.join(held.select("file_name"), "file_name", "left_anti")
    return new, new.isEmpty()


class NewerPeriodError(RuntimeError):
    pass


class NoSourceFilesError(RuntimeError):
    """No workbook is listed: the page has probably changed."""


class AllWorkbooksFailedError(RuntimeError):
    pass


def run_enrollment_pipeline(wh, grid: DataFrame, records: DataFrame, *, held: DataFrame | None = None,
                            watched: DataFrame | None = None, files: DataFrame | None = None,
                            accepted: DataFrame | None = None, quality=None, table: str = "enrollment_primary",
                            pipeline: str = "enrollment", group_name: str | None = "monthly") -> dict:
    """One enrollment run in the source's order (§3.2):

    listed files -> findings gate -> newer-period guard -> short-circuit when every found
    file is already held -> publish.  Whatever fails, wherever, leaves exactly one
    ended run record (K13); a run with nothing new leaves a no-change record
    with the published row count (K19).  Records carry the schedule group, which the
    freshness gate reads (K16).  Returns a small summary.
    """
    import datetime as _dt

    from tallgrass.operators.dataops import QualityConfig, run_record
    from tallgrass.sources.sinks import _record, new_run_id, publish_cycle, record_no_change

    run_id = new_run_id()
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    _record(wh, run_record(run_id, pipeline, table, "running", started, group_name=group_name))
    warning = None
    try:
        listed = records.filter(F.col("pattern") != "school_site_li")
        if listed.isEmpty():
            raise NoSourceFilesError("no workbook is listed; the page has probably changed")
        shaped = reshape_workbooks(grid, records, files, accepted)
        if shaped.statuses.filter(F.col("status") == "reshaped").isEmpty():
            raise AllWorkbooksFailedError("none of the listed workbooks could be reshaped")
        gate_on_findings(shaped.findings)
        if watched is not None:
            status = newer_period_check(listed.select(F.col("fiscal_year").alias("Year")), watched).first()["status"]
            if status == "newer_period_available":
                raise NewerPeriodError("a newer period is published than the one collected")
            warning = "newer_period_unknown" if status == "unknown" else None
        _, nothing_new = incremental_skip(listed.select(F.col("workbook").alias("file_name")), held)
    except Exception as e:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        _record(wh, run_record(run_id, pipeline, table, "failed", started, now, group_name=group_name,
                               error=f"{type(e).__name__}: {e}"))
        raise
    # both of these record their own end
    if nothing_new:
        rec = record_no_change(wh, table, pipeline=pipeline, run_id=run_id, group_name=group_name)
        return {"status": "success_no_change", "row_count": rec["row_count"], "warning": warning}
    r = publish_cycle(wh, shaped.long, table, quality or QualityConfig(), pipeline=pipeline, run_id=run_id,
                      group_name=group_name, announced=True)
    return {"status": r.status, "row_count": r.row_count, "warning": warning}


def run_from_pages(wh, pages: DataFrame, grid: DataFrame, *, inventory=None, arrived: DataFrame | None = None,
                   files: DataFrame | None = None, watched: DataFrame | None = None, quality=None) -> dict:
    """From the pages to the published table: snapshot, discovery, archive, run, retention.

    The pages are archived before anything is read from them, so a change of theirs that
    breaks the run can be looked at.  ``inventory`` (sources.inventory) knows the files held so
    far; after a run that did not fail it takes in what ``arrived`` (file_name, content) and keeps
    the listed primary files only."""
    from tallgrass.sources.sinks import new_run_id
    run_id = new_run_id()
    raw = snapshot_pages(pages, f"{wh.root}/raw/pages", run_id)
    records = materialize(records_from_pages(raw))
    archive_grids(grid, f"{wh.root}/raw/workbooks")
    held = inventory.held().select("file_name") if inventory is not None else None
    out = run_enrollment_pipeline(wh, grid, records, held=held, files=files, watched=watched, quality=quality)
    if inventory is not None:
        listed = records.filter(F.col("pattern") != "school_site_li").select(F.col("workbook").alias("file_name"))
        inventory.update(listed, arrived)
    return out
