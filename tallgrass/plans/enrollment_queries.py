"""Query keys for the wide-sheet reshaping job and link discovery."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.functions import clean_year
from tallgrass.operators import reshape as R
from tallgrass.operators.relational import materialize
from tallgrass.plans import enrollment as E
from tallgrass.session import scratch_root
from tallgrass.sources.roles import ENROLLMENT_HTML

WIDE_IDS = {"schoolyear": "SchoolYear", "county": "County", "district": "District",
            "school_name": "School Name", "grade": "Grade"}


def enrollment_pages(src) -> DataFrame:
    """The given pages, each with an enrollment section of its own links."""
    return src.raw("pages").select("page_id", "url", F.expr(ENROLLMENT_HTML).alias("html"))


def q_page_anchors(src, cfg: MartConfig) -> DataFrame:
    return R.page_anchors(enrollment_pages(src))


def q_discover_links(src, cfg: MartConfig) -> DataFrame:
    return R.discover_links(enrollment_pages(src))


def q_link_warnings(src, cfg: MartConfig) -> DataFrame:
    return R.link_warnings(enrollment_pages(src))


def q_melt_wide(src, cfg: MartConfig) -> DataFrame:
    return R.melt_wide(src.wide_enrollment, WIDE_IDS)


def _job(src):
    grid = E.derived_grid(src)
    return E.run_enrollment(grid, E.records_for(grid))


def q_enrollment_primary(src, cfg: MartConfig) -> DataFrame:
    long, _ = _job(src)
    return long


def _listed(name: str, year: Column, sheet: str, sheet_no: int, row_no: int, cells: Column) -> list[Column]:
    return [F.concat(F.lit(f"{name}_"), year).alias("workbook"), F.lit(sheet).alias("sheet"), F.lit(sheet_no).alias("sheet_no"),
            F.lit(row_no).cast("bigint").alias("row_no"), cells.alias("cells")]


def faulty_workbooks(wide: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Workbooks gone wrong, a set for each school year: (grid, files, accepted).

    summary: no sheet with a known header; lost: not fetched; broken: not decoded; twice: a
    column two times; moved: a value column renamed since the workbook was accepted; stars:
    linked by "click here", a like sheet before the named one, two counts that are no numbers
    in every row of the kindergartens."""
    years, year = wide.select("schoolyear").distinct(), F.col("schoolyear")
    head = E._PRIMARY_HEADERS[0]
    values = [F.lit(str(i)) for i in range(len(R.VALUE_COLUMNS))]
    row = F.array(year, F.lit("C"), F.lit("D"), F.lit("S"), F.lit("1"), F.lit("5"), *values)
    moved = ["Hisp Men" if c == "His M" else c for c in head]
    kinder = wide.filter(F.col("grade") == "K")
    stars = F.array(year, "county", "district", "school_name", "school_code", "grade", F.lit("***"), F.lit("1,234"), *values[2:])
    parts = [years.select(*_listed("summary", year, "Summary", 0, 0, R._lit_array(["Year", "Total students", "Change"]))),
             years.select(*_listed("twice", year, "Data", 0, 0, R._lit_array([*head, "School Site"]))),
             years.select(*_listed("twice", year, "Data", 0, 1, F.concat(row, F.array(F.lit("T"))))),
             years.select(*_listed("moved", year, "Data", 0, 0, R._lit_array(moved))),
             years.select(*_listed("moved", year, "Data", 0, 1, row)),
             years.select(*_listed("stars", year, "Cover", 0, 0, R._lit_array(head))),
             years.select(*_listed("stars", year, R.TOTALS_SHEET, 1, 0, R._lit_array(head))),
             kinder.select(*_listed("stars", year, R.TOTALS_SHEET, 1, 0, stars)).withColumn(
                 "row_no", F.lit(1) + F.abs(F.xxhash64("cells") % F.lit(10 ** 12)))]
    grid = reduce(DataFrame.unionByName, parts)
    files = years.select(F.explode(F.array(
        F.struct(F.concat(F.lit("lost_"), year).alias("workbook"), F.lit("unreachable").alias("state"),
                 F.lit("no answer in 60 s").alias("error")),
        F.struct(F.concat(F.lit("broken_"), year).alias("workbook"), F.lit("unreadable").alias("state"),
                 F.lit("no zip file").alias("error")))).alias("f")).select("f.*")
    accepted = years.select(F.concat(F.lit("moved_"), year).alias("workbook"), F.lit("Data").alias("sheet"),
                            F.lit(0).cast("bigint").alias("header_row"))
    return grid, files, accepted


def _faulty_job(src) -> E.Reshaped:
    grid, files, accepted = faulty_workbooks(src.wide_enrollment)
    faulty = src.derived("enrollment_faulty", lambda: grid)
    whole = E.derived_grid(src)
    names = faulty.select("workbook").union(whole.select("workbook")).union(files.select("workbook"))
    return E.reshape_workbooks(whole.unionByName(faulty), E.records_for(names), files, accepted)


def q_findings(src, cfg: MartConfig) -> DataFrame:
    return _faulty_job(src).findings


def q_workbook_status(src, cfg: MartConfig) -> DataFrame:
    return _faulty_job(src).statuses


def listing_page(wide: DataFrame) -> DataFrame:
    """One page that lists a primary and a companion workbook per school year under FY headings."""
    year = F.col("schoolyear")
    section = F.concat(
        F.lit('<div class="title aem-GridColumn--default--12"><h2>FY '), clean_year(year),
        F.lit('</h2></div><div class="text aem-GridColumn--default--12"><ul><li><a href="files/enrollment_'), year,
        F.lit(f'">{R.PRIMARY_LINK_TEXT}</a></li><li><a href="files/site_totals_'), year,
        F.lit(f'">{R.COMPANION_LINK_TEXT}</a></li></ul></div>'))
    parts = wide.select("schoolyear").distinct().select(F.struct("schoolyear", section.alias("html")).alias("s"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["html"]), "")
    return parts.agg(body.alias("body")).select(
        F.lit(1).cast("bigint").alias("page_id"), F.lit("https://state.example.org/enrollment/index.html").alias("url"),
        F.concat(F.lit('<div class="aem-Grid aem-Grid--12 aem-Grid--default--12">'), "body", F.lit("</div>")).alias("html"))


def q_enrollment_run(src, cfg: MartConfig) -> DataFrame:
    """From a page that lists the workbooks to the published table, and again with nothing new:
    the table's rows, and how many runs published or found no change."""
    from tallgrass.sources.inventory import Inventory
    from tallgrass.sources.sinks import Warehouse
    root = f"{scratch_root(src.spark)}/tallgrass_enrollment/{uuid.uuid4().hex}"
    wh, inventory = Warehouse(src.spark, f"{root}/warehouse"), Inventory(src.spark, f"{root}/files")
    # the school years moved into this century, the only one that headings are read for
    wide = src.wide_enrollment.withColumn("schoolyear", (F.col("schoolyear").cast("int") + 20).cast("string"))
    grid = src.derived("enrollment_grid_moved", lambda: E.grids_from_wide(wide))
    pages = listing_page(wide)
    arrived = grid.select(F.col("workbook").alias("file_name")).distinct().withColumn("content", F.col("file_name").cast("binary"))
    for _ in range(2):
        E.run_from_pages(wh, pages, grid, inventory=inventory, arrived=arrived)
    runs = wh.manifest().groupBy("dataset").agg(F.count_if(F.col("status") == "success").alias("published"),
                                                F.count_if(F.col("status") == "success_no_change").alias("unchanged"),
                                                F.max("row_count").alias("recorded"))
    return wh.read("enrollment_primary").withColumn("dataset", F.lit("enrollment_primary")).join(
        F.broadcast(runs), "dataset")   # one row


def q_find_header(src, cfg: MartConfig) -> DataFrame:
    idx = R.sheet_index(E.derived_grid(src))
    return idx.filter(F.col("sig").isNotNull()).select("workbook", "sheet", F.col("sig.row").alias("header_row"))


def q_pick_sheet(src, cfg: MartConfig) -> DataFrame:
    grid = E.derived_grid(src)
    chosen = R.choose_sheets(R.sheet_index(grid), E.records_for(grid))
    return chosen.select("workbook", "pattern", "sheet", "header_row")


def q_rename_by_alias(src, cfg: MartConfig) -> DataFrame:
    grid = E.derived_grid(src)
    chosen = R.choose_sheets(R.sheet_index(grid), E.records_for(grid))
    return chosen.select("workbook", F.array_join(R.rename_by_alias(F.col("header_cells")), "|", "<none>")
                         .alias("names"))


def q_backfill_blank(src, cfg: MartConfig) -> DataFrame:
    long, _ = _job(src)
    return long  # all rows: the blanks that are filled and the rows that must not change


def q_pair_companion(src, cfg: MartConfig) -> DataFrame:
    recs = E.records_for(E.derived_grid(src))
    links = recs.select(F.lit(0).alias("page_id"), F.xxhash64("workbook").alias("pos"),
                        F.col("workbook").alias("link"), F.concat("workbook", F.lit(".xlsx")).alias("file_name"),
                        "pattern", "fiscal_year")
    paired = R.pair_companion(links)
    return paired.select(F.col("link").alias("workbook"), "fiscal_year", "companion_file")


def q_newer_period_check(src, cfg: MartConfig) -> DataFrame:
    """The three outcomes, over the school years moved into this century."""
    years = materialize(src.wide_enrollment.select((F.col("schoolyear").cast("int") + 20).alias("y")).distinct())
    every = years.select(clean_year(F.col("y")).alias("Year"))
    behind = years.filter(F.col("y") < years.select(F.max("y")).scalar()).select(F.concat(F.col("y"), F.lit(".0")).alias("Year"))
    unheaded = years.select(F.concat(F.lit("Notes of "), "y").alias("Year"))
    cases = {"all collected": every, "one behind": behind, "no heading": unheaded}
    return reduce(DataFrame.unionByName, [
        E.newer_period_check(collected, every).withColumn("collected", F.lit(name)) for name, collected in cases.items()])


def q_incremental_skip(src, cfg: MartConfig) -> DataFrame:
    """Runs over the same pages with differing holdings: nothing held; everything; some files
    not held yet and one that no page lists any more (J18, J19)."""
    # the discovered file list, written once (all runs and their checks reuse it)
    files = materialize(R.discover_links(enrollment_pages(src)).select("file_name").distinct())
    stale = src.spark.createDataFrame([("gone.xlsx",)], "file_name string")
    some = files.filter(F.length("file_name") % 3 != 0).unionByName(stale)
    out = []
    for run, held in enumerate([None, files, some], start=1):
        new, skip = E.incremental_skip(files, held)
        kept = 0 if held is None else held.join(files, "file_name", "left_semi").count()
        out.append((run, new.count(), kept, "success_no_change" if skip else "rebuild"))
    return src.spark.createDataFrame(out, "RUN int, NEW_FILES bigint, KEPT_FILES bigint, STATUS string")


ENROLLMENT_QUERIES = {
    "page_anchors": q_page_anchors,
    "discover_links": q_discover_links,
    "link_warnings": q_link_warnings,
    "melt_wide": q_melt_wide,
    "enrollment_primary": q_enrollment_primary,
    "findings": q_findings,
    "workbook_status": q_workbook_status,
    "enrollment_run": q_enrollment_run,
    "find_header": q_find_header,
    "pick_sheet": q_pick_sheet,
    "rename_by_alias": q_rename_by_alias,
    "backfill_blank": q_backfill_blank,
    "pair_companion": q_pair_companion,
    "newer_period_check": q_newer_period_check,
    "incremental_skip": q_incremental_skip,
}
