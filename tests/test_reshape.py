"""Link discovery on pages and the grid reshape, on small fixtures."""

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import reshape as R
from tallgrass.plans import enrollment as E

def _section(heading, *items):
    return (f'<div class="aem-GridColumn--default--12 title"><h2>{heading}</h2></div>'
            f'<div class="aem-GridColumn--default--12 text">{"".join(items)}</div>')


def _item(href, text):
    return f'<ul><li>See <a title="x" href="{href}">{text}</a></li></ul>'


# three sections of one grid: two fiscal years and one whose heading names none
PAGE = ('<html><div class="aem-Grid aem-Grid--12 aem-Grid--default--12">'
        + _section("FY 2021&ndash;2022", _item("/files/wide%20a.xlsx", "School site totals, w/ ethnicity and gender"),
                   _item("sites&amp;codes.xlsx", "school SITE totals"), _item("/files/wide%20a.xlsx", R.PRIMARY_LINK_TEXT))
        + _section("FY 19", '<a href="?file=3.xlsx">CLICK HERE</a>', _item("//cdn.example.org/b.xlsx#t", f"<i>{R.PRIMARY_LINK_TEXT}</i>"))
        + _section("Older", _item("lonely.xlsx", R.COMPANION_LINK_TEXT), '<a href="page.html">More</a>')
        + f'</div><p>{_item("footer.xlsx", R.PRIMARY_LINK_TEXT)}</p></html>')

BARE = """<html><body><div class="text aem-GridColumn--default--12">
<p><a href="export.xlsx">Click here</a></p></div></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, "https://state.example.gov/enrollment/totals.html", PAGE),
                                  (2, "https://state.example.gov/x/y.html", BARE),
                                  (3, "https://state.example.gov/z.html", "<p>no links</p>")],
                                 "page_id long, url string, html string")


def test_classify_anchor(spark):
    df = spark.createDataFrame([("School Site Totals w/Ethnicity and Gender", True), ("School Site Totals", True),
                                ("Click here", False), ("School Site Totals", False)], "t string, li boolean")
    got = [r[0] for r in df.select(R.classify_anchor(F.col("t"), F.col("li"))).collect()]
    assert got == ["school_ethgen_li", "school_site_li", "click_here", None]


def test_links_of_a_page_with_three_sections(pages):
    got = [(r["file_name"], r["link"], r["pattern"], r["fiscal_year"])
           for r in R.discover_links(pages.filter("page_id = 1")).orderBy("pos").collect()]
    base = "https://state.example.gov/"
    assert got == [
        ("wide a.xlsx", base + "files/wide%20a.xlsx", "school_ethgen_li", "2021-2022"),
        ("sites&codes.xlsx", base + "enrollment/sites&codes.xlsx", "school_site_li", "2021-2022"),
        ("totals.html?file=3.xlsx", base + "enrollment/totals.html?file=3.xlsx", "click_here", "2018-2019"),
        ("b.xlsx#t", "https://cdn.example.org/b.xlsx#t", "school_ethgen_li", "2018-2019")]
    paired = {r["file_name"]: r["companion_file"] for r in R.pair_companion(R.discover_links(pages)).collect()}
    assert paired["wide a.xlsx"] == "sites&codes.xlsx" and paired["b.xlsx#t"] is None


def test_page_without_wrapper_is_searched_whole_with_a_warning(pages):
    links = R.discover_links(pages.filter("page_id = 2")).collect()
    assert [r["link"] for r in links] == ["https://state.example.gov/x/export.xlsx"]
    warnings = {(r["page_id"], r["kind"]) for r in R.link_warnings(pages).collect()}
    assert warnings == {(2, "grid_wrapper_not_found"), (3, "grid_wrapper_not_found"), (3, "no_enrollment_links")}


def test_wrapper_without_anchors_only_lacks_links(spark):
    only_wrapper = spark.createDataFrame(
        [(4, "https://state.example.gov/w.html", '<div class="aem-Grid aem-Grid--12 aem-Grid--default--12"></div>')],
        "page_id long, url string, html string")
    assert {(r["page_id"], r["kind"]) for r in R.link_warnings(only_wrapper).collect()} == {
        (4, "no_enrollment_links")}


GRID = '<div class="aem-Grid aem-Grid--12 aem-Grid--default--12">'
BOX = '<div class="text aem-GridColumn--default--12">'
PROBES = {
    "after a nested grid": f'{GRID}{BOX}{GRID}<p>x</p></div><a href="a.xlsx">Click here</a></div></div>',
    "after a nested text block": f'{GRID}{BOX}{BOX}<p>x</p></div><a href="a.xlsx">Click here</a></div></div>',
    "script with closing tags": f'{GRID}{BOX}<script>w("</div></div>")</script><a href="a.xlsx">Click here</a></div></div>',
    "comment with closing tags": f'{GRID}{BOX}<!-- </div></div> --><a href="a.xlsx">Click here</a></div></div>',
    "unquoted link": f'{GRID}{BOX}<a class=x href=a.xlsx>Click here</a></div></div>',
    "references": f'{GRID}{BOX}<a href="a.xlsx">&nbsp;Click here </a></div></div>',
    "anchor left open": f'{GRID}{BOX}<a href="a.xlsx">Click here',
}
NO_LINKS = {
    "container around the grid only": f'{BOX}{GRID}<a href="a.xlsx">Click here</a></div></div>',
    "after the container": f'{GRID}{BOX}</div><a href="a.xlsx">Click here</a></div>',
    "list item left open, after its list": f'{GRID}{BOX}<ul><li>x</ul><a href="a.xlsx">{R.PRIMARY_LINK_TEXT}</a></div></div>',
    "inside an open script": f'{GRID}{BOX}<script><a href="a.xlsx">Click here</a></div></div>',
    "empty": "",
    "null": None,
}


def _as_pages(spark, htmls):
    return spark.createDataFrame([(i, "https://h.example.org/d/p.html", h) for i, h in enumerate(htmls)],
                                 "page_id long, url string, html string")


def test_links_through_nesting_scripts_and_open_elements(spark):
    got = {r["page_id"]: r["link"] for r in R.discover_links(_as_pages(spark, PROBES.values())).collect()}
    assert got == {i: "https://h.example.org/d/a.xlsx" for i in range(len(PROBES))}
    assert R.discover_links(_as_pages(spark, NO_LINKS.values())).count() == 0


def test_open_list_items_still_classify(spark):
    html = f'{GRID}{BOX}<ul><li><a href="p.xlsx">{R.PRIMARY_LINK_TEXT}</a><li><a href="c.xlsx">{R.COMPANION_LINK_TEXT}</a></ul>'
    got = [r["pattern"] for r in R.discover_links(_as_pages(spark, [html])).orderBy("pos").collect()]
    assert got == ["school_ethgen_li", "school_site_li"]


def test_relative_links(spark):
    hrefs = ["a.xlsx", "../a.xlsx", "../../../a.xlsx", "./a/../b.xlsx?v=../1", "/x/./y/../a.xlsx", "//o.org/a", "..",
             "https://o.org/a/../b", "a..b/c.xlsx"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    got = [r["link"] for r in R.page_anchors(_as_pages(spark, [html])).orderBy("pos").collect()]
    assert got == ["https://h.example.org/d/a.xlsx", "https://h.example.org/a.xlsx", "https://h.example.org/a.xlsx",
                   "https://h.example.org/d/b.xlsx?v=../1", "https://h.example.org/x/a.xlsx", "https://o.org/a",
                   "https://h.example.org/", "https://o.org/a/../b", "https://h.example.org/d/a..b/c.xlsx"]


def test_file_names_decode_or_stay(spark):
    links = ["https://h/x/a%20b.xlsx", "https://h/x/a+b.xlsx", "https://h/x/50%zz.xlsx", "https://h/x/a.xlsx?v=1"]
    df = spark.createDataFrame([(x,) for x in links], "link string")
    assert [r[0] for r in df.select(R.file_name(F.col("link"))).collect()] == [
        "a b.xlsx", "a+b.xlsx", "50%zz.xlsx", "a.xlsx?v=1"]


def test_link_discovery_matches_duckdb_restatement(spark, pages):
    """The same rules as range joins in DuckDB, over the fixture pages."""
    import duckdb

    from tallgrass.plans.oracle import reshape_sql
    from tallgrass.sources.roles import ENROLLMENT_HTML
    con = duckdb.connect()
    htmls = [*PROBES.values(), *NO_LINKS.values()]
    # the restatement knows a few references and no links of a query alone
    every = pages.filter("page_id > 1").unionByName(_as_pages(spark, htmls).withColumn("page_id", F.col("page_id") + 10))
    con.register("pages", every.toPandas())  # some fixture pages
    sql = reshape_sql()
    # the pages as they are, then with the derived enrollment section
    for html in ("html", ENROLLMENT_HTML):
        derived = every.select("page_id", "url", F.expr(html).alias("html"))
        for key, got in [("discover_links", R.discover_links(derived)), ("link_warnings", R.link_warnings(derived)),
                         ("page_anchors", R.page_anchors(derived))]:
            want = con.execute(sql[key].replace(ENROLLMENT_HTML, html)).fetchall()
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr), (key, html)


def _grid(spark, rows):
    return spark.createDataFrame(rows, "workbook string, sheet string, sheet_no int, row_no bigint, cells array<string>")


V1 = R.convention_headers(1)
V2 = R.convention_headers(2)


def fixture_grids(spark):
    vals = [str(i) for i in range(1, 15)]
    rows = [
        # abbreviated style, no year column, header under a title row, sheet found by name
        ("totals", "Read me", 0, 0, ["notes"]),
        ("totals", "School Totals by Race", 1, 0, ["Enrollment by school"]),
        ("totals", "School Totals by Race", 1, 1, ["County", "District", "School Name", "Grade", *R.VALUE_COLUMNS]),
        ("totals", "School Totals by Race", 1, 2, ["CREEK", "D1", "School 1", "3H", *vals]),
        ("totals", "School Totals by Race", 1, 3, ["TULSA", "D2", "School 2", "K", *vals]),
        # verbose v1 with both "Grade Code" and a prose "Grade"; a blank County to backfill
        ("ethgen", "Sheet1", 0, 0, ["SchoolYear", "County", "District", "School Name", "School Code",
                                    "Grade Code", "Grade", *V1]),
        ("ethgen", "Sheet1", 0, 1, ["2024", " ", "D1", "School 1", "101", "5", "Fifth grade", *vals]),
        ("ethgen", "Sheet1", 0, 2, ["2024.0", "OSAGE", "D3", "School 3", "103", "12", "Twelfth", *vals]),
        ("ethgen", "Sheet1", 0, 3, ["", "OSAGE", "D3", "School 3", "103", "12", "Twelfth", *vals]),
        # verbose v2, second sheet
        ("wave", "Cover", 0, 0, ["x"]),
        ("wave", "Data", 1, 0, ["County", "District", "School Site", "Site Code", "Grade", *V2]),
        ("wave", "Data", 1, 1, ["CREEK", "D1", "School 1", "101", "PK", *vals]),
        # companion: preferred sheet by name, header below a title row
        ("site", "Other", 0, 0, ["County", "School Name", "School Code"]),
        ("site", "ALL sites", 1, 0, ["Site list"]),
        ("site", "ALL sites", 1, 1, ["County", "School Site", "School Code"]),
        ("site", "ALL sites", 1, 2, ["CREEK", "School 1", "101"]),
        ("site", "ALL sites", 1, 3, ["ROGERS", "School 1", "101"]),
        # no known signature anywhere
        ("odd", "Sheet1", 0, 0, ["Year", "Students"]),
        ("odd", "Sheet1", 0, 1, ["2024", "5"]),
    ]
    records = spark.createDataFrame([
        ("totals", "click_here", "2023-2024"), ("ethgen", "school_ethgen_li", "2023-2024"),
        ("wave", "school_ethgen_li", "2022-2023"), ("site", "school_site_li", "2023-2024"),
        ("odd", "school_ethgen_li", "2018-2019"),
    ], "workbook string, pattern string, fiscal_year string")
    return _grid(spark, rows), records


def test_sheet_and_header_choice(spark):
    grid, records = fixture_grids(spark)
    chosen = {r["workbook"]: (r["sheet"], r["header_row"]) for r in R.choose_sheets(R.sheet_index(grid), records).collect()}
    assert chosen == {"totals": ("School Totals by Race", 1), "ethgen": ("Sheet1", 0), "wave": ("Data", 0),
                      "site": ("ALL sites", 1)}


def test_reshape_renames_backfills_and_unpivots(spark):
    grid, records = fixture_grids(spark)
    long, findings = E.run_enrollment(grid, records)
    rows = long.collect()
    assert len(rows) == (2 + 2 + 1) * 14          # blank-year row dropped, odd workbook skipped
    assert {r["Year"] for r in rows} == {"2023-2024", "2022-2023"}
    by = {(r["School"], r["Grade"], r["Race"], r["Gender"]): r for r in rows}
    filled = by[("School 1", "5th Grade", "Hispanic or Latino", "Male")]
    assert filled["County"] == "CREEK" and filled["Total"] == 1    # backfilled from the companion, first row wins
    assert by[("School 1", "Pre-Kindergarten", "Two or more races", "Female")]["Total"] == 14
    assert {r["Grade"] for r in rows} == {"Pre-Kindergarten", "Kindergarten", "5th Grade", "12th Grade"}
    assert [(f["kind"], f["detail"]) for f in findings.collect()] == [("no_matching_sheet", "odd (pattern school_ethgen_li)")]
    with pytest.raises(E.EnrollmentFindingsError):
        E.gate_on_findings(findings)


def test_pairing_by_place_and_pattern(spark):
    """The last companion listed counts, whatever its name; "click here" workbooks
    are not filled; a blank without a match becomes NULL; a companion without a
    fitting sheet is a finding and pairs with nothing."""
    vals = [str(i) for i in range(1, 15)]
    head = ["SchoolYear", "County", "District", "School Name", "Site Code", "School Code", "Grade", *R.VALUE_COLUMNS]

    def primary(workbook, sheet):
        return [(workbook, sheet, 0, 0, head),
                (workbook, sheet, 0, 1, ["2024", " ", "D1", "S1", "7", "0", "5", *vals]),
                (workbook, sheet, 0, 2, ["2024", "", "D2", "S2", "8", "0", "5", *vals])]

    def companion(workbook, county):
        return [(workbook, "ALL sites", 0, 0, ["County", "School Site", "School Code"]),
                (workbook, "ALL sites", 0, 1, [county, "S1", "7"])]

    grid = _grid(spark, primary("listed", "A") + primary("clicked", R.TOTALS_SHEET) + companion("z_first", "WRONG")
                 + companion("a_last", "RIGHT") + [("broken", "ALL sites", 0, 0, ["nothing"])])
    records = spark.createDataFrame([
        ("listed", "school_ethgen_li", "2023-2024", 1), ("clicked", "click_here", "2023-2024", 2),
        ("z_first", "school_site_li", "2023-2024", 3), ("a_last", "school_site_li", "2023-2024", 4),
        ("broken", "school_site_li", "2023-2024", 5),
    ], "workbook string, pattern string, fiscal_year string, pos int")
    long, findings = E.run_enrollment(grid, records)
    got = {(r["School"], r["County"]) for r in long.collect()}
    assert got == {("S1", "RIGHT"), ("S2", None), ("S1", " "), ("S2", "")}
    assert [r["detail"] for r in findings.collect()] == ["broken (pattern school_site_li)"]


def test_rename_by_alias_three_conventions(spark):
    df = spark.createDataFrame([
        (["School Year", "County", "Grade Code", "Grade", "Hispanic Male", "White Female, (Non Hispanic)"],),
        (["School Site", "HispanicLatino Female", "Two or More Races(Non-Hispanic) Male", "Notes"],),
        (["Pac Is M", "SCHOOL NAME", "grade"],),
    ], "h array<string>")
    got = [r[0] for r in df.select(R.rename_by_alias(F.col("h"))).collect()]
    assert got == [["SchoolYear", "County", "Grade", None, "His M", "White F"],
                   ["School Name", "His F", "Multi M", None],
                   ["Pac Is M", "School Name", "Grade"]]


def test_grid_path_equals_direct_unpivot(src):
    from tallgrass.plans.enrollment_queries import WIDE_IDS
    long, findings = E.run_enrollment(E.derived_grid(src), E.records_for(E.derived_grid(src)))
    direct = R.melt_wide(src.wide_enrollment, WIDE_IDS)
    assert long.exceptAll(direct).count() == 0 and direct.exceptAll(long).count() == 0
    assert findings.count() == 0


def test_newer_period_check(spark):
    c = spark.createDataFrame([("2022-2023",), ("2023-2024",)], "Year string")
    w = spark.createDataFrame([("2024-2025",)], "Year string")
    assert E.newer_period_check(c, w).first()["status"] == "newer_period_available"
    assert E.newer_period_check(c, c).first()["status"] == "ok"
    none = spark.createDataFrame([(None,)], "Year string")
    assert E.newer_period_check(c, none).first()["status"] == "unknown"


def test_end_year_takes_school_years_only(spark):
    cases = {"2025-2026": 2026, "2026": 2026, "2026.0": 2026, " 2026 ": 2026, "1999-2000": None, "1998": None, "in 2024": None,
             "2024 2025": None, "2024-1999": None, None: None, "": None}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, y string")
    from tallgrass.functions import end_year
    assert [r[1] for r in sorted(df.select("i", end_year("y")).collect())] == list(cases.values())


def _wide_rows(workbook, head, *rows, sheet=R.TOTALS_SHEET, sheet_no=0):
    return [(workbook, sheet, sheet_no, i, r) for i, r in enumerate([head, *rows])]


HEAD = ["SchoolYear", "County", "District", "School Name", "School Code", "Grade", *R.VALUE_COLUMNS]


def _row(*first, year="2024"):
    return [year, "C", "D", "S", "1", "5", *first, *["2"] * (14 - len(first))]


def _records(spark, *rows):
    return spark.createDataFrame([(w, p, "2023-2024") for w, p in rows], "workbook string, pattern string, fiscal_year string")


def test_what_goes_wrong_with_a_workbook_is_a_finding(spark):
    grid = _grid(spark, _wide_rows("good", HEAD, _row("1", "", "7.0")) + _wide_rows("twice", [*HEAD, "School Site"], [*_row(), "T"])
                 + _wide_rows("moved", ["Hisp" if c == "His M" else c for c in HEAD], _row("1"))
                 + _wide_rows("stars", HEAD, _row("***", "1,234", "nan"), _row("5", "n/a")))
    primary = ("good", "twice", "moved", "stars", "lost", "bad", "absent")
    files = spark.createDataFrame([("lost", "unreachable", None), ("bad", "unreadable", "no zip file"), ("good", "ok", None)],
                                  E.FILES_SCHEMA)
    accepted = spark.createDataFrame([("moved", R.TOTALS_SHEET, 0)], "workbook string, sheet string, header_row int")
    out = E.reshape_workbooks(grid, _records(spark, *[(w, "school_ethgen_li") for w in primary]), files, accepted)
    assert sorted((r["kind"], r["detail"]) for r in out.findings.collect()) == [
        ("missing_race_gender_columns", "moved: His M"), ("source_file_unreachable", "lost: no answer"),
        ("unparseable_counts", "stars: 3 such as ***"), ("workbook_reshape_skipped", "twice: twice School Name"),
        ("workbook_unreadable", "absent: no sheet"), ("workbook_unreadable", "bad: no zip file")]
    status = {r["workbook"]: (r["status"], r["rows"], r["unparsed"]) for r in out.statuses.collect()}
    assert status == {"good": ("reshaped", 14, 0), "twice": ("skipped", 0, 0), "moved": ("reshaped", 13, 0),
                      "stars": ("reshaped", 28, 3), "lost": ("unreachable", 0, 0), "bad": ("unreadable", 0, 0),
                      "absent": ("unreadable", 0, 0)}
    # blank counts stay, counts that are no numbers are NULL, and every other row is there
    assert out.long.count() == 14 + 13 + 28 and out.long.filter("Total is null").count() == 1 + 4


def test_click_here_takes_the_named_sheet(spark):
    grid = _grid(spark, _wide_rows("w", HEAD, _row("9"), sheet="Cover")
                 + _wide_rows("w", HEAD, _row("1"), sheet="school totals, BY race", sheet_no=1))
    out = E.reshape_workbooks(grid, _records(spark, ("w", "click_here")))
    assert out.statuses.first()["sheet"] == "school totals, BY race"
    assert out.long.filter("Race = 'Hispanic or Latino' and Gender = 'Male'").first()["Total"] == 1


@pytest.mark.parametrize("fault, error", [("nothing listed", "NoSourceFilesError"), ("all bad", "AllWorkbooksFailedError"),
                                          ("finding", "EnrollmentFindingsError"), ("newer", "NewerPeriodError"),
                                          ("grid unreadable", "AnalysisException"), ("check", "QualityCheckError")])
def test_any_failure_leaves_one_ended_run(spark, scratch, fault, error):
    from tallgrass.operators.dataops import QualityConfig, read_run_log
    from tallgrass.sources.sinks import Warehouse
    wh = Warehouse(spark, scratch)
    grid = _grid(spark, _wide_rows("w", HEAD, _row("***" if fault == "finding" else "1")))
    records = _records(spark, ("w", "school_ethgen_li"))
    kw = {}
    if fault == "nothing listed":
        records = records.limit(0)
    if fault == "all bad":
        records = _records(spark, ("x", "school_ethgen_li"))
    if fault == "newer":
        kw["watched"] = spark.createDataFrame([("2030-2031",)], "Year string")
    if fault == "grid unreadable":
        grid = grid.drop("cells")
    if fault == "check":
        kw["quality"] = QualityConfig(known_row_counts={"enrollment_primary": 1})
    with pytest.raises(Exception) as e:
        E.run_enrollment_pipeline(wh, grid, records, **kw)
    assert type(e.value).__name__ == error
    runs = wh.manifest().collect()
    assert [(r["status"], r["group_name"]) for r in runs] == [("failed", "monthly")] and runs[0]["error"].startswith(error)
    assert sorted(r["status"] for r in read_run_log(spark, wh.manifest_path).collect()) == ["failed", "running"]


def test_from_pages_to_the_table(spark, scratch):
    from tallgrass.sources.inventory import Inventory
    from tallgrass.sources.sinks import Warehouse
    html = PROBE_GRID = f'{GRID}{BOX}<a href="w.xlsx">Click here</a></div></div>'
    pages = _as_pages(spark, [html])
    grid = _grid(spark, _wide_rows("w.xlsx", HEAD, _row("1")))
    wh, inventory = Warehouse(spark, f"{scratch}/wh"), Inventory(spark, f"{scratch}/files")
    arrived = spark.createDataFrame([("w.xlsx", b"1"), ("other.xlsx", b"2")], "file_name string, content binary")
    first = E.run_from_pages(wh, pages, grid, inventory=inventory, arrived=arrived)
    assert (first["status"], first["row_count"]) == ("success", 14)
    assert [r["file_name"] for r in inventory.held().collect()] == ["w.xlsx"]      # only what is listed is kept
    again = E.run_from_pages(wh, pages, grid, inventory=inventory, arrived=arrived)
    assert (again["status"], again["row_count"]) == ("success_no_change", 14)
    assert spark.read.parquet(f"{scratch}/wh/raw/pages").count() == 2              # a snapshot per run, whole
    assert spark.read.parquet(f"{scratch}/wh/raw/pages").first()["html"] == PROBE_GRID
    assert spark.read.parquet(f"{scratch}/wh/raw/workbooks").count() == 2          # each workbook once
    # the records carry the group, so the freshness gate sees the run
    from tallgrass.operators import dataops
    limits = dataops.thresholds_frame(spark, [("enrollment", "monthly", 0)])
    import datetime as dt
    late = dt.datetime.now() + dt.timedelta(days=3)
    assert [r["dataset"] for r in dataops.stale_datasets(wh.manifest(), limits, late).collect()] == ["enrollment_primary"]


def test_incremental_skip(spark):
    found = spark.createDataFrame([("a.xlsx",), ("b.xlsx",)], "file_name string")
    new, skip = E.incremental_skip(found, None)
    assert new.count() == 2 and not skip
    new, skip = E.incremental_skip(found, found)
    assert new.count() == 0 and skip


def test_pipeline_order_gate_publish_and_no_change(spark, scratch):
    from tallgrass.sources.sinks import Warehouse
    grid, records = fixture_grids(spark)
    wh = Warehouse(spark, scratch)
    with pytest.raises(E.EnrollmentFindingsError):      # the odd workbook fails the run first
        E.run_enrollment_pipeline(wh, grid, records)
    assert [r["status"] for r in wh.manifest().collect()] == ["failed"]
    good = records.filter("workbook <> 'odd'")
    newer = spark.createDataFrame([("2030-2031",)], "Year string")
    with pytest.raises(E.NewerPeriodError):
        E.run_enrollment_pipeline(wh, grid, good, watched=newer)
    out = E.run_enrollment_pipeline(wh, grid, good, watched=spark.createDataFrame([("2023-2024",)], "Year string"))
    assert out["status"] == "success" and out["row_count"] == 70
    held = good.select(F.col("workbook").alias("file_name"))
    again = E.run_enrollment_pipeline(wh, grid, good, held=held)
    assert again == {"status": "success_no_change", "row_count": 70, "warning": None}
    assert sorted(r["status"] for r in wh.manifest().collect()) == ["failed", "failed", "success", "success_no_change"]
