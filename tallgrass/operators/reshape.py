"""Wide-sheet reshaping: link discovery on pages, sheet and header
detection on cell grids, alias renaming, blank backfill and unpivot.

Inputs are DataFrames, never files opened on the driver:

* pages  ``(page_id, url, html)``
* grids  ``(workbook, sheet, sheet_no, row_no, cells array<string>)`` - one
  row per spreadsheet row (decoding xlsx bytes into grids is outside the
  library; see README).

Per-page and per-row work is column expressions and higher-order array
functions; windows are partitioned by page (bounded by one document) and
the only joins are with small per-workbook header tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tallgrass.functions import (
    clean_year,
    format_grade,
    is_blank,
    normalize,
    parse_fiscal_year,
    split_race_gender,
)
from tallgrass.functions.markup import decoded, file_name, fold_out, let, link_parts, resolve
from tallgrass.operators.relational import broadcast_if_bounded

# ---------------------------------------------------------------------------
# Page structure and link texts of the enrollment page.
# ---------------------------------------------------------------------------
WRAPPER_CLASSES = ("aem-Grid", "aem-Grid--12", "aem-Grid--default--12")
CONTAINER_CLASS = "aem-GridColumn--default--12"
CLICK_HERE_TEXT = "click here"
PRIMARY_LINK_TEXT = "School Site Totals w/Ethnicity and Gender"
COMPANION_LINK_TEXT = "School Site Totals"
TOTALS_SHEET = "School Totals by Race"
SITE_SHEET_PREFERENCE = ["GG_BySITE", "ALL sites", "School Totals"]
HEADER_SCAN_ROWS = 8

# ---------------------------------------------------------------------------
# Enrollment sheet vocabulary (three naming conventions).
# ---------------------------------------------------------------------------
ID_COLUMNS = ["SchoolYear", "County", "District", "School Name", "Grade"]
VALUE_COLUMNS = [
    "His M", "His F",
    "AmInd M", "AmInd F",
    "Asian M", "Asian F",
    "Black M", "Black F",
    "Pac Is M", "Pac Is F",
    "White M", "White F",
    "Multi M", "Multi F",
]
#: (spelling in a header, column it names, header convention; 0: in any)
SPELLINGS = [
    ("Hispanic Male", "His M", 1),
    ("Hispanic Female", "His F", 1),
    ("American Indian Male (Non Hispanic)", "AmInd M", 1),
    ("American Indian Female (Non Hispanic)", "AmInd F", 1),
    ("Asian Male (Non Hispanic)", "Asian M", 1),
    ("Asian Female (Non Hispanic)", "Asian F", 1),
    ("Black Male (Non Hispanic)", "Black M", 1),
    ("Black Female (Non Hispanic)", "Black F", 1),
    ("Hawaiian or Pacific Islander Male (Non Hispanic)", "Pac Is M", 1),
    ("Hawaiian or Pacific Islander Female (Non Hispanic)", "Pac Is F", 1),
    ("White Male (Non Hispanic)", "White M", 1),
    ("White Female, (Non Hispanic)", "White F", 1),
    ("Two or More Races Male (Non Hispanic)", "Multi M", 1),
    ("Two or More Races Female (Non Hispanic)", "Multi F", 1),
    ("HispanicLatino Male", "His M", 2),
    ("HispanicLatino Female", "His F", 2),
    ("American Indian(Non-Hispanic) Male", "AmInd M", 2),
    ("American Indian(Non-Hispanic) Female", "AmInd F", 2),
    ("Asian(Non-Hispanic) Male", "Asian M", 2),
    ("Asian(Non-Hispanic) Female", "Asian F", 2),
    ("Black(Non-Hispanic) Male", "Black M", 2),
    ("Black(Non-Hispanic) Female", "Black F", 2),
    ("Hawaiian or Pacific Islander(Non-Hispanic) Male", "Pac Is M", 2),
    ("Hawaiian or Pacific Islander(Non-Hispanic) Female", "Pac Is F", 2),
    ("White(Non-Hispanic) Male", "White M", 2),
    ("White(Non-Hispanic) Female", "White F", 2),
    ("Two or More Races(Non-Hispanic) Male", "Multi M", 2),
    ("Two or More Races(Non-Hispanic) Female", "Multi F", 2),
    ("Grade Code", "Grade", 0),
    ("School Site", "School Name", 0),
    *[(name, name, 0) for name in ID_COLUMNS],
    *[(name, name, 3) for name in VALUE_COLUMNS],
]
SCHOOL_CODE_NAMES = ("schoolcode", "sitecode")


def py_normalize(text: str) -> str:
    """Driver-side twin of ``functions.normalize`` for building lookups."""
    return "".join(ch for ch in str(text).lower() if ch.isascii() and ch.isalnum())


#: Normalised spelling -> column.
ALIASES = {py_normalize(spelling): name for spelling, name, _ in SPELLINGS}
#: The normalised value headers of each convention.
SIGNATURES = [sorted(py_normalize(spelling) for spelling, _, kind in SPELLINGS if kind == convention)
              for convention in (3, 1, 2)]


def convention_headers(convention: int) -> list[str]:
    """The value headers of a convention, as spelled."""
    return [spelling for spelling, _, kind in SPELLINGS if kind == convention]


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _map_lit(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _norm_cells(c: Column) -> Column:
    return F.transform(c, lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", ""))


# ---------------------------------------------------------------------------
# pages -> tags -> links, all inside the page's own row
# ---------------------------------------------------------------------------
#: Comments, scripts and styles hold no markup (an unclosed one runs to the end).
_UNREAD = (r"(?is)<!--(?:.*?-->|.*\z)|<script\b(?:.*?</script\s*>|.*\z)|<style\b(?:.*?</style\s*>|.*\z)")
_TAG = r"^<(/?)([A-Za-z][A-Za-z0-9]*)([^>]*)>"
_HREF = r"""(?i)(?:^|\s)href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CLASS = r"""class\s*=\s*["']([^"']*)["']"""
_EDGE = "^[ \t\r\n\f\u00a0]+|[ \t\r\n\f\u00a0]+$"
_STRUCTURE = ("div", "a", "h2", "li", "ul", "ol")
_OPEN = "struct<pos:int,depth:int>"
_ANCHOR = "struct<pos:int,stop:int,href:string,in_li:boolean,any_box:int,wrapped_box:int,heading:string>"
_STATE = (f"struct<depth:int,items:int,lists:array<int>,wrapper:int,title:int,any_box:{_OPEN},wrapped_box:{_OPEN},"
          f"has_wrapper:boolean,a:{_ANCHOR},h2:int,heading:string>")


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE, "")


def _tokens(html: Column) -> Column:
    """The page split before every ``<``: one tag (a div with its attributes, an anchor with
    its link) and the text up to the next, character references replaced."""
    pieces = F.split(F.regexp_replace(F.coalesce(html, F.lit("")), _UNREAD, ""), "(?=<)")

    def token(p: Column, i: Column) -> Column:
        def of(t: Column) -> Column:
            attrs = F.regexp_extract(p, _TAG, 3)
            quoted = F.regexp_replace(F.regexp_extract(attrs, _HREF, 1), "^[\"']|[\"']$", "")
            link = F.when((t["tag"] == "a") & ~t["closing"], F.when(attrs.rlike(_HREF), quoted))
            # the text and the link, each once through the references
            plain = F.transform(F.array(F.substring(p, t["cut"] + 1, F.char_length(p)), link),
                                lambda x, at: decoded(x, at == 1))
            return let(plain, lambda x: F.struct(
                i.alias("pos"), t["tag"].alias("tag"), t["closing"].alias("closing"),
                F.when((t["tag"] == "div") & ~t["closing"], attrs).alias("attrs"), x[0].alias("text"),
                F.when(x[1].isNotNull(), _stripped(x[1])).alias("href")))
        cut = F.when(p.startswith("<"), F.locate(">", p)).otherwise(0)
        return let(F.struct(cut.alias("cut"), p.startswith("</").alias("closing"), F.when(
            cut > 0, F.lower(F.regexp_extract(p, "^</?([A-Za-z][A-Za-z0-9]*)", 1))).otherwise("").alias("tag")), of)

    return F.transform(pieces, token)


def _structure(tokens: Column) -> Column:
    """The tags that shape a page, with what their classes make them."""
    def described(t: Column) -> Column:
        box = (t["tag"] == "div") & ~t["closing"]
        named = F.when(box, F.split(F.trim(F.regexp_extract(t["attrs"], _CLASS, 1)), r"\s+"))

        def of(classes: Column) -> Column:
            def has(*names: str) -> Column:
                return F.coalesce(reduce(lambda a, b: a & b, [F.array_contains(classes, F.lit(n)) for n in names]), F.lit(False))
            return F.struct(
                t["pos"].alias("pos"), t["tag"].alias("tag"), (~t["closing"]).alias("opens"),
                F.when(box, 1).when(t["tag"] == "div", -1).otherwise(0).alias("down"), t["href"].alias("href"),
                has(*WRAPPER_CLASSES).alias("wrapper"), has("text", CONTAINER_CLASS).alias("box"),
                has("title", CONTAINER_CLASS).alias("title"))
        return let(named, of)
    return F.transform(F.filter(tokens, lambda t: t["tag"].isin(*_STRUCTURE)), described)


def _step(s: Column, t: Column, text) -> tuple[Column, Column]:
    """One tag of the fold: the next state, and the anchor that ends here.

    The state has a fixed size but for the open lists.  A container is open while the div
    depth has not fallen below the depth at its opening; only the outermost open one counts,
    as it holds whatever an inner one holds.  ``items`` counts the open list items; the end
    of a list ends the items opened in it.  ``heading`` is the last FY heading that ended."""
    tag, opens = t["tag"], t["opens"]
    div = tag == "div"
    depth = s["depth"] + t["down"]
    here = F.struct(t["pos"].alias("pos"), depth.alias("depth"))

    def outermost(old: Column, old_depth: Column, opened: Column, new: Column) -> Column:
        return F.when(~div, old).when(old.isNotNull() & (depth >= old_depth), old).when(old.isNull() & opened, new)

    is_list = tag.isin("ul", "ol")
    base = F.when(F.size(s["lists"]) > 0, F.element_at(s["lists"], -1)).otherwise(F.lit(0))
    items = (F.when((tag == "li") & opens, s["items"] + 1).when(tag == "li", F.greatest(s["items"] - 1, base))
              .when(is_list & ~opens, base).otherwise(s["items"]))
    lists = (F.when(~is_list, s["lists"]).when(opens, F.concat(s["lists"], F.array(s["items"])))
              .when(F.size(s["lists"]) > 0, F.slice(s["lists"], F.lit(1), F.size(s["lists"]) - 1))
              .otherwise(s["lists"]))
    anchor = F.struct(t["pos"].alias("pos"), F.lit(None).cast("int").alias("stop"), t["href"].alias("href"),
                      (s["items"] > 0).alias("in_li"), s["any_box"]["pos"].alias("any_box"),
                      s["wrapped_box"]["pos"].alias("wrapped_box"), s["heading"].alias("heading"))
    ended = let(text(s["h2"], t["pos"]), lambda x: F.when(F.upper(x).startswith("FY"), x).otherwise(s["heading"]))
    after = F.struct(
        depth.alias("depth"), items.alias("items"), lists.alias("lists"),
        outermost(s["wrapper"], s["wrapper"], t["wrapper"], depth).alias("wrapper"),
        outermost(s["title"], s["title"], t["title"], depth).alias("title"),
        outermost(s["any_box"], s["any_box"]["depth"], t["box"], here).alias("any_box"),
        outermost(s["wrapped_box"], s["wrapped_box"]["depth"], t["box"] & s["wrapper"].isNotNull(), here)
        .alias("wrapped_box"),
        (s["has_wrapper"] | t["wrapper"]).alias("has_wrapper"),
        F.when(tag != "a", s["a"]).when(opens, anchor).alias("a"),
        F.when(tag != "h2", s["h2"]).when(opens & s["title"].isNotNull(), t["pos"]).alias("h2"),
        F.when((tag == "h2") & s["h2"].isNotNull(), ended).otherwise(s["heading"]).alias("heading"))
    return after, F.when((tag == "a") & s["a"].isNotNull(), s["a"].withField("stop", t["pos"]))


def _page_row(html: Column, url: Column) -> Column:
    """struct(has_wrapper, anchors) of one page."""
    start = F.from_json(F.lit('{"depth":0,"items":0,"lists":[],"has_wrapper":false}'), _STATE)

    def of(tokens: Column) -> Column:
        def text(first: Column, stop: Column) -> Column:
            inner = F.slice(tokens, first + 1, stop - first)
            return _stripped(F.array_join(F.transform(inner, lambda t: t["text"]), ""))

        def read(f: Column, base: Column) -> Column:
            s = f["s"]
            open_ = F.when(s["a"].isNotNull(), F.array(s["a"].withField("stop", F.size(tokens)))) \
                .otherwise(F.array().cast(f"array<{_ANCHOR}>"))
            anchors = F.transform(F.filter(F.concat(f["out"], open_), lambda a: a["href"].isNotNull()), lambda a: F.struct(
                a["pos"].alias("pos"), a["href"].alias("href"), resolve(url, base, a["href"]).alias("link"),
                text(a["pos"], a["stop"]).alias("text"), a["in_li"].alias("in_li"),
                F.when(s["has_wrapper"], a["wrapped_box"]).otherwise(a["any_box"]).alias("container"),
                a["heading"].alias("heading")))
            return F.struct(s["has_wrapper"].alias("has_wrapper"), anchors.alias("anchors"))

        folded = let(_structure(tokens), lambda tags: fold_out(tags, start, _ANCHOR, lambda s, t: _step(s, t, text)))
        return let(folded, lambda f: let(link_parts(url), lambda base: read(f, base)))
    return let(_tokens(html), of)


#: The expression of a page's row, by Spark context.
_PAGE_ROWS: dict[SparkContext, Column] = {}


def page_markup(pages: DataFrame) -> DataFrame:
    """``(page_id, has_wrapper, anchors)``: one row per page, read inside its row.

    Comments, scripts and styles are dropped, the rest is split into tags, and
    one fold over the page's structural tags follows containers, lists, anchors
    and headings; no page is shuffled, sorted or joined.  A null or empty page
    has no wrapper and no anchors.  Unclosed elements run to the page's end (an
    anchor or heading to the next of its kind); stray closing tags end nothing
    that was opened after them.
    """
    context = SparkContext._active_spark_context
    if context not in _PAGE_ROWS:   # some thousand calls into the JVM, made once
        _PAGE_ROWS[context] = _page_row(F.col("html"), F.col("url"))
    return pages.select("page_id", _PAGE_ROWS[context].alias("m")) \
        .select("page_id", "m.has_wrapper", "m.anchors")


def page_anchors(pages: DataFrame) -> DataFrame:
    """Every ``<a href>``: page_id, pos (place among the page's tags), href,
    link (resolved), text (all text inside, stripped), in_li, container (place
    of the outermost text container that counts, NULL outside one), heading
    (the last FY heading that ended before it inside a title container)."""
    return page_markup(pages).select("page_id", F.inline("anchors"))


def classify_anchor(text: Column, in_li: Column) -> Column:
    """'click_here', 'school_ethgen_li', 'school_site_li' or NULL.

    Exact normalised equality, so "School Site Totals" does not match the
    longer "School Site Totals w/Ethnicity and Gender".
    """
    n = normalize(text)
    return (F.when(F.lower(F.trim(text)) == CLICK_HERE_TEXT, F.lit("click_here"))
             .when(in_li & (n == py_normalize(PRIMARY_LINK_TEXT)), F.lit("school_ethgen_li"))
             .when(in_li & (n == py_normalize(COMPANION_LINK_TEXT)), F.lit("school_site_li")))


_LINK = "struct<pos:int,link:string,text:string,pattern:string,heading:string,container:int>"


def _page_links(anchors: Column) -> Column:
    """The links that count, in page order: classified anchors inside a text
    container; companions only beside a primary link of their container; a URL
    at its first occurrence.  Both rules look at neighbours in a sorted array."""
    named = F.filter(F.transform(F.filter(anchors, lambda a: a["container"].isNotNull()), lambda a: F.struct(
        a["pos"].alias("pos"), a["link"].alias("link"), a["text"].alias("text"),
        classify_anchor(a["text"], a["in_li"]).alias("pattern"), a["heading"].alias("heading"),
        a["container"].alias("container"))), lambda a: a["pattern"].isNotNull())

    def beside_primary(found: Column) -> Column:
        # a container's primaries come before its other links
        ordered = F.array_sort(F.transform(found, lambda a: F.struct(
            a["container"].alias("container"), (a["pattern"] != "school_ethgen_li").alias("other"), a["pos"].alias("pos"),
            a.alias("a"))))

        def step(s: Column, e: Column) -> tuple[Column, Column]:
            primary = F.when(e["other"], s["primary"]).otherwise(e["container"])
            stays = (e["a"]["pattern"] != "school_site_li") | F.coalesce(s["primary"] == e["container"], F.lit(False))
            return F.struct(primary.alias("primary")), F.when(stays, e["a"])

        return let(ordered, lambda o: fold_out(o, F.struct(F.lit(None).cast("int").alias("primary")), _LINK, step)["out"])

    def first_only(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda a: F.struct(a["link"].alias("link"), a["pos"].alias("pos"), a.alias("a"))))
        return let(ordered, lambda o: F.array_sort(F.transform(
            F.filter(o, lambda e, i: (i == 0) | (F.get(o, i - 1)["link"] != e["link"])), lambda e: e["a"])))

    return let(let(named, beside_primary), first_only)


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, has_wrapper, links)``: the enrollment links of each page."""
    return page_markup(pages).select("page_id", "has_wrapper", _page_links(F.col("anchors")).alias("links"))


def discover_links(pages: DataFrame) -> DataFrame:
    """Enrollment source links per page.

    Only anchors inside text containers count, and only containers inside a
    grid wrapper when the page has one.
    """
    a = page_links(pages).select("page_id", F.inline("links"))
    return a.select("page_id", "pos", "link", "text", "pattern", "heading",
                    parse_fiscal_year(F.col("heading")).alias("fiscal_year"), file_name(F.col("link")).alias("file_name"))


def link_warnings(pages: DataFrame) -> DataFrame:
    """Pages without the grid wrapper (searched whole) and pages where no
    link was found at all (J1 warning, J21 error), from one pass."""
    kinds = F.array_compact(F.array(F.when(~F.col("has_wrapper"), F.lit("grid_wrapper_not_found")),
                                    F.when(F.size("links") == 0, F.lit("no_enrollment_links"))))
    return page_links(pages).select("page_id", F.explode(kinds).alias("kind"))


def pair_companion(links: DataFrame) -> DataFrame:
    """Attach to each primary link the companion of the same fiscal year;
    the last companion on the page wins; no year never pairs (C16, T16)."""
    comp = links.filter(F.col("pattern") == "school_site_li").filter(F.col("fiscal_year").isNotNull())
    comp = (comp.groupBy("page_id", "fiscal_year")
                .agg(F.max_by(F.struct(F.col("link").alias("companion_link"),
                                       F.col("file_name").alias("companion_file")), F.col("pos")).alias("c"))
                .select("page_id", "fiscal_year", "c.*"))
    prim = links.filter(F.col("pattern") != "school_site_li")
    paired = prim.join(comp, on=["page_id", "fiscal_year"], how="left")
    for c in ("companion_link", "companion_file"):   # "click here" workbooks carry their own locations
        paired = paired.withColumn(c, F.when(F.col("pattern") == "school_ethgen_li", F.col(c)))
    return paired


# ---------------------------------------------------------------------------
# grids: sheet choice, header row, names
# ---------------------------------------------------------------------------
def sheets(grid: DataFrame) -> DataFrame:
    return grid.select("workbook", "sheet", "sheet_no").distinct()


def _signature_match(ncells: Column) -> Column:
    return F.exists(F.array(*[_lit_array(sig) for sig in SIGNATURES]),
                    lambda sig: F.size(F.array_except(sig, ncells)) == 0)


def _companion_match(ncells: Column) -> Column:
    has_loc = F.array_contains(ncells, "county") & (F.array_contains(ncells, "schoolname")
                                                    | F.array_contains(ncells, "schoolsite"))
    return has_loc & F.arrays_overlap(ncells, _lit_array(SCHOOL_CODE_NAMES))


def sheet_index(grid: DataFrame) -> DataFrame:
    """Per sheet: its order, and the first of rows 0-7 matching the
    value-column signature and the companion shape, with their cells
    (J6, J8).  Only the scanned rows are normalised; the sheet list itself
    is a plain distinct."""
    sheets_ = grid.select("workbook", "sheet", "sheet_no").distinct()
    top = grid.filter(F.col("row_no") < HEADER_SCAN_ROWS).withColumn("__n", _norm_cells(F.col("cells")))
    hdr = F.struct(F.col("row_no").alias("row"), F.col("cells").alias("cells"))
    cand = top.groupBy("workbook", "sheet", "sheet_no").agg(
        F.min(F.when(_signature_match(F.col("__n")), hdr)).alias("sig"),
        F.min(F.when(_companion_match(F.col("__n")), hdr)).alias("comp"))
    return sheets_.join(cand, on=["workbook", "sheet", "sheet_no"], how="left")


def choose_sheets(index: DataFrame, records: DataFrame) -> DataFrame:
    """Sheet and header row per recorded workbook, by its link pattern.

    'click_here': the sheet named like the totals sheet (J4), signature
    header; 'school_ethgen_li': first sheet with a signature header (J7);
    'school_site_li': preferred sheet name, else the first sheet (J5),
    companion header (J8).  ``header_row`` is NULL when nothing matched.
    """
    j = index.join(broadcast_if_bounded(records.select("workbook", "pattern")), "workbook")
    name = normalize(F.col("sheet"))
    pref = F.lit(len(SITE_SHEET_PREFERENCE))
    for i, want in reversed(list(enumerate(SITE_SHEET_PREFERENCE))):
        pref = F.when(name.contains(py_normalize(want)), F.lit(i)).otherwise(pref)
    pattern = F.col("pattern")
    rank = (F.when(pattern == "click_here", F.when(name == py_normalize(TOTALS_SHEET), F.lit(0)))
             .when(pattern == "school_site_li", pref)
             .otherwise(F.when(F.col("sig").isNotNull(), F.lit(0))))
    header = F.when(pattern == "school_site_li", F.col("comp")).otherwise(F.col("sig"))
    pick = F.struct(F.col("sheet"), header.alias("h"))
    chosen = (j.filter(rank.isNotNull())
               .groupBy("workbook", "pattern").agg(F.min_by(pick, F.struct(rank, F.col("sheet_no"))).alias("p")))
    return chosen.select("workbook", "pattern", F.col("p.sheet").alias("sheet"),
                         F.col("p.h.row").alias("header_row"), F.col("p.h.cells").alias("header_cells"))


def rename_by_alias(header_cells: Column) -> Column:
    """Canonical names for a header row (J9), keeping the code column over
    the prose one when a sheet has both "Grade Code" and "Grade" (J10);
    unknown headers map to NULL."""
    lookup = _map_lit(ALIASES)
    has_code = F.exists(header_cells, lambda x: F.trim(x) == "Grade Code")
    return F.transform(header_cells, lambda x: F.when(has_code & (F.trim(x) == "Grade"), F.lit(None))
                       .otherwise(F.try_element_at(lookup, F.regexp_replace(F.lower(x), "[^a-z0-9]", ""))))


def _code_index(header_cells: Column) -> Column:
    """1-based position of the first school/site code column, or NULL."""
    is_code = F.transform(_norm_cells(header_cells), lambda x: x.isin(*SCHOOL_CODE_NAMES))
    return F.nullif(F.array_position(is_code, F.lit(True)), F.lit(0)).cast("int")


def header_layout(hdr: DataFrame) -> DataFrame:
    """Per header row: canonical names, the position of each id column and
    of the school code, and (position, race, gender) of every value column.

    All name handling happens here, once per workbook; data rows then only
    index into their cells.
    """
    names = rename_by_alias(F.col("header_cells"))
    h = hdr.withColumn("names", names)
    cols = [F.col("names")]
    for c in ID_COLUMNS:
        p = F.array_position(F.col("names"), F.lit(c))
        cols.append(F.when(p > 0, p).cast("int").alias(f"__pos_{c}"))
    idx = F.sequence(F.lit(1), F.size("names"))
    with_name = F.transform(idx, lambda i: F.struct(i.alias("i"), F.try_element_at(F.col("names"), i).alias("name")))
    values = F.filter(with_name, lambda x: F.array_contains(_lit_array(VALUE_COLUMNS), x["name"]))
    race, gender = split_race_gender(F.col("__v.name"))
    h = h.select("*", *cols[1:], _code_index(F.col("header_cells")).alias("__pos_code"), values.alias("__vals"))
    # labels per value column, computed on the header table
    labelled = (h.select("workbook", "sheet", F.explode_outer("__vals").alias("__v"))
                 .select("workbook", "sheet", F.struct(F.col("__v.i").alias("i"), F.col("__v.name").alias("name"),
                                                      race.alias("race"), gender.alias("gender")).alias("v"))
                 .groupBy("workbook", "sheet").agg(F.collect_list(F.when(F.col("v.i").isNotNull(), F.col("v")))
                                                   .alias("value_layout")))
    return h.drop("__vals").join(labelled, on=["workbook", "sheet"], how="left")


def row_records(grid: DataFrame, hdr: DataFrame) -> DataFrame:
    """Data rows (below the header) with id fields, school code and the
    value cells (with race/gender labels from the header layout)."""
    h = header_layout(hdr)
    rows = grid.join(broadcast_if_bounded(h), on=["workbook", "sheet"]).filter(F.col("row_no") > F.col("header_row"))

    def cell(pos_col: str) -> Column:
        return F.when(F.col(pos_col).isNotNull(), F.try_element_at(F.col("cells"), F.col(pos_col)))

    # value cells stay in the row (with the header's layout); melt_records
    # explodes the layout and indexes the cells, all in generated code
    return rows.select(
        "workbook", "sheet", "row_no", "names",
        *[cell(f"__pos_{c}").alias(c) for c in ID_COLUMNS],
        F.trim(cell("__pos_code")).alias("school_code"),
        "value_layout", "cells",
    )


def backfill_blank(recs: DataFrame, lookup: DataFrame, pairing: DataFrame) -> DataFrame:
    """Fill blank County / District / School Name from the paired companion
    by school code; only blank cells change, a blank without a match becomes
    NULL, and a NULL code never matches (J11, C15; deviation T15)."""
    r = recs.join(broadcast_if_bounded(pairing), on="workbook", how="left")
    lk = lookup.withColumnRenamed("companion", "__lc").withColumnRenamed("school_code", "__lcode")
    r = r.join(broadcast_if_bounded(lk), on=(F.col("companion") == F.col("__lc")) & (F.col("school_code") == F.col("__lcode")),
               how="left").drop("__lc", "__lcode")
    for col, fill in (("County", "c_county"), ("District", "c_district"), ("School Name", "c_school")):
        r = r.withColumn(col, F.when(is_blank(F.col(col)) & F.col("companion").isNotNull()
                                  & F.col("school_code").isNotNull(), F.col(fill)).otherwise(F.col(col)))
    return r.drop("c_county", "c_district", "c_school", "companion")


def melt_records(recs: DataFrame, fiscal_year: Column | None = None) -> DataFrame:
    """Unpivot value cells into (Race, Gender, Total) rows and clean the
    labels (J12-J14, B20, H21-H23).  Blank counts are kept as NULL; the text of
    a count that is no number is in ``Unparsed``."""
    year = F.col("SchoolYear")
    if fiscal_year is not None:
        year = F.when(F.array_contains(F.col("names"), "SchoolYear"), year).otherwise(fiscal_year)
    long = recs.select("*", clean_year(year).alias("__year"), format_grade(F.col("Grade")).alias("__grade"),
                       F.explode("value_layout").alias("__v"))
    cell = F.trim(F.try_element_at(F.col("cells"), F.col("__v.i")))
    total = cell.try_cast("double").try_cast("bigint")
    out = long.select(
        "workbook", F.col("__year").alias("Year"), "County", "District", F.col("School Name").alias("School"),
        F.col("__v.race").alias("Race"), F.col("__v.gender").alias("Gender"), F.col("__grade").alias("Grade"),
        total.alias("Total"), F.when(total.isNull() & ~is_blank(cell), cell).alias("Unparsed"))
    return out.filter(~is_blank(F.col("Year")))


def melt_wide(df: DataFrame, id_map: dict[str, str], value_columns=VALUE_COLUMNS) -> DataFrame:
    """Unpivot an already-typed wide table (one column per race/gender).

    ``id_map`` maps input columns to SchoolYear / County / District /
    School Name / Grade.  Value columns absent from ``df`` are skipped
    (a finding in the grid path).
    """
    present = [c for c in value_columns if c in df.columns]
    ids = {dst: F.col(src).cast("string") for src, dst in id_map.items()}

    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

    def cell(name: str) -> Column:
        race, gender = split_race_gender(F.lit(name))  # literals: folded by the optimizer
        v = F.col(f"`{name}`")
        total = v.cast("bigint") if isinstance(df.schema[name].dataType, integral) \
            else v.cast("string").try_cast("bigint")   # text cells: unparseable -> NULL
        return F.struct(race.alias("race"), gender.alias("gender"), total.alias("total"))

    # labels cleaned once per wide row, before the 14-way explode
    rows = df.select(clean_year(ids["SchoolYear"]).alias("Year"), ids["County"].alias("County"),
                     ids["District"].alias("District"), ids["School Name"].alias("School"),
                     format_grade(ids["Grade"]).alias("Grade"), F.array(*[cell(c) for c in present]).alias("__cells"))
    stacked = rows.filter(~is_blank(F.col("Year"))).select("*", F.explode("__cells").alias("__v"))
    return stacked.select("Year", "County", "District", "School", F.col("__v.race").alias("Race"),
                          F.col("__v.gender").alias("Gender"), "Grade", F.col("__v.total").alias("Total"))
