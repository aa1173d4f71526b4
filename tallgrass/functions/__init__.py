"""Column expressions (all JVM-side built-ins; no Python UDFs).

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def area_code(c) -> Column:
    """Five-character county code: ``LPAD(x, 5, '0')`` (cuts longer input)."""
    return F.lpad(_col(c).cast("string"), 5, "0")


def in_state(c, dtype: T.DataType | None = None, state: str = "40") -> Column:
    """``LEFT(LPAD(x, 5, '0'), 2) = state`` in a form Parquet can prune on.

    Padding only ever adds leading zeros, so for a non-zero state prefix the
    test is exactly "at least five characters and starts with the prefix".
    For strings that is ``startswith`` (a pushed-down StringStartsWith);
    for integers the test is exactly a union of ranges, one for each number of
    digits the type can hold (40000-40999, 400000-409999, ...); every range is
    pushed down, so row groups beyond the state's codes are skipped on both sides.
    """
    x = _col(c)
    exact = F.left(area_code(x), F.lit(2)) == F.lit(state)
    if state.startswith("0") or len(state) != 2:
        return exact
    if isinstance(dtype, T.StringType):
        return x.startswith(state) & (F.length(x) >= 5)
    if isinstance(dtype, _INTEGRAL):
        most = {T.ShortType: 2**15, T.IntegerType: 2**31}.get(type(dtype), 2**63) - 1
        first, test, width = int(state), F.lit(False), 1000
        while first * width <= most:
            test = test | x.between(first * width, min((first + 1) * width - 1, most))
            width *= 10
        return test
    return exact


def filter_state(df: DataFrame, col: str, state: str = "40") -> DataFrame:
    """Keep rows whose area code lies in ``state``."""
    return df.filter(in_state(col, df.schema[col].dataType, state))


def div0(a, b) -> Column:
    """``DIV0(a, b)``: 0 when b = 0, NULL when b is NULL, else a / b."""
    a, b = _col(a), _col(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def safe_ratio(a, b) -> Column:
    """a / b as double; NULL when b is 0 or NULL (ANSI would raise)."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def normalize(c) -> Column:
    """Lower-case and keep only ``[a-z0-9]`` (loose header/text matching)."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")


def is_blank(c) -> Column:
    """NULL, empty after trim, or the text 'nan' (a blank spreadsheet cell)."""
    x = F.trim(_col(c).cast("string"))
    return x.isNull() | (x == "") | (F.lower(x) == "nan")


def parse_fiscal_year(c) -> Column:
    """'FY 2023/2024' -> '2023-2024'; 'FY 2024' or 'FY24' -> '2023-2024'."""
    x = _col(c)
    years4 = F.regexp_extract_all(x, F.lit(r"(20\d{2})"), 1)
    years2 = F.regexp_extract_all(x, F.lit(r"(\d{2})"), 1)
    y1 = F.try_element_at(years4, F.lit(1)).cast("int")
    last2 = (F.lit(2000) + F.try_element_at(years2, F.lit(-1)).cast("int"))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.size(years4) >= 2,
                  F.concat(F.try_element_at(years4, F.lit(1)), F.lit("-"), F.try_element_at(years4, F.lit(2))))
            .when(F.size(years4) == 1, F.concat((y1 - 1).cast("string"), F.lit("-"), y1.cast("string")))
            .when(F.size(years2) >= 1, F.concat((last2 - 1).cast("string"), F.lit("-"), last2.cast("string"))))


def clean_year(c) -> Column:
    """'2024' or '2024.0' -> '2023-2024'; other text is trimmed and kept."""
    s = F.trim(_col(c).cast("string"))
    # int(float(s)): double, truncated toward zero (a cast to bigint does that)
    t = F.coalesce(s.try_cast("double").try_cast("bigint").cast("string"), s)
    return F.when(t.rlike(r"^20\d{2}$"),
                  F.concat((t.cast("int") - 1).cast("string"), F.lit("-"), t)).otherwise(t)


def format_grade(c) -> Column:
    """3F/3H/P.. -> Pre-Kindergarten, K.. -> Kindergarten, 1-12 -> 'Nth Grade',
    anything else -> 'Other'."""
    s = F.trim(_col(c).cast("string"))
    su = F.upper(s)
    n = s.try_cast("double").try_cast("int")
    suffix = (F.when((n % 100 >= 11) & (n % 100 <= 13), F.lit("th"))
              .when(n % 10 == 1, F.lit("st")).when(n % 10 == 2, F.lit("nd"))
              .when(n % 10 == 3, F.lit("rd")).otherwise(F.lit("th")))
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(su.isin("3F", "3H") | su.startswith("P"), F.lit("Pre-Kindergarten"))
            .when(su.startswith("K"), F.lit("Kindergarten"))
            .when((n >= 1) & (n <= 12), F.concat(n.cast("string"), suffix, F.lit(" Grade")))
            .otherwise(F.lit("Other")))


def end_year(c) -> Column:
    """'2025-2026', '2026' or '2026.0' -> 2026; NULL for anything but a school year of this century."""
    year = F.regexp_extract(clean_year(c), r"^20\d{2}-(20\d{2})$", 1)
    return F.when(year != "", year.cast("int"))


# Race and gender labels of the enrollment sheets.
RACE_LABELS = {
    "His": "Hispanic or Latino",
    "AmInd": "American Indian or Alaska Native",
    "Asian": "Asian",
    "Black": "Black or African American",
    "Pac Is": "Native Hawaiian or Other Pacific Islander",
    "White": "White",
    "Multi": "Two or more races",
}
GENDER_LABELS = {"M": "Male", "F": "Female"}


def _map_or_keep(x: Column, mapping: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(lookup, x), x)


def split_race_gender(c) -> tuple[Column, Column]:
    """'Pac Is M' -> ('Native Hawaiian or Other Pacific Islander', 'Male').

    Splits at the last space; an unmapped part passes through unchanged.
    """
    x = _col(c)
    race = F.regexp_extract(x, r"^(.*) (\S+)$", 1)
    gender = F.regexp_extract(x, r"^(.*) (\S+)$", 2)
    return _map_or_keep(race, RACE_LABELS), _map_or_keep(gender, GENDER_LABELS)


RATIO_DIGITS = 18


def avg_ratio(a, b) -> Column:
    """Average of the rows' a / b for whole numbers, in any order of summation: each ratio
    is a decimal of 18 places (half up), the sum is exact; NULL where b is 0 or NULL."""
    ratio = F.try_divide(_col(a).cast("decimal(20,0)"), _col(b).cast("decimal(20,0)")).cast(f"decimal(38,{RATIO_DIGITS})")
    units = (F.sum(ratio) * F.lit(10 ** RATIO_DIGITS).cast("decimal(19,0)")).cast("decimal(38,0)").cast("double")
    return F.try_divide(units, F.count(ratio).cast("double") * F.lit(float(10 ** RATIO_DIGITS)))
