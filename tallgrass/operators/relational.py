"""Reusable DataFrame -> DataFrame operators distilled from the marts.

Design rules followed throughout:

* Declarative DataFrame plans only; Catalyst prunes columns and pushes
  filters into the Parquet scans.
* Aggregate before joining where the semantics allow (partial, map-side
  aggregation makes hot keys cheap).
* Windows only over already-aggregated inputs whose partitions are bounded
  by a code list (e.g. industries per occupation), never over raw rows.
* A side is broadcast only when the optimizer's size estimate (of compressed
  files, so no strict upper bound) is under a limit; otherwise the join is left to sort-merge / AQE, which re-plans at runtime
  with real sizes and splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import div0, safe_ratio

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
BROADCAST_LIMIT_IDS = 1_000_000   # ids of a broadcast list; a hashed id takes 60 to 100 bytes in the driver and every executor


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (no job is run)."""
    try:
        # a Scala BigInt; py4j hands it over as an int or as a Java object
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - plan stats unavailable: never broadcast
        return 1 << 62


def broadcast_if_bounded(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check; else leave it to the planner."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate once as Parquet under the shared
    ``spark.checkpoint.dir`` and read it back (survives executor loss; the
    lineage is cut), so a plan that uses it several times computes it once.
    A written table rather than ``checkpoint()``, which computes its input a
    second time for the checkpoint write unless it is cached."""
    import uuid

    from tallgrass.session import scratch_root
    from tallgrass.sources.fs import write_parquet_atomic
    spark = df.sparkSession
    path = write_parquet_atomic(df, f"{scratch_root(spark)}/tallgrass_materialized/{uuid.uuid4().hex}")
    return spark.read.parquet(path)


def _cols(names: Iterable[str]) -> list[Column]:
    return [F.col(n) for n in names]


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------
def crosswalk(df: DataFrame, map_df: DataFrame, code: str, map_code: str, bucket: str,
              out: str | None = None, how: str = "left") -> DataFrame:
    """Code -> bucket lookup.

    ``how='left'`` keeps unmatched rows with a NULL bucket; ``'inner'`` drops
    them.  A code mapped to several buckets multiplies rows, as in SQL.
    """
    out = out or bucket
    m = map_df.select(F.col(map_code).alias("__cw_code"), F.col(bucket).alias(out))
    joined = df.join(broadcast_if_bounded(m), df[code] == F.col("__cw_code"), how)
    return joined.drop("__cw_code")


def star_join(spine: DataFrame, sides: Sequence[DataFrame], key: str) -> DataFrame:
    """Fold left joins of ``sides`` onto ``spine`` by ``key`` (C14)."""
    return reduce(lambda acc, side: acc.join(broadcast_if_bounded(side), on=key, how="left"), sides, spine)


def flatten_hierarchy(df: DataFrame, id_col: str, parent_col: str, carry: Sequence[str],
                      leaf: Column, depth: int, how: str = "left",
                      prefix: str = "h") -> DataFrame:
    """Walk ``depth`` parent links from every leaf row.

    Returns columns ``{prefix}0_<col>`` for the leaf and ``{prefix}k_<col>``
    for the k-th ancestor, for ``id_col`` and each column in ``carry``.
    The hierarchy is a code list (small): every step joins the same
    broadcast side under a new alias, so the side is built and broadcast
    once and reused by every step.
    """
    keep = [id_col, parent_col, *[c for c in carry if c not in (id_col, parent_col)]]
    side_src = broadcast_if_bounded(df.select(*keep))
    out = df.filter(leaf).select(*keep).alias(f"{prefix}0")
    cols = [F.col(f"{prefix}0.{c}").alias(f"{prefix}0_{c}") for c in keep]
    for k in range(1, depth + 1):
        side = side_src.alias(f"{prefix}{k}")
        out = out.join(side, F.col(f"{prefix}{k - 1}.{parent_col}") == F.col(f"{prefix}{k}.{id_col}"), how)
        cols += [F.col(f"{prefix}{k}.{c}").alias(f"{prefix}{k}_{c}") for c in keep]
    return out.select(*cols)


# ---------------------------------------------------------------------------
# windows re-expressed as aggregations
# ---------------------------------------------------------------------------
def prefer_source(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (E1, ``ROW_NUMBER() = 1``).

    Expressed as ``min_by`` over a struct so it is a partial (map-side)
    aggregation: a key holding a third of all rows does not land whole in
    one task.  Put every output column in ``order`` for a total order.
    """
    columns = list(columns or [c for c in df.columns if c not in keys])
    payload = F.struct(*[F.col(c).alias(c) for c in columns])
    ordering = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picked = df.groupBy(*keys).agg(F.min_by(payload, ordering).alias("__pick"))
    return picked.select(*keys, *[F.col(f"__pick.{c}").alias(c) for c in columns])


def asc_nulls_last(c) -> list[Column]:
    """Ordering terms for ``min_by``: ascending with NULLs after values."""
    x = F.col(c) if isinstance(c, str) else c
    return [x.isNull(), x]


def share_of_group(df: DataFrame, keys: Sequence[str], measure: str, out: str,
                   method: str = "join") -> DataFrame:
    """``x / NULLIF(SUM(x) OVER (PARTITION BY keys), 0)``.

    ``method='join'`` (default, for raw rows): totals come from a partial
    aggregation joined back on the keys (null-safe, like a window
    partition), so a hot group is split by AQE's skew join instead of being
    sorted in one task.  ``method='window'``: a window over the keys, for
    inputs already aggregated below the keys, where a partition holds one
    row per code of the remaining key (bounded by the code list) and the
    input is read once.
    """
    if method == "window":
        total = F.sum(measure).over(Window.partitionBy(*keys)).cast("double")
        return df.withColumn(out, F.col(measure).cast("double") / F.nullif(total, F.lit(0.0)))
    totals = df.groupBy(*keys).agg(F.sum(measure).alias("__group_total"))
    t = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__group_total")
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(t[f"__k_{k}"]) for k in keys])
    joined = df.join(t, cond, "inner")
    share = F.col(measure).cast("double") / F.nullif(F.col("__group_total").cast("double"), F.lit(0.0))
    return joined.withColumn(out, share).drop("__group_total", *[f"__k_{k}" for k in keys])


def index_to_baseline(df: DataFrame, keys: Sequence[str], measure: str, is_base: Column,
                      base_out: str, index_out: str) -> DataFrame:
    """Join each row to its key's baseline row and divide.

    Same rows as the self-join ``t1 JOIN t1 AS t2 ON keys AND t2 is base``:
    rows of keys without a baseline are dropped, several baseline rows
    multiply.  A plain equi-join to the few baseline rows: it streams, and a
    hot key is split like any skewed join; no group is gathered.
    """
    base = df.filter(is_base).select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(measure).alias(base_out))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    out = df.join(base, on).drop(*[f"__k_{k}" for k in keys])
    return out.withColumn(index_out, F.try_divide(F.col(measure).cast("double"), F.col(base_out).cast("double")))


# ---------------------------------------------------------------------------
# aggregation shapes
# ---------------------------------------------------------------------------
def shift_period(df: DataFrame, col: str, n: int = 1) -> DataFrame:
    """Move a period column forward by ``n`` (the *_lagged marts)."""
    return df.withColumn(col, (F.col(col) + F.lit(n)).cast(df.schema[col].dataType))


def year_over_year(df: DataFrame, keys: Sequence[str], period: str, measures: Sequence[str],
                   prior_prefix: str = "PRIOR_") -> DataFrame:
    """Current rows left-joined to the same keys one period earlier."""
    prior = shift_period(df.select(*keys, period, *measures), period, 1)
    prior = prior.select(*keys, period, *[F.col(m).alias(prior_prefix + m) for m in measures])
    return df.join(prior, on=[*keys, period], how="left")


def sum_with_support(df: DataFrame, keys: Sequence[str], cols: dict[str, tuple[str, str]],
                     count_out: str | None = None) -> DataFrame:
    """Per group: SUM(col) and COUNT(col) (non-null support) for each column.

    ``cols`` maps a column (or SQL expression) to ``(sum_name, count_name)``;
    ``count_name`` may be None.
    """
    aggs: list[Column] = []
    if count_out:
        aggs.append(F.count(F.lit(1)).alias(count_out))
    for expr, (sum_name, n_name) in cols.items():
        c = F.expr(expr)
        aggs.append(F.sum(c).alias(sum_name))
        if n_name:
            aggs.append(F.count(c).alias(n_name))
    return df.groupBy(*keys).agg(*aggs)


def reduce_to_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is among ``ids``, before anything of ``df`` is shuffled.

    A bounded id list is broadcast and tested in the scan's own stage.  A longer one is
    left to the join that follows, into whose scan Spark puts a Bloom filter of the other
    side's ids (session.py sets the sizes from which it does).  The ids are counted: the
    estimate is an id's share of compressed files, which tens of millions keep under."""
    keys = ids.select(F.col(id_col).alias("__key"))
    if estimated_bytes(keys) > BROADCAST_LIMIT_BYTES or keys.count() > BROADCAST_LIMIT_IDS:
        return df
    return df.join(F.broadcast(keys.distinct()), df[id_col] == F.col("__key"), "left_semi")


def flagged_count(df: DataFrame, flagged_ids: DataFrame, id_col: str, keys: Sequence[str],
                  n_out: str, flagged_out: str) -> DataFrame:
    """Rows per group, and distinct flagged ids per group (I5 decorrelated).

    Equals the correlated form ``(SELECT COUNT(DISTINCT id) ... WHERE k = k)``:
    a group with a NULL key never matches under ``=``, so it gets 0 (T2).
    One pass over ``df``: flags are attached by a join to the distinct ids, and
    only flags of ids that ``df`` holds are made distinct.
    """
    near = reduce_to_ids(flagged_ids.select(id_col), id_col, df)
    flags = near.select(F.col(id_col).alias("__fid")).distinct().withColumn("__flag", F.lit(True))
    marked = df.join(flags, df[id_col] == F.col("__fid"), "left")
    all_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    out = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(n_out),
        F.count_distinct(F.when(F.col("__flag"), F.col(id_col))).alias("__nf"),
    )
    return out.withColumn(flagged_out, F.when(all_keys, F.col("__nf")).otherwise(F.lit(0)).cast("bigint")).drop("__nf")


def distinct_of_ids(df: DataFrame, columns: Sequence[str], key: str, id_col: str, ids: DataFrame) -> DataFrame:
    """Distinct ``columns`` of the rows whose ``id_col`` is among ``ids``.

    ``key`` is one of the columns and mostly stands with one row of them: then the ids
    meet only (id, key) and the columns are made distinct by themselves, so no wide row
    is shuffled by id.  Rows of a key that stands with several rows, or is null, meet the
    ids whole.
    """
    rows = materialize(df.select(*columns).distinct())
    several = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
                          .filter((F.col("__n") > 1) | F.col(key).isNull()).select(F.col(key).alias("__key")))
    named = df.select(id_col, key).join(ids.select(id_col), id_col, "left_semi").select(key).distinct()
    out = rows.join(named, key, "left_semi").select(*columns)
    if several.isEmpty():
        return out
    unclear = F.col(key).eqNullSafe(F.col("__key"))
    whole = df.join(several, unclear, "left_semi").join(ids.select(id_col), id_col, "left_semi").select(*columns).distinct()
    return out.join(several, unclear, "left_anti").unionByName(whole)


def group_total_alongside(detail: DataFrame, base: DataFrame, keys: Sequence[str],
                          total_out: str) -> DataFrame:
    """Attach the base table's row count of the same group (inner on keys)."""
    totals = base.groupBy(*keys).agg(F.count(F.lit(1)).alias(total_out))
    return detail.join(totals, on=list(keys), how="inner")


FANOUT_CELL = 1_000_000   # joined rows from which an id is split, and about the rows of a cell


def _axis_buckets(sizes: Column, cell: float) -> Column:
    """Buckets per axis so that a cell, one bucket of each, joins to about ``cell`` rows.

    Axes are cut from the shortest on: an axis shorter than an even share of the
    cell stays whole and leaves its share to the longer ones."""
    order = F.array_sort(F.transform(sizes, lambda n, i: F.struct(F.greatest(n, F.lit(1)).alias("n"), i.alias("i"))))
    start = F.from_json(F.lit(f'{{"room":{float(cell)},"axes":0,"cut":[]}}'),
                        "struct<room:double,axes:int,cut:array<struct<i:int,g:bigint>>>")

    def cut(s: Column, e: Column) -> Column:
        share = F.floor(F.pow(s["room"], F.lit(1.0) / (F.size(sizes) - s["axes"])) + F.lit(1e-9))
        width = F.greatest(F.lit(1), F.least(e["n"], share))
        return F.struct(F.greatest(F.lit(1.0), s["room"] / width).alias("room"), (s["axes"] + 1).alias("axes"),
                        F.concat(s["cut"], F.array(F.struct(e["i"].alias("i"), F.ceil(e["n"] / width).alias("g"))))
                        .alias("cut"))

    done = F.aggregate(order, start, lambda s, e: cut(s, e).cast(
        "struct<room:double,axes:int,cut:array<struct<i:int,g:bigint>>>"), lambda s: F.array_sort(s["cut"]))
    return F.transform(done, lambda e: e["g"])


def _axis_sizes(rels: Sequence[DataFrame], id_col: str) -> DataFrame:
    """Rows per id of every relation, as one array (partial counts before the shuffle)."""
    parts = [rel.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n")).select(id_col, F.lit(i).alias("__i"), "__n")
             for i, rel in enumerate(rels)]
    return reduce(DataFrame.unionByName, parts).filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("__i") == i, F.col("__n"))), F.lit(0)) for i in range(len(rels))])
        .alias("__n"))


def _joined_rows(sizes: Column, hows: Sequence[str]) -> Column:
    """Rows an id joins to: the product of its relations' rows (a left join keeps at least one)."""
    out = sizes[0].cast("double")
    for i, how in enumerate(hows, start=1):
        out = out * (sizes[i] if how == "inner" else F.greatest(sizes[i], F.lit(1))).cast("double")
    return out


def fanout_grid(pairs: Sequence[tuple[DataFrame, str]], id_col: str, hows: Sequence[str],
                cell: int = FANOUT_CELL) -> DataFrame:
    """Ids that join to more than ``cell`` rows: their distinct pairs per relation (``__n``)
    and the buckets of each axis (``__g``).

    Raw row counts, which never lie below the distinct ones, name the candidates; distinct
    pairs are counted for those alone.  Both tables are written and of any length."""
    many = _joined_rows(F.col("__n"), hows) > cell
    raw = _axis_sizes([rel.select(id_col) for rel, _ in pairs], id_col)
    some = materialize(raw.filter(many).select(id_col))
    if some.isEmpty():
        return some.select(id_col, F.array().cast("array<bigint>").alias("__n"), F.array().cast("array<bigint>").alias("__g"))
    known = broadcast_if_bounded(some)
    exact = _axis_sizes([rel.select(id_col, attr).join(known, id_col, "left_semi").distinct() for rel, attr in pairs], id_col)
    return materialize(exact.filter(many).withColumn("__g", _axis_buckets(F.col("__n"), cell)))


def entity_fanout_count(pairs: Sequence[tuple[DataFrame, str]], id_col: str, hows: Sequence[str],
                        out: str, cell: int = FANOUT_CELL) -> DataFrame:
    """Counts over the join of distinct (id, attribute) relations.

    ``pairs`` = [(relation, attribute column)], joined on ``id_col`` in
    order with ``hows``; the count is per combination of attributes.
    Every relation is reduced to distinct pairs first (a map-side partial
    aggregation), so the fan-out join sees one row per pair.

    An id whose relations join to more than ``cell`` rows is spread over a grid:
    each relation is cut along its own axis into buckets of its attribute's hash,
    and a pair is copied to every cell that holds its bucket.  The join runs on
    (id, cell), so about ``cell`` rows of an id are made in one place, however
    they come about (one long relation or several middling ones).  Copies stay few
    beside the rows joined: a cell of a * b * c rows receives a + b + c pairs.
    A left-joined relation with pairs of the id, but none in a cell, adds no row
    there.  Without such ids the relations are joined on the id alone.
    """
    rels = [rel.select(id_col, attr).distinct() for rel, attr in pairs]
    attrs = [attr for _, attr in pairs]
    grid = fanout_grid(pairs, id_col, hows, cell)
    if grid.isEmpty():
        joined = rels[0]
        for rel, how in zip(rels[1:], hows):
            joined = joined.join(rel, on=id_col, how=how)
        return joined.groupBy(*attrs).agg(F.count(F.lit(1)).alias(out))
    side = broadcast_if_bounded(grid)
    buckets = [F.col("__g")[i] for i in range(len(rels))]

    def in_cells(i: int) -> DataFrame:
        """Relation ``i`` with one row per cell of each pair (cell numbers: mixed radix of the axes' buckets)."""
        low = reduce(lambda a, b: a * b, buckets[:i], F.lit(1).cast("bigint"))
        copies = reduce(lambda a, b: a * b, [b for j, b in enumerate(buckets) if j != i], F.lit(1).cast("bigint"))
        own = F.pmod(F.xxhash64(attrs[i]), buckets[i])
        cells = F.transform(F.sequence(F.lit(0).cast("bigint"), copies - 1),
                            lambda r: (F.floor(r / low) * buckets[i] + own) * low + F.pmod(r, low))
        placed = F.when(F.col("__g").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(cells)
        return rels[i].join(side, id_col, "left").withColumn("__cell", F.explode(placed))

    joined = in_cells(0).select(id_col, "__cell", "__n", attrs[0])
    for i, how in enumerate(hows, start=1):
        right = in_cells(i).select(id_col, "__cell", attrs[i], F.lit(True).alias("__met"))
        joined = joined.join(right, on=[id_col, "__cell"], how=how)
        if how != "inner":
            joined = joined.filter(F.col("__met").isNotNull() | F.col("__n").isNull() | (F.col("__n")[i] == 0))
        joined = joined.drop("__met")
    return joined.groupBy(*attrs).agg(F.count(F.lit(1)).alias(out))


def latest_and_prior_year(df: DataFrame, year: str, tag: str = "PERIOD") -> DataFrame:
    """Rows of the latest year and the year before, tagged current / prior.

    The maximum is an uncorrelated scalar subquery, bound once as a column
    (so it is planned and run once) and referenced from there.
    """
    d = df.withColumn("__max", df.select(F.max(year)).scalar())
    cur = F.col("__max")
    return (d.filter((F.col(year) == cur) | (F.col(year) == cur - 1))
             .withColumn(tag, F.when(F.col(year) == cur, F.lit("current")).otherwise(F.lit("prior")))
             .drop("__max"))


def pivot_current_prior(df: DataFrame, key: str, level: str, levels: dict, measure: str,
                        year: str, current_year=None) -> DataFrame:
    """One pass: SUM(measure) per key for each level, current and prior year.

    ``levels`` maps a level value to an output stem; columns are
    ``CURRENT_<stem>`` and ``PRIOR_<stem>``.  The current year defaults to
    the table's maximum (a scalar subquery, bound once as a column).  NULL
    where a key has no row.
    """
    cur_value = df.select(F.max(year)).scalar() if current_year is None else F.lit(current_year)
    d = df.withColumn("__cur", cur_value)
    cur = F.col("__cur")
    aggs = []
    for value, stem in levels.items():
        is_level = F.lit(True) if value is None else (F.col(level) == F.lit(value))
        aggs.append(F.sum(F.when(is_level & (F.col(year) == cur), F.col(measure))).alias(f"CURRENT_{stem}"))
        aggs.append(F.sum(F.when(is_level & (F.col(year) == cur - 1), F.col(measure))).alias(f"PRIOR_{stem}"))
    return (d.filter((F.col(year) == cur) | (F.col(year) == cur - 1))
              .groupBy(key).agg(*aggs))


def change_and_pct_change(df: DataFrame, cur: str, prior: str, raw_out: str | None, pct_out: str,
                          zero: str = "div0") -> DataFrame:
    """Raw change and relative change; ``zero='div0'`` gives 0 on a zero base,
    ``'null'`` gives NULL."""
    diff = F.col(cur) - F.col(prior)
    if raw_out:
        df = df.withColumn(raw_out, diff)
    pct = div0(diff, F.col(prior)) if zero == "div0" else safe_ratio(diff, F.col(prior))
    return df.withColumn(pct_out, pct)


def calendar_window_count(df: DataFrame, date_col: str, as_of, keys: Sequence[str],
                          current_out: str, prior_out: str) -> DataFrame:
    """Postings in the same calendar year as ``as_of`` and the one before.

    ``DATEDIFF(YEAR, d, as_of)`` counts year boundaries, so "< 1" is "same
    calendar year (or later)" and "[1, 2)" is "previous calendar year" (T3).
    NULL when a key has none.
    """
    gap = F.lit(as_of.year) - F.year(F.col(date_col))
    out = df.groupBy(*keys).agg(
        F.sum(F.when(gap < 1, F.lit(1))).cast("bigint").alias(current_out),
        F.sum(F.when((gap >= 1) & (gap < 2), F.lit(1))).cast("bigint").alias(prior_out),
    )
    return out.filter(F.col(current_out).isNotNull() | F.col(prior_out).isNotNull())
