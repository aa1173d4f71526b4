"""Near-duplicate components by bottom-k sketches.

A document's set is its distinct 64-bit hashes of 5-word shingles (A-Z in
lower case; below five words the whole sequence is one shingle).  Documents
with equal sets are one class.  Two classes are linked if the Jaccard
similarity of their full sets reaches ``percent``; components of links get the
smallest document id.

One hash function gives every class the ``SKETCH`` smallest values of its set.
Inverted lists run over these retained values, the rarest ones of each class
first: linked sketches share so many values that they meet on one of the
``prefix`` rarest with near certainty (five standard deviations of the
overlap; exact for sets no larger than the sketch).  Values held by a single
class make no list.

A list of m classes is never expanded into its m * m pairs.  In a hub round
every class meets one hub per list; the first hub is the class with the
fewest values of its own, the nearest to what the group has in common.  The
union sketch of a pair estimates its similarity and drops pairs five standard
deviations below the limit; the rest is verified on the full sets.  Links
join into components; rounds with other hubs follow while many pairs are open
and a round settles at least half of them.  A last join compares, within the
lists that still hold several components, classes of different components.
In short lists its condition is the exact test, so it emits links only.  The
classes of long lists (families of pages that share much, but too little for a
link) go by the rarest values of their full sets instead, as many as a
linked partner of that size cannot lack: the common part of a family below the
limit is in none of these lists, so its pairs are never formed.  Where such a
list is long again (copies of one page about the limit), its classes meet one
hub, the class with the fewest rare values; those it does not settle are
compared if they share a change from the hub, as linked ones must.

Defined results: a null or empty text, or one without words, has an empty set
and is its own component; repeated rows and ids are fine (classes go by set,
not id); a null id gets its component's smallest id and is kept only if there
is none; long texts stay in their row; ties go to the smallest id; extra
columns are ignored; an empty table gives an empty result.  Classes are named
by a 64-bit hash of their sorted set.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import ascii_lower, durable, let, small_side, window_hashes, words

SHINGLE = 5
SKETCH = 64
PERCENT = 85
#: Hub rounds end below this many open pairs a class; the last join compares those.
OPEN_PAIRS = 4
BROADCAST_IDS = 2_000_000
#: Pairs of a list up to this long are tested one by one; the classes of longer lists join on
#: the rarest values of their full sets.
LONG_LIST = 128
#: Links that one task takes in a step of ``components``.
LINKS_A_TASK = 100_000
#: Set sizes from which on bands hold several sizes, and the ratio of a band's ends.
BAND_FROM = 50
BAND = 1.02


def least_estimate(percent: int) -> float:
    """Sketch estimates below this belong to no link: five standard deviations off."""
    limit = percent / 100
    return limit - 5 * math.sqrt(limit * (1 - limit) / SKETCH)


def shingle_set(text: Column, n: int = SHINGLE) -> Column:
    """Sorted distinct shingle hashes of a text (array<bigint>)."""
    def of(w: Column) -> Column:
        few = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.lit(n), w)))
        return F.when(F.size(w) < n, few).otherwise(F.sort_array(F.array_distinct(window_hashes(w, n))))
    return let(words(ascii_lower(F.coalesce(text, F.lit("")))), of)


def _described(docs: DataFrame) -> DataFrame:
    """(doc_id, content, n, node, sketch) of (doc_id, text)."""
    one = docs.select("doc_id", F.xxhash64("text").alias("content"), let(shingle_set(F.col("text")), lambda s: F.struct(
        F.size(s).cast("long").alias("n"), F.xxhash64(s).alias("node"),
        F.slice(s, 1, SKETCH).alias("sketch"))).alias("d"))
    return one.select("doc_id", "content", "d.n", "d.node", "d.sketch")


def prefix_length(n: Column, percent: int) -> Column:
    """How many of its rarest retained values a class of n shingles must list."""
    size = F.least(n, F.lit(SKETCH))
    exact = n - F.ceil(n * percent / 100) + 1
    return F.when(n <= SKETCH * percent // 100, exact).otherwise(
        size - F.ceil(size * least_estimate(percent)) + 1).cast("int")


def inverted_lists(nodes: DataFrame, percent: int) -> DataFrame:
    """(value, node, n, own, rank): the lists each class enters; ``own`` counts
    its values that no other class retains, ``rank`` orders by rarity."""
    spread = nodes.select("node", "n", F.explode("sketch").alias("value")).repartition("value")
    often = spread.groupBy("value").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    shared = spread.join(often, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "value"))).alias("values"))  # at most SKETCH of them
    own = F.least(F.col("n"), F.lit(SKETCH)).cast("int") - F.size("values")
    room = F.greatest(F.lit(0), prefix_length(F.col("n"), percent) - F.col("own"))
    return shared.withColumn("own", own).where(room > 0).select(
        "node", "n", "own", F.posexplode(F.slice("values", F.lit(1), room)).alias("rank", "v")) \
        .select("v.value", "node", "n", "own", "rank")


def _near_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _alike(a: Column, b: Column, percent: int) -> Column:
    """The exact test on two full sets: 100 i >= P (|a| + |b| - i) for the intersection's size i."""
    return (100 + percent) * F.size(F.array_intersect(a, b)) >= percent * (F.size(a) + F.size(b))


def _estimate(a: Column, b: Column) -> Column:
    """Jaccard estimate from the union's bottom-k sketch."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return let(union, lambda u: F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u))


def hub_links(lists: DataFrame, order: Column, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between every class and the hub of each of its
    lists; ``lists`` has comp, and classes of one component are not compared."""
    hubs = lists.groupBy("value").agg(F.min(F.struct(order.alias("o"), "node", "n", "comp")).alias("hub"))
    met = lists.join(hubs, "value").where((F.col("comp") != F.col("hub.comp")) & _near_size(F.col("n"), F.col("hub.n"), percent))
    pairs = met.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
    sketches = nodes.select("node", "sketch")
    likely = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a") \
        .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b") \
        .where(_estimate(F.col("sa"), F.col("sb")) >= least_estimate(percent)).select("a", "b")
    full = likely.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    return durable(full.where(_alike(F.col("sa"), F.col("sb"), percent)).select("a", "b"), "links")


def last_links(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components that share a list (its entries: held)."""
    found = short_list_links(lists.where(F.col("held") <= LONG_LIST).drop("held"), sets, percent)
    crowd = durable(lists.where(F.col("held") > LONG_LIST).select("node", "n", "comp").distinct(), "crowd")
    return found if crowd.isEmpty() else found.unionByName(prefix_links(crowd, sets, percent))


def short_list_links(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair in a list of at most ``LONG_LIST`` classes, tested in the first such list that both are in."""
    mine = lists.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "value"))),
                                                 lambda e: e["value"]).alias("values"))  # at most SKETCH
    full = lists.join(mine, "node").join(sets, "node").select("value", "node", "n", "comp", "values", "set")
    a, b = full.alias("a"), full.alias("b")
    on = (F.col("a.value") == F.col("b.value")) & (F.col("a.node") < F.col("b.node")) \
        & (F.col("a.comp") != F.col("b.comp")) & _near_size(F.col("a.n"), F.col("b.n"), percent) \
        & (F.array_intersect("a.values", "b.values")[0] == F.col("a.value")) \
        & _alike(F.col("a.set"), F.col("b.set"), percent)
    return durable(a.join(b, on).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")), "links")


def size_band(n: Column) -> Column:
    """Number of the band of set sizes: one size each up to ``BAND_FROM``, then of ratio ``BAND``."""
    return F.when(n <= BAND_FROM, n.cast("int")).otherwise(
        BAND_FROM + F.floor(F.log(n / BAND_FROM) / math.log(BAND))).cast("int")


def least_size(band: Column) -> Column:
    """No set of the band is smaller."""
    return F.when(band <= BAND_FROM, band.cast("long")).otherwise(
        F.floor(F.pow(F.lit(BAND), band - BAND_FROM) * (BAND_FROM * (1 - 1e-9)))).cast("long")


def _shared_at_least(total: Column, percent: int) -> Column:
    """Elements that two linked sets with sizes of this sum must share."""
    return F.ceil(total * percent / (100 + percent))


def prefix_lists(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(value, low, high, band, node, n, comp, own, place): full-set lists for pairs of size bands.

    Towards partners of a band, a class lists its rarest values that cannot all
    be missing from a linked partner; ``place`` counts them from the rarest on."""
    spread = crowd.join(sets, "node").select("node", "n", "comp", F.explode("set").alias("value"))
    often = spread.groupBy("value").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    ranked = spread.join(often, "value").groupBy("node", "n", "comp").agg(
        F.sort_array(F.collect_list(F.struct("held", "value"))).alias("values"))  # of one class's set
    own = (F.col("n") - F.size("values")).cast("int")
    partners = F.sequence(size_band(F.ceil(F.col("n") * percent / 100)), size_band(F.floor(F.col("n") * 100 / percent)))
    towards = ranked.select("node", "n", "comp", "values", own.alias("own"), F.explode(partners).alias("band"))
    room = F.col("n") - _shared_at_least(F.col("n") + least_size(F.col("band")), percent) + 1 - F.col("own")
    listed = towards.withColumn("room", room.cast("int")).where("room > 0").select(
        "node", "n", "comp", "own", "band", F.posexplode(F.slice("values", F.lit(1), F.col("room"))).alias("at", "v"))
    mine = size_band(F.col("n"))
    return listed.select(F.col("v.value").alias("value"), F.least(mine, "band").alias("low"),
                         F.greatest(mine, "band").alias("high"), mine.alias("band"), "node", "n", "comp", "own",
                         (F.col("own") + F.col("at")).alias("place"))


def prefix_links(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components of ``crowd`` (node, n, comp), without loss
    (within a component that these links join, only enough of them to join it).

    Linked sets a and b share at least m = P (|a| + |b|) / (100 + P) values, so one of the |a| - m + 1
    rarest of a is one of the |b| - m + 1 rarest of b.  What a family of pages has in common is in no
    such list unless it is enough for a link by itself.  Lists of at most ``LONG_LIST`` entries form
    their pairs; the classes of longer ones meet their list's hub, then each other by ``changed_pairs``."""
    key = ["value", "low", "high"]
    lists = durable(prefix_lists(crowd, sets, percent), "prefix")
    held = durable(_crossing(lists, key), "crossing")
    met = lists.join(held.where(F.col("held") > LONG_LIST).select(*key, "hub"), key) \
        .select(F.col("node").alias("a"), F.col("hub").alias("b")).where("a <> b").distinct()
    changes = durable(hub_changes(met, sets, percent), "changes")
    near = changes.where("linked").select("a", "b")
    merged = durable(_merged(crowd, near), "merged")
    few = lists.join(held.where(F.col("held") <= LONG_LIST).select(*key), key).drop("comp") \
        .join(merged.select("node", "comp"), "node")
    found = band_pairs(few, key, percent).unionByName(changed_pairs(changes, merged, percent))
    pairs = durable(found.distinct(), "pairs")
    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    return durable(full.where(_alike(F.col("sa"), F.col("sb"), percent)).select("a", "b").unionByName(near), "links")


def _crossing(lists: DataFrame, key: list[str]) -> DataFrame:
    """key, held, top, hub of the lists with classes of both bands and of several components: the entries, the
    largest component, and the class with the fewest values rarer than the list's, nearest to what they share."""
    parts = lists.groupBy(*key, "comp").agg(
        F.count("*").alias("m"), F.min("band").alias("x"), F.max("band").alias("y"),
        F.min(F.struct("place", "own", "node")).alias("first"))
    return parts.groupBy(*key).agg(
        F.sum("m").alias("held"), F.count("*").alias("parts"), F.min("x").alias("x"), F.max("y").alias("y"),
        F.max(F.struct("m", "comp"))["comp"].alias("top"), F.min("first")["node"].alias("hub")) \
        .where("parts > 1 and x = low and y = high").select(*key, "held", "top", "hub")


def band_pairs(lists: DataFrame, key: list[str], percent: int) -> DataFrame:
    """Pairs (a, b) of different components in lists of two size bands.

    The largest component of a list is on one side of a join only, so its own pairs are not formed."""
    found = durable(lists.join(_crossing(lists, key).select(*key, "top"), key), "open")
    a, b = found.where("band = low").alias("a"), found.where("band = high").alias("b")
    miss = _shared_at_least(F.col("a.n") + F.col("b.n"), percent)
    on = (F.col("a.comp") != F.col("b.comp")) \
        & (F.col("a.place") <= F.col("a.n") - miss) & (F.col("b.place") <= F.col("b.n") - miss)
    for name in key:
        on = (F.col(f"a.{name}") == F.col(f"b.{name}")) & on
    once = (F.col("a.low") < F.col("a.high")) | (F.col("a.comp") == F.col("a.top")) | (F.col("a.node") < F.col("b.node"))
    ends = [F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")]
    return a.join(b.where("comp <> top"), on & once).select(*ends).unionByName(
        a.where("comp <> top and low < high").join(b.where("comp = top"), on).select(*ends))


def hub_changes(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, linked, change): whether a is linked with its hub b, and the values that only one of them has."""
    full = met.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    return full.select("a", "b", F.size("sa").cast("long").alias("n"),
                       _alike(F.col("sa"), F.col("sb"), percent).alias("linked"),
                       F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa")).alias("change"))


def _merged(crowd: DataFrame, links: DataFrame) -> DataFrame:
    """``crowd`` with the components that ``links`` make of its components."""
    of = crowd.select("node", "comp")
    ends = links.join(of.select(F.col("node").alias("a"), F.col("comp").alias("x")), "a") \
        .join(of.select(F.col("node").alias("b"), F.col("comp").alias("y")), "b")
    joined = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))) \
        .select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return crowd.join(joined, "comp", "left").select("node", "n", F.coalesce("into", "comp").alias("comp"))


def _most_apart(total: Column, percent: int) -> Column:
    """Most values that only one of two linked sets with sizes of this sum has."""
    return total - 2 * _shared_at_least(total, percent)


def changed_pairs(changes: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components with one hub that share a change from it, without loss.

    Sets are linked if at most c (|a| + |b|) values are in one of them only, c = (100 - P) / (100 + P).
    If a is not linked with hub h, their change has more than c (|a| + |h|) values, and that of b at
    least | |b| - |h| |: together more than a link of a and b allows, so a linked pair shares changes
    (if both are linked with h, they are one component).  The part that a family has in common is in
    no change.  Lists run over the rarest changes of each class, like ``prefix_lists``; a change that one
    component alone has makes no list."""
    sized = changes.select(F.col("a").alias("node"), F.col("b").alias("hub"), "n", "change") \
        .join(comps.select("node", "comp"), "node")
    mixed = sized.groupBy("hub").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("hub")
    spread = durable(sized.join(mixed, "hub").select(
        "hub", "node", "n", "comp", F.size("change").alias("apart"), F.explode("change").alias("value")), "changed")
    key = ["hub", "value"]
    parts = spread.groupBy(*key, "comp").agg(F.count("*").alias("m"))
    often = parts.groupBy(*key).agg(F.sum("m").alias("held"), F.count("*").alias("parts"),
                                    F.max(F.struct("m", "comp"))["comp"].alias("top")).where("parts > 1").drop("parts")
    one = ["hub", "node", "n", "comp", "apart"]
    ranked = spread.join(often, key).groupBy(*one).agg(
        F.sort_array(F.collect_list(F.struct("held", "value", "top"))).alias("values"))  # of one class's change
    own = (F.col("apart") - F.size("values")).cast("int")
    partner = F.floor(F.col("n") * 100 / percent)
    room = F.least(F.col("apart").cast("long"), _most_apart(F.col("n") + partner, percent) + 2) - own
    listed = ranked.withColumn("own", own).withColumn("room", room.cast("int")).where("room > 0").select(
        *one, "own", F.posexplode(F.slice("values", F.lit(1), F.col("room"))).alias("at", "v")) \
        .select(*one, F.col("v.value").alias("value"), F.col("v.top").alias("top"), (F.col("own") + F.col("at")).alias("place"))
    found = durable(listed, "listed-changes")
    a, b = found.alias("a"), found.where("comp <> top").alias("b")
    apart = F.col("a.apart") + F.col("b.apart")
    common = F.ceil((apart - _most_apart(F.col("a.n") + F.col("b.n"), percent)) / 2)
    on = (F.col("a.hub") == F.col("b.hub")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.comp") != F.col("b.comp")) \
        & ((F.col("a.comp") == F.col("a.top")) | (F.col("a.node") < F.col("b.node"))) \
        & _near_size(F.col("a.n"), F.col("b.n"), percent) \
        & (F.col("a.place") <= F.col("a.apart") - common) & (F.col("b.place") <= F.col("b.apart") - common)
    return a.join(b, on).select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, comp): components of undirected links, by alternating large-star
    and small-star steps; every step is a written table.

    A step's table is dealt in proportion to its rows: a few links need no exchange."""
    edges = durable(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "stars")
    while True:
        part = edges.coalesce(max(1, math.ceil(edges.count() / LINKS_A_TASK)))
        if _all_stars(part):
            return part.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        both = _pairs(part, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _pairs(large.join(low, "u"), ("v", "m"), ("u", "m")).where("u <> v")
        edges = durable(small.distinct(), "stars")


def _pairs(df: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """(u, v): each row's pairs of these columns."""
    return df.select(F.inline(F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in ends])))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u, v) has one edge to a smaller node, or none and is such a node."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    return edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")) \
        .where("ups > 1 or ups = 1 and least = 0").isEmpty()


def _with_comp(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """``lists`` with each class's component and the list's number of entries (held), only lists of several components."""
    named = lists.drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = named.groupBy("value").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("held")) \
        .where("x <> y").select("value", "held")
    return named.join(mixed, "value")


def _open_pairs(mixed: DataFrame) -> int:
    """Pairs of classes of different components, counted in each list they share."""
    held = mixed.groupBy("value", "comp").agg(F.count("*").alias("m")).groupBy("value").agg(
        F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("inside"))
    return held.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("inside")) / 2), F.lit(0))).first()[0]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return _verdicts(docs, doc_id, text, percent).drop("content")


def _verdicts(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """``near_duplicates`` with a hash of each row's text (content)."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = durable(_described(own), "described")
    nodes = durable(rows.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("sketch").alias("sketch")), "nodes")
    lists = durable(inverted_lists(nodes, percent), "lists")
    listed = durable(lists.select("node").distinct().join(nodes.select("node", "first_id"), "node"), "listed")
    ids = listed.select(F.col("first_id").alias("_first"))
    some = own.join(small_side(ids.distinct(), BROADCAST_IDS), F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi")
    named = some.select(shingle_set(F.col("text")).alias("set")).withColumn("node", F.xxhash64("set"))
    sets = durable(named.join(small_side(listed.select("node"), BROADCAST_IDS), "node", "left_semi")
                   .groupBy("node").agg(F.min("set").alias("set")), "sets")
    links = hub_links(lists.withColumn("comp", F.col("node")), F.col("own"), nodes, sets, percent)
    mixed = durable(_with_comp(lists, components(links)), "mixed")
    few, before, left, salt = OPEN_PAIRS * nodes.count(), math.inf, _open_pairs(mixed), 0
    while left > few and left <= before / 2:
        links = links.unionByName(hub_links(mixed, F.xxhash64("node", "value", F.lit(salt)), nodes, sets, percent))
        mixed = durable(_with_comp(lists, components(links)), "mixed")
        before, left, salt = left, _open_pairs(mixed), salt + 1
    comps = components(links.unionByName(last_links(mixed, sets, percent)))
    named = nodes.select("node", "first_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    firsts = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of_node = durable(named.join(firsts, "comp").select("node", "component_id"), "components")
    linked = rows.where("n > 0").select("doc_id", "content", "n", "node").join(of_node, "node")
    alone = rows.where("n = 0").select("doc_id", "content", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "content", "n", "component_id").unionByName(alone).select(
        "doc_id", "content", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the rows of ``docs`` (columns doc_id and
    text) that are kept, all columns as they are, whatever their names.  Rows are
    found again by id and text, so of an id with several texts each has its own verdict."""
    mark = uuid.uuid4().hex
    kept = _verdicts(docs, "doc_id", "text", percent).where("kept").select(
        F.col("doc_id").alias(f"id_{mark}"), F.col("content").alias(f"content_{mark}")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(f"id_{mark}"))
                     & (F.xxhash64("text") == F.col(f"content_{mark}")), "left_semi")
