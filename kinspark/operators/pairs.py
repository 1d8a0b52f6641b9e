"""Co-occurrence counting: the engine under rules and both similarities.

For a table of (group, item) rows -- basket and product, user and rated
item, feature and feature set -- count for every pair of items the groups
holding both.  This is the self-join on the group key of the original
programs, planned for large, skewed tables:

* **pre-aggregate**: rows are first reduced to one row per (group, item)
  with a multiplicity ``w``.  The quadratic join then sees each item once
  per group; bag semantics multiply the weights (w_a * w_b), so repeated
  rows cost nothing extra.
* **symmetry**: only a < b is joined and counted, then mirrored with a
  two-element explode -- half the join output and half the shuffle.
  Diagonal counts (a, a) come from the per-item totals, not from the join.
* **ordinary groups, one shuffle**: groups with at most ``tile_rows`` rows
  are hash-partitioned by the group once; de-duplication and the self-join
  both reuse that partitioning (the two join sides are one reused exchange).
* **hot groups are tiled**: a group with more than ``tile_rows`` rows is
  de-duplicated on (group, item), which spreads it, then cut into ``nt``
  chunks by a hash of the item; the join key becomes (group, chunk_left,
  chunk_right) with chunk_left <= chunk_right, so every unordered pair meets
  in one tile.  Each of the nt (nt + 1) / 2 tiles has at most ~tile_rows^2
  candidate pairs, so one basket holding a third of all rows is
  spread over many tasks instead of one.  Rows of a hot group are replicated
  nt + 1 times in all, a 1 / tile_rows fraction of the pair work it causes
  anyway.  The chunk is a hash, not a random number, so a recomputed task
  after an executor loss sees the same assignment.  (AQE's skew-join split
  is sized by input bytes for linear work and starts at 256 MB; the work
  here is quadratic, hence the explicit tiles.)
* **lists, not pairs, are shuffled**: a member row sends the array of its group's items
  that come after it by (frequency, item) to the task that counts its pairs (:func:`pair_lists`).
  An array element is a fraction of a pair row (an int or a long that holds item and frequency, where
  items are whole numbers: :class:`Codes`), and the rarer item lists, so no
  item's partition is larger than the member table, whoever holds it.
* **map-side combine** where it combines: pairs of items that are in many groups (:attr:`Members.often`)
  are few and repeat in every task; they are counted in the join's stage, before the shuffle.
* **partitions by pair work**: a partition's cost is the sum of its squared
  group sizes, which bytes say nothing about.  A histogram of group sizes
  (:class:`Work`) gives the total work W; the join gets W / ``PAIRS_PER_TASK``
  partitions, or one per ``ROWS_PER_TASK`` member rows if that is more, the count W / ``PAIRS_PER_COUNT``
  (numbers of their own, which AQE does not merge by bytes), and
  groups with more than a ``TILES_PER_TASK``-th of a partition's work are tiled,
  so that what hashing deals out is many small shares.
* **lower bounds on counts come first**: no pair counts more than
  :func:`item_bounds` says of either item, so for a least count the rows of items
  below it leave before groups are sized, tiled and joined (:func:`reaching`).

The histogram is one partial aggregate of rows per group, reduced to a few
hundred rows in a small job before the plan is built: with no hot group the
tiling path is left out entirely; otherwise the hot-group table (at most
rows / tile rows entries) is broadcast when its counted size is under
``HOT_BROADCAST_ROWS`` and shuffle-joined above it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from kinspark.session import stage

# Largest number of rows a group may have before it is tiled.
# A tile then holds at most ~tile_rows^2 / 2 candidate pairs (5e7 here).
DEFAULT_TILE_ROWS = 10_000

# No group of fewer rows is tiled for the balance of the work (1.3e5 candidate pairs).
MIN_TILE_ROWS = 512

# Candidate pairs a task of the self-join is meant to form, and the equal shares
# that a partition's work should at least consist of.
PAIRS_PER_TASK = 20_000_000
TILES_PER_TASK = 32

# Member rows a task of the self-join is meant to sort, and candidate pairs that a
# task is meant to count: either fits a task's memory without a spill.
ROWS_PER_TASK = 1_000_000
PAIRS_PER_COUNT = 1_000_000

# Candidate pairs a member row must have for lists to pay where no frequency is asked for.
LIST_PAIRS = 8

# No item in fewer groups is counted by the map-side combine (see Members.often).
MIN_OFTEN = 1_000

# Most hot groups whose (group, chunk count) table is broadcast; above this
# count it is joined by a shuffle instead (each entry is two numbers).
HOT_BROADCAST_ROWS = 1_000_000


def _weigh(rows: DataFrame, keys: list[str], dedupe: bool) -> DataFrame:
    if dedupe:
        return rows.select(*keys).distinct().withColumn("_w", F.lit(1).cast("long"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_w"))


def members(df: DataFrame, group_col: str, item_col: str, dedupe: bool = True) -> DataFrame:
    """One row per (group, item) with weight ``_w``.

    ``dedupe=True``: groups are sets, ``_w`` = 1.  ``dedupe=False``: ``_w`` is
    the number of repeats (bag semantics).  NULL groups or items can join
    nothing and are dropped.
    """
    rows = df.select(group_col, item_col).where(
        F.col(group_col).isNotNull() & F.col(item_col).isNotNull()
    )
    return _weigh(rows, [group_col, item_col], dedupe)


def item_totals(memb: DataFrame, item_col: str, total_col: str = "freq", square: bool = False) -> DataFrame:
    """Per item: sum of weights (rows or groups), or of squared weights."""
    w = F.col("_w") * F.col("_w") if square else F.col("_w")
    return memb.groupBy(item_col).agg(F.sum(w).alias(total_col))


def row_counts(df: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """Rows with an item per non-NULL group: (group, _m).

    An upper bound of the distinct items per group, taken straight from the
    input with a partial aggregate (one row per group is shuffled).  Its row
    count is the number of groups; a group whose items are all NULL is one,
    with _m = 0.
    """
    rows = df.where(F.col(group_col).isNotNull())
    return rows.groupBy(group_col).agg(F.count(F.col(item_col)).alias("_m"))


@dataclass
class Members:
    """(group, item, _w) rows, split by group size.

    ``normal``: groups with at most ``tile_rows`` rows, hash-partitioned by
    the group (one shuffle of the input; de-duplication and the self-join
    reuse that partitioning).  ``hot``: the larger groups with their chunk
    count ``_nt``, de-duplicated on (group, item), which spreads them.
    """

    normal: DataFrame
    hot: DataFrame | None
    n_groups: int | None = None  # distinct non-NULL groups, when counted
    parts: int | None = None  # partitions that the pair work asks for
    counters: int | None = None  # partitions that the counting of pairs asks for
    rows: int | None = None  # member rows, about
    pairs: float | None = None  # candidate pairs, about
    pruned: bool = False  # whether items below a least count have left
    moved: bool = False  # whether a join by item has moved the rows of ``normal`` off their groups
    freq: DataFrame | None = None  # (item, freq), once the members carry it

    @property
    def often(self) -> int:
        """Groups from which an item's pairs are combined before the shuffle.

        An item in f groups has at most rows / f partners at least as frequent; a task forms f / parts rows with
        each of them or fewer, so combining can't pay below the root of rows * parts.
        """
        return max(MIN_OFTEN, math.isqrt(4 * (self.rows or 0) * (self.parts or 1)))

    def all(self) -> DataFrame:
        if self.hot is None:
            return self.normal
        return self.normal.unionByName(self.hot.drop("_nt"))


@dataclass
class Work:
    """Group sizes of a (group, _m) table as a histogram: (largest size, groups, sum of squared sizes) per class."""

    classes: list[tuple[int, int, float]]

    @property
    def groups(self) -> int:
        return sum(n for _, n, _ in self.classes)

    @property
    def pairs(self) -> float:
        """Candidate pairs of the self-join, about."""
        return sum(q for *_, q in self.classes) / 2

    @property
    def rows(self) -> int:
        """Rows of all groups: a class's groups taken as its largest, so a tenth too many at most."""
        return sum(m * n for m, n, _ in self.classes)

    def partitions(self, cores: int) -> int:
        """One per ``PAIRS_PER_TASK`` and per ``ROWS_PER_TASK``, and all cores once there is a tenth of the former for each."""
        least = max(math.ceil(self.pairs / PAIRS_PER_TASK), math.ceil(self.rows / ROWS_PER_TASK))
        return max(1, least, min(cores, math.ceil(self.pairs * 10 / PAIRS_PER_TASK)))

    def counters(self, cores: int) -> int:
        """Partitions of the pairs themselves: one per ``PAIRS_PER_COUNT``, and all cores as soon as the self-join has them."""
        return max(math.ceil(self.pairs / PAIRS_PER_COUNT), min(cores, self.partitions(cores)))

    def tile_rows(self, parts: int, most: int) -> int:
        """Largest group left whole: a ``TILES_PER_TASK``-th of a partition's work, within the two bounds."""
        share = math.isqrt(int(2 * self.pairs / (parts * TILES_PER_TASK)))
        return min(most, max(MIN_TILE_ROWS, share))

    def above(self, rows: int) -> int:
        """Groups with more rows than that, or of a class that has such."""
        return sum(n for m, n, _ in self.classes if m > rows)


def group_work(sizes: DataFrame) -> Work:
    """The histogram of a (group, _m) table: one small aggregate job, eight classes for each doubling of the size."""
    kind = F.floor(F.log2(F.greatest("_m", F.lit(1))) * 8)
    square = F.col("_m").cast("double") * F.col("_m")
    found = sizes.groupBy(kind.alias("kind")).agg(F.max("_m").alias("m"), F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"))
    return Work([(int(r["m"]), int(r["n"]), float(r["q"])) for r in found.collect()])


def split_members(
    df: DataFrame,
    group_col: str,
    item_col: str,
    dedupe: bool = True,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
    sizes: DataFrame | None = None,
    deal: int | None = None,
) -> Members:
    """Members of ordinary and of hot groups (see :class:`Members`).

    ``sizes`` (group, _m) defaults to :func:`row_counts`; it may over-count a
    group's distinct items, which only gives that group more, smaller tiles.
    With ``tile_rows`` set, groups are counted first (:func:`group_work`): their
    count doubles as the basket count N, and the pair work decides how many
    partitions there are and from which size below ``tile_rows`` on groups are tiled.
    ``deal`` sets the partitions of ``normal`` where they aren't those of a self-join.
    """
    rows = df.select(group_col, item_col).where(
        F.col(group_col).isNotNull() & F.col(item_col).isNotNull()
    )
    keys = [group_col, item_col]
    if tile_rows is None:
        return Members(_weigh(rows.repartition(group_col), keys, dedupe), None)
    sizes = sizes if sizes is not None else row_counts(df, group_col, item_col)
    work = group_work(sizes)
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_groups, parts = work.groups, work.partitions(cores)
    counted = {"n_groups": n_groups, "parts": parts, "counters": work.counters(cores), "rows": work.rows, "pairs": work.pairs}
    tile_rows = work.tile_rows(parts, tile_rows)
    n_hot = work.above(tile_rows)
    deal = deal or parts
    dealt = (deal, group_col) if deal > 1 else (group_col,)
    if n_hot == 0:
        return Members(_weigh(rows.repartition(*dealt), keys, dedupe), None, **counted)
    hot_groups = sizes.where(F.col("_m") > F.lit(tile_rows)).select(
        group_col, F.ceil(F.col("_m") / F.lit(tile_rows)).cast("int").alias("_nt")
    )
    if n_hot <= HOT_BROADCAST_ROWS:
        hot_groups = F.broadcast(hot_groups)
    tagged = rows.join(hot_groups, on=group_col, how="left")
    normal = tagged.where(F.col("_nt").isNull()).select(*keys).repartition(*dealt)
    hot = tagged.where(F.col("_nt").isNotNull())
    return Members(_weigh(normal, keys, dedupe), _weigh(hot, [*keys, "_nt"], dedupe), **counted)


def item_bounds(memb: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """Per item of a (group, item, _w) table: ``freq`` (sum of weights) and ``most``, which no pair count of the item passes.

    A basket adds w_a * w_b to a pair, at most w_a times the lesser of the basket's other weight and
    its largest weight.  A basket's two numbers come from a partial aggregate, so a hot one is no more than a row.
    """
    totals = memb.groupBy(group_col).agg(F.sum("_w").alias("_all"), F.max("_w").alias("_top"))
    seen = memb.join(totals, group_col)
    return seen.groupBy(item_col).agg(F.sum("_w").alias("freq"), F.sum(F.expr("_w * least(_all - _w, _top)")).alias("most"))


def reaching(
    df: DataFrame,
    group_col: str,
    item_col: str,
    dedupe: bool,
    least: Column,
    per: Column | None = None,
    memb: DataFrame | None = None,
) -> DataFrame:
    """(item, freq) of the items that a pair counting ``least`` (or that share of ``per``) may hold.

    In set form no pair counts more than its items' frequencies, in bag form not more than ``most``.
    Counts are divided as the pair counts will be, so rounding can't part the two.
    ``memb`` may pass the :func:`members` of ``df``.
    """
    memb = memb if memb is not None else members(df, group_col, item_col, dedupe)
    # one row per item, counted once however often the plans built on it read it
    stats = stage(item_totals(memb, item_col, "freq") if dedupe else item_bounds(memb, group_col, item_col), "item-counts")
    bound = F.col("freq" if dedupe else "most")
    bound = bound if per is None else bound.cast("double") / per
    return stats.where(bound >= least).select(item_col, "freq")


def rows_of(df: DataFrame, group_col: str, item_col: str, items: DataFrame) -> DataFrame:
    """The (group, item) rows of these items: what is split, tiled and joined after pruning."""
    return df.select(group_col, item_col).join(items.select(item_col), item_col, "left_semi")


def with_frequency(m: Members, freq: DataFrame, item_col: str) -> Members:
    """Members with their item's ``freq``, joined before the self-join; items that ``freq`` lacks leave.

    Member rows grow with the input, pair rows with its square: joined here, the
    frequencies ride through the pair count, and the pair table is shuffled
    once, for its aggregate, however many items there are.
    """
    own = freq.select(item_col, F.col("freq").alias("_f"))
    hot = m.hot.join(own, item_col) if m.hot is not None else None
    return replace(m, normal=m.normal.join(own, item_col), hot=hot, freq=freq, moved=True)


def _q(name: str) -> str:
    """Quote a column name for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def pair_rows(
    m: Members,
    group_col: str,
    item_col: str,
    *,
    a_col: str = "item_a",
    b_col: str = "item_b",
) -> DataFrame:
    """(group, a, b, w) for every a < b in the same group; w = w_a * w_b.

    Members that carry a frequency (:func:`with_frequency`) add (_fa, _fb).

    Ordinary groups: a self-join on the group over the already co-partitioned
    member table (no further shuffle).  Hot groups: the tiled join on
    (group, chunk_left, chunk_right).  Both sides are member tables, which
    grow with the data: they are never broadcast (AQE would, below its
    threshold, through the driver); a sort-merge join spills instead of
    failing when a partition is large.
    """
    g, it, a, b = _q(group_col), _q(item_col), _q(a_col), _q(b_col)
    f = "_f" in m.normal.columns
    out_cols = [f"_g AS {g}", a, b, "_wa * _wb AS _w", *(["_fa", "_fb"] if f else [])]
    fa, fb, own = (["_f AS _fa"], ["_f AS _fb"], ["_f"]) if f else ([], [], [])
    left = m.normal.selectExpr(f"{g} AS _g", f"{it} AS {a}", "_w AS _wa", *fa)
    right = m.normal.selectExpr(f"{g} AS _g", f"{it} AS {b}", "_w AS _wb", *fb)
    out = left.join(right.hint("merge"), on="_g").where(f"{a} < {b}").selectExpr(*out_cols)
    if m.hot is None:
        return out
    chunk = f"CAST(pmod(xxhash64({it}), _nt) AS INT)"
    chunked = m.hot.selectExpr(f"{g} AS _g", f"{it} AS _i", "_w", f"{chunk} AS _c", "_nt", *own)
    low = chunked.selectExpr("_g", "_i AS _x", "_w AS _wa", "_c AS _ci", "explode(sequence(_c, _nt - 1)) AS _cj", *fa)
    high = chunked.selectExpr("_g", "_i AS _y", "_w AS _wb", "explode(sequence(0, _c)) AS _ci", "_c AS _cj", *fb)
    # within a tile of one chunk both sides hold every item; between chunks a pair comes in either order
    keys = ["_g", "_ci", "_cj"]
    if m.parts is not None and m.parts > 1:
        low, high = low.repartition(m.parts, *keys), high.repartition(m.parts, *keys)
    met = low.join(high.hint("merge"), on=keys).where("_ci < _cj OR _x < _y")
    swapped = ["if(_x < _y, _fa, _fb) AS _fa", "if(_x < _y, _fb, _fa) AS _fb"] if f else []
    tiles = met.selectExpr("_g", f"least(_x, _y) AS {a}", f"greatest(_x, _y) AS {b}", "_wa", "_wb", *swapped)
    return out.unionByName(tiles.selectExpr(*out_cols))


def pair_lists(m: Members, group_col: str, item_col: str, owners: str | None = None, weights: bool = True, lean: bool = False) -> DataFrame:
    """(_x, _fx, _wx, _y, _fy, _wy): per member row, arrays of the items of its group that come after it by (frequency, item).

    Every unordered pair of a group is listed once, by its rarer item.  A listed partner takes an
    array element, a joined pair a row with both keys, so lists are what is shuffled to be counted.  ``owners`` keeps
    the lists of some members only.  The joins are those of :func:`pair_rows`, a group's
    (or chunk's) members being one row on the other side; a list is no longer than a group that isn't hot, or a chunk.
    Rows that a join by item has moved go back to their groups once for both sides, as plain rows.  Without ``weights`` there
    are no _wx, _wy; ``lean`` items are :class:`Codes` and bring no _fx, _fy.
    """
    g, it = _q(group_col), _q(item_col)
    held = [*([] if lean else ["_f"]), f"{it} AS _i", *(["_w"] if weights else [])]
    cols = [c.split(" AS ")[-1] for c in held]
    own = {c: f"_{c[1].replace('i', '')}x" for c in cols}  # _f, _i, _w: _fx, _x, _wx
    each = {c: own[c].replace("x", "y") for c in cols}
    entry = F.struct(*cols) if len(cols) > 1 else F.col("_i")
    part = {c: f"_l.{c}" if len(cols) > 1 else "_l" for c in cols}
    some = owners or "true"
    out_cols = [own[c] for c in cols] + [f"{part[c]} AS {each[c]}" for c in cols]

    # no item is NULL: said here, as the join would infer it for its left side and the two sides would part
    rows = m.normal.selectExpr(f"{g} AS _g", *held, f"({some}) AS _own").where("_i IS NOT NULL")
    if m.moved:
        rows = rows.repartition(*([m.parts] if m.parts is not None and m.parts > 1 else []), "_g")
    whole = rows.groupBy("_g").agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    left = rows.where("_own").selectExpr("_g", *[f"{c} AS {own[c]}" for c in cols])
    right = whole.selectExpr("_g", *[f"{part[c]} AS {c}s" for c in cols])
    at = "CAST(array_position(_is, _x) AS INT)"
    rest = [f"slice({c}s, {at} + 1, size(_is)) AS {each[c]}" for c in cols]
    out = left.join(right.hint("merge"), on="_g").where(f"{at} < size(_is)").selectExpr(*own.values(), *rest)
    if m.hot is None:
        return out
    chunk, every = f"CAST(pmod(xxhash64({it}), _nt) AS INT)", "explode(sequence(0, _nt - 1))"
    keys = ["_g", "_ci", "_cj"]
    low = m.hot.where(some).selectExpr(f"{g} AS _g", *held, f"{chunk} AS _ci", f"{every} AS _cj")
    low = low.selectExpr(*keys, *[f"{c} AS {own[c]}" for c in cols])
    high = m.hot.selectExpr(f"{g} AS _g", *held, f"{every} AS _ci", f"{chunk} AS _cj")
    if m.parts is not None and m.parts > 1:
        low, high = low.repartition(m.parts, *keys), high.repartition(m.parts, *keys)
    chunks = high.groupBy(*keys).agg(F.collect_list(entry).alias("_l"))
    later = "e._f > _fx OR (e._f = _fx AND e._i > _x)" if not lean else "e._i > _x" if weights else "e > _x"
    after = f"filter(_l, e -> {later}) AS _l"
    tiles = low.join(chunks.hint("merge"), on=keys).selectExpr(*own.values(), after).where("size(_l) > 0")
    return out.unionByName(tiles.selectExpr(*out_cols))


def _count_lists(lists: DataFrame, dedupe: bool, frequency: bool, counters: int | None) -> DataFrame:
    """(_x, _y, _n[, _fx, _fy]) of :func:`pair_lists`, shuffled by the item that lists."""
    extra = [*(["_fx", "_fy"] if frequency else []), *([] if dedupe else ["_wx", "_wy"])]
    rows = lists.select("_x", "_y", *extra)
    dealt = (counters, "_x") if counters is not None and counters > 1 else ("_x",)
    return _count_rows(_listed_rows(rows.repartition(*dealt), dedupe, frequency), dedupe, frequency)


def _listed_rows(lists: DataFrame, dedupe: bool, frequency: bool) -> DataFrame:
    """A row per listed pair: (_x, _y[, _fx, _fy][, _w])."""
    carried = [*(["_fx", "_fy[_at] AS _fy"] if frequency else []), *([] if dedupe else ["_wx * _wy[_at] AS _w"])]
    each = lists.selectExpr("*", "posexplode(_y) AS (_at, _one)")
    return each.selectExpr("_x", "_one AS _y", *carried)


def _count_rows(rows: DataFrame, dedupe: bool, frequency: bool) -> DataFrame:
    agg = F.count(F.lit(1)) if dedupe else F.sum("_w")
    carried = [F.max(c).alias(c) for c in ("_fx", "_fy")] if frequency else []  # the same in all rows of a pair
    return rows.groupBy("_x", "_y").agg(agg.alias("_n"), *carried)


@dataclass
class Codes:
    """Whole numbers that stand for (frequency, item), in that order: an item's offset from ``low`` in ``bits`` bits, its frequency above."""

    low: int
    bits: int
    kind: str  # int, or bigint where 31 bits don't hold both

    @staticmethod
    def of(low: int, high: int, most: int) -> Codes | None:
        """For items from ``low`` to ``high`` of frequencies up to ``most``, if a long holds both."""
        bits = (high - low).bit_length()
        whole = bits + most.bit_length()
        return None if whole > 62 or max(abs(low), abs(high)) >= 2**62 else Codes(low, bits, "int" if whole <= 31 else "bigint")

    def encode(self, item_col: str) -> Column:
        """The code of a member row that carries ``_f``."""
        return F.expr(f"CAST(shiftleft(_f, {self.bits}) | (CAST({_q(item_col)} AS BIGINT) - ({self.low}L)) AS {self.kind})")

    def item(self, code: str, kind: str) -> str:
        return f"CAST((CAST({code} AS BIGINT) & {2**self.bits - 1}L) + ({self.low}L) AS {kind})"

    def frequency(self, code: str) -> str:
        return f"shiftright(CAST({code} AS BIGINT), {self.bits})"


def coded(m: Members, item_col: str, codes: Codes) -> Members:
    """The members under their items' codes."""
    code = codes.encode(item_col)
    hot = m.hot.withColumn(item_col, code) if m.hot is not None else None
    return replace(m, normal=m.normal.withColumn(item_col, code), hot=hot)


def listed_counts(m: Members, group_col: str, item_col: str, dedupe: bool, frequency: bool, below: float | None = None) -> DataFrame:
    """(_x, _y, _n[, _fx, _fy]) for every unordered pair of items with a group in common, in either order.

    Pairs of items that few groups hold hardly repeat within a task: their lists are shuffled as they are.  Pairs of
    items from :attr:`Members.often` groups on repeat, and are few: they are counted in the join's stage first.
    Whole-number items are listed and counted as :class:`Codes`, one number of half the size in place of item and frequency.
    ``below`` leaves out pairs of two items of that frequency or more: those whose rarer item, which lists, has it.
    """
    often = m.often
    whole = m.freq.schema[item_col].dataType.simpleString()
    ranges = [f"min({_q(item_col)}) AS low", f"max({_q(item_col)}) AS high"] if whole in ("tinyint", "smallint", "int", "bigint") else []
    found = m.freq.agg(
        F.count_if(F.col("freq") >= F.lit(often)).alias("o"), F.count(F.lit(1)).alias("n"), F.max("freq").alias("most"), *map(F.expr, ranges)
    ).first()
    codes = Codes.of(found["low"], found["high"], found["most"]) if ranges and found["n"] else None
    if codes is None:
        return _counted_as(m, group_col, item_col, dedupe, frequency, often, found, below)
    counts = _counted_as(coded(m, item_col, codes), group_col, item_col, dedupe, False, often, found, below, codes)
    carried = [f"{codes.frequency(c)} AS _f{c[1:]}" for c in ("_x", "_y")] if frequency else []
    return counts.selectExpr(f"{codes.item('_x', whole)} AS _x", f"{codes.item('_y', whole)} AS _y", "_n", *carried)


def _counted_as(
    m: Members,
    group_col: str,
    item_col: str,
    dedupe: bool,
    frequency: bool,
    often: int,
    found: Row,
    below: float | None,
    codes: Codes | None = None,
) -> DataFrame:
    n_often = n_items = 0
    if m.rows is not None and (m.pruned or m.n_groups is None or m.n_groups > often):  # no item has more groups than there are
        n_often, n_items = found["o"], found["n"]
        if m.n_groups and 2 * n_items * n_items * (m.parts or 1) < m.rows * (m.rows / m.n_groups - 1):
            often, n_often = 0, n_items  # few items: a task's pairs repeat, whichever they are
    f = "_f" if codes is None else codes.frequency(_q(item_col))

    def lists(*owners: str) -> DataFrame:
        some = [*owners, *([] if below is None else [f"{f} < CAST({float(below)!r} AS DOUBLE)"])]
        return pair_lists(m, group_col, item_col, " AND ".join(some) or None, not dedupe, codes is not None)

    if n_often == 0 or (below is not None and below <= often):
        return _count_lists(lists(), dedupe, frequency, m.counters)
    every = n_often >= n_items
    combined = _count_rows(_listed_rows(lists(*([] if every else [f"{f} >= {often}"])), dedupe, frequency), dedupe, frequency)
    if every:
        return combined
    return combined.unionByName(_count_lists(lists(f"{f} < {often}"), dedupe, frequency, m.counters))


def mirror(
    pairs: DataFrame,
    a_col: str,
    b_col: str,
    rest: list[str],
    swap: list[tuple[str, str]] = (),
) -> DataFrame:
    """Both directions of every a < b row, in one pass (no union, no rescan).

    ``rest`` columns are copied as they are (symmetric values); each pair in
    ``swap`` (say the two item frequencies) trades places in the b -> a row.
    """

    def row(first: str, second: str, swapped: bool) -> str:
        fields = [(a_col, first), (b_col, second)] + [(c, c) for c in rest]
        for x, y in swap:
            fields += [(x, y), (y, x)] if swapped else [(x, x), (y, y)]
        return "named_struct(" + ", ".join(f"'{name}', {_q(src)}" for name, src in fields) + ")"

    both = f"inline(array({row(a_col, b_col, False)}, {row(b_col, a_col, True)}))"
    return pairs.selectExpr(both)


def item_stats(memb: DataFrame, item_col: str) -> DataFrame:
    """Per item: ``freq`` = sum of weights and ``freq_sq`` = sum of squared
    weights (the bag-form diagonal), in one aggregate."""
    return memb.groupBy(item_col).agg(
        F.sum("_w").alias("freq"), F.sum(F.col("_w") * F.col("_w")).alias("freq_sq")
    )


def pair_counts(
    df: DataFrame,
    group_col: str,
    item_col: str,
    *,
    dedupe: bool = True,
    ordered: bool = True,
    diagonal: bool = False,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
    a_col: str = "item_a",
    b_col: str = "item_b",
    count_col: str = "n",
    memb: Members | None = None,
    sizes: DataFrame | None = None,
    min_count: int | None = None,
) -> DataFrame:
    """Groups holding both items, per item pair: (a, b, n).

    ``dedupe``: set semantics (default) or bag semantics, where an item
    repeated k times in a group counts k times.  ``ordered``: emit (a, b) and
    (b, a); otherwise only a < b.  ``diagonal``: add (a, a) rows (groups
    holding a, or the sum of squared repeats in bag form).  ``memb`` may pass
    a :func:`split_members` result shared with other outputs; members with a
    frequency add the columns (_fa, _fb) (``ordered=False`` only).
    ``min_count`` keeps pairs that count at least as much (no diagonal then); items
    that can't reach it leave first, so groups are sized and tiled without them.
    """
    if min_count is not None and memb is None:
        df = rows_of(df, group_col, item_col, reaching(df, group_col, item_col, dedupe, F.lit(int(min_count))))
        sizes = None
        memb = replace(split_members(df, group_col, item_col, dedupe, tile_rows), pruned=True)
    memb = memb if memb is not None else split_members(df, group_col, item_col, dedupe, tile_rows, sizes)
    frequency = "_f" in memb.normal.columns
    if not frequency and memb.pairs is not None and memb.pairs <= LIST_PAIRS * memb.rows:
        # small groups: a member row has few pairs, and joining frequencies would move more than lists save
        rows = pair_rows(memb, group_col, item_col, a_col="_x", b_col="_y")
        return _outcome(_count_rows(rows, dedupe, False), memb, item_col, dedupe, ordered, diagonal, False, a_col, b_col, count_col, min_count)
    own = memb if frequency else with_frequency(memb, item_totals(memb.all(), item_col), item_col)
    counts = listed_counts(own, group_col, item_col, dedupe, frequency and not ordered)
    return _outcome(counts, memb, item_col, dedupe, ordered, diagonal, frequency, a_col, b_col, count_col, min_count)


def ordered_pairs(counts: DataFrame, a_col: str, b_col: str, count_col: str, frequency: bool = True) -> DataFrame:
    """(a, b, n[, _fa, _fb]) for a < b of (_x, _y, _n[, _fx, _fy]), whose items come in either order."""
    ends = [f"least(_x, _y) AS {_q(a_col)}", f"greatest(_x, _y) AS {_q(b_col)}", f"_n AS {_q(count_col)}"]
    turned = ["if(_x < _y, _fx, _fy) AS _fa", "if(_x < _y, _fy, _fx) AS _fb"] if frequency else []
    return counts.selectExpr(*ends, *turned)


def _outcome(
    counts: DataFrame,
    memb: Members,
    item_col: str,
    dedupe: bool,
    ordered: bool,
    diagonal: bool,
    frequency: bool,
    a_col: str,
    b_col: str,
    count_col: str,
    min_count: int | None,
) -> DataFrame:
    """The columns and rows that :func:`pair_counts` promises, from (_x, _y, _n[, _fx, _fy])."""
    if ordered:
        counts = counts.selectExpr(f"_x AS {_q(a_col)}", f"_y AS {_q(b_col)}", f"_n AS {_q(count_col)}")
        counts = mirror(counts, a_col, b_col, [count_col])
    else:
        counts = ordered_pairs(counts, a_col, b_col, count_col, frequency)
    if diagonal and min_count is None:
        diag = item_totals(memb.all(), item_col, count_col, square=not dedupe).select(
            F.col(item_col).alias(a_col), F.col(item_col).alias(b_col), F.col(count_col)
        )
        counts = counts.unionByName(diag)
    return counts if min_count is None else counts.where(F.col(count_col) >= F.lit(int(min_count)))
