"""Pairwise association rules: support, confidence, lift, top-k, summaries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinspark.functions.measures import confidence_sql, lift_sql
from kinspark.operators.baskets import _n_col
from kinspark.operators.bitmaps import split_few_counts, split_pair_counts
from kinspark.operators.pairs import (
    DEFAULT_TILE_ROWS,
    LIST_PAIRS,
    group_work,
    item_totals,
    members,
    mirror,
    ordered_pairs,
    pair_counts,
    reaching,
    row_counts,
    rows_of,
    split_members,
    with_frequency,
)
from kinspark.operators.products import FEW_ITEMS, few_pair_counts
from kinspark.session import stage

RULE_COLUMNS = ["antecedent", "consequent", "ant_support", "cons_support", "support", "confidence", "lift"]
METRICS = ("support", "confidence", "lift")

#: Parts that rules are ranked in first when lists are longer than the window group limit.
LIST_SALTS = 256


def association_rules(
    flat: DataFrame,
    trans_col: str = "trans_id",
    item_col: str = "item",
    *,
    dedupe: bool = True,
    n_baskets: int | Column | None = None,
    min_support: float | None = None,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
    dense_share: float | None = None,
) -> DataFrame:
    """All 1 -> 1 rules a -> b (a != b) over baskets of (trans, item) rows.

    support = n(a, b) / N, confidence = support / support(a),
    lift = support / (support(a) * support(b)).  N defaults to the number of
    distinct transaction ids, also of those without an item (the same N as
    ``basket_count`` and ``item_support``); pass ``n_baskets`` for the
    listed-file meaning (lines).  ``dedupe=False`` keeps the bag counts of the original
    programs, where repeats inflate counts and support can pass 1.
    ``min_support`` (off by default) keeps rules of at least that support; items
    whose pairs can't reach it leave the baskets before the self-join; where few items are left in large baskets,
    their pairs are counted by matrix products in its place (:mod:`kinspark.operators.products`).
    ``dense_share`` (set form, off by default) counts pairs of items that this share of the
    baskets holds by bit arrays (:mod:`kinspark.operators.bitmaps`).
    """
    if dense_share is not None and not dedupe:
        raise ValueError("dense_share needs the set form: a bit holds no multiplicity")
    if min_support is not None:
        n = F.lit(row_counts(flat, trans_col, item_col).count()) if n_baskets is None else _n_col(flat, trans_col, n_baskets)
        # weighed once for the bounds and for products: the rows are read several times
        held = stage(members(flat, trans_col, item_col, dedupe), "members")
        freq = reaching(flat, trans_col, item_col, dedupe, F.lit(float(min_support)), n, held)
        n_items = freq.count()
        if n_items <= FEW_ITEMS and tile_rows is not None:
            rows = held.join(F.broadcast(freq.select(item_col)), item_col, "left_semi")
            work = group_work(rows.groupBy(trans_col).agg(F.count(F.lit(1)).alias("_m")))
            if work.pairs > LIST_PAIRS * work.rows:
                counted = {"n_items": n_items, "n_rows": work.rows}
                if dense_share is None:
                    pairs = few_pair_counts(rows, freq, trans_col, item_col, **counted)
                else:
                    counted |= {"n_groups": work.groups, "share": dense_share, "tile_rows": tile_rows}
                    pairs = split_few_counts(rows, freq, trans_col, item_col, **counted)
                return rules_from_counts(ordered_pairs(pairs, "antecedent", "consequent", "_n"), n, min_support=min_support)
        memb = split_members(rows_of(flat, trans_col, item_col, freq), trans_col, item_col, dedupe, tile_rows)
        memb = replace(memb, pruned=True)
    else:
        memb = split_members(flat, trans_col, item_col, dedupe, tile_rows)
        if n_baskets is not None:
            n = _n_col(flat, trans_col, n_baskets)
        elif memb.n_groups is not None:
            n = F.lit(memb.n_groups)  # counted with the hot-basket check
        else:
            n = row_counts(flat, trans_col, item_col).select(F.count(F.lit(1))).scalar()
        freq = item_totals(memb.all(), item_col, "freq")
    if dense_share is not None:
        # the groups that bits are dealt over: those with a row left
        n_groups = memb.n_groups if memb.n_groups is not None else memb.all().select(trans_col).distinct().count()
        half = split_pair_counts(
            memb,
            freq,
            trans_col,
            item_col,
            n_groups=n_groups,
            share=dense_share,
            tile_rows=tile_rows,
            a_col="antecedent",
            b_col="consequent",
            count_col="_n",
        )
        return rules_from_counts(half, n, min_support=min_support)
    # counts for a < b only, with the two frequencies, then mirrored
    half = pair_counts(
        flat,
        trans_col,
        item_col,
        dedupe=dedupe,
        ordered=False,
        tile_rows=tile_rows,
        a_col="antecedent",
        b_col="consequent",
        count_col="_n",
        memb=with_frequency(memb, freq, item_col),
    )
    return rules_from_counts(half, n, min_support=min_support)


def rules_from_counts(half: DataFrame, n: int | Column, *, min_support: float | None = None) -> DataFrame:
    """Rules from pair counts (antecedent < consequent, ``_n``) with the two
    item frequencies (``_fa``, ``_fb``), and the basket count ``n``.

    Rows are mirrored; support and lift are symmetric, confidence is computed
    per direction.
    """
    n = n if isinstance(n, Column) else F.lit(int(n))
    if min_support is not None:
        half = half.where(F.col("_n").cast("double") / n >= F.lit(float(min_support)))
    both = mirror(half, "antecedent", "consequent", ["_n"], swap=[("_fa", "_fb")])
    sup, ant_sup, cons_sup = (f"CAST({c} AS DOUBLE) / _nbaskets" for c in ("_n", "_fa", "_fb"))
    return both.select("*", n.alias("_nbaskets")).selectExpr(
        "antecedent",
        "consequent",
        f"{ant_sup} AS ant_support",
        f"{cons_sup} AS cons_support",
        f"{sup} AS support",
        f"{confidence_sql(sup, ant_sup)} AS confidence",
        f"{lift_sql(sup, ant_sup, cons_sup)} AS lift",
    )


def top_rules(rules: DataFrame, metric: str = "support", k: int = 100) -> DataFrame:
    """The k rules with the largest ``metric``; ties by antecedent, consequent.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own top k, only k rows per partition reach the final merge.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    return rules.orderBy(F.desc(metric), F.asc("antecedent"), F.asc("consequent")).limit(k)


def top_lists(rules: DataFrame, k: int = 100, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(metric, place, rule columns): the k best rules by each metric, from one scan of the rules.

    Each list is that of :func:`top_rules`, ties included.  A rule becomes one row per metric, and
    a task sends at most k rows per metric to the ranking: Spark's window group limit drops the
    others before the shuffle.  It is bounded by a setting, so longer lists are ranked per salt first.
    """
    for m in metrics:
        if m not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}, not {m!r}")
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    ranked = rules.select(*RULE_COLUMNS, each.alias("_e")).select("_e.metric", "_e.value", *RULE_COLUMNS)
    order = [F.desc("value"), F.asc("antecedent"), F.asc("consequent")]
    if k > int(rules.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salt = F.pmod(F.xxhash64("antecedent", "consequent"), F.lit(LIST_SALTS))
        local = F.row_number().over(Window.partitionBy("metric", salt).orderBy(*order))
        ranked = ranked.withColumn("_local", local).where(F.col("_local") <= k).drop("_local")
    place = F.row_number().over(Window.partitionBy("metric").orderBy(*order))
    best = ranked.withColumn("place", place).where(F.col("place") <= k)
    return best.select("metric", F.col("place").cast("bigint").alias("place"), *RULE_COLUMNS)


def rules_per_antecedent(rules: DataFrame) -> DataFrame:
    """(antecedent, n_rules)."""
    return rules.groupBy("antecedent").agg(F.count(F.lit(1)).alias("n_rules"))


def stat_columns(mean_digits: int | None = None) -> list[Column]:
    """The aggregates of :func:`rule_stats`, also for a write that is observed."""
    aggs = [F.count(F.lit(1)).alias("n_rules")]
    for m in METRICS:
        mean = F.avg(m)
        if mean_digits is not None:
            mean = F.round(mean, mean_digits)
        aggs += [F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}"), mean.alias(f"mean_{m}")]
    return aggs


def rule_stats(rules: DataFrame, mean_digits: int | None = None) -> DataFrame:
    """One row: rule count and min / max / mean of support, confidence, lift.

    Empty input gives n_rules 0 and NULL statistics.  Means are sums of
    doubles, whose last bits depend on summation order; ``mean_digits``
    rounds them for comparisons across engines.
    """
    return rules.agg(*stat_columns(mean_digits))


def rules_with_descriptions(
    rules: DataFrame, catalog: DataFrame, item_col: str = "stock_code", desc_col: str = "description"
) -> DataFrame:
    """Rules plus ``ant_description`` / ``cons_description`` (NULL when unknown).

    ``catalog`` must hold one row per item (see ``item_descriptions``), so the
    left joins never multiply rules.  The catalog has one row per distinct
    item, far smaller than the rule table; AQE broadcasts it when it is under
    the broadcast threshold.
    """
    ant = catalog.select(F.col(item_col).alias("antecedent"), F.col(desc_col).alias("ant_description"))
    cons = catalog.select(F.col(item_col).alias("consequent"), F.col(desc_col).alias("cons_description"))
    out = rules.join(ant, "antecedent", "left").join(cons, "consequent", "left")
    return out.select(*RULE_COLUMNS, "ant_description", "cons_description")


def described_rules(
    rules: DataFrame,
    catalog: DataFrame,
    item_col: str = "stock_code",
    desc_col: str = "description",
    supports: DataFrame | None = None,
) -> DataFrame:
    """:func:`rules_with_descriptions` of a table that holds every rule in both directions.

    Only a < b rows are joined to the catalogue, which is a shuffle of the rules for each of the two items where
    the catalogue is too large to broadcast; the other direction swaps supports and descriptions, and confidence
    and lift are divided as the rules' own were.  ``supports``, an (item, support) table with every item of the
    rules, spares the shuffles the two supports too: they come with the descriptions.
    """
    items = catalog.select(F.col(item_col).alias("_item"), F.col(desc_col).alias("description"))
    carried = ["ant_support", "cons_support"]
    if supports is not None:
        item, support = supports.columns
        items = supports.select(F.col(item).alias("_item"), F.col(support).alias("support")).join(items, "_item", "left")
        carried = []
    found = rules.where("antecedent < consequent").select("antecedent", "consequent", *carried, "support")
    for end, side in (("antecedent", "ant"), ("consequent", "cons")):
        known = [F.col(c).alias(f"{side}_{c}") for c in items.columns if c != "_item"]
        found = found.join(items.select(F.col("_item").alias(end), *known), end, "left")
    swap = [("ant_support", "cons_support"), ("ant_description", "cons_description")]
    both = mirror(found, "antecedent", "consequent", ["support"], swap=swap)
    confidence = F.expr(confidence_sql("support", "ant_support")).alias("confidence")
    lift = F.expr(lift_sql("support", "ant_support", "cons_support")).alias("lift")
    return both.select("*", confidence, lift).select(*RULE_COLUMNS, "ant_description", "cons_description")
