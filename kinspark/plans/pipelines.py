"""End-to-end pipelines: retail rules, basket rules, similarities, ALS evaluation.

The ``run_*`` functions write every output under a folder.  A table that feeds
several outputs (lines, rules, ratings) is written once and read back: lineage is
cut, and the quadratic join and the joins behind it run once.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinspark.operators.baskets import basket_count_col, flatten_baskets, item_support
from kinspark.operators.collab import collaborative_similarity
from kinspark.operators.content import content_similarity
from kinspark.operators.ratings import error_metrics, fit_als, hash_split, predict
from kinspark.operators.retail import (
    distinct_countries,
    item_catalog,
    item_descriptions,
    retail_baskets,
    retail_summary,
)
from kinspark.operators.rules import (
    METRICS,
    association_rules,
    described_rules,
    rule_stats,
    rules_per_antecedent,
    rules_with_descriptions,
    stat_columns,
    top_lists,
    top_rules,
)
from kinspark.session import stage
from kinspark.sources.sinks import rule_lines, to_lines, write_table

TOP_K = 100

FOLDERS = {"catalog": "items_map"}  # outputs whose folder has another name than their field


@dataclass
class RetailRules:
    summary: DataFrame
    countries: DataFrame
    catalog: DataFrame
    item_support: DataFrame
    rules: DataFrame
    rules_with_descriptions: DataFrame
    per_antecedent: DataFrame
    stats: DataFrame
    top_support: DataFrame
    top_confidence: DataFrame
    top_lift: DataFrame


def write_rules(rules: DataFrame, path: str) -> DataFrame:
    """Write the rules as Parquet and return their :func:`rule_stats`, gathered by the write itself.

    The statistics are observed in the stage that writes, so the rules are neither planned nor read again for them.
    """
    seen = Observation("rule statistics")
    write_table(rules.observe(seen, *stat_columns()), path)
    schema = "n_rules bigint, " + ", ".join(f"{f}_{m} double" for m in METRICS for f in ("min", "max", "mean"))
    found = {"n_rules": 0, **seen.get}
    columns = [c.split()[0] for c in schema.split(", ")]
    return rules.sparkSession.createDataFrame([tuple(found.get(c) for c in columns)], schema)


def retail_rules(
    lines: DataFrame,
    *,
    dedupe: bool = True,
    k: int = TOP_K,
    rules: DataFrame | None = None,
    stats: DataFrame | None = None,
    lists: DataFrame | None = None,
    supports: DataFrame | None = None,
) -> RetailRules:
    """Summary, catalogue, item support, rules, their statistics, descriptions and the three top-k lists.

    Pass ``rules`` to reuse a rule table already written, ``stats`` and ``lists`` (a :func:`top_lists`
    table) to reuse what came with it, ``supports`` to reuse the item support (see :func:`run_retail_rules`);
    otherwise all are planned from ``lines``.
    """
    baskets = retail_baskets(lines)
    if rules is None:
        rules = association_rules(baskets, dedupe=dedupe)
    desc = item_descriptions(lines)

    def top(metric: str) -> DataFrame:
        best = top_rules(rules, metric, k) if lists is None else lists.where(F.col("metric") == metric)
        return rules_with_descriptions(best, desc)

    return RetailRules(
        summary=retail_summary(lines),
        countries=distinct_countries(lines),
        catalog=item_catalog(lines),
        item_support=item_support(baskets, dedupe=dedupe) if supports is None else supports,
        rules=rules,
        rules_with_descriptions=described_rules(rules, desc, supports=supports),
        per_antecedent=rules_per_antecedent(rules),
        stats=rule_stats(rules) if stats is None else stats,
        top_support=top("support"),
        top_confidence=top("confidence"),
        top_lift=top("lift"),
    )


def run_retail_rules(spark: SparkSession, lines: DataFrame, out_dir: str, *, dedupe: bool = True, fmt: str = "parquet") -> RetailRules:
    """Write every retail output under ``out_dir``: lines are staged and the rules written first,
    everything else comes from those copies.  The write of the rules yields their statistics, and one more
    scan of them the three top-k lists.  The described rules are lines of text, some 140 bytes each as they are:
    their files are gzipped."""
    lines = stage(lines, "retail-lines")
    stats = write_rules(association_rules(retail_baskets(lines), dedupe=dedupe), f"{out_dir}/rules")
    rules = spark.read.parquet(f"{out_dir}/rules")
    lists = stage(top_lists(rules, TOP_K), "top-lists")
    supports = stage(item_support(retail_baskets(lines), dedupe=dedupe), "item-support")
    res = retail_rules(lines, dedupe=dedupe, rules=rules, stats=stats, lists=lists, supports=supports)
    described = rule_lines(res.rules_with_descriptions, with_descriptions=True)
    write_table(described, f"{out_dir}/rules_with_item_desc", fmt="text", compression="gzip")
    for f in fields(res):
        if f.name not in ("rules", "rules_with_descriptions"):
            write_table(getattr(res, f.name), f"{out_dir}/{FOLDERS.get(f.name, f.name)}", fmt=fmt)
    return res


@dataclass
class BasketRules:
    rules: DataFrame
    per_antecedent: DataFrame
    stats: DataFrame


def basket_rules(
    baskets: DataFrame,
    *,
    listed: bool,
    dedupe: bool = True,
    trans_col: str = "trans_id",
    item_col: str = "item",
    rules: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> BasketRules:
    """Rules, rules per antecedent and rule statistics for basket input.

    ``listed=True``: rows are (trans_id, items[]) lines, flattened here, and
    N counts lines.  ``listed=False``: rows are (trans_id, item), N counts
    distinct ids.  Pass ``rules`` to reuse a written rule table (see
    :func:`run_basket_rules`).
    """
    if rules is None:
        flat = flatten_baskets(baskets, trans_col, "items", item_col) if listed else baskets
        n = basket_count_col(baskets, trans_col, by="rows") if listed else None
        rules = association_rules(flat, trans_col, item_col, dedupe=dedupe, n_baskets=n)
    return BasketRules(
        rules=rules, per_antecedent=rules_per_antecedent(rules), stats=rule_stats(rules) if stats is None else stats
    )


def run_basket_rules(spark: SparkSession, baskets: DataFrame, out_dir: str, *, listed: bool, fmt: str = "parquet") -> BasketRules:
    """Write the rules, and from the written copy the rules per antecedent; the write yields the statistics."""
    stats = write_rules(basket_rules(baskets, listed=listed).rules, f"{out_dir}/rules")
    res = basket_rules(baskets, listed=listed, rules=spark.read.parquet(f"{out_dir}/rules"), stats=stats)
    write_table(res.per_antecedent, f"{out_dir}/per_antecedent", fmt=fmt)
    write_table(res.stats, f"{out_dir}/stats", fmt=fmt)
    return res


SIMILARITIES = "Similarities"  # Fixed value: the name of the original output folder


def run_collaborative_similarities(ratings: DataFrame, out_dir: str, **options) -> DataFrame:
    """Write item pairs with their collaborative scores as text lines."""
    lines = to_lines(collaborative_similarity(ratings, **options), ["item_a", "item_b", "jaccard", "euclid", "cosine"])
    write_table(lines, f"{out_dir}/{SIMILARITIES}", fmt="text")
    return lines


def run_content_similarities(items: DataFrame, out_dir: str, **options) -> DataFrame:
    """Write item pairs with their content scores as text lines; pass ``min_score`` or ``top_k`` to bound them."""
    lines = to_lines(content_similarity(items, **options), ["item_a", "item_b", "jaccard", "euclid", "cosine"])
    write_table(lines, f"{out_dir}/{SIMILARITIES}", fmt="text")
    return lines


@dataclass
class AlsEvaluation:
    predictions: DataFrame
    metrics: DataFrame
    model: ALSModel
    train: DataFrame


def evaluate_als(
    ratings: DataFrame,
    *,
    seed: int = 42,
    train: DataFrame | None = None,
    test: DataFrame | None = None,
    **als_params,
) -> AlsEvaluation:
    """Split 80/20 by a hash of the key, fit ALS on the train part, predict the test part, and
    measure RMSE / MAE over the non-NaN predictions.  Ratings and predictions are staged, so what
    is behind them runs once."""
    if train is None or test is None:
        train, test = hash_split(stage(ratings, "ratings"))
    model = fit_als(train, seed=seed, **als_params)
    pred = stage(predict(model, test), "predictions")
    return AlsEvaluation(predictions=pred, metrics=error_metrics(pred), model=model, train=train)
