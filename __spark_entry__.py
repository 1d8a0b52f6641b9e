"""

``entry(spark)`` runs the flagship query (top 100 rules by lift) on sf0.001.
``queries()`` maps every operator of the inventory to a callable
(spark, sf_dir) -> DataFrame over the driver's tables; ``oracle_sql()`` gives
the same result in DuckDB SQL where one exists.  Column names and types agree
between the two sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinspark.operators import basket_store as BS  # noqa: E402
from kinspark.operators import baskets as B  # noqa: E402
from kinspark.operators import collab as CO  # noqa: E402
from kinspark.operators import content as CT  # noqa: E402
from kinspark.operators import ratings as RA  # noqa: E402
from kinspark.operators import retail as RT  # noqa: E402
from kinspark.operators import rules as R  # noqa: E402
from kinspark.plans import pipelines as P  # noqa: E402
from kinspark.plans import views as V  # noqa: E402
from kinspark.sources import readers as RD  # noqa: E402
from kinspark.session import shared_path, stage  # noqa: E402
from kinspark.sources.sinks import rule_lines, write_table  # noqa: E402

try:  # the text operators are an optional part
    from kinspark.llm import queries as LLM  # noqa: E402
except ImportError as missing:
    if missing.name not in ("kinspark.llm", "corpus_pipeline"):
        raise  # present, but something it needs is not
    LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"
TOP_K = 100
MIN_SCORE = 0.1  # of the item-level content pairs; without a bound they grow with the square of the items
MIN_SUPPORT, MIN_SUPPORT_BAG = 0.1, 5.0  # of the rules between words of documents
DENSE_USERS, DENSE_DOCS = 1 / 32, 0.25  # shares from which items are counted by bit arrays
ALS_RESIDUAL = 1e-4  # of the normal equations of a float factor row
DIGITS = 9  # rounding of order-dependent double sums (means, RMSE, MAE)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 100 strongest rules by lift over sf0.001 order baskets."""
    return _top_lift(spark, SMOKE_DIR)


# --------------------------------------------------------------- rule queries


def _rules(spark, d, dedupe=True):
    return R.association_rules(V.flat_basket(spark, d), dedupe=dedupe)


def _top_lift(spark, d):
    return R.top_rules(_rules(spark, d), "lift", TOP_K)


def _retail_rules(spark, d):
    return P.retail_rules(V.retail(spark, d)).top_lift


def _rules_with_desc(spark, d):
    # joined once: sizes, frequencies, pairs and descriptions each read them
    lines = stage(V.retail(spark, d).select("invoice", "stock_code", "description"), "retail-lines")
    rules = R.association_rules(RT.retail_baskets(lines))
    return R.described_rules(rules, RT.item_descriptions(lines))


def _basket_pairs(spark, d):
    return B.basket_pairs(V.flat_basket(spark, d), dedupe=False)


def _store(spark, flat):
    """The baskets written as a bucketed store, and opened again."""
    path = shared_path(spark, "basket-store")
    BS.write_baskets(flat, path).forget()
    return BS.open_baskets(spark, path)


# ------------------------------------------------------------ content queries


def _content_sets(spark, d):
    return CT.content_set_similarity(V.item_features(spark, d))


def _content_measure(measure):
    def run(spark, d):
        sp = _content_sets(spark, d)
        return sp.select(
            F.array_join("set_a", "|").alias("set_a"), F.array_join("set_b", "|").alias("set_b"), measure
        )

    return run


def _content_similarity(spark, d):
    return CT.content_similarity(V.item_features(spark, d), min_score=MIN_SCORE)


def _nonzero_pair_count(spark, d):
    sp = _content_sets(spark, d).where(F.col("jaccard") > 0)
    return sp.agg(F.sum(F.col("items_a") * F.col("items_b")).cast("bigint").alias("n_pairs"))


# ------------------------------------------------------- collaborative queries


def _implicit(spark, d):
    """The ratings, joined once: sizes, frequencies and pairs each read them."""
    return stage(V.implicit(spark, d), "ratings")


def _collab(spark, d, dedupe=True):
    return CO.collaborative_similarity(_implicit(spark, d), dedupe=dedupe)


def _collab_measure(measure):
    def run(spark, d):
        return _collab(spark, d).select("item_a", "item_b", measure)

    return run


def _user_similarity(spark, d):
    return CO.collaborative_similarity(_implicit(spark, d), user_col="item", item_col="user").select(
        F.col("item_a").alias("user_a"), F.col("item_b").alias("user_b"), "n", "jaccard", "euclid", "cosine"
    )


# ------------------------------------------------------------- rating queries


def _split(spark, d):
    return RA.hash_split(V.rating(spark, d))


def _rating_split(spark, d):
    train, test = _split(spark, d)
    cols = ["userId", "itemId", "rating"]
    return train.select(*cols, F.lit("train").alias("part")).unionByName(
        test.select(*cols, F.lit("test").alias("part"))
    )


def _item_mean_metrics(spark, d):
    train, test = _split(spark, d)
    return RA.error_metrics(RA.item_mean_predictions(train, test))


def _rating_rmse(spark, d):
    return _item_mean_metrics(spark, d).select(F.round("rmse", DIGITS).alias("rmse"))


def _rating_mae(spark, d):
    return _item_mean_metrics(spark, d).select(F.round("mae", DIGITS).alias("mae"))


def _eval_counts(spark, d):
    return _item_mean_metrics(spark, d).select("n_rows", "n_valid")


def _als_eval(spark, d):
    return P.evaluate_als(V.rating(spark, d), seed=42)


def _als_predictions(spark, d):
    """Each prediction against the dot product of its factor rows."""
    found = _als_eval(spark, d)
    cold = F.isnan("prediction").alias("is_cold")
    gap = F.abs(F.col("prediction").cast("double") - F.col("recomputed"))
    equal = F.when(F.isnan("prediction"), F.isnan("recomputed")).otherwise(gap <= 1e-4 * (1 + F.abs("recomputed")))
    rows = RA.recompute_predictions(found.model, found.predictions)
    return rows.select("userId", "itemId", "rating", cold, equal.alias("is_dot_product"))


def _als_metrics(spark, d):
    """Row counts, and whether both errors are those of the dot products of the factor rows."""
    found = _als_eval(spark, d)
    again = RA.error_metrics(RA.recompute_predictions(found.model, found.predictions), pred_col="recomputed")
    both = found.metrics.join(again.selectExpr("n_rows", "rmse AS rmse2", "mae AS mae2"), "n_rows")
    equal = (F.abs(F.col("rmse") - F.col("rmse2")) <= 1e-5) & (F.abs(F.col("mae") - F.col("mae2")) <= 1e-5)
    return both.select("n_rows", "n_valid", equal.alias("errors_match"))


def _als_residuals(spark, d):
    """Users with their ratings in the fit, and whether their factor row solves its normal equations."""
    found = _als_eval(spark, d)
    rows = RA.factor_residuals(found.model, found.train)
    return rows.select("userId", "n_ratings", (F.col("residual") <= ALS_RESIDUAL).alias("is_solved"))


def _builtin_metrics(spark, d):
    train, test = _split(spark, d)
    pred = RA.item_mean_predictions(train, test).where("NOT isnan(prediction)")
    found = RA.evaluate_builtin(stage(pred, "predictions"))
    return spark.range(1).select(*[F.round(F.lit(v), DIGITS).alias(k) for k, v in found.items()])


# --------------------------------------------------------------- sink queries


def _rule_lines(spark, d):
    """Every rule as a text line, and the line's seven fields again."""
    kinds = ["bigint"] * 2 + ["double"] * 5
    lines = rule_lines(_rules(spark, d)).select(F.split("value", ", ").alias("f"))
    return lines.select(*[F.col("f")[i].cast(k).alias(c) for i, (c, k) in enumerate(zip(R.RULE_COLUMNS, kinds))])


def _written_table(spark, d):
    path = shared_path(spark, "written-rules")
    write_table(_rules(spark, d), path)
    return spark.read.parquet(path)


def _listed_rules(spark, d):
    return P.basket_rules(V.listed_basket(spark, d), listed=True)


def _retail_run_stats(spark, d):
    """Statistics that the written retail rules left behind."""
    stats = P.run_retail_rules(spark, V.retail(spark, d), shared_path(spark, "retail-run")).stats
    return stats.select(*[F.round(c, DIGITS).alias(c) if c.startswith("mean_") else c for c in stats.columns])


def _retail_output(name):
    def run(spark, d):
        return getattr(P.retail_rules(stage(V.retail(spark, d), "retail-lines")), name)

    return run


# ------------------------------------------------------------- reader queries


def _listed_baskets(spark, d):
    return RD.read_listed_baskets(spark, V.listed_basket_text(spark, d))


def _flat_baskets(spark, d):
    return RD.read_flat_baskets(spark, V.flat_basket_text(spark, d))


def _retail_lines(spark, d):
    return RD.read_retail_lines(spark, V.retail_csv(spark, d), timestamp_format="yyyy-MM-dd HH:mm:ss")


def _retail_naive(spark, d):
    return RD.read_retail_lines(spark, V.retail_naive_text(spark, d), naive_split=True)


def _items(spark, d):
    return RD.read_items(spark, V.items_text(spark, d))


def _ratings_implicit(spark, d):
    return RD.read_ratings_dat(spark, V.ratings_dat_text(spark, d))


def _ratings_explicit(spark, d):
    return RD.read_ratings_tsv(spark, V.ratings_tsv_text(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **(LLM.queries() if LLM else {}),
        # sources
        "listed_baskets": _listed_baskets,
        "flat_baskets": _flat_baskets,
        "retail_lines": _retail_lines,
        "item_features": _items,
        "ratings_implicit": _ratings_implicit,
        "ratings_explicit": _ratings_explicit,
        "retail_lines_naive": _retail_naive,
        "rule_lines": _rule_lines,
        "write_table": _written_table,
        # flattening, joins, counts
        "flatten_baskets": lambda s, d: B.flatten_baskets(V.listed_basket(s, d)),
        "basket_pairs": _basket_pairs,
        "item_frequency": lambda s, d: B.item_frequency(V.flat_basket(s, d)),
        "item_support": lambda s, d: B.item_support(V.flat_basket(s, d)),
        "basket_count": lambda s, d: B.basket_count(V.flat_basket(s, d)),
        "pair_frequency": lambda s, d: B.pair_frequency(V.flat_basket(s, d)),
        "item_frequency_bag": lambda s, d: B.item_frequency(V.flat_basket(s, d), dedupe=False),
        "basket_count_rows": lambda s, d: B.basket_count(V.listed_basket(s, d), by="rows"),
        "pair_frequency_bag": lambda s, d: B.pair_frequency(V.flat_basket(s, d), dedupe=False),
        # rules
        "association_rules_tiled": lambda s, d: R.association_rules(V.flat_basket(s, d), tile_rows=3),
        "association_rules_min_support": lambda s, d: R.association_rules(V.word_basket(s, d), min_support=MIN_SUPPORT),
        "association_rules_bag_min_support": lambda s, d: R.association_rules(
            V.word_basket(s, d), dedupe=False, min_support=MIN_SUPPORT_BAG
        ),
        "pair_frequency_min_count": lambda s, d: B.pair_frequency(V.flat_basket(s, d), min_count=2),
        "collab_similarity_min_count": lambda s, d: CO.collaborative_similarity(_implicit(s, d), min_count=3),
        "association_rules_bitmaps": lambda s, d: R.association_rules(
            V.word_basket(s, d), min_support=MIN_SUPPORT, dense_share=DENSE_DOCS
        ),
        "cooccurrence_count_bitmaps": lambda s, d: CO.cooccurrence_count(_implicit(s, d), dense_share=DENSE_USERS),
        "collab_similarity_bitmaps": lambda s, d: CO.collaborative_similarity(
            _implicit(s, d), min_count=3, dense_share=DENSE_USERS
        ),
        "top_lists": lambda s, d: R.top_lists(_rules(s, d), TOP_K),
        "retail_run_stats": _retail_run_stats,
        "content_pair_classes": lambda s, d: CT.cross_pair_classes(V.item_features(s, d)),
        "als_residuals": _als_residuals,
        # the same over a bucketed store
        "store_basket_count": lambda s, d: _store(s, V.flat_basket(s, d)).basket_count(),
        "store_item_support": lambda s, d: _store(s, V.flat_basket(s, d)).item_support(),
        "store_basket_pairs": lambda s, d: _store(s, V.flat_basket(s, d)).basket_pairs(),
        "store_pair_frequency_bag": lambda s, d: _store(s, V.flat_basket(s, d)).pair_frequency(dedupe=False),
        "store_rules": lambda s, d: _store(s, V.flat_basket(s, d)).rules(),
        "store_rules_min_support": lambda s, d: _store(s, V.word_basket(s, d)).rules(min_support=MIN_SUPPORT),
        "store_rules_bag_min_support": lambda s, d: _store(s, V.word_basket(s, d)).rules(dedupe=False, min_support=MIN_SUPPORT_BAG),
        "basket_rules": lambda s, d: _listed_rules(s, d).rules,
        "basket_rules_per_antecedent": lambda s, d: _listed_rules(s, d).per_antecedent,
        "association_rules": lambda s, d: _rules(s, d),
        "association_rules_bag": lambda s, d: _rules(s, d, dedupe=False),
        "top_support": lambda s, d: R.top_rules(_rules(s, d), "support", TOP_K),
        "top_confidence": lambda s, d: R.top_rules(_rules(s, d), "confidence", TOP_K),
        "top_lift": _top_lift,
        "rules_per_antecedent": lambda s, d: R.rules_per_antecedent(_rules(s, d)),
        "rule_stats": lambda s, d: R.rule_stats(_rules(s, d), mean_digits=DIGITS),
        # retail
        "retail_summary": lambda s, d: RT.retail_summary(stage(V.retail(s, d), "retail-lines")),
        "distinct_countries": lambda s, d: RT.distinct_countries(V.retail(s, d)),
        "item_catalog": lambda s, d: RT.item_catalog(V.retail(s, d)),
        "rules_with_desc": _rules_with_desc,
        "retail_rules": _retail_rules,
        "retail_item_support": _retail_output("item_support"),
        "retail_rules_per_antecedent": _retail_output("per_antecedent"),
        "retail_rule_stats": lambda s, d: R.rule_stats(_retail_output("rules")(s, d), mean_digits=DIGITS),
        # content similarity
        "feature_vocabulary": lambda s, d: CT.feature_vocabulary(V.item_features(s, d)),
        "item_cross_pairs": lambda s, d: CT.cross_pair_summary(V.item_features(s, d)),
        "nonzero_pair_count": _nonzero_pair_count,
        "content_jaccard": _content_measure("jaccard"),
        "content_containment": _content_measure("containment"),
        "content_euclid": _content_measure("euclid"),
        "content_one_sided": _content_measure("one_sided_euclid"),
        "content_cosine": _content_measure("cosine"),
        "content_similarity": _content_similarity,
        "content_min_score": lambda s, d: CT.content_similarity(V.item_features(s, d), min_score=0.5),
        "order_similarity": lambda s, d: CT.content_similarity(V.order_features(s, d), min_score=0.4),
        "order_containment": lambda s, d: CT.content_similarity(V.order_features(s, d), min_score=0.5, score_col="containment"),
        "order_top_k": lambda s, d: CT.content_similarity(V.order_features(s, d), top_k=3, score_col="cosine"),
        "content_top_k": lambda s, d: CT.content_similarity(V.item_features(s, d), top_k=10),
        # collaborative similarity
        "cooccurrence_count": lambda s, d: CO.cooccurrence_count(_implicit(s, d)),
        "item_rating_frequency": lambda s, d: CO.item_rating_frequency(V.implicit(s, d)),
        "cooccurrence_count_bag": lambda s, d: CO.cooccurrence_count(_implicit(s, d), dedupe=False),
        "item_rating_frequency_bag": lambda s, d: CO.item_rating_frequency(V.implicit(s, d), dedupe=False),
        "collab_cosine": _collab_measure("cosine"),
        "collab_euclid": _collab_measure("euclid"),
        "collab_jaccard": _collab_measure("jaccard"),
        "collab_similarity": lambda s, d: _collab(s, d),
        "collab_similarity_bag": lambda s, d: _collab(s, d, dedupe=False),
        "user_similarity": _user_similarity,
        # ratings
        "rating_split": _rating_split,
        "rating_rmse": _rating_rmse,
        "rating_mae": _rating_mae,
        "eval_counts": _eval_counts,
        "rmse_mae_builtin": _builtin_metrics,
        "als_predictions": _als_predictions,
        "als_metrics": _als_metrics,
    }


# ----------------------------------------------------------------- oracle SQL

_D = "CAST({} AS DOUBLE)"

_FLAT_SET = "SELECT DISTINCT l_orderkey t, l_partkey i FROM lineitem"
_FLAT_BAG = "SELECT l_orderkey t, l_partkey i FROM lineitem"


def _rules_sql(flat: str, freq: str) -> str:
    n = "(SELECT COUNT(DISTINCT t) FROM f)"
    sup, ant, cons = (f"CAST(p.c AS DOUBLE) / {n}", f"CAST(x.c AS DOUBLE) / {n}", f"CAST(y.c AS DOUBLE) / {n}")
    return f"""
WITH f AS ({flat}),
s AS (SELECT i, {freq} c FROM f GROUP BY i),
p AS (SELECT a.i a, b.i b, COUNT(*) c FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i)
SELECT p.a AS antecedent, p.b AS consequent, {ant} AS ant_support, {cons} AS cons_support,
       {sup} AS support, ({sup}) / ({ant}) AS confidence, ({sup}) / (({ant}) * ({cons})) AS lift
FROM p JOIN s x ON x.i = p.a JOIN s y ON y.i = p.b"""


def _word_rules_sql(dedupe: bool, least: float) -> str:
    """Rules between words of a least support.  Counts are per document and word; words below the bound are left out of the self-join."""
    w, most = ("1", "COUNT(*)") if dedupe else ("COUNT(*)", "SUM(w * (total - w))")
    return f"""
WITH g AS (SELECT doc_id t, unnest(string_split(text, ' ')) i FROM documents),
f AS (SELECT t, i, CAST({w} AS BIGINT) w FROM g WHERE i <> '' GROUP BY t, i),
n AS (SELECT COUNT(DISTINCT t) n FROM f),
s AS (SELECT i, CAST(SUM(w) AS BIGINT) c, CAST({most} AS BIGINT) most FROM (SELECT *, SUM(w) OVER (PARTITION BY t) total FROM f) q GROUP BY i),
k AS (SELECT f.* FROM f JOIN s ON s.i = f.i, n WHERE CAST(most AS DOUBLE) / n >= {least}),
p AS (SELECT a.i a, b.i b, CAST(SUM(a.w * b.w) AS BIGINT) c FROM k a JOIN k b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i),
r AS (SELECT a antecedent, b consequent, CAST(x.c AS DOUBLE) / n ant_support, CAST(y.c AS DOUBLE) / n cons_support, CAST(p.c AS DOUBLE) / n support
      FROM p JOIN s x ON x.i = p.a JOIN s y ON y.i = p.b, n)
SELECT *, support / ant_support AS confidence, support / (ant_support * cons_support) AS lift FROM r WHERE support >= {least}"""


_RULES = _rules_sql(_FLAT_SET, "COUNT(*)")
_RULES_BAG = _rules_sql(_FLAT_BAG, "COUNT(*)")


_STATS = f"""
SELECT COUNT(*) n_rules,
       MIN(support) min_support, MAX(support) max_support, ROUND(AVG(support), {DIGITS}) mean_support,
       MIN(confidence) min_confidence, MAX(confidence) max_confidence, ROUND(AVG(confidence), {DIGITS}) mean_confidence,
       MIN(lift) min_lift, MAX(lift) max_lift, ROUND(AVG(lift), {DIGITS}) mean_lift
FROM ({_RULES}) r"""


def _top(metric: str) -> str:
    return f"SELECT * FROM ({_RULES}) r ORDER BY {metric} DESC, antecedent, consequent LIMIT {TOP_K}"


_RETAIL = """
SELECT CAST(l_orderkey AS VARCHAR) invoice, CAST(l_partkey AS VARCHAR) stock_code, p_name description,
       CAST(l_quantity AS INTEGER) quantity, o_orderdate invoice_date, l_extendedprice price,
       CAST(o_custkey AS VARCHAR) customer_id, n_name country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_DESC = "CASE WHEN description IS NULL OR description = '' THEN 'NA' ELSE description END"

_RETAIL_RULES = f"""
WITH rl AS ({_RETAIL}),
f AS (SELECT DISTINCT invoice t, stock_code i FROM rl),
s AS (SELECT i, COUNT(*) c FROM f GROUP BY i),
p AS (SELECT a.i a, b.i b, COUNT(*) c FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i),
r AS (
  SELECT p.a AS antecedent, p.b AS consequent,
         CAST(x.c AS DOUBLE) / (SELECT COUNT(DISTINCT t) FROM f) AS ant_support,
         CAST(y.c AS DOUBLE) / (SELECT COUNT(DISTINCT t) FROM f) AS cons_support,
         CAST(p.c AS DOUBLE) / (SELECT COUNT(DISTINCT t) FROM f) AS support
  FROM p JOIN s x ON x.i = p.a JOIN s y ON y.i = p.b),
d AS (SELECT stock_code, MIN({_DESC}) description FROM rl GROUP BY stock_code)
SELECT antecedent, consequent, ant_support, cons_support, support,
       support / ant_support AS confidence, support / (ant_support * cons_support) AS lift,
       da.description AS ant_description, dc.description AS cons_description
FROM r LEFT JOIN d da ON da.stock_code = r.antecedent LEFT JOIN d dc ON dc.stock_code = r.consequent"""

_ITEMS = """
SELECT p_partkey item, p_name title,
       list_sort(list_distinct(string_split(p_name, ' ') || [p_type])) features
FROM part"""

_SET_PAIRS = f"""
WITH it AS ({_ITEMS}),
sets AS (SELECT features fs, COUNT(*) n_items FROM it GROUP BY features),
e AS (SELECT fs, unnest(fs) f FROM sets),
p AS (SELECT a.fs sa, b.fs sb, COUNT(*) m11 FROM e a JOIN e b ON a.f = b.f GROUP BY a.fs, b.fs)
SELECT p.sa, p.sb, p.m11, CAST(len(p.sa) AS BIGINT) fa, CAST(len(p.sb) AS BIGINT) fb,
       x.n_items items_a, y.n_items items_b
FROM p JOIN sets x ON x.fs = p.sa JOIN sets y ON y.fs = p.sb"""


def _scores_sql(m11: str, fa: str, fb: str) -> dict[str, str]:
    one = "CAST(1 AS DOUBLE)"
    return {
        "jaccard": f"CAST({m11} AS DOUBLE) / CAST(({fa} - {m11}) + {m11} + ({fb} - {m11}) AS DOUBLE)",
        "euclid": f"{one} / ({one} + sqrt(CAST(({fa} - {m11}) + ({fb} - {m11}) AS DOUBLE)))",
        "cosine": f"CAST({m11} AS DOUBLE) / (sqrt(CAST({fa} AS DOUBLE)) * sqrt(CAST({fb} AS DOUBLE)))",
        "containment": f"CAST({m11} AS DOUBLE) / CAST({fa} AS DOUBLE)",
        "one_sided_euclid": f"{one} / ({one} + sqrt(CAST({fa} - {m11} AS DOUBLE)))",
    }


_CS = _scores_sql("m11", "fa", "fb")


def _content_measure_sql(measure: str) -> str:
    return (
        f"SELECT array_to_string(sa, '|') AS set_a, array_to_string(sb, '|') AS set_b, {_CS[measure]} AS {measure} "
        f"FROM ({_SET_PAIRS}) q"
    )


def _content_items_sql(items: str) -> str:
    return f"""
WITH it AS ({items}),
e AS (SELECT item, unnest(features) f FROM it),
p AS (SELECT a.item a, b.item b, COUNT(*) m11 FROM e a JOIN e b ON a.f = b.f GROUP BY a.item, b.item),
q AS (SELECT p.a, p.b, p.m11, CAST(len(x.features) AS BIGINT) fa, CAST(len(y.features) AS BIGINT) fb
      FROM p JOIN it x ON x.item = p.a JOIN it y ON y.item = p.b)
SELECT a AS item_a, b AS item_b, m11, {", ".join(f"{v} AS {k}" for k, v in _CS.items())} FROM q"""


_CONTENT_ITEMS = _content_items_sql(_ITEMS)
_ORDER_ITEMS = _content_items_sql("SELECT l_orderkey item, list_sort(list_distinct(list(l_partkey))) features FROM lineitem GROUP BY l_orderkey")


def _top_k_sql(pairs: str, score: str, k: int) -> str:
    return f"""
SELECT item_a, item_b, m11, {", ".join(_CS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY {score} DESC, item_b) AS place
  FROM ({pairs}) q WHERE item_a <> item_b) z WHERE place <= {k}"""


_IMPLICIT = "SELECT o_custkey u, l_partkey i FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _collab_sql(rows: str, cols: str = "item_a, item_b, n, jaccard, euclid, cosine", ua="item_a", ub="item_b") -> str:
    s = _scores_sql("p.n", "x.c", "y.c")
    return f"""
WITH r AS ({rows}),
f AS (SELECT i, COUNT(*) c FROM r GROUP BY i),
p AS (SELECT a.i a, b.i b, COUNT(*) n FROM r a JOIN r b ON a.u = b.u GROUP BY a.i, b.i),
q AS (SELECT p.a AS {ua}, p.b AS {ub}, p.n AS n, {s["jaccard"]} AS jaccard, {s["euclid"]} AS euclid,
             {s["cosine"]} AS cosine
      FROM p JOIN f x ON x.i = p.a JOIN f y ON y.i = p.b)
SELECT {cols} FROM q"""


_COLLAB = _collab_sql(f"SELECT DISTINCT u, i FROM ({_IMPLICIT}) z")
_COLLAB_BAG = _collab_sql(_IMPLICIT)
_USERS = _collab_sql(
    f"SELECT DISTINCT i AS u, u AS i FROM ({_IMPLICIT}) z",
    cols="user_a, user_b, n, jaccard, euclid, cosine",
    ua="user_a",
    ub="user_b",
)

_RATING = """
SELECT CAST(o_custkey AS INTEGER) "userId", CAST(l_partkey AS INTEGER) "itemId",
       CAST(AVG(l_quantity) / 10.0::DOUBLE AS FLOAT) rating,
       CAST(MAX(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))) AS BIGINT) * 86400 "timestamp"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey"""

_HEX = """substr(md5(CAST("userId" AS VARCHAR) || ':' || CAST("itemId" AS VARCHAR)), 1, 8)"""
_BUCKET = f"(CAST('0x' || {_HEX} AS BIGINT) % 10)"

_ITEM_MEAN = f"""
WITH r AS ({_RATING}),
train AS (SELECT * FROM r WHERE {_BUCKET} >= 2),
test AS (SELECT * FROM r WHERE {_BUCKET} < 2),
m AS (SELECT "itemId", AVG(CAST(rating AS DOUBLE)) mean FROM train GROUP BY "itemId"),
e AS (SELECT CAST(t.rating AS DOUBLE) - m.mean err FROM test t LEFT JOIN m ON m."itemId" = t."itemId")"""


#: Queries over a basket store, and those that give the same rows without one.
_STORED = {
    "store_basket_count": "basket_count",
    "store_item_support": "item_support",
    "store_basket_pairs": "basket_pairs",
    "store_pair_frequency_bag": "pair_frequency_bag",
    "store_rules": "association_rules",
    "store_rules_min_support": "association_rules_min_support",
    "store_rules_bag_min_support": "association_rules_bag_min_support",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that has an exact SQL form."""
    listed = """
SELECT CAST(l_orderkey AS VARCHAR) trans_id, list_sort(list(CAST(l_partkey AS VARCHAR))) items
FROM lineitem GROUP BY l_orderkey"""
    listed_rules = f"SELECT * REPLACE (CAST(antecedent AS VARCHAR) AS antecedent, CAST(consequent AS VARCHAR) AS consequent) FROM ({_RULES}) q"
    train = f'SELECT "userId", "itemId" FROM ({_RATING}) q WHERE {_BUCKET} >= 2'
    cold = f"""
WITH r AS ({_RATING}), train AS ({train}), t AS (SELECT * FROM r WHERE {_BUCKET} < 2),
p AS (SELECT t."userId", t."itemId", t.rating,
  ("userId" NOT IN (SELECT "userId" FROM train) OR "itemId" NOT IN (SELECT "itemId" FROM train)) AS is_cold FROM t)
"""
    found = {
        **(LLM.oracle_sql() if LLM else {}),
        "listed_baskets": listed,
        "flat_baskets": "SELECT CAST(l_orderkey AS VARCHAR) trans_id, CAST(l_partkey AS VARCHAR) item FROM lineitem",
        "retail_lines": _RETAIL,
        "item_features": f"SELECT CAST(item AS INTEGER) item, title, features FROM ({_ITEMS}) q",
        "ratings_implicit": f'SELECT "userId" AS "user", "itemId" AS item FROM ({_RATING}) q',
        "ratings_explicit": _RATING,
        "retail_lines_naive": f"""
SELECT invoice, stock_code, description, CAST(quantity AS VARCHAR) AS quantity,
       strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date, CAST(price AS VARCHAR) AS price, customer_id, country
FROM ({_RETAIL}) q""",
        "rule_lines": _RULES,
        "write_table": _RULES,
        "item_frequency_bag": "SELECT l_partkey item, COUNT(*) freq FROM lineitem GROUP BY l_partkey",
        "basket_count_rows": f"SELECT COUNT(*) n_baskets FROM ({listed}) q",
        "pair_frequency_bag": f"""
WITH f AS ({_FLAT_BAG})
SELECT a.i AS antecedent, b.i AS consequent, COUNT(*) AS n
FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i""",
        "association_rules_tiled": _RULES,
        "association_rules_min_support": _word_rules_sql(True, MIN_SUPPORT),
        "association_rules_bag_min_support": _word_rules_sql(False, MIN_SUPPORT_BAG),
        "pair_frequency_min_count": f"""
WITH f AS ({_FLAT_SET})
SELECT a.i AS antecedent, b.i AS consequent, COUNT(*) AS n
FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i HAVING COUNT(*) >= 2""",
        "collab_similarity_min_count": f"SELECT * FROM ({_COLLAB}) q WHERE n >= 3",
        "basket_rules": listed_rules,
        "basket_rules_per_antecedent": f"SELECT antecedent, COUNT(*) n_rules FROM ({listed_rules}) q GROUP BY antecedent",
        "retail_item_support": """
SELECT CAST(l_partkey AS VARCHAR) AS item,
       CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) / (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS support
FROM lineitem GROUP BY l_partkey""",
        "retail_rules_per_antecedent": f"SELECT antecedent, COUNT(*) n_rules FROM ({listed_rules}) q GROUP BY antecedent",
        "retail_rule_stats": _STATS,
        "als_predictions": f"{cold} SELECT *, true AS is_dot_product FROM p",
        "als_metrics": f"{cold} SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE NOT is_cold) AS n_valid, true AS errors_match FROM p",
        "als_residuals": f'SELECT "userId", COUNT(*) AS n_ratings, true AS is_solved FROM ({train}) q GROUP BY "userId"',
        "top_lists": " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{m}' AS metric, row_number() OVER (ORDER BY {m} DESC, antecedent, consequent) AS place, r.*
FROM ({_RULES}) r) q WHERE place <= {TOP_K}"""
            for m in R.METRICS
        ),
        "retail_run_stats": _STATS,
        "content_pair_classes": f"""
WITH sp AS ({_SET_PAIRS}),
o AS (SELECT fa, fb, m11, CAST(SUM(items_a * items_b) AS BIGINT) n_pairs FROM sp GROUP BY fa, fb, m11),
s AS (SELECT CAST(len(features) AS BIGINT) size, COUNT(*) n FROM ({_ITEMS}) q GROUP BY len(features)),
z AS (SELECT x.size fa, y.size fb, CAST(0 AS BIGINT) m11,
             x.n * y.n - COALESCE((SELECT SUM(o.n_pairs) FROM o WHERE o.fa = x.size AND o.fb = y.size), 0) n_pairs FROM s x, s y),
c AS (SELECT * FROM o UNION ALL SELECT * FROM z WHERE n_pairs > 0)
SELECT fa AS size_a, fb AS size_b, m11, CAST(n_pairs AS BIGINT) AS n_pairs, {", ".join(f"{v} AS {k}" for k, v in _scores_sql("m11", "fa", "fb").items())}
FROM c""",
        "association_rules_bitmaps": _word_rules_sql(True, MIN_SUPPORT),
        "cooccurrence_count_bitmaps": f"""
WITH r AS (SELECT DISTINCT u, i FROM ({_IMPLICIT}) z)
SELECT a.i AS item_a, b.i AS item_b, COUNT(*) AS n FROM r a JOIN r b ON a.u = b.u GROUP BY a.i, b.i""",
        "collab_similarity_bitmaps": f"SELECT * FROM ({_COLLAB}) q WHERE n >= 3",
        "rmse_mae_builtin": f"""{_ITEM_MEAN}
SELECT ROUND(sqrt(AVG(err * err)), {DIGITS}) AS rmse, ROUND(AVG(abs(err)), {DIGITS}) AS mae FROM e
WHERE err IS NOT NULL AND NOT isnan(err)""",
        "content_top_k": _top_k_sql(_CONTENT_ITEMS, "jaccard", 10),
        "content_min_score": f"SELECT * FROM ({_CONTENT_ITEMS}) q WHERE jaccard >= 0.5",
        "order_similarity": f"SELECT * FROM ({_ORDER_ITEMS}) q WHERE jaccard >= 0.4",
        "order_containment": f"SELECT * FROM ({_ORDER_ITEMS}) q WHERE containment >= 0.5",
        "order_top_k": _top_k_sql(_ORDER_ITEMS, "cosine", 3),
        "cooccurrence_count_bag": f"""
WITH r AS ({_IMPLICIT})
SELECT a.i AS item_a, b.i AS item_b, COUNT(*) AS n FROM r a JOIN r b ON a.u = b.u GROUP BY a.i, b.i""",
        "item_rating_frequency_bag": f"SELECT i AS item, COUNT(*) AS freq FROM ({_IMPLICIT}) z GROUP BY i",
        "flatten_baskets": "SELECT CAST(l_orderkey AS VARCHAR) trans_id, CAST(l_partkey AS VARCHAR) item FROM lineitem",
        "basket_pairs": f"""
WITH f AS ({_FLAT_BAG})
SELECT a.t AS trans_id, a.i AS antecedent, b.i AS consequent, COUNT(*) AS n
FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.t, a.i, b.i""",
        "item_frequency": "SELECT l_partkey item, COUNT(DISTINCT l_orderkey) freq FROM lineitem GROUP BY l_partkey",
        "item_support": """
SELECT l_partkey item, CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) / (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) support
FROM lineitem GROUP BY l_partkey""",
        "basket_count": "SELECT COUNT(DISTINCT l_orderkey) n_baskets FROM lineitem",
        "pair_frequency": f"""
WITH f AS ({_FLAT_SET})
SELECT a.i AS antecedent, b.i AS consequent, COUNT(*) AS n
FROM f a JOIN f b ON a.t = b.t AND a.i <> b.i GROUP BY a.i, b.i""",
        "association_rules": _RULES,
        "association_rules_bag": _RULES_BAG,
        "top_support": _top("support"),
        "top_confidence": _top("confidence"),
        "top_lift": _top("lift"),
        "rules_per_antecedent": f"SELECT antecedent, COUNT(*) n_rules FROM ({_RULES}) r GROUP BY antecedent",
        "rule_stats": _STATS,
        "retail_summary": f"""
SELECT COUNT(*) n_lines, COUNT(DISTINCT invoice) n_invoices, COUNT(DISTINCT stock_code) n_items,
       COUNT(DISTINCT description) n_descriptions, COUNT(DISTINCT customer_id) n_customers
FROM ({_RETAIL}) q""",
        "distinct_countries": f"SELECT DISTINCT country FROM ({_RETAIL}) q",
        "item_catalog": f"SELECT DISTINCT stock_code, {_DESC} AS description FROM ({_RETAIL}) q",
        "rules_with_desc": _RETAIL_RULES,
        "retail_rules": f"SELECT * FROM ({_RETAIL_RULES}) q ORDER BY lift DESC, antecedent, consequent LIMIT {TOP_K}",
        "feature_vocabulary": f"""
SELECT DISTINCT trim(f) feature FROM (SELECT unnest(features) f FROM ({_ITEMS}) q) z
WHERE NOT contains(trim(f), 'no genres listed')""",
        "item_cross_pairs": f"""
WITH sp AS ({_SET_PAIRS}), n AS (SELECT COUNT(*) n FROM part)
SELECT n.n n_items, n.n * n.n n_pairs, CAST(SUM(items_a * items_b) AS BIGINT) n_overlap_pairs,
       CAST(SUM(items_a * items_b * m11) AS BIGINT) sum_m11,
       n.n * n.n - CAST(SUM(items_a * items_b) AS BIGINT) n_disjoint_pairs
FROM sp, n GROUP BY n.n""",
        "nonzero_pair_count": f"SELECT CAST(SUM(items_a * items_b) AS BIGINT) n_pairs FROM ({_SET_PAIRS}) q WHERE m11 > 0",
        "content_jaccard": _content_measure_sql("jaccard"),
        "content_containment": _content_measure_sql("containment"),
        "content_euclid": _content_measure_sql("euclid"),
        "content_one_sided": _content_measure_sql("one_sided_euclid"),
        "content_cosine": _content_measure_sql("cosine"),
        "content_similarity": f"SELECT * FROM ({_CONTENT_ITEMS}) q WHERE jaccard >= {MIN_SCORE}",
        "cooccurrence_count": f"""
WITH r AS (SELECT DISTINCT u, i FROM ({_IMPLICIT}) z)
SELECT a.i AS item_a, b.i AS item_b, COUNT(*) AS n FROM r a JOIN r b ON a.u = b.u GROUP BY a.i, b.i""",
        "item_rating_frequency": f"SELECT i AS item, COUNT(DISTINCT u) AS freq FROM ({_IMPLICIT}) z GROUP BY i",
        "collab_cosine": f"SELECT item_a, item_b, cosine FROM ({_COLLAB}) q",
        "collab_euclid": f"SELECT item_a, item_b, euclid FROM ({_COLLAB}) q",
        "collab_jaccard": f"SELECT item_a, item_b, jaccard FROM ({_COLLAB}) q",
        "collab_similarity": _COLLAB,
        "collab_similarity_bag": _COLLAB_BAG,
        "user_similarity": _USERS,
        "rating_split": f"""
SELECT "userId", "itemId", rating, CASE WHEN {_BUCKET} < 2 THEN 'test' ELSE 'train' END AS part
FROM ({_RATING}) q""",
        "rating_rmse": f"""{_ITEM_MEAN}
SELECT ROUND(sqrt(AVG(err * err) FILTER (WHERE err IS NOT NULL AND NOT isnan(err))), {DIGITS}) AS rmse FROM e""",
        "rating_mae": f"""{_ITEM_MEAN}
SELECT ROUND(AVG(abs(err)) FILTER (WHERE err IS NOT NULL AND NOT isnan(err)), {DIGITS}) AS mae FROM e""",
        "eval_counts": f"""{_ITEM_MEAN}
SELECT COUNT(*) AS n_rows, COUNT(err) FILTER (WHERE NOT isnan(err)) AS n_valid FROM e""",
    }
    return {**found, **{stored: found[plain] for stored, plain in _STORED.items()}}
