"""kinspark: item-affinity analytics and rating prediction on Spark DataFrames.

Every operator is a function from DataFrame(s) to a DataFrame built from
Spark SQL expressions (Spark ML for ALS, numpy in tasks for pairs of few items).
Nothing is collected to the driver but a few counts per pair operator (group sizes by
class, items and their range), which choose its plan.

Modules
-------
sources     readers for basket / item / rating text formats, sinks
functions   column expressions (Java-style split, similarity measures)
operators   pair counting, association rules, similarity, ALS, retail
plans       end-to-end pipelines and the test views over the driver tables
"""

from kinspark.operators.pairs import pair_counts, split_members
from kinspark.operators.baskets import (
    basket_count,
    basket_pairs,
    flatten_baskets,
    item_frequency,
    item_support,
    pair_frequency,
)
from kinspark.operators.rules import (
    association_rules,
    rules_from_counts,
    rule_stats,
    rules_per_antecedent,
    rules_with_descriptions,
    top_rules,
)
from kinspark.operators.content import (
    content_set_similarity,
    content_similarity,
    cross_pair_summary,
    feature_sets,
    feature_vocabulary,
)
from kinspark.operators.collab import (
    collaborative_similarity,
    cooccurrence_count,
    item_rating_frequency,
)
from kinspark.operators.retail import (
    distinct_countries,
    item_catalog,
    item_descriptions,
    retail_baskets,
    retail_summary,
)
from kinspark.operators.ratings import (
    error_metrics,
    evaluate_builtin,
    fit_als,
    hash_split,
    predict,
    split_ratings,
)

__all__ = [name for name in dir() if not name.startswith("_")]
