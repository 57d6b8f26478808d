"""Products bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.text import contains_ignore_case
from basketry.operators.baskets import best_pairs, best_partners
from basketry.operators.joins import HotKeys
from basketry.operators.name_index import find


def _named(df: DataFrame, product_dim: DataFrame, key: str, name: str) -> DataFrame:
    return df.join(product_dim.select(F.col("product_id").alias(key), F.col("name").alias(name)), key)


def top_pairs(items: DataFrame, product_dim: DataFrame, k: int = 20, hot: HotKeys | None = None) -> DataFrame:
    """Most frequent pairs; names are joined to ``k`` rows only."""
    best = best_pairs(items, k, hot)
    named = _named(_named(best, product_dim, "product_a", "product_a_name"), product_dim, "product_b", "product_b_name")
    return named.select("product_a", "product_a_name", "product_b", "product_b_name", "co_purchase_count").orderBy(
        F.desc("co_purchase_count"), "product_a", "product_b"
    )


def also_bought(items: DataFrame, product_dim: DataFrame, k: int = 3, hot: HotKeys | None = None) -> DataFrame:
    """The ``k`` products most often bought with each product, ranked before names are joined; in no order."""
    return _with_names(best_partners(items, k, hot), product_dim)


def _with_names(best: DataFrame, product_dim: DataFrame) -> DataFrame:
    named = _named(_named(best, product_dim, "source_product", "source_name"), product_dim, "recommended_product", "rec_name")
    return named.select("source_product", "source_name", "recommended_product", "rec_name", "co_purchase_count")


def search_recommendations(recs: DataFrame, text: str) -> DataFrame:
    """Recommendations whose product or recommended product contains ``text``, most frequent first per product."""
    found = recs.filter(contains_ignore_case("source_name", text) | contains_ignore_case("rec_name", text))
    return found.orderBy("source_product", F.desc("co_purchase_count"), "recommended_product")


def search_by_index(best: DataFrame, product_dim: DataFrame, index: DataFrame, text: str) -> DataFrame:
    """As ``search_recommendations``, from unnamed partners (``best_partners``) and the index of product names
    (``name_index.postings``): the postings of ``text`` decide, and only partners found are named."""
    found = find(index, "product_id", [text]).select("product_id")
    hit = lambda key, flag: found.select(F.col("product_id").alias(key), F.lit(True).alias(flag))
    kept = best.join(hit("source_product", "_source"), "source_product", "left").join(hit("recommended_product", "_rec"), "recommended_product", "left")
    named = _with_names(kept.filter(F.col("_source") | F.col("_rec")).drop("_source", "_rec"), product_dim)
    return named.orderBy("source_product", F.desc("co_purchase_count"), "recommended_product")
