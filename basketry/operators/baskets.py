"""Pairs of products bought together.

``pair_counts`` lists every pair, as asked. The ``best_*`` functions want only the most frequent ones, and use
bounds to leave out what cannot be among them:

- A pair is never more frequent than its rarer product. The pairs of the ``PROBE`` most frequent products give a
  first bound for the k-th best; products below it drop out before the pairs are listed.
- The pairs of a transaction with more than ``LARGE_BASKET`` distinct products are not listed, whatever the number
  of such transactions. A product keeps the sorted list of those it is in. A pair listed elsewhere has its large
  transactions in common counted from the two lists, if the shorter one could lift it to the k-th best.
- A pair listed nowhere else is found by prefixes: two lists with ``n`` entries in common share one within their
  first ``length - n + 1`` entries. Products with equal lists are interchangeable up to the tie-break by id, so the
  first few ids of each stand for all.

The result is exact.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.joins import HotKeys, _lookup
from basketry.operators.ranking import top_k, top_k_per_group
from basketry.session import durable

LARGE_BASKET = 1000
PROBE = 128
# Pairs one task lists and counts on average at most.
TASK_PAIRS = 1 << 19


def distinct_baskets(items: DataFrame) -> DataFrame:
    """One row per (transaction, product): a repeated product counts once."""
    return items.select("transaction_id", "product_id").distinct()


def pair_counts(items: DataFrame, hot: HotKeys | None = None, large: int = LARGE_BASKET) -> DataFrame:
    """``product_a < product_b`` and in how many transactions they meet.

    A self-join on the transaction with the inequality inside the join. Usual
    transactions are dealt to as many tasks as their lines ask for. A
    transaction that holds a large share of all lines is cut into blocks of
    products; every pair of blocks is a join key of its own, so the pairs of one
    transaction are produced by many tasks and each pair exactly once.
    Counts are combined before the shuffle.
    """
    heavy, number, tasks, repeats = _large(items, large)
    if not number:
        return _merged(basket_pairs(_dealt(items, tasks, repeats)), tasks)
    light = basket_pairs(_dealt(items.join(heavy, "transaction_id", "left_anti"), tasks, repeats))
    return _merged(light.unionByName(basket_pairs(distinct_baskets(items.join(heavy, "transaction_id", "left_semi")), hot)), tasks)


def _dealt(items: DataFrame, tasks: int, repeats: bool = False) -> DataFrame:
    """``_part, transaction_id, product_id``: baskets of transactions of usual size, each whole in one of ``tasks`` parts.

    Adaptive execution would merge what is small before the join of pairs and large after it. By its part a
    transaction is made distinct, joined and counted in the same task. ``repeats``: some have so many lines
    that they are made distinct before they are dealt.
    """
    rows = distinct_baskets(items) if repeats else items
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(tasks)).cast("int").alias("_part")
    return rows.select(part, "transaction_id", "product_id").repartitionById(tasks, "_part").distinct()


def _merged(pairs: DataFrame, tasks: int) -> DataFrame:
    """Counts of parts, already combined there, summed by ``tasks`` tasks."""
    return pairs.repartition(tasks, "product_a", "product_b").groupBy("product_a", "product_b").agg(F.sum("co_purchase_count").alias("co_purchase_count"))


def basket_pairs(baskets: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The same from baskets that hold a product once; from dealt ones the counts of each part."""
    part = [c for c in baskets.columns if c == "_part"]
    if hot is None or not hot.counts:
        left = baskets.select(*part, "transaction_id", F.col("product_id").alias("product_a"))
        right = baskets.select(*part, "transaction_id", F.col("product_id").alias("product_b"))
        pairs = left.join(right, [*part, "transaction_id"]).filter("product_a < product_b")
    else:
        pairs = _blocked_pairs(baskets, hot)
    return pairs.groupBy(*part, "product_a", "product_b").agg(F.count("*").alias("co_purchase_count")).drop("_part")


def _blocked_pairs(baskets: DataFrame, hot: HotKeys) -> DataFrame:
    partitions = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # n blocks give about n*n/2 pairs of blocks, each a unit of work.
    blocks = {k: max(2, ceil(sqrt(2 * n))) for k, n in hot.splits(partitions).items()}
    n = _lookup(F.col("transaction_id"), blocks)
    placed = baskets.select(
        "transaction_id", "product_id", (n - 1).cast("int").alias("_last"),
        F.pmod(F.xxhash64("product_id"), n).cast("int").alias("_block"),
    )
    left = placed.select(
        "transaction_id", F.col("product_id").alias("_l"), F.col("_block").alias("_i"),
        F.explode(F.sequence("_block", "_last")).alias("_j"),
    )
    right = placed.select(
        "transaction_id", F.col("product_id").alias("_r"), F.col("_block").alias("_j"),
        F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("_i"),
    )
    met = left.join(right, ["transaction_id", "_i", "_j"]).filter("_i < _j OR _l < _r")
    return met.select(F.least("_l", "_r").alias("product_a"), F.greatest("_l", "_r").alias("product_b"))


def best_pairs(items: DataFrame, k: int, hot: HotKeys | None = None, large: int = LARGE_BASKET) -> DataFrame:
    """The ``k`` most frequent pairs; ties by product ids."""
    baskets = durable(distinct_baskets(items), "baskets")  # read several times below
    products = ["product_a", "product_b"]
    supports, least = first_bound(baskets, k, hot)
    if least > 1:
        baskets = baskets.join(supports.filter(F.col("support") >= least).select("product_id"), "product_id", "left_semi")
    heavy, number, tasks, _ = _large(baskets, large)
    if not number:
        return top_k(_merged(basket_pairs(_dealt(baskets, tasks)), tasks), "co_purchase_count", k, products)
    lists = _large_lists(baskets, heavy)
    light = _merged(basket_pairs(_dealt(baskets.join(heavy, "transaction_id", "left_anti"), tasks)), tasks)
    listed = durable(_with_lists(light, lists, products), "listed-pairs")
    longest, shortest = F.greatest(F.size("_l0"), F.size("_l1")), F.least(F.size("_l0"), F.size("_l1"))
    sure = listed.select((F.col("co_purchase_count") + F.greatest(longest + shortest - number, F.lit(0))).alias("n"))
    bounds = [r["n"] for r in sure.orderBy(F.desc("n")).limit(k).collect()]  # k numbers
    least = max(1, least, bounds[-1] if len(bounds) == k else 0)
    counted = listed.filter(F.col("co_purchase_count") + shortest >= least).select(*products, (F.col("co_purchase_count") + _common("_l0", "_l1")).alias("co_purchase_count"))
    if least <= number:
        counted = _larger(counted, _unlisted(lists, k, least), products)
    return top_k(counted, "co_purchase_count", k, products)


def first_bound(baskets: DataFrame, k: int, hot: HotKeys | None = None) -> tuple[DataFrame, int]:
    """``product_id, support``, and how often the k-th best pair of the most frequent products occurs (0 if there is none)."""
    supports = baskets.groupBy("product_id").agg(F.count("*").alias("support"))
    probe = top_k(supports, "support", PROBE, ["product_id"]).select("product_id")
    counts = basket_pairs(baskets.join(probe, "product_id", "left_semi"), hot)
    best = counts.select("co_purchase_count").orderBy(F.desc("co_purchase_count")).limit(k).collect()  # k numbers
    return supports, best[-1][0] if len(best) == k else 0


def best_partners(items: DataFrame, k: int, hot: HotKeys | None = None, large: int = LARGE_BASKET) -> DataFrame:
    """``source_product, recommended_product, co_purchase_count``: the ``k`` most frequent partners
    of every product; ties by id. Each task keeps ``k`` rows per product before the shuffle."""
    heavy, number, tasks, repeats = _large(items, large)
    listed = _merged(basket_pairs(_dealt(items.join(heavy, "transaction_id", "left_anti") if number else items, tasks, repeats)), tasks)
    a, b = F.col("product_a"), F.col("product_b")
    both = F.array(
        F.struct(a.alias("source_product"), b.alias("recommended_product")),
        F.struct(b.alias("source_product"), a.alias("recommended_product")),
    )
    ends = ["source_product", "recommended_product"]
    counted = listed.select(F.explode(both).alias("p"), "co_purchase_count").select("p.*", "co_purchase_count")
    if number:
        lists = _large_lists(distinct_baskets(items), heavy)
        counted = _with_lists(counted, lists, ends).select(*ends, (F.col("co_purchase_count") + _common("_l0", "_l1")).alias("co_purchase_count"))
        sources = lists.select(F.col("product_id").alias("source_product"), F.col("_list").alias("_s"))
        unlisted = sources.join(_partners_by_list(lists, k), "_s").filter("source_product <> recommended_product").select(*ends, "co_purchase_count")
        counted = _larger(counted, unlisted, ends)
    return top_k_per_group(counted, "source_product", "co_purchase_count", k, ["recommended_product"])


def _large(baskets: DataFrame, large: int) -> tuple[DataFrame, int, int, bool]:
    """The transactions with more than ``large`` distinct products and their number; ``baskets`` may repeat a product.

    Also how many tasks the pairs of the others ask for, and whether any transaction has more than ``large`` lines.
    """
    lines = baskets.groupBy("transaction_id").agg(F.count("*").alias("_products"))
    usual = F.least("_products", F.lit(large))
    most, pairs = lines.agg(F.max("_products"), F.sum(usual * (usual - 1) / 2)).first()
    tasks = max(1, ceil((pairs or 0) / TASK_PAIRS))
    lines = lines.filter(F.col("_products") > large)
    if (most or 0) <= large:  # fewer lines, fewer products: nothing needs to be made distinct
        return lines.select("transaction_id"), 0, tasks, False
    heavy = distinct_baskets(baskets).groupBy("transaction_id").agg(F.count("*").alias("_products")).filter(F.col("_products") > large).select("transaction_id")
    heavy = durable(heavy, "large-baskets")
    return heavy, heavy.count(), tasks, True


def _large_lists(baskets: DataFrame, heavy: DataFrame) -> DataFrame:
    """``product_id, _list``: the large transactions each product is in, in order."""
    inside = baskets.join(heavy, "transaction_id", "left_semi")
    return durable(inside.groupBy("product_id").agg(F.sort_array(F.collect_list("transaction_id")).alias("_list")), "large-lists")


def _with_lists(pairs: DataFrame, lists: DataFrame, products: list[str]) -> DataFrame:
    """Pairs with the lists ``_l0, _l1`` of both products, empty for products in no large transaction."""
    for i, name in enumerate(products):
        pairs = pairs.join(lists.select(F.col("product_id").alias(name), F.col("_list").alias(f"_l{i}")), name, "left")
    none = F.array().cast(lists.schema["_list"].dataType)
    return pairs.withColumns({f"_l{i}": F.coalesce(f"_l{i}", none) for i in range(2)})


def _common(left: str, right: str) -> Column:
    """Number of large transactions two products share."""
    return F.size(F.array_intersect(left, right)).cast("bigint")


def _unlisted(lists: DataFrame, k: int, least: int) -> DataFrame:
    """Pairs that share ``least`` or more large transactions, among products that can be of the best."""
    # A pair is preceded by every pair of the same lists with smaller ids: 2k members of a list are enough.
    members = top_k_per_group(lists.filter(F.size("_list") >= least).withColumn("_one", F.lit(1)), "_list", "_one", 2 * k, ["product_id"])
    prefix = members.select("product_id", "_list", F.explode(F.slice("_list", F.lit(1), F.size("_list") - F.lit(least) + 1)).alias("_in"))
    left = prefix.select("_in", F.col("product_id").alias("product_a"), F.col("_list").alias("_l0"))
    right = prefix.select("_in", F.col("product_id").alias("product_b"), F.col("_list").alias("_l1"))
    met = left.join(right, "_in").filter("product_a < product_b").select("product_a", "product_b", _common("_l0", "_l1").alias("co_purchase_count"))
    return met.filter(F.col("co_purchase_count") >= least).distinct()


def _partners_by_list(lists: DataFrame, k: int) -> DataFrame:
    """Best ``k + 1`` partners shared by all products of a list (one of them may be the product itself)."""
    members = top_k_per_group(lists.withColumn("_one", F.lit(1)), "_list", "_one", k + 1, ["product_id"])
    members = members.withColumn("_in", F.explode("_list"))
    sources = members.select("_in", F.col("_list").alias("_s")).distinct()
    partners = members.select("_in", F.col("product_id").alias("recommended_product"), F.col("_list").alias("_r"))
    met = sources.join(partners, "_in").select("_s", "recommended_product", _common("_s", "_r").alias("co_purchase_count")).distinct()
    return top_k_per_group(met, "_s", "co_purchase_count", k + 1, ["recommended_product"])


def _larger(counted: DataFrame, unlisted: DataFrame, keys: list[str]) -> DataFrame:
    """A pair met both ways has its full count in the first frame, which is never the smaller one."""
    return counted.unionByName(unlisted).groupBy(*keys).agg(F.max("co_purchase_count").alias("co_purchase_count"))
