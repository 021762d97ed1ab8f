"""Frequent itemsets and association rules over a few categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import safe_ratio
from tidemark.operators.bounds import sized


def _item(attribute: str) -> Column:
    return F.concat(F.lit(f"{attribute}_"), F.col(attribute).cast("string"))


def itemsets(
    df: DataFrame, attributes: Sequence[str] = tuple(vocab.RULE_ATTRIBUTES), min_support: float = vocab.MIN_SUPPORT
) -> DataFrame:
    """(items, n_items, n_rows, support) of every frequent combination.

    Rows are first counted per combination of all attributes, so the cube expands that
    small table and not the rows. A missing value is no item.
    """
    attributes = list(attributes)
    combos = df.groupBy(*attributes).agg(F.count("*").alias("n"))
    total = combos.agg(F.sum("n").alias("n")).scalar()
    cube = combos.cube(*attributes).agg(
        F.sum("n").alias("n_rows"), *[F.grouping(a).alias(f"_{a}") for a in attributes]
    )
    for a in attributes:
        cube = cube.where((F.col(f"_{a}") == 1) | F.col(a).isNotNull())
    used = [F.when(F.col(f"_{a}") == 0, _item(a)) for a in attributes]
    items = F.array_sort(F.array_compact(F.array(*used)))
    out = cube.select(items.alias("items"), "n_rows", (F.col("n_rows") / total).alias("support"))
    return out.where((F.size("items") > 0) & (F.col("support") >= min_support)).select(
        "items", F.size("items").alias("n_items"), "n_rows", "support"
    )


def itemsets_fpgrowth(
    df: DataFrame, attributes: Sequence[str] = tuple(vocab.RULE_ATTRIBUTES), min_support: float = vocab.MIN_SUPPORT
) -> DataFrame:
    """The same table through Spark ML's FP-growth, for many attributes."""
    baskets = df.select(F.array_compact(F.array(*[_item(a) for a in attributes])).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets)
    total = baskets.agg(F.count("*").alias("n")).scalar()
    found = model.freqItemsets
    return found.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("n_items"),
        F.col("freq").alias("n_rows"),
        (F.col("freq") / total).alias("support"),
    )


def rules(frequent: DataFrame, min_lift: float = vocab.MIN_LIFT, single: bool = False) -> DataFrame:
    """Every split of a frequent itemset into antecedents and consequents, with measures.

    All subsets of a frequent set are frequent, so the supports come from the table itself,
    which is stored once and joined on the items as one text. ``single`` makes only the splits
    with one consequent, as many as the set has items; all splits are 2^n - 2.
    Conviction is null where the rule always holds.
    """
    frequent = sized(frequent.select("items", "n_items", "support", _key("items").alias("key")), "itemsets")
    size = F.col("n_items")
    many = frequent.where(size >= 2)
    if single:
        split = many.select("items", "support", F.explode("items").alias("c"))
        split = split.select("support", F.array_remove("items", F.col("c")).alias("antecedents"), F.array("c").alias("consequents"))
    else:
        masks = F.sequence(F.lit(1).cast("bigint"), F.pow(F.lit(2), size).cast("bigint") - 2)
        split = many.select("items", "support", F.explode(masks).alias("mask"))
        split = split.select("support", _side(1).alias("antecedents"), _side(0).alias("consequents"))
    split = split.select("*", _key("antecedents").alias("ka"), _key("consequents").alias("kc"))
    left = frequent.select(F.col("key").alias("ka"), F.col("support").alias("antecedent_support"))
    right = frequent.select(F.col("key").alias("kc"), F.col("support").alias("consequent_support"))
    out = split.join(left, "ka").join(right, "kc")
    s, a, c = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    return (
        out.withColumn("confidence", s / a)
        .withColumn("lift", F.col("confidence") / c)
        .withColumn("leverage", s - a * c)
        .withColumn("conviction", safe_ratio(1 - c, F.when(F.col("confidence") < 1, 1 - F.col("confidence"))))
        .where(F.col("lift") >= min_lift)
        .select(
            "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
            "confidence", "lift", "leverage", "conviction",
        )
    )


def _key(items: str) -> Column:
    return F.array_join(items, "\x1f")


def _side(bit: int) -> Column:
    return F.filter("items", lambda _, i: F.getbit(F.col("mask"), i) == bit)


def level_rules(found: DataFrame, attribute: str = "congestion_level", levels: Sequence[str] = tuple(vocab.FOUR_LEVELS)) -> DataFrame:
    """Rules whose only consequent is a level of one attribute, as text, best lift first."""
    targets = [f"{attribute}_{v}" for v in levels]
    out = found.where((F.size("consequents") == 1) & F.col("consequents")[0].isin(*targets))
    for side in ("antecedents", "consequents"):
        out = out.withColumn(side, F.array_join(F.array_sort(side), ", "))
    return out.orderBy(F.desc("lift"), "antecedents", "consequents")


def top_rules(level: DataFrame, top_n: int = 15) -> DataFrame:
    return level.orderBy(F.desc("lift"), "antecedents", "consequents").limit(top_n)
