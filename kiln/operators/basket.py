"""Market-basket analysis (R1-R12, J7): baskets, item frequencies, frequent
itemsets grown from baskets counted once each, rules, and rule post-processing,
all as DataFrame joins and aggregates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.columns import split_wide, strip_chars
from kiln.operators.relational import top_n
from kiln.session import checkpoint_root


def set_label(arr) -> Column:
    """Item set as text ``{a,b}`` with items sorted (arules label form)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.concat(F.lit("{"), F.array_join(F.array_sort(a), ","), F.lit("}"))


def baskets(lines: DataFrame, names: DataFrame, basket: str = "order_id", key: str = "product_id",
            item: str = "product_name") -> DataFrame:
    """One row per basket with its de-duplicated, sorted item list.

    (basket, item) pairs are de-duplicated first - a shuffle on both columns,
    so one very large basket is spread out - and each list then holds at most
    the distinct items of its basket.
    """
    pairs = (lines.select(basket, key).join(names.select(key, item), key)
                  .select(basket, F.col(item).alias("item")).distinct())
    return pairs.groupBy(basket).agg(F.array_sort(F.collect_list("item")).alias("items"))


def _n_baskets(b: DataFrame) -> DataFrame:
    return b.agg(F.count(F.lit(1)).alias("n_baskets"))


def item_frequency(b: DataFrame, top: int | None = 20, relative: bool = False,
                   items: str = "items") -> DataFrame:
    """Baskets containing each item (absolute) or that over the basket
    count (relative); ``top`` keeps the most frequent, ties included."""
    f = b.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("count"))
    if relative:
        f = (f.crossJoin(F.broadcast(_n_baskets(b)))
              .withColumn("frequency", F.col("count") / F.col("n_baskets")).drop("n_baskets"))
    return top_n(f, top, "count") if top else f


@dataclass(frozen=True)
class Itemsets:
    """Frequent item sets (items sorted, freq) of ``n_sets`` baskets with items out
    of ``kiln_n_baskets``, and the rules of one item that follow from them."""
    freqItemsets: DataFrame
    min_confidence: float
    n_sets: int
    kiln_n_baskets: int

    @property
    def associationRules(self) -> DataFrame:
        """(antecedent, consequent, confidence, lift, support)."""
        sets = self.freqItemsets
        whole = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("_item"))
        halves = whole.select(F.array_except("items", F.array("_item")).alias("antecedent"), F.array("_item").alias("consequent"), "freq")
        left = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_left"))
        right = sets.where(F.size("items") == 1).select(F.col("items").alias("consequent"), F.col("freq").alias("_right"))
        found = (halves.join(left, "antecedent").withColumn("confidence", F.col("freq") / F.col("_left"))
                       .where(F.col("confidence") >= self.min_confidence).join(right, "consequent"))
        n = F.lit(float(self.n_sets))
        return found.select("antecedent", "consequent", "confidence", (F.col("confidence") / (F.col("_right") / n)).alias("lift"), (F.col("freq") / n).alias("support"))


def counted_baskets(b: DataFrame, items: str = "items") -> DataFrame:
    """(items sorted, n): each different basket once, with how many are equal to it.
    As in Spark's FP-growth, a basket that names an item twice is an error."""
    column = F.col(items)
    twice = F.size(F.array_distinct(column)) < F.size(column)
    once = F.when(twice, F.raise_error(F.lit("Items in a basket must be unique"))).otherwise(F.array_sort(column))
    return b.select(once.alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("n"))


def fit(b: DataFrame, min_support: float = 0.001, min_confidence: float = 0.8,
        items: str = "items", small: int = 100_000) -> Itemsets:
    """All frequent item sets, by growing sets item by item on ever shorter baskets.

    Equal baskets become one row with their number, so that the work after the first
    shuffle grows with the different baskets. A row holds a set, the items after it
    in some baskets and their number; a level counts each set with one item more,
    drops what is not frequent from the items left, and adds up rows that became
    equal. Every shuffle is on a set and items, none on an item alone; the level's
    frequent sets are broadcast if there are ``small`` of them at most.
    """
    checkpoint_root(b.sparkSession)
    rows = counted_baskets(b, items).select(F.col("items").alias("_rest"), F.col("n").alias("_n")).checkpoint(eager=True)
    n_baskets, n_sets = rows.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("_rest").isNotNull(), F.col("_n"))), F.lit(0))).first()
    least = math.ceil(min_support * n_sets)
    kind = rows.schema["_rest"].dataType.simpleString()
    rows = rows.where("_rest IS NOT NULL").select(F.array().cast(kind).alias("_set"), "_rest", "_n")
    found = []
    while True:
        counted = rows.select("_set", F.explode("_rest").alias("_item"), "_n").groupBy("_set", "_item").agg(F.sum("_n").alias("freq"))
        level = counted.where(F.col("freq") >= least).checkpoint(eager=True)
        grown, n = F.concat("_set", F.array("_item")), level.count()
        found.append(level.select(grown.alias("items"), "freq"))
        if not n:
            break
        good = level.groupBy("_set").agg(F.collect_list("_item").alias("_good"))
        shorter = rows.join(F.broadcast(good) if n <= small else good, "_set").select("_set", F.array_intersect("_rest", "_good").alias("_rest"), "_n")
        each = shorter.where(F.size("_rest") > 1).select("_set", "_rest", "_n", F.posexplode("_rest").alias("_at", "_item"))
        rows = (each.select(grown.alias("_set"), F.slice("_rest", F.col("_at") + 2, F.size("_rest")).alias("_rest"), "_n")
                    .where(F.size("_rest") > 0).groupBy("_set", "_rest").agg(F.sum("_n").alias("_n")).checkpoint(eager=True))
    return Itemsets(reduce(DataFrame.unionByName, found), min_confidence, n_sets, n_baskets)


def _n_rows(b: DataFrame, model) -> DataFrame:
    n = getattr(model, "kiln_n_baskets", None)
    if n is None:
        return _n_baskets(b)
    return b.sparkSession.range(1).select(F.lit(int(n)).cast("bigint").alias("n_baskets"))


def frequent_itemsets(b: DataFrame, min_support: float = 0.001, max_len: int | None = None,
                      items: str = "items", model=None) -> DataFrame:
    """Item sets in at least ``ceil(min_support * n)`` baskets:
    (items sorted, itemset text, size, freq, support)."""
    m = model or fit(b, min_support, 1.0, items)
    fi = m.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    if max_len:
        fi = fi.where(F.size("items") <= max_len)
    return (fi.crossJoin(F.broadcast(_n_rows(b, m)))
              .select("items", set_label("items").alias("itemset"), F.size("items").alias("size"),
                      "freq", (F.col("freq") / F.col("n_baskets")).alias("support")))


def rules(b: DataFrame, min_support: float = 0.001, min_confidence: float = 0.8,
          min_len: int = 1, max_len: int | None = None, items: str = "items", model=None) -> DataFrame:
    """Rules ``lhs => {rhs}`` with support, confidence, lift and count,
    length (= |lhs| + 1) between ``min_len`` and ``max_len``."""
    m = model or fit(b, min_support, min_confidence, items)
    r = m.associationRules
    size = F.size("antecedent") + 1
    r = r.where(size >= min_len)
    if max_len:
        r = r.where(size <= max_len)
    return (r.crossJoin(F.broadcast(_n_rows(b, m)))
             .select(F.array_sort("antecedent").alias("antecedent"), "consequent",
                     set_label("antecedent").alias("lhs"), set_label("consequent").alias("rhs"),
                     "support", "confidence", "lift",
                     F.round(F.col("support") * F.col("n_baskets")).cast("bigint").alias("count"),
                     size.alias("length")))


def rules_for(b: DataFrame, item: str, min_support: float = 0.001, min_confidence: float = 0.8,
              max_len: int | None = None, items: str = "items", model=None) -> DataFrame:
    """Rules whose right-hand side is ``item``; like arules with the default
    ``minlen=1`` this includes ``{} => {item}`` when the item alone passes."""
    m = model or fit(b, min_support, min_confidence, items)
    r = rules(b, min_support, min_confidence, 1, max_len, items, m).where(
        F.col("consequent") == F.array(F.lit(item)))
    single = (frequent_itemsets(b, min_support, 1, items, m)
              .where(F.col("items") == F.array(F.lit(item)))
              .where(F.col("support") >= min_confidence)
              .select(F.array().cast("array<string>").alias("antecedent"), F.col("items").alias("consequent"),
                      F.lit("{}").alias("lhs"), set_label("items").alias("rhs"), "support",
                      F.col("support").alias("confidence"), F.lit(1.0).alias("lift"),
                      F.col("freq").alias("count"), F.lit(1).alias("length")))
    return r.unionByName(single)


def rules_matching(r: DataFrame, text: str) -> DataFrame:
    """Rules whose right-hand side has an item containing ``text``."""
    return r.where(F.exists("consequent", lambda x: x.contains(text)))


def _rule_order(by: str):
    return [F.col(by).desc(), F.col("lhs"), F.col("rhs")]


def top_rules(r: DataFrame, by: str = "lift", n: int = 5) -> DataFrame:
    """First n rules by a quality measure, ties broken on the rule text."""
    return r.orderBy(*_rule_order(by)).limit(n)


def rules_summary(r: DataFrame) -> DataFrame:
    """Rule count per length and a six-number summary of each quality."""
    lengths = (r.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit("length").alias("section"), F.col("length").cast("string").alias("key"), "n",
                        *[F.lit(None).cast("double").alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")]))
    from kiln.operators.indexing import quantiles
    qs = ("support", "confidence", "lift")
    aggs = [F.count(F.lit(1)).alias("n")]
    for q in qs:
        aggs += [F.min(q).alias(f"{q}_min"), F.max(q).alias(f"{q}_max"), F.avg(q).alias(f"{q}_mean")]
    a = r.agg(*aggs)
    qt = (quantiles(r, list(qs), [0.25, 0.5, 0.75]).groupBy("column")
          .agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(nm)
                 for p, nm in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))
    rows = [F.struct(F.lit("quality").alias("section"), F.lit(q).alias("key"), F.col("n").alias("n"),
                     F.col(f"{q}_min").alias("min"), F.col(f"{q}_mean").alias("mean"),
                     F.col(f"{q}_max").alias("max")) for q in qs]
    quality = (a.select(F.inline(F.array(*rows))).join(qt, F.col("key") == F.col("column"), "left")
                .select("section", "key", "n", "min", "q1", "median", "mean", "q3", "max"))
    return lengths.unionByName(quality)


def prune_rules(r: DataFrame, by: str = "lift") -> DataFrame:
    """In ``by`` order, drop every rule whose item set (lhs + rhs) contains
    the item set of an earlier rule (an equal set counts).

    The order (``by`` descending, then the rule's text) is compared in the join of
    each rule, keyed on its rarest item, with the rules that hold that item; only
    the dropped rules leave the join. No ranking, no all-pairs product.
    """
    item_set = F.array_sort(F.array_union("antecedent", "consequent"))
    order = F.struct((-F.col(by)).alias("by"), F.col("lhs"), F.col("rhs"))
    own = r.select(item_set.alias("_set"), order.alias("_order"))
    items = own.select("_set", "_order", F.explode("_set").alias("_item"))
    # key each rule on its rarest item, so a very common item does not gather
    # most candidate pairs in one join partition
    freq = items.groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))
    keyed = (items.join(freq, "_item").groupBy("_order", "_set")
                  .agg(F.min(F.struct("_n", "_item"))["_item"].alias("_item")))
    first = keyed.select("_item", F.col("_set").alias("_sub"), F.col("_order").alias("_before"))
    redundant = (items.join(first, "_item")
                      .where((F.col("_before") < F.col("_order")) & (F.size(F.array_except("_sub", "_set")) == 0))
                      .select(F.col("_order.lhs").alias("lhs"), F.col("_order.rhs").alias("rhs")).distinct())
    return r.join(redundant, ["lhs", "rhs"], "left_anti")


def rules_table(r: DataFrame, lhs_parts: int | None = None) -> DataFrame:
    """Rules as ``{a,b} => {c}`` text, cleaned of braces and quotes, split
    into LHS_1..LHS_k and RHS.

    k is the length of the longest left-hand side (one aggregate) unless given; a
    k that would lose items is refused.
    """
    longest = r.agg(F.max(F.size("antecedent"))).first()[0] or 1
    if lhs_parts is not None and lhs_parts < longest:
        raise ValueError(f"rules have up to {longest} items on the left, lhs_parts is {lhs_parts}")
    t = r.select(F.concat("lhs", F.lit(" => "), "rhs").alias("rules"), "support", "confidence", "lift", "count")
    clean = t.withColumn("_clean", strip_chars("rules", '{}"'))
    two = split_wide(clean, "_clean", "=>", 2, prefix="_side")
    wide = split_wide(two, "_side_1", ",", lhs_parts or longest, prefix="LHS")
    return wide.withColumnRenamed("_side_2", "RHS").drop("_clean", "_side_1")


def rule_edges(r: DataFrame, n: int = 10, by: str = "lift") -> DataFrame:
    """Item -> rule -> item edges of the first n rules (graph plot data)."""
    top = top_rules(r, by, n).withColumn(
        "rule", F.concat(F.lit("rule_"), F.row_number().over(Window.orderBy(*_rule_order(by))).cast("string")))
    lhs = top.select(F.explode("antecedent").alias("src"), F.col("rule").alias("dst"))
    rhs = top.select(F.col("rule").alias("src"), F.explode("consequent").alias("dst"))
    return lhs.unionByName(rhs)
