"""Market-basket queries (R1-R12, J7) on brand baskets of the order lines.

Fixture thresholds: support 0.001, confidence 0.15 (0.8 gives no rule of
length 3 on these tables). Rules have three items or more, as the scripts ask
for; neither item sets nor rules have a greatest length.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import basket as B
from kiln.operators.relational import subset_pairs
from kiln.plans.registry import query
from kiln.sources.views import views

SUPPORT, CONFIDENCE, MIN_LENGTH, TARGET = 0.001, 0.15, 3, "Brand#1"


def _baskets(spark, sf_dir):
    v = views(spark, sf_dir)
    return B.baskets(v.order_products, v.products, item="aisle")


def _model(b):
    return B.fit(b, SUPPORT, CONFIDENCE)


# --- SQL building blocks: every subset of every basket, grown item by item ---

_SETS = f"""
b AS (SELECT DISTINCT order_id, item FROM baskets_long),
nb AS (SELECT COUNT(DISTINCT order_id) AS n, CEIL({SUPPORT} * COUNT(DISTINCT order_id)) AS minc FROM b),
grown AS (SELECT order_id, [item] AS items, item AS last FROM b
          UNION ALL SELECT g.order_id, list_append(g.items, b.item), b.item
          FROM grown g JOIN b ON b.order_id = g.order_id AND b.item > g.last),
sets AS (SELECT items, '{{' || array_to_string(items, ',') || '}}' AS label, len(items) AS size, COUNT(*) AS freq
         FROM grown GROUP BY items HAVING COUNT(*) >= (SELECT minc FROM nb))"""

_ALL_RULES = _SETS + f""",
split AS (SELECT items, freq, unnest(items) AS rhs_item FROM sets WHERE size > 1),
halves AS (SELECT *, list_filter(items, lambda x: x <> rhs_item) AS antecedent FROM split),
all_rules AS (
  SELECT l.label AS lhs, '{{' || h.rhs_item || '}}' AS rhs, h.rhs_item, h.antecedent, h.freq AS count, h.freq / nb.n AS support,
         h.freq / l.freq AS confidence, (h.freq / l.freq) / (r.freq / nb.n) AS lift, len(h.items) AS length
  FROM halves h JOIN sets l ON l.items = h.antecedent JOIN sets r ON r.items = [h.rhs_item], nb
  WHERE h.freq / l.freq >= {CONFIDENCE})"""

_RULES = _ALL_RULES + f""",
rules AS (SELECT * FROM all_rules WHERE length >= {MIN_LENGTH})"""

_RULE_COLS = ("lhs, rhs, ROUND(support, 6) AS support, ROUND(confidence, 6) AS confidence, "
              "ROUND(lift, 6) AS lift, count")


def _round_rules(r):
    return r.select("lhs", "rhs", *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift")], "count")


@query("r1_baskets", "SELECT order_id, list_sort(list(item)) AS items FROM baskets_long GROUP BY order_id")
def r1_baskets(spark, sf_dir):
    return _baskets(spark, sf_dir)


@query("r2_item_frequency", """
SELECT item, COUNT(*) AS count FROM baskets_long GROUP BY item QUALIFY RANK() OVER (ORDER BY COUNT(*) DESC) <= 20
""")
def r2_item_frequency(spark, sf_dir):
    return B.item_frequency(_baskets(spark, sf_dir), top=20)


@query("r3_item_frequency_relative", """
SELECT item, COUNT(*) AS count,
       ROUND(COUNT(*) / (SELECT COUNT(DISTINCT order_id) FROM baskets_long), 6) AS frequency
FROM baskets_long GROUP BY item
""")
def r3_item_frequency_relative(spark, sf_dir):
    f = B.item_frequency(_baskets(spark, sf_dir), top=None, relative=True)
    return f.withColumn("frequency", F.round("frequency", 6))


@query("r4_frequent_itemsets", "WITH RECURSIVE " + _SETS + """
SELECT label AS itemset, CAST(size AS INTEGER) AS size, freq, ROUND(freq / (SELECT n FROM nb), 6) AS support FROM sets
""")
def r4_frequent_itemsets(spark, sf_dir):
    fi = B.frequent_itemsets(_baskets(spark, sf_dir), SUPPORT)
    return fi.select("itemset", "size", "freq", F.round("support", 6).alias("support"))


@query("r5_rules", f"WITH RECURSIVE {_RULES}\nSELECT {_RULE_COLS} FROM rules")
def r5_rules(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    return _round_rules(B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b)))


@query("r6_rules_for_item", f"""WITH RECURSIVE {_ALL_RULES}
SELECT lhs, rhs, ROUND(support, 6) AS support, ROUND(confidence, 6) AS confidence, ROUND(lift, 6) AS lift, count
FROM all_rules WHERE rhs_item = '{TARGET}'
UNION ALL
SELECT '{{}}', label, ROUND(freq / n, 6), ROUND(freq / n, 6), 1.0, freq
FROM sets, nb WHERE items = ['{TARGET}'] AND freq / n >= {CONFIDENCE}
""")
def r6_rules_for_item(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    return _round_rules(B.rules_for(b, TARGET, SUPPORT, CONFIDENCE, model=_model(b)))


@query("r7_rules_matching", f"WITH RECURSIVE {_RULES}\nSELECT {_RULE_COLS} FROM rules WHERE contains(rhs_item, '{TARGET}')")
def r7_rules_matching(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    r = B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b))
    return _round_rules(B.rules_matching(r, TARGET))


@query("r8_top_rules", f"WITH RECURSIVE {_RULES}\nSELECT {_RULE_COLS} FROM rules ORDER BY lift DESC, lhs, rhs LIMIT 5")
def r8_top_rules(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    r = B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b))
    return _round_rules(B.top_rules(r, "lift", 5))


def _summary_sql():
    q = []
    for m in ("support", "confidence", "lift"):
        q.append(f"SELECT 'quality' AS section, '{m}' AS key, COUNT(*) AS n, ROUND(MIN({m}), 6) AS min, "
                 f"ROUND(quantile_cont({m}, 0.25), 6) AS q1, ROUND(quantile_cont({m}, 0.5), 6) AS median, "
                 f"ROUND(AVG({m}), 6) AS mean, ROUND(quantile_cont({m}, 0.75), 6) AS q3, ROUND(MAX({m}), 6) AS max "
                 "FROM rules")
    return (f"WITH RECURSIVE {_RULES}\nSELECT 'length' AS section, CAST(length AS VARCHAR) AS key, COUNT(*) AS n, CAST(NULL AS DOUBLE) AS min, "
            "CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS mean, "
            "CAST(NULL AS DOUBLE) AS q3, CAST(NULL AS DOUBLE) AS max FROM rules GROUP BY length\nUNION ALL " + "\nUNION ALL ".join(q))


@query("r9_rules_summary", _summary_sql())
def r9_rules_summary(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    s = B.rules_summary(B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b)))
    return s.select("section", "key", "n", *[F.round(c, 6).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")])


@query("r10_prune_rules", f"""WITH RECURSIVE {_RULES},
ranked AS (SELECT *, list_sort(list_distinct(list_concat(antecedent, [rhs_item]))) AS s,
                  ROW_NUMBER() OVER (ORDER BY lift DESC, lhs, rhs) AS rk FROM rules)
SELECT {_RULE_COLS} FROM ranked x
WHERE NOT EXISTS (SELECT 1 FROM ranked y WHERE y.rk < x.rk AND list_has_all(x.s, y.s))
""")
def r10_prune_rules(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    r = B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b))
    return _round_rules(B.prune_rules(r, "lift"))


@query("r11_rules_table", f"""WITH RECURSIVE {_RULES}
SELECT lhs || ' => ' || rhs AS rules, ROUND(support, 6) AS support, ROUND(confidence, 6) AS confidence,
       ROUND(lift, 6) AS lift, count, antecedent AS LHS, rhs_item AS RHS
FROM rules
""")
def r11_rules_table(spark, sf_dir):
    """The columns LHS_1 to LHS_k, as many as the longest rule needs, shown as one
    array, since their number depends on the data."""
    b = _baskets(spark, sf_dir)
    t = B.rules_table(B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b)))
    return t.select("rules", *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift")], "count",
                    F.array_compact(F.array(*[c for c in t.columns if c.startswith("LHS_")])).alias("LHS"), "RHS")


@query("r12_rule_edges", f"""WITH RECURSIVE {_RULES},
top AS (SELECT *, 'rule_' || CAST(ROW_NUMBER() OVER (ORDER BY lift DESC, lhs, rhs) AS VARCHAR) AS rule
        FROM rules ORDER BY lift DESC, lhs, rhs LIMIT 10)
SELECT unnest(antecedent) AS src, rule AS dst FROM top
UNION ALL SELECT rule AS src, rhs_item AS dst FROM top
""")
def r12_rule_edges(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    return B.rule_edges(B.rules(b, SUPPORT, CONFIDENCE, MIN_LENGTH, model=_model(b)), 10, "lift")


@query("j7_subset_pairs", "WITH RECURSIVE " + _SETS + """
SELECT x.label AS sub, y.label AS sup FROM sets x JOIN sets y ON x.label <> y.label AND list_has_all(y.items, x.items)
""")
def j7_subset_pairs(spark, sf_dir):
    """Containment pairs among all frequent item sets, keyed on each subset's
    rarest item."""
    b = _baskets(spark, sf_dir)
    fi = B.frequent_itemsets(b, SUPPORT)
    freq1 = fi.where(F.col("size") == 1).select(F.col("items")[0].alias("item"), F.col("freq").alias("n"))
    pairs = subset_pairs(fi.select("itemset", "items"), "itemset", "items", freq=freq1)
    return pairs.select(F.col("sub_id").alias("sub"), F.col("sup_id").alias("sup"))
