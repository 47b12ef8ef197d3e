"""Mixing sources to target weights: capped water-filling and seeded repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import WORD, frozen, packed, table, text_of
from kiln.llm.registry import query
from kiln.operators.indexing import prefix_sum, row_index


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """Targets of the sources by water-filling.

    ``sizes`` has one row per source: source, source_size. The sources by code
    point (null last) get ``weights``, repeated in turn, and share ``share`` x
    all sizes by weight. No target is above ``max_epochs`` x its source's size;
    what is over goes to the others by weight, again and again, until none is
    above. Where all are at their limit, the targets sum to less. Adds weight
    and target (double).

    The level ``target / weight`` is found by repeated sums over the sources;
    only two numbers come to the driver in each round.
    """
    ranked = row_index(sizes, [F.col("source").asc_nulls_last()], name="_rank")
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    rated = frozen(ranked.select("source", "source_size", pick.alias("weight"),
                                 (F.col("source_size") * max_epochs).alias("_most")))
    total, level = rated.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        full = F.col("_most") < F.col("weight") * F.lit(level)
        held, free = rated.agg(F.sum(F.when(full, F.col("_most"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        nxt = (total * share - (held or 0)) / free
        if nxt <= level:
            break
        level = nxt
    want = F.col("weight") * F.lit(level)
    return rated.withColumn("target", F.when(F.col("_most") < want, F.col("_most").cast("double")).otherwise(want)).drop("_most")


def _draw(seed: str, id_col: str):
    return F.struct(F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("h"), F.col(id_col).alias("i")).alias("_draw")


def mix_plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: str = "mix",
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): the documents as (_id, source, size, _draw), and per source
    source_size, target, whole (repetitions of every document) and the draw up to
    which documents are taken once more (_cut, null for none).

    size counts the words of the whole text. Documents of a source are drawn in
    the order of a seeded hash of their id; one more repetition is taken of those
    whose middle word lies before the part of the target that whole repetitions
    leave, so the source comes within half a document of its target.
    """
    sized = frozen(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                               F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"), _draw(seed, id_col)))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, max_epochs)
    ahead = prefix_sum(sized, [F.col("source").asc_nulls_last(), F.col("_draw"), F.col("size")], "size", name="_ahead")
    first = ahead.groupBy("source").agg(F.min("_ahead").alias("_start"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    parts = frozen(targets.join(first.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                    .withColumn("whole", whole)
                    .withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size")))
    middle = F.col("_ahead") - F.col("_start") + F.col("size") / 2.0
    cuts = (_join_sources(ahead.withColumnRenamed("source", "_s"), parts.select("source", "_start", "_rest"), **options)
                 .where((F.col("size") > 0) & (middle < F.col("_rest")))
                 .groupBy("source").agg(F.max("_draw").alias("_cut")).withColumnRenamed("source", "_s"))
    plan = (parts.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left")
                 .select("source", "source_size", "weight", "target", "whole", "_cut"))
    return sized, frozen(plan)


def _join_sources(rows: DataFrame, rules: DataFrame, sources_to_broadcast: int = 50_000, salts: int = 64) -> DataFrame:
    """``rows`` (with _s, the source) joined to the source's row of ``rules``. Up
    to ``sources_to_broadcast`` sources, counted first, are broadcast (about
    10 MB); of more, each is repeated for ``salts`` salts, so that a source with a
    third of all rows is spread over as many keys."""
    same = F.col("_s").eqNullSafe(F.col("source"))
    if rules.count() <= sources_to_broadcast:
        return rows.join(F.broadcast(rules), same)
    spread = rules.withColumn("_rule_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("_draw"), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", salt).join(spread, same & (F.col("_salt") == F.col("_rule_salt"))).drop("_salt", "_rule_salt")


def _copies():
    return (F.col("whole") + F.when(F.col("_draw") <= F.col("_cut"), F.lit(1)).otherwise(F.lit(0))).cast("long")


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc id, source, size, source_size, target,
    copies and taken (words that the mix takes, repeats counted).

    A null text has size 0; a null source is a source of its own, the last one;
    a null id is drawn first; rows that repeat an id are taken alike. An empty
    table gives an empty result. See ``mix_plan`` for the options.
    """
    sized, plan = mix_plan(docs, **options)
    joins = {k: v for k, v in options.items() if k in ("sources_to_broadcast", "salts")}
    return (_join_sources(sized.withColumnRenamed("source", "_s"), plan, **joins)
                 .withColumn("copies", _copies())
                 .select(F.col("_id").alias(options.get("id_col", "doc_id")), "source", "size", "source_size", "target",
                         "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix_sources(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its
    repetition number in ``epoch``. Texts are shuffled only where there are too
    many sources to broadcast."""
    _, plan = mix_plan(docs, seed=seed, id_col=id_col, source_col=source_col, **options)
    others = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "epoch"])
    joins = {k: v for k, v in options.items() if k in ("sources_to_broadcast", "salts")}
    return (_join_sources(others.select(packed(others), _draw(seed, id_col), F.col(source_col).alias("_s")), plan, **joins)
                  .withColumn("copies", _copies()).where("copies > 0")
                  .select("_row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("epoch")))


@query("op1_mix_sources", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(concat('mix:', doc_id)) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS i FROM s),
w AS (SELECT source, source_size, 2 * source_size AS most, [3, 1, 2][(i % 3 + 1)::INT] AS weight FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY most::DOUBLE / weight, source) AS k,
             sum(most) OVER (ORDER BY most::DOUBLE / weight, source) AS held,
             sum(weight) OVER (ORDER BY most::DOUBLE / weight, source) AS gone FROM w),
c AS (SELECT 0 AS k, (SELECT sum(source_size) * 1.5::DOUBLE / sum(weight) FROM w) AS level
      UNION ALL SELECT k, ((SELECT sum(source_size) FROM w) * 1.5::DOUBLE - held) / ((SELECT sum(weight) FROM w) - gone) AS level
      FROM o WHERE gone < (SELECT sum(weight) FROM w)),
l AS (SELECT level FROM c WHERE (SELECT count(*) FROM w WHERE w.most < w.weight * c.level) = c.k),
t AS (SELECT source, source_size, CASE WHEN most < weight * level THEN most::DOUBLE ELSE weight * level END AS target FROM w, l),
a AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN size > 0 AND ahead + size / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM a
""")
def op1_mix_sources(spark, sf_dir):
    return mix_counts(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
