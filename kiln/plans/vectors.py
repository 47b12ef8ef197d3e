"""Vector queries on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import network as N
from kiln.operators.relational import embed, vector_sum
from kiln.plans.registry import query
from kiln.sources.tables import Tables

DIMS, HIDDEN = 64, 4
NET_LR = 0.5
CLASSES = 10
MAX_NORM = 5.0
POOL = 4


def _emb(spark, sf_dir):
    return Tables(spark, sf_dir).embeddings


def net_weights(n_in=DIMS, n_hidden=HIDDEN):
    """Deterministic weights of the network queries, by a rule (multiples of 1/16)."""
    w1 = [[(((i * 5 + j * 3) % 9) - 4) / 16 for j in range(n_hidden)] for i in range(n_in)]
    return w1, [[(j * 2 - 3) / 16] for j in range(n_hidden)]


def affine_weights(n_in=DIMS, n_out=CLASSES):
    """Deterministic weights for the affine query, by a rule (multiples of 1/8)."""
    w = [[(((i * 7 + j * 3) % 11) - 5) / 8 for j in range(n_out)] for i in range(n_in)]
    b = [(j - 5) / 4 for j in range(n_out)]
    return w, b


def _lit_list(vals):
    return "[" + ", ".join(repr(float(v)) for v in vals) + "]"


_E = "CAST(embedding AS DOUBLE[])"


@query("f19_softmax", f"""
SELECT vec_id, list_transform(e, lambda x: ROUND(exp(x - list_max(e)) / list_sum(list_transform(e, lambda y: exp(y - list_max(e)))), 6))
       AS probs
FROM (SELECT vec_id, {_E} AS e FROM embeddings)
""")
def f19_softmax(spark, sf_dir):
    e = A.with_softmax(_emb(spark, sf_dir), "embedding", "probs")
    return e.select("vec_id", A.round_array("probs", 6).alias("probs"))


@query("f20_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings")
def f20_argmax(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", A.argmax("embedding").alias("argmax"))


@query("f21_rescale", f"SELECT vec_id, list_transform({_E}, lambda x: ROUND(x * {1 / 255!r}, 6) + 0.0) AS scaled FROM embeddings")
def f21_rescale(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("vec_id", A.round_array(A.rescale("embedding", 1 / 255), 6).alias("scaled"))


_SUMS = f"""sums AS (
  SELECT label, list(ROUND(s, 6) + 0.0 ORDER BY idx) AS embedding_sum, list(s ORDER BY idx) AS raw, MAX(n) AS n FROM (
    SELECT label, idx, SUM(v) AS s, COUNT(*) AS n FROM (
      SELECT label, generate_subscripts(e, 1) AS idx, unnest(e) AS v FROM (SELECT label, {_E} AS e FROM embeddings))
    GROUP BY label, idx)
  GROUP BY label)"""


@query("g13_vector_sum", f"WITH {_SUMS} SELECT label, embedding_sum FROM sums")
def g13_vector_sum(spark, sf_dir):
    s = vector_sum(_emb(spark, sf_dir), "label", "embedding")
    return s.select("label", A.round_array("embedding_sum", 6).alias("embedding_sum"))


@query("j8_embed", f"""WITH {_SUMS},
cent AS (SELECT label, list_transform(raw, lambda x: x / n) AS centroid FROM sums)
SELECT e.vec_id, e.label, list_transform(c.centroid, lambda x: ROUND(x, 6) + 0.0) AS centroid
FROM embeddings e LEFT JOIN cent c ON e.label = c.label
""")
def j8_embed(spark, sf_dir):
    """Each vector's class centroid, looked up by id (the label) in a centroid table."""
    e = _emb(spark, sf_dir)
    n = e.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    cent = (vector_sum(e, "label", "embedding").join(n, "label")
            .select("label", F.transform("embedding_sum", lambda x: x / F.col("_n")).alias("centroid")))
    out = embed(e.select("vec_id", "label"), cent, "label", vector="centroid")
    return out.select("vec_id", "label", A.round_array("centroid", 6).alias("centroid"))


def _softmax_sql(arr):
    return (f"list_transform({arr}, lambda x: exp(x - list_max({arr})) / "
            f"list_sum(list_transform({arr}, lambda y: exp(y - list_max({arr})))))")


def _affine_array(rounded=False):
    w, b = affine_weights()
    wl = "[" + ", ".join(_lit_list(col) for col in zip(*w)) + "]"
    one = f"list_sum(list_transform(range(1, {DIMS + 1}), lambda i: e[i] * {wl}[j][i])) + {_lit_list(b)}[j]"
    return f"list_transform(range(1, {CLASSES + 1}), lambda j: {f'ROUND({one}, 6) + 0.0' if rounded else one})"


_PROBS = f"""scored AS (SELECT label, {_affine_array()} AS z FROM (SELECT label, {_E} AS e FROM embeddings)),
probs AS (SELECT label, {_softmax_sql("z")} AS p FROM scored)"""


def _probabilities(spark, sf_dir):
    """Class probabilities of whole vectors under the fixed linear classifier."""
    w, b = affine_weights()
    z = _emb(spark, sf_dir).select("label", A.affine("embedding", w, b).alias("z"))
    return A.with_softmax(z, "z", "p").select("label", "p")


@query("q6_nll", f"WITH {_PROBS} SELECT ROUND(AVG(-ln(p[label + 1])), 6) AS loss FROM probs")
def q6_nll(spark, sf_dir):
    e = _probabilities(spark, sf_dir)
    return e.select(A.nll("p", "label").alias("l")).agg(F.round(F.avg("l"), 6).alias("loss"))


@query("q8_affine", f"SELECT vec_id, {_affine_array(True)} AS out FROM (SELECT vec_id, {_E} AS e FROM embeddings)")
def q8_affine(spark, sf_dir):
    w, b = affine_weights()
    e = _emb(spark, sf_dir)
    return e.select("vec_id", A.round_array(A.affine("embedding", w, b), 6).alias("out"))


def _net_sql():
    w1, w2 = net_weights()
    cols = "[" + ", ".join(_lit_list(col) for col in zip(*w1)) + "]"
    hidden = (f"list_transform(range(1, {HIDDEN + 1}), lambda j: 1.0 / (1.0 + exp(-list_sum(list_transform(range(1, {DIMS + 1}), "
              f"lambda i: e[i] * {cols}[j][i])))))")
    return f"""net AS (SELECT vec_id, label, e, h, list_sum(list_transform(range(1, {HIDDEN + 1}), lambda j: h[j] * {_lit_list(r[0] for r in w2)}[j])) AS score
  FROM (SELECT vec_id, label, e, {hidden} AS h FROM (SELECT vec_id, label, {_E} AS e FROM embeddings)))"""


@query("q9_net_score", f"WITH {_net_sql()} SELECT vec_id, ROUND(score, 6) + 0.0 AS score FROM net")
def q9_net_score(spark, sf_dir):
    e = _emb(spark, sf_dir).select("vec_id", "embedding")
    return N.net_score(e, "embedding", *net_weights()).select("vec_id", F.round("score", 6).alias("score"))


def _step_sql():
    w1, w2 = net_weights()
    flat = "[" + ", ".join(_lit_list(row) for row in w1) + "]"
    out = _lit_list(r[0] for r in w2)
    return f"""WITH {_net_sql()},
err AS (SELECT e, h, CAST(label AS DOUBLE) / 10 - score AS err FROM net),
hid AS (SELECT e, h, err, unnest(range(1, {HIDDEN + 1})) AS j FROM err),
back AS (SELECT e, j, {out}[j] * err * h[j] * (1.0 - h[j]) AS t, err * h[j] AS d2 FROM hid),
top AS (SELECT 'hidden_output' AS layer, j - 1 AS i, 0 AS j, {out}[j] + {NET_LR!r} * SUM(d2) / COUNT(*) AS w FROM back GROUP BY back.j),
one AS (SELECT j, t, unnest(range(1, {DIMS + 1})) AS i, unnest(e) AS v FROM back),
low AS (SELECT 'input_hidden' AS layer, i - 1 AS i, j - 1 AS j, {flat}[i][j] + {NET_LR!r} * SUM(t * v) / COUNT(*) AS w FROM one GROUP BY one.i, one.j)
SELECT layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, ROUND(w, 6) + 0.0 AS weight FROM (FROM top UNION ALL FROM low)"""


@query("q10_net_step", _step_sql())
def q10_net_step(spark, sf_dir):
    """One full-batch step on whole vectors, target = label / 10."""
    e = _emb(spark, sf_dir).select(F.col("embedding").alias("x"), (F.col("label") / 10).alias("y"))
    st = N.net_step(e, "x", "y", *net_weights(), NET_LR)
    return st.select("layer", "i", "j", F.round("weight", 6).alias("weight"))


@query("q12_clip_norm", f"""
WITH ss AS (SELECT SUM(list_sum(list_transform({_E}, lambda x: x * x))) AS s FROM embeddings),
r AS (SELECT {MAX_NORM!r} / (sqrt(s) + 1e-6) AS rate FROM ss)
SELECT vec_id, CASE WHEN r.rate < 1 THEN list_transform({_E}, lambda x: ROUND(x * r.rate, 6) + 0.0)
                    ELSE list_transform({_E}, lambda x: ROUND(x, 6) + 0.0) END AS embedding
FROM embeddings, r
""")
def q12_clip_norm(spark, sf_dir):
    e = _emb(spark, sf_dir).select("vec_id", "embedding")
    c = A.clip_norm(e, "embedding", MAX_NORM)
    return c.select("vec_id", A.round_array("embedding", 6).alias("embedding"))


@query("q14_eval_classifier", f"""WITH {_PROBS}
SELECT ROUND(AVG(-ln(p[label + 1])), 6) AS loss,
       ROUND(AVG(CASE WHEN list_position(p, list_max(p)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM probs
""")
def q14_eval_classifier(spark, sf_dir):
    return A.eval_classifier(_probabilities(spark, sf_dir), "p", "label").select(
        F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query("q16_mean_pool", f"""
SELECT vec_id, list_transform(range(0, {POOL}), lambda c: ROUND(list_sum(list_transform(range(0, len(e) // {POOL}),
       lambda p: e[p * {POOL} + c + 1])) / (len(e) // {POOL}), 6) + 0.0) AS pooled
FROM (SELECT vec_id, {_E} AS e FROM embeddings)
""")
def q16_mean_pool(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("vec_id", A.round_array(A.mean_pool("embedding", POOL), 6).alias("pooled"))
