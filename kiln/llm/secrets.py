"""Secret scans: patterns, and weak parts linked to complementary ones nearby."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import frozen, table, text_of
from kiln.llm.registry import query

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Weak parts: a name of an account, a bare key, an address.
IDENT = r"""(?i)(user_?name|user_?id|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)"""
KEY = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"""(?i)https?://[^\x20\x09-\x0D"'<>]+"""
MIN_VALUE, MIN_ACCESS, MIN_HEX, SCOPE = 6, 20, 24, 200

KINDS = ["assign", "access", "hex", "ident", "key", "endpoint"]
_DOC = ["_id", "_tk"]


def _matches(text, kind: str, pattern: str):
    """Array of (kind, gap, found): the matches in order, gap being the number
    of code points since the match before. Empty without a match."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    rows = F.transform(found, lambda m, i: F.struct(F.lit(kind).alias("kind"), F.length(F.get(gaps, i)).alias("gap"), m.alias("found")))
    return F.when(text.rlike(pattern), rows)


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All strong and weak parts: _id, _tk (hash of the text), kind, start, end.

    A run of hex digits or of an access key shorter than its minimum fails
    whatever its start, so these patterns hold their minimum; a value is
    measured after the match, since a failing one also uses up its text.
    """
    text = F.col("_text")
    scans = [("assign", ASSIGN), ("access", ACCESS[:-1] + f"{{{MIN_ACCESS - 4},}}"), ("hex", HEX[:-1] + f"{{{MIN_HEX},}}"),
             ("ident", IDENT), ("key", KEY), ("endpoint", ENDPOINT)]
    empty = F.array().cast("array<struct<kind:string,gap:int,found:string>>")
    rows = (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_tk", F.xxhash64("_text"))
                .select(*_DOC, F.array(*[F.coalesce(_matches(text, k, p), empty) for k, p in scans]).alias("_all"))
                .select(*_DOC, F.explode("_all").alias("_own")).where(F.size("_own") > 0)
                .select(*_DOC, F.posexplode("_own").alias("_i", "_m"))
                .select(*_DOC, "_i", "_m.kind", "_m.gap", F.length("_m.found").alias("len"),
                        F.when(F.col("_m.kind") == "assign", F.length(F.regexp_extract("_m.found", ASSIGN, 2)))
                        .otherwise(F.lit(MIN_VALUE)).alias("value_len"))
                .dropDuplicates([*_DOC, "kind", "_i"]))
    run = Window.partitionBy(*_DOC, "kind").orderBy("_i")
    return (rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(run)).where(F.col("value_len") >= MIN_VALUE)
                .select(*_DOC, "kind", (F.col("end") - F.col("len")).alias("start"), "end"))


def _near(cand: DataFrame, other: DataFrame, scope: int) -> DataFrame:
    """Rows of ``cand`` with a row of ``other`` at most ``scope`` away in the same
    document: an equi-join on (document, bin of ``scope`` code points). A bin
    holds a bounded number of parts, since those of a kind don't overlap."""
    lo, hi = F.col("start") - scope, F.col("end") + scope
    left = cand.withColumn("_bin", F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope))))
    right = (other.select(F.col("_id").alias("_oid"), F.col("_tk").alias("_otk"), F.col("start").alias("_s"), F.col("end").alias("_e"),
                          F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("_obin")))
    same = F.col("_id").eqNullSafe(F.col("_oid")) & (F.col("_tk") == F.col("_otk")) & (F.col("_bin") == F.col("_obin"))
    return left.join(right, same & (F.col("_s") <= hi) & (F.col("_e") >= lo), "left_semi").drop("_bin").distinct()


def linked_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base spans, and the weak ones whose complement lies within ``scope``: an
    account name needs a secret, a bare key an identifier, an address both.
    Bare keys that overlap a base span are part of it and not reported."""
    base = found.where(F.col("kind").isin("assign", "access", "hex"))
    keys = found.where("kind = 'key'")
    own = base.select(F.col("_id").alias("_bid"), F.col("_tk").alias("_btk"), F.col("start").alias("_bs"), F.col("end").alias("_be"),
                      F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("_bbin"))
    keys = (keys.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
                .join(own, F.col("_id").eqNullSafe(F.col("_bid")) & (F.col("_tk") == F.col("_btk")) & (F.col("_bin") == F.col("_bbin"))
                      & (F.col("_bs") < F.col("end")) & (F.col("_be") > F.col("start")), "left")
                .groupBy(*_DOC, "kind", "start", "end").agg(F.count("_bs").alias("_over")).where("_over = 0").drop("_over"))
    idents = found.where(F.col("kind").isin("access", "ident"))
    secrets = found.where(F.col("kind").isin("assign", "hex")).unionByName(keys)
    return (base.unionByName(_near(found.where("kind = 'ident'"), secrets, scope))
                .unionByName(_near(keys, idents, scope))
                .unionByName(_near(_near(found.where("kind = 'endpoint'"), secrets, scope), idents, scope)))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and spans, an array of (start,
    rank, end, kind) in order of start, then kind as listed in ``KINDS``; offsets
    are code points, end exclusive.

    Null text is empty and has no span. Rows that repeat id and text get the
    same answer; rows that share an id (or have none) and differ in text are
    scanned each for itself. An empty table gives an empty result; other columns
    are ignored. Texts are scanned in place: only spans are shuffled.
    """
    spans = linked_parts(frozen(parts(docs, id_col, text_col)), scope)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    lists = spans.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct(
        F.col("start").cast("long").alias("start"), rank.alias("rank"), F.col("end").cast("long").alias("end"), "kind"))).alias("spans"))
    rows = docs.select(F.col(id_col).alias("_did"), F.xxhash64(text_of(text_col)).alias("_dtk"))
    return (rows.join(lists, F.col("_did").eqNullSafe(F.col("_id")) & (F.col("_dtk") == F.col("_tk")), "left")
                .select(F.col("_did").alias(id_col), F.coalesce("spans", F.array().cast(
                    "array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>")).alias("spans")))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


_KIND_SQL = r"""
{k}0 AS (SELECT doc_id, '{k}' AS kind, {r} AS rank, regexp_extract_all(t, '{p}', 0{o}) AS m, regexp_extract_all(t, '{p}', {g}{o}) AS v,
                string_split_regex(t, '{q}') AS gaps FROM d),
{k}1 AS (SELECT doc_id, kind, rank, unnest(m) AS m, unnest(v) AS v, unnest(gaps[:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM {k}0 WHERE len(m) > 0),
{k}2 AS (SELECT doc_id, kind, rank, v, length(m) AS n, (sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS e FROM {k}1),
{k} AS (SELECT doc_id, kind, rank, e - n AS s, e FROM {k}2 WHERE length(v) >= {least}),"""


def _oracle() -> str:
    def kind(k, r, p, g=0, least=0):
        body = p.removeprefix("(?i)").replace("'", "''")
        return _KIND_SQL.format(k=k, r=r, p=body, q=("(?i)" if p != body and p.startswith("(?i)") else "") + body, g=g, least=least,
                                o=", 'i'" if p.startswith("(?i)") else "")
    near = "EXISTS (SELECT 1 FROM {o} o WHERE o.doc_id = c.doc_id AND o.s <= c.e + 200 AND o.e >= c.s - 200)"
    sql = "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),"
    sql += (kind("assign", 1, ASSIGN, 2, MIN_VALUE) + kind("access", 2, ACCESS, 0, MIN_ACCESS) + kind("hex", 3, HEX, 0, MIN_HEX)
            + kind("ident", 4, IDENT) + kind("anykey", 5, KEY) + kind("endpoint", 6, ENDPOINT))
    return sql + f"""
base AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
bare AS (SELECT doc_id, 'key' AS kind, rank, s, e FROM anykey c
         WHERE NOT EXISTS (SELECT 1 FROM base o WHERE o.doc_id = c.doc_id AND o.s < c.e AND o.e > c.s)),
idents AS (SELECT * FROM access UNION ALL SELECT * FROM ident),
hidden AS (SELECT * FROM assign UNION ALL SELECT * FROM hex UNION ALL SELECT * FROM bare),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM ident c WHERE {near.format(o='hidden')}
          UNION ALL SELECT * FROM bare c WHERE {near.format(o='idents')}
          UNION ALL SELECT * FROM endpoint c WHERE {near.format(o='hidden')} AND {near.format(o='idents')})
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) FILTER (WHERE rank <= 3), '')) AS base_sha256,
       coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) FILTER (WHERE kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id GROUP BY d.doc_id"""


@query("op10_secret_scan", _oracle())
def op10_secret_scan(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents"))

    def number(k):
        return F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["rank"] <= 3)
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
