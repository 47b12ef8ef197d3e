"""Source/sink queries (S1-S3, S5-S8): round trips through the shared
checkpoint folder, on data derived from the test tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from kiln.functions.columns import fmt2  # noqa: F401
from kiln.operators import sequence as S
from kiln.plans.projections import _fmt2_sql
from kiln.plans.sequence import _VOCAB
from kiln.plans.registry import query
from kiln.sources import files as IO
from kiln.sources.tables import Tables
from kiln.sources.views import views
from kiln.session import scratch_dir


@query("s1_read_csv", "SELECT * FROM customer")
def s1_read_csv(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    path = scratch_dir(spark, "customer-csv")
    IO.write_delimited(c, path)
    return IO.read_csv(spark, path, schema=c.schema)


@query("s2_read_tsv", "SELECT * FROM orders")
def s2_read_tsv(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = scratch_dir(spark, "orders-tsv")
    IO.write_delimited(o, path, sep="\t")
    return IO.read_tsv(spark, path, schema=o.schema)


@query("s3_read_head", """
SELECT * FROM order_products ORDER BY order_id, add_to_cart_order, product_id, reordered LIMIT 20000
""")
def s3_read_head(spark, sf_dir, n=20000):
    return IO.read_head(views(spark, sf_dir).order_products, n,
                        ["order_id", "add_to_cart_order", "product_id", "reordered"])


@query("s5_cached_table", f"WITH {_VOCAB} SELECT token, token_id FROM vocab")
def s5_cached_table(spark, sf_dir):
    """Vocabulary written once to the shared folder and read back on reuse."""
    path = scratch_dir(spark, "vocab")
    voc = S.vocab(S.tokens(Tables(spark, sf_dir).documents.select("doc_id", "text")))
    first = IO.cached_table(voc, path)
    return IO.cached_table(first, path)  # second call finds the table and reads it


@query("s6_read_labelled_dir", """
SELECT 'cls=class_' || label AS label, CAST(ROW_NUMBER() OVER (ORDER BY 'class_' || label) - 1 AS INTEGER) AS class_index, true AS has_bytes
FROM (SELECT DISTINCT label FROM embeddings)
""")
def s6_read_labelled_dir(spark, sf_dir):
    """Vectors written into one folder per class, then scanned as files: the classes
    of the files found (how many files a class has depends on the writer)."""
    path = scratch_dir(spark, "labelled")
    e = Tables(spark, sf_dir).embeddings
    (e.withColumn("cls", F.concat(F.lit("class_"), F.col("label").cast("string")))
      .write.mode("overwrite").partitionBy("cls").parquet(path))
    files = IO.read_labelled_dir(spark, path)
    return files.select("label", "class_index", (F.col("length") > 0).alias("has_bytes")).distinct()


@query("s7_save_load_model", """
SELECT ts_hour, cnt, ROUND(temp * (SELECT regr_slope(cnt, temp) FROM hourly) + (SELECT regr_intercept(cnt, temp) FROM hourly), 6) AS prediction
FROM hourly
""")
def s7_save_load_model(spark, sf_dir):
    h = views(spark, sf_dir).hourly
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["temp"], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol="cnt", solver="normal")])
    path = scratch_dir(spark, "model")
    IO.save_model(pipe.fit(h), path)
    return IO.load_model(path).transform(h).select("ts_hour", "cnt", F.round("prediction", 6).alias("prediction"))


@query("s8_report", f"""
SELECT department, {_fmt2_sql('avg_price')} AS avg_price, {_fmt2_sql('revenue')} AS revenue, n
FROM (SELECT p_type AS department, AVG(l_extendedprice / l_quantity) AS avg_price,
             SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, COUNT(*) AS n
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)
""")
def s8_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .groupBy(F.col("p_type").alias("department"))
         .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_price"),
              F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
              F.count(F.lit(1)).alias("n")))
    return IO.report(g, 2)
