"""Readers/writers: CSV with CRLF and empty cells, TSV, cached tables,
labelled folders, streaming per-row work."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kiln.functions.columns import strip_chars
from kiln.sources import files as IO
from kiln.sources.tables import Tables
from kiln.streaming import run_to_files, stream_parquet

MEMBERSHIP_CSV = "m1,m2,m3,mean\r\nA,,,1\r\nB,,,3\r\nA,B,,4\r\nA,B,C,9\r\n"


def test_csv_crlf_and_empty_cells(spark):
    d = tempfile.mkdtemp(prefix="kiln-csv-")
    with open(os.path.join(d, "m.csv"), "w", newline="") as f:
        f.write(MEMBERSHIP_CSV)
    df = IO.read_csv(spark, d, schema="m1 string, m2 string, m3 string, mean int")
    rows = df.orderBy("mean").collect()
    assert [r.mean for r in rows] == [1, 3, 4, 9]
    assert rows[0].m2 is None and rows[3].m3 == "C"
    inferred = IO.read_csv(spark, d)
    assert dict(inferred.dtypes)["mean"] == "int"


def test_tsv_round_trip(spark, sf):
    c = Tables(spark, sf).customer
    d = tempfile.mkdtemp(prefix="kiln-tsv-")
    IO.write_delimited(c, d + "/t", sep="\t")
    back = IO.read_tsv(spark, d + "/t", schema=c.schema)
    assert back.exceptAll(c).count() == 0 and c.exceptAll(back).count() == 0


def test_cached_table_reused(spark):
    d = tempfile.mkdtemp(prefix="kiln-cache-") + "/t"
    first = IO.cached_table(spark.range(5), d)
    second = IO.cached_table(spark.range(100), d)
    assert first.count() == 5 and second.count() == 5


def test_labelled_dir(spark):
    d = tempfile.mkdtemp(prefix="kiln-img-")
    for label, n in (("beta", 2), ("alpha", 3)):
        os.makedirs(os.path.join(d, label))
        for i in range(n):
            with open(os.path.join(d, label, f"{i}.bin"), "wb") as f:
                f.write(b"x" * (i + 1))
    rows = IO.read_labelled_dir(spark, d).collect()
    assert len(rows) == 5
    assert {r.label: r.class_index for r in rows} == {"alpha": 0, "beta": 1}


def test_read_head_is_ordered(spark, sf):
    o = Tables(spark, sf).orders
    h = IO.read_head(o, 10, ["o_orderkey"]).collect()
    assert [r.o_orderkey for r in h] == sorted(r.o_orderkey for r in o.collect())[:10]


def test_stream_rowwise(spark, sf):
    e = Tables(spark, sf).events
    src = tempfile.mkdtemp(prefix="kiln-stream-")
    e.select("event_id", "props").write.mode("overwrite").parquet(src + "/in")
    sdf = stream_parquet(spark, src + "/in", e.select("event_id", "props").schema, max_files_per_trigger=1)
    out = run_to_files(sdf, src + "/out", lambda d: d.select("event_id", strip_chars("props").alias("clean")),
                       checkpoint=src + "/ckpt")
    assert out.count() == e.count()
    assert out.where(F.col("clean").contains("{")).count() == 0


def test_cached_table_repairs_unreadable_folder(spark):
    d = tempfile.mkdtemp(prefix="kiln-cache-") + "/t"
    os.makedirs(d + "/_temporary")  # what a failed job leaves behind
    assert IO.cached_table(spark.range(7), d).count() == 7


def test_a_cluster_needs_a_shared_folder():
    """No private folder stands in for a missing setting outside of local mode."""
    from types import SimpleNamespace
    from kiln.session import checkpoint_root
    here = []
    def session(master, setting=None):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=here.append)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: setting))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            checkpoint_root(session(master))
    assert checkpoint_root(session("yarn", "hdfs:///x/")) == "hdfs:///x" and here == ["hdfs:///x/"]
    assert checkpoint_root(session("local[4]")) == here[-1]


def test_na_is_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,NA\nNA,b\n,c\n")
    rows = IO.read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, None), (None, "b"), (None, "c")]


def test_dates_in_several_forms(spark):
    from kiln.functions import columns as C
    df = spark.createDataFrame([("2020-01-05",), ("2020/1/5",), ("20200105",), ("2020.01.05",), ("x",), (None,)], "s string")
    got = [r.d and r.d.isoformat() for r in df.select(C.parse_date("s").alias("d")).collect()]
    assert got == ["2020-01-05"] * 4 + [None, None]


def test_flag_ignores_case_of_the_pattern_too(spark):
    from kiln.functions import columns as C
    df = spark.createDataFrame([("Organic x",), ("plain",)], "s string")
    assert [r.f for r in df.select(C.flag_contains("s", "Organic", "y", "n").alias("f")).collect()] == ["y", "n"]
