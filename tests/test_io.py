"""Readers and writers: multi-line CSV, doubled quotes, footers, headers, single file."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from riskframe.session import scratch_path
from riskframe.sources import files

CSV = ('id,desc,amount\n'
       '1,"line one\nline two",10.5\n'
       '2,"say ""hi"", then go",20\n'
       '3,plain,30\n'
       'Total amount funded,,\n')


def _write(tmp_dir, text, name="loans.csv"):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_raw_csv_multiline_and_quotes(spark, tmp_dir):
    df = files.read_raw(spark, _write(tmp_dir, CSV),
                        valid_row=F.col("amount").isNotNull())
    rows = df.collect()
    assert [r["id"] for r in rows] == ["1", "2", "3"]
    assert rows[0]["desc"] == "line one\nline two"
    assert rows[1]["desc"] == 'say "hi", then go'
    assert all(isinstance(v, str) for v in rows[0])


def test_apply_header_checks_count(spark, tmp_dir):
    df = files.read_raw(spark, _write(tmp_dir, CSV), header=False)
    assert files.apply_header(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    with pytest.raises(ValueError):
        files.apply_header(df, ["a", "b"])


def test_typed_read_with_schema(spark, tmp_dir):
    df = files.read_typed(spark, _write(tmp_dir, CSV), schema="id INT, desc STRING, amount DOUBLE")
    assert [r["amount"] for r in df.collect()][:3] == [10.5, 20.0, 30.0]


def test_write_table_roundtrip_and_single_csv(spark):
    df = spark.createDataFrame([(i, f"t{i}", i * 1.5) for i in range(50)], "k int, t string, v double")
    p = scratch_path(spark, "roundtrip")
    files.write_table(df.repartition(4), p, partition_by=["k"])
    assert spark.read.parquet(p).count() == 50
    single = scratch_path(spark, "single")
    files.write_single_csv(df.repartition(5), single)
    parts = glob.glob(os.path.join(single.removeprefix("file:"), "part-*"))
    assert len(parts) == 1


def test_scratch_under_checkpoint_dir(spark):
    root = spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root)


def test_ingest_raw_to_parquet(spark, tmp_dir):
    out = scratch_path(spark, "ingest")
    df = files.ingest_raw(spark, _write(tmp_dir, CSV), out, casts={"amount": "double"},
                          partitions=3, valid_row=F.col("amount").isNotNull())
    assert sorted(r["amount"] for r in df.collect()) == [10.5, 20.0, 30.0]
    assert dict(df.dtypes)["amount"] == "double"
