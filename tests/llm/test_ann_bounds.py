"""What a task of the neighbour search holds at once, where little can be left out."""

import numpy as np
import pandas as pd
import pytest

from riskframe.llm import ann


def bounded(run):
    """The same function, but a batch of visits above 6 MB is an error."""
    def checked(batches):
        for batch in run(batches):
            if "query_id" in batch.schema.names and batch.nbytes > 6 << 20:
                raise MemoryError(f"{batch.nbytes} bytes in one batch of {batch.num_rows} visits")
            yield batch
    return checked


def test_visits_come_in_bounded_batches(spark, monkeypatch):
    """Vectors without structure: each of 7,500 queries has nearly all leaves to visit, 100 MB of query vectors in all."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((15_000, 64))
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}), "vec_id long, embedding array<double>")
    frame = type(table)
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, *rest: plain(self, bounded(run), *rest))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")          # thousands of queries in a task
    try:
        got = ann.nearest(table, table.where("vec_id % 2 = 0")).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 7500 * 20 and got.groupby("query_id")["rank"].max().eq(20).all()
    hits = 0
    for i in range(0, 15_000, 500):
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & set(got.loc[got.query_id == i, "vec_id"]))
    assert hits >= 0.9 * 20 * 30


@pytest.mark.parametrize("sizes", [[0, 5, 0], [1] * 100, [5000, 1, 1, 9000, 0, 4095, 2]])
def test_bundles_of_leaves_are_bounded(sizes):
    index = ann.Index(1.0, np.zeros((2, 8)), [], [], [], [], len(sizes))
    index.rows = np.array(sizes)
    index.tie()
    assert index.bundle[0] == 0 and set(np.diff(index.bundle)) <= {0, 1} and index.bundle_rows().sum() == sum(sizes)
    for b, n in enumerate(index.bundle_rows()):
        leaves = np.flatnonzero(index.bundle == b)
        assert index.bit[leaves].tolist() == list(range(len(leaves))) and len(leaves) <= ann.BUNDLE_LEAVES
        assert n <= ann.CHUNK_VECTORS or len(leaves) == 1
