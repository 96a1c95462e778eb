"""Mixing sources to target weights.

The words of each source, document after document, are packed into blocks of a
fixed number of words. Every source gets as many slots as its target needs; a
multinomial draw spreads them over the output shards, so the source counts of
a shard follow the target weights. Slot ``i`` of a source is mapped through
the source's pseudorandom permutation of block indices (a new one for each
pass over the source), and blocks are joined to slots by index. The last slot
of a source is cut short, so the words taken meet the target to the word.

Documents with NULL text have no words. NULL sources are one source (the last).
Documents of one source are laid out by a hash bucket of their id, then id, then
text hash, so no step sorts a source in one task. Repeated rows are documents of
their own. Empty tables give no rows. Other columns are only carried by
:func:`mix_documents`.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textarrow import mix64, raw, slices, word_bounds

BLOCK_WORDS = 256
SHARD_SLOTS = 1024
SHARE, CAP, WEIGHTS = 1.5, 2.0, (3, 1, 2)
SEED = 20240
_ROWS_PER_BUCKET = 10_000          # documents of a layout bucket, about
_SLOTS_PER_CHUNK = 250_000         # slots that one call draws


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size): words of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, words = word_bounds(*raw(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), part.column("text_hash"),
                     pa.array(np.diff(words), pa.int64())], names=["doc_id", "source", "text_hash", "size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("source").cast("string"), F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, f"doc_id {kind}, source string, text_hash long, size long"))


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(sid, source, source_size, target), one row per source.

    Sources in code-point order (NULL last) take the weights in turn. Targets share ``share`` times
    all words by weight; none exceeds ``cap`` times its source, and what is cut off is shared again. That
    fixed point is a water level: sources with the least cap per weight are at their cap, the others
    share the rest. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    ordered = per.withColumn("sid", F.row_number().over(named) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("sid") % len(weights) + 1).cast("int"))
    s = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    everything = Window.partitionBy()
    s = (s.withColumn("below", F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)))
          .withColumn("rest_weight", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
          .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
          .withColumn("level", (F.col("total") - F.coalesce("below", F.lit(0.0))) / F.col("rest_weight"))
          # the first source whose cap lies above the level of those from it on fixes the level
          .withColumn("water", F.min(F.when(F.col("most") >= F.col("level") * F.col("weight"),
                                            F.struct(F.col("most") / F.col("weight"), "sid", "level")))
                      .over(everything)["level"]))
    target = F.when(F.col("water").isNull(), F.col("most")).otherwise(
        F.least("most", F.col("water") * F.col("weight")))
    return s.select("sid", "source", "source_size", target.alias("target"))


def laid_out(sizes: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """Add ``sid``, ``source_size``, ``target`` and ``start`` (words of the source before the document).

    Prefix sums in two steps: within a hash bucket of a source, and over the bucket sums.
    """
    buckets = max(1, -(-rows // _ROWS_PER_BUCKET))
    d = (sizes.join(sources.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
         .withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))))
    sums = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("offset"))
    inner = (Window.partitionBy("sid", "bucket").orderBy("doc_id", "text_hash", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
            .join(offsets, ["sid", "bucket"]).withColumn("start", F.col("offset") + F.col("before"))
            .drop("bucket", "before", "offset"))


class Permutation:
    """Pseudorandom bijection of [0, n): a four-round Feistel network, walked until it lands inside."""

    def __init__(self, n: int, seed: int, source: int, turn: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mix64(np.array([(seed * 1_000_003 + source) * 1_000_003 + turn * 4 + r for r in range(4)], np.uint64))

    def _step(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & self.mask)
        return right << self.half | left

    def _walk(self, x, keys) -> np.ndarray:
        x = np.asarray(x, np.uint64)
        if self.n <= 1:
            return np.zeros(x.shape, np.int64)
        out = self._step(x, keys)
        while (outside := out >= np.uint64(self.n)).any():
            out[outside] = self._step(out[outside], keys)
        return out.astype(np.int64)

    def __call__(self, x):
        return self._walk(x, self.keys)

    def inverse(self, y):
        # the halves are swapped at the end of a step, so the same steps with the keys reversed undo it
        return self._walk(y, self.keys[::-1])


def _shape(size: int, target: float, block: int, seed: int, sid: int) -> tuple[int, int, int, int, int]:
    """(blocks, words of the last block, whole passes, words of the last pass, its slots) of a source."""
    wanted = min(int(target + 0.5), int(2 ** 62))
    blocks = -(-size // block)
    last = size - (blocks - 1) * block
    passes, rest = divmod(wanted, size)
    if not rest:
        return blocks, last, passes, 0, 0
    q = int(Permutation(blocks, seed, sid, passes).inverse([blocks - 1])[0])
    if rest <= q * block:
        slots = -(-rest // block)
    elif rest <= q * block + last:
        slots = q + 1
    else:
        slots = -(-(rest + block - last) // block)
    return blocks, last, passes, rest, slots


def draw_slots(sources: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
               seed: int = SEED) -> DataFrame:
    """(shard, sid, slot, turn, block, take): every slot of the mix, the block it shows and how many of its words.

    ``turn`` numbers the passes over the source. A chunk of slots draws its shards at
    once (sorted, so a chunk's counts per shard are one multinomial draw); seeds depend on source and
    chunk alone, so reruns and retried tasks agree.
    """
    total = F.sum("target").over(Window.partitionBy())

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if not r["source_size"]:
                    continue
                blocks, _, passes, _, more = _shape(r["source_size"], r["target"], block, seed, r["sid"])
                starts = np.arange(0, passes * blocks + more, _SLOTS_PER_CHUNK, dtype=np.int64)
                for at in range(0, len(starts), 10_000):
                    part = starts[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), *[pa.array([r[c]] * len(part), k) for c, k in (
                            ("sid", pa.int32()), ("source_size", pa.int64()), ("target", pa.float64()),
                            ("total", pa.float64()))]], names=["first", "sid", "source_size", "target", "total"])

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sid = r["sid"]
                blocks, last, passes, rest, more = _shape(r["source_size"], r["target"], block, seed, sid)
                i = np.arange(r["first"], min(r["first"] + _SLOTS_PER_CHUNK, passes * blocks + more))
                shards = max(1, int(-(-r["total"] // (block * shard_slots))))
                shard = np.sort(np.random.default_rng([seed, sid, r["first"]]).integers(0, shards, len(i)))
                turn, j = i // blocks, i % blocks
                shown = np.empty(len(i), np.int64)
                for t in np.unique(turn):
                    shown[turn == t] = Permutation(blocks, seed, sid, int(t))(j[turn == t])
                take = np.where(shown == blocks - 1, last, block)
                if rest:
                    q = int(Permutation(blocks, seed, sid, passes).inverse([blocks - 1])[0])
                    before = j * block - np.where(j > q, block - last, 0)
                    take = np.where(turn == passes, np.minimum(take, rest - before), take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(np.full(len(i), sid, np.int32)), pa.array(i),
                     pa.array(turn.astype(np.int32)), pa.array(shown), pa.array(take)],
                    names=["shard", "sid", "slot", "turn", "block", "take"])

    cut = (sources.withColumn("total", total).select("sid", "source_size", "target", "total")
           .mapInArrow(chunks, "first long, sid int, source_size long, target double, total double"))
    return cut.repartition("sid", "first").mapInArrow(
        slots, "shard long, sid int, slot long, turn int, block long, take long")


def mix(docs: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS,
        block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix as pieces of documents: one row per (document, slot that shows words of it).

    Columns: doc_id, source, text_hash, size, source_size, target, start (identifies the document in its source),
    shard, slot, turn, word_from, word_to (word numbers in the document). A document of which nothing
    is taken has one row with NULL slot. ``docs`` needs doc_id, source and text.
    """
    sizes = materialize(document_sizes(docs))
    sources = materialize(source_targets(sizes, share, cap, weights))
    placed = laid_out(sizes, sources, sizes.count())
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    # the slots come from the few rows of ``sources``, so the planner's size for them is far too low: never broadcast
    shown = pieces.join(draw_slots(sources, block, shard_slots, seed).hint("merge"), ["sid", "block"], "left")
    base, taken = F.col("block") * block, F.col("slot").isNotNull()
    return shown.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", "start", "shard", "slot", "turn",
        F.when(taken, F.greatest(base - F.col("start"), F.lit(0))).alias("word_from"),
        F.when(taken, F.least(base + F.col("take") - F.col("start"), F.col("size"))).alias("word_to"))


def taken_words(pieces: DataFrame) -> DataFrame:
    """Words taken of each document, repeats counted (one row per document)."""
    words = F.when(F.col("slot").isNotNull(), F.greatest(F.col("word_to") - F.col("word_from"), F.lit(0)))
    # documents without words share their place: they stay rows of their own by count
    got = pieces.groupBy("doc_id", "source", "text_hash", "size", "source_size", "target", "start").agg(
        F.coalesce(F.sum(words), F.lit(0)).alias("taken"), F.count(F.when(F.col("size") == 0, 1)).alias("empties"))
    return got.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("empties", F.lit(1))))).drop("copy", "empties")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus in ``docs``'s columns: per document and pass, the words taken, in order.

    ``text`` is cut from the original (white space between words kept; cut-out stretches leave one
    line break), ``n_chars`` (if present) is its new length. Rows with nothing taken go.
    """
    columns = docs.columns
    pieces = mix(docs, **options).where("word_to > word_from")
    spans = pieces.groupBy("doc_id", "source", "text_hash", "start", "turn").agg(
        F.sort_array(F.collect_list(F.struct("word_from", "word_to"))).alias("spans"))
    plan = spans.groupBy("doc_id", "source", "text_hash").agg(F.collect_list("spans").alias("copies"))
    # rows alike in id, source and text are interchangeable: one of them stands for all their copies
    whole = docs.withColumn("__hash", F.xxhash64("text")).groupBy(
        F.col("doc_id").alias("__id"), F.col("source").cast("string").alias("__source"), "__hash").agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("row"))
    plan = plan.withColumnsRenamed({"doc_id": "__pid", "source": "__psource", "text_hash": "__phash"})
    both = whole.join(plan, F.col("__id").eqNullSafe(F.col("__pid")) & F.col("__source").eqNullSafe(F.col("__psource"))
                      & (F.col("__hash") == F.col("__phash")))
    rows = both.select("row", F.explode("copies").alias("spans"))
    flat = rows.select(*[F.col("row")[c].alias(c) for c in columns], F.col("spans").alias("__spans"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = raw(part.column("text"))
                starts, ends, words = word_bounds(data, offsets)
                texts, whole_bytes = [], data.tobytes()
                for n, spans in enumerate(part.column("__spans").to_pylist()):
                    joined: list[list[int]] = []
                    for s in spans:
                        if joined and joined[-1][1] == s["word_from"]:
                            joined[-1][1] = s["word_to"]
                        else:
                            joined.append([s["word_from"], s["word_to"]])
                    texts.append("\n".join(whole_bytes[starts[words[n] + a]:ends[words[n] + b - 1]].decode("utf-8")
                                           for a, b in joined))
                made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in columns],
                                                 names=columns)

    kinds |= {"text": "string"} | ({"n_chars": "bigint"} if "n_chars" in kinds else {})
    return flat.mapInArrow(cut, ", ".join(f"`{c}` {kinds[c]}" for c in columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "source", "text")
    return taken_words(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")
