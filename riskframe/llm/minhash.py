"""MinHash near-dedup: fast similarity sketching, banding, exact verification.

Sketch: in round i each shingle is hashed into one of t bins with a value; a bin
keeps the least (round, value) that ever falls into it. Rounds go on until all bins of a document
are filled; from round t on, round t + j sends every shingle to bin j, so 2t rounds always
suffice. Two sets agree on a coordinate with their Jaccard similarity as probability.

Bands of r coordinates are hashed; documents that share a band are candidates.
Equal sets are one class first, so exact copies are never compared. Within a bucket
every class is checked against one representative. Buckets whose classes are then still in different
components are tested as a whole, in blocks that one task holds: every pair across components is counted, but only
links leave the task. So no link is lost to the shortcut, and no group emits its pairs.

A document's set: its distinct 5-word shingles of A-Z-lower-cased words; with fewer words the whole
sequence as one; without words, empty and linked with nothing. Links need 100 * |intersection| >=
percent * |union|, confirmed on the full sets (64-bit shingle hashes). NULL text
has no words. Rows with one doc_id are one document for linking; rows with a NULL id count as one document
that sorts last. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, stage_table
from .components import components
from .textarrow import ascii_lower, gram_hashes, mix64, raw, seeded, signed, slices, word_bounds, word_hashes

SHINGLE, PERCENT = 5, 85
#: 26 bands of 5 rows: a pair of similarity 0.85 shares no band with probability 2e-7.
BANDS, ROWS = 26, 5
_FILTER_BITS = 25                      # 2^25 bits (4 MB): which documents are candidates
_BLOCK_SHINGLES = 400_000              # of a bucket's block, about (8 bytes each)
_NO_ID = (1 << 63) - 1

_U = np.uint64


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, end to end, and their offsets (n + 1)."""
    data, offsets = raw(column)
    data = ascii_lower(data)
    starts, ends, words = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    grams = gram_hashes(hashes, k)
    sets, sizes = [], np.zeros(len(offsets), np.int64)
    for d, (a, b) in enumerate(zip(words[:-1].tolist(), words[1:].tolist())):
        if b - a >= k:
            one = grams[a:b - k + 1].copy()
            one.sort()
            if len(one) > 1:
                one = one[np.concatenate([[True], one[1:] != one[:-1]])]
        elif b > a:
            one = gram_hashes(hashes[a:b], b - a)
        else:
            continue
        sets.append(one)
        sizes[d + 1] = len(one)
    return (np.concatenate(sets) if sets else np.zeros(0, _U)), np.cumsum(sizes)


def sketches(elements: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches: (documents, t) words; rows of empty sets stay at the largest value."""
    docs = len(offsets) - 1
    most = np.iinfo(np.uint64).max
    sketch = np.full(docs * t, most, _U)
    sizes = np.diff(offsets)
    active = np.flatnonzero(sizes > 0)
    owner = np.repeat(np.arange(docs), sizes)
    seeds = seeded(2 * t, 23)
    for i in range(t):
        if not len(active):
            return sketch.reshape(docs, t)
        if len(active) < docs:
            chosen = np.zeros(docs, bool)
            chosen[active] = True
            here = chosen[owner]
            elements, owner = elements[here], owner[here]
        h = mix64(elements ^ seeds[i])
        # bin from the high half, value from the low half: later rounds never beat earlier ones
        place = ((h >> _U(32)) * _U(t)) >> _U(32)
        np.minimum.at(sketch, owner * t + place.astype(np.int64), _U(i) << _U(32) | (h & _U(0xFFFFFFFF)))
        active = active[(sketch.reshape(docs, t)[active] == most).any(axis=1)]
    for j in range(t):                         # the rounds that fill bin j for certain
        lacking = active[sketch.reshape(docs, t)[active, j] == most]
        for d in lacking.tolist():
            h = mix64(elements[owner == d] ^ seeds[t + j]) & _U(0xFFFFFFFF)
            sketch[d * t + j] = _U(t + j) << _U(32) | h.min()
    return sketch.reshape(docs, t)


def sketch_documents(docs: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands): set size, a 128-bit sum identifying the set, and the band hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                elements, offsets = shingle_sets(part.column("text"), k)
                table = sketches(elements, offsets, bands * rows)
                number = gram_hashes(np.arange(bands, dtype=_U), 1)
                with np.errstate(over="ignore"):
                    salt = seeded(rows, 31) | _U(1)
                    keys = mix64((table.reshape(len(table), bands, rows) * salt).sum(axis=2, dtype=_U) ^ number)
                    sums = [np.concatenate([[_U(0)], np.cumsum(mix64(elements ^ s), dtype=_U)]) for s in seeded(2, 41)]
                    s1, s2 = [c[offsets[1:]] - c[offsets[:-1]] for c in sums]
                sizes = np.diff(offsets)
                held = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)),
                    signed(keys[sizes > 0].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), signed(s1), signed(s2), held],
                    names=["doc_id", "n_shingles", "s1", "s2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>")


def _full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, set) of the documents in ``ids``: their shingle hashes as bytes.

    A bitmap of fixed size (hash of the id) tells the tasks which texts to read
    on; texts that pass by chance go in the join that follows.
    """
    spark = docs.sparkSession
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << _FILTER_BITS))
    # bitmap buckets and positions count numbers from 1 on
    maps = (ids.select((place(F.col("id")) + 1).alias("h")).groupBy(F.bitmap_bucket_number("h").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect())
    wanted = np.zeros(1 << (_FILTER_BITS - 3), np.uint8)
    for r in maps:
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["n"] - 1) * 4096                # a bucket holds 32,768 bits
        wanted[at:at + len(bits)] = bits
    shared = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            passed = batch.filter(pa.array((bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(passed, "text"):
                elements, offsets = shingle_sets(part.column("text"), k)
                body = elements.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([body[a * 8:b * 8] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())],
                    names=["id", "set"])

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    return docs.select(key.alias("id"), place(key).alias("h"), "text").mapInArrow(run, "id long, set binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets reach ``percent``."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    both = np.sort(np.concatenate([x, y]))
                    common = int((both[1:] == both[:-1]).sum())
                    keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _links_in(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join different components among the documents of a unit: every pair across components
    is counted, and a pair is handed on only if nothing handed on before joins the two."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    posting, first = owner[order], np.cumsum(df) - df
    starts = np.cumsum(sizes) - sizes
    _, label = np.unique(roots, return_inverse=True)
    label = label.copy()
    most = np.bincount(label).argmax()               # pairs inside the largest component need no test
    links = []
    for x in np.flatnonzero(label != most).tolist():
        mine = place[starts[x]:starts[x] + sizes[x]]
        mine = mine[df[mine] > 1]
        lengths = df[mine]
        at = np.repeat(first[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(posting[at], minlength=len(sets))
        linked = 100 * common >= percent * (sizes + sizes[x] - common)
        while (new := np.flatnonzero(linked & (label != label[x]))).size:
            links.append((int(ids[x]), int(ids[new[0]])))
            label[label == label[new[0]]] = label[x]
    return links


def _open_links(held: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents of one bucket that are still in different components (columns key, id, n, root).

    Buckets of the same members are one. A bucket is cut into blocks of about ``_BLOCK_SHINGLES``, and each
    pair of blocks is a unit that one task tests in memory; only links leave it, never candidate pairs.
    """
    sign = F.sum(F.xxhash64("id").cast("decimal(38,0)"))
    split = held.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("c"),
                                    F.sum("n").alias("total"), sign.alias("sign"), F.min("id").alias("least"))
    # two members have been compared already
    split = split.where("r0 < r1 and c > 2").groupBy("sign", "c", "least").agg(F.min(F.struct("key", "total")).alias("k"))
    split = split.select("k.key", F.expr(f"int(k.total div {_BLOCK_SHINGLES} + 1)").alias("blocks"))
    rows = held.join(split, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    units = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("u0"), F.greatest("block", "other").alias("u1"), "id", "root")
    full = units.join(sets, "id").select("key", "u0", "u1", "id", "root", "set")

    def run(table: pa.Table) -> pa.Table:
        found = _links_in(table.column("id").to_numpy(), table.column("root").to_numpy(),
                          [np.frombuffer(x.as_buffer(), _U) for x in table.column("set")], percent)
        return pa.Table.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return full.groupBy("key", "u0", "u1").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and copies (documents of the same set)."""
    marked = materialize(sketch_documents(docs, k, bands, rows))
    classes = materialize(
        marked.where("n_shingles > 0").groupBy("s1", "s2").agg(
            F.coalesce(F.min("doc_id"), F.lit(_NO_ID)).alias("id"), F.first("n_shingles").alias("n"),
            F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")))
    placed = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = placed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    members = materialize(placed.join(shared.select("key", "least"), "key").select("key", "id", "n", "least"))
    ids = members.select("id").distinct()
    sets = stage_table(_full_sets(docs, ids, k).join(ids, "id"), "shingle-sets")

    links = materialize(verified(
        members.where("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct(), sets, percent))
    roots = components(links)
    held = members.join(roots, "id", "left").select("key", "id", "n", F.coalesce("root", "id").alias("root"))
    links = links.union(materialize(_open_links(held, sets, percent)))
    roots = components(links)
    named = classes.join(roots, "id", "left").select(
        "s1", "s2", "copies", F.nullif(F.coalesce("root", "id"), F.lit(_NO_ID)).alias("root"))
    # copies of a class may carry an id that links elsewhere: the class's own root holds for all of them
    out = marked.drop("bands").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"), F.coalesce("copies", F.lit(1)).alias("copies"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that have a near copy of smaller id (columns as they are).

    Documents with a NULL id come last, in the order of their texts' hashes; of rows that agree in id and text one stays.
    """
    text = F.xxhash64("text")
    # ids past 2^62 stand for the documents without one
    own = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), text.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))))
    marked = materialize(near_duplicates(own.select(F.col("__id").alias("doc_id"), "text"), **options).select("doc_id", "kept"))
    gone = marked.where("not kept").select(F.col("doc_id").alias("__id")).distinct()
    left = own.join(gone, "__id", "left_anti")
    again = materialize(marked.where("kept").groupBy(F.col("doc_id").alias("__id")).count().where("count > 1").select("__id"))
    if again.take(1):
        some = left.join(again, "__id", "left_semi").withColumn("__text", text).dropDuplicates(["__id", "__text"]).drop("__text")
        left = left.join(again, "__id", "left_anti").unionByName(some)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text"))


# The same groups from an inverted index of all shingles and the reachable documents.
OP5_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as words
  from documents),
s as (
  select distinct doc_id, array_to_string(list_slice(words, i, i + 4), ' ') as g
  from (select doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) as i from w where len(words) > 0)),
n as (select doc_id, count(*) as n, md5(string_agg(g, '|' order by g)) as same from s group by doc_id),
c as (select same, count(*) as copies from n group by same),
p as (select a.doc_id as x, b.doc_id as y, count(*) as common from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * common >= 85 * (nx.n + ny.n - common)),
pair as (select x, y from e union all select y, x from e),
r as (select doc_id, doc_id as reach from w union select r.doc_id, pair.y from r join pair on r.reach = pair.x),
m as (select doc_id, min(reach) as component_id from r group by doc_id)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, component_id = w.doc_id as kept,
       coalesce(copies, 1)::bigint as copies
from w join m using (doc_id) left join n using (doc_id) left join c using (same)
"""
