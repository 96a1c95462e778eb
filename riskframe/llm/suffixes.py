"""Repeated passages with sparse suffix arrays.

Only suffixes that start at content-selected positions are kept: the minimisers of
every window of ``window`` consecutive word pairs (the position of the least hash). A passage
of ``least`` words that stands in two places selects the same position
within its first ``window`` words in both, and ``least - window`` words follow it there. Suffixes are keyed by
the hash of their first ``least - window`` words and carry the hashes of all passages of ``least`` words that selected
them. Suffixes of a key are sorted by the words after it; for each passage, every suffix that holds it is
linked with the one before that holds it too, and links are extended to the left and right, word by word,
over the whole texts. So every passage of ``least`` words that stands in two places is met at each of them, however
many other texts share a part of it.

A key that many suffixes share is counted first (partial counts per task) and its suffixes are spread
over salted sub-groups; the first holder of each passage in a sub-group is linked with those of the others in a second
step, dealt by passage. So no task sorts a hot key alone.

Words are case-sensitive runs of other than space and control bytes 9 to 13; white space does not matter. NULL
text has no words; documents shorter than ``least`` words repeat no passage. Rows with one doc_id (or NULL
ids) are one document, read in text-hash order; rows that agree in id and text are one text and no partners of each
other. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .lines import bitmap_of
from .textarrow import gram_hashes, mix64, raw, signed, slices, word_bounds, word_hashes

LEAST_WORDS, WINDOW = 50, 24
_SALT_ROWS = 2_000                     # suffixes of one key in a sub-group, about
_FILTER_BITS = 27
_U = np.uint64


def minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every start of ``window`` consecutive ones, the position of the least hash (the last of equals)."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    best, at = hashes, np.arange(len(hashes))
    span = 1
    while span < window:                        # least of [i, i + span) -> of [i, i + span + step)
        step = min(span, window - span)
        m = len(best) - step
        right = best[step:] <= best[:m]
        at = np.where(right, at[step:], at[:m])
        best = np.where(right, best[step:], best[:m])
        span += step
    return at


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = raw(part.column("text"))
            starts, ends, words = word_bounds(data, offsets)
            yield part, word_hashes(data, starts, ends), words, starts, ends


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> _U(64 - _FILTER_BITS)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def sparse_suffixes(docs: DataFrame, least: int = LEAST_WORDS, window: int = WINDOW, repeated=None, hot=None,
                    salts: int = 1) -> DataFrame:
    """(key): hashes of the first ``least - window`` words of the kept suffixes.

    With ``repeated``, a broadcast bitmap of key prefixes, (row, at, key, salt, next, passages) of the suffixes inside
    it: ``next`` hashes as many more words, ``passages`` the ``least`` words from each start that selected
    the suffix on, and ``salt`` is above 0 for keys inside the bitmap ``hot``.
    """
    k = least - window

    def run(batches):
        for part, words, bounds, _, _ in _texts(batches):
            sizes = np.diff(bounds)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            starts = np.flatnonzero(np.arange(len(words)) + least <= bounds[doc + 1])
            if not len(starts):
                continue
            keys = gram_hashes(words, k)
            chosen = minimisers(gram_hashes(words, 2), window)[starts]
            if repeated is not None:
                inside = _in(repeated.value, keys[chosen])
                starts, chosen = starts[inside], chosen[inside]
                if not len(starts):
                    continue
            # starts that select one position follow each other
            first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
            at = chosen[first]
            if repeated is None:
                yield pa.RecordBatch.from_arrays([signed(keys[at])], names=["key"])
                continue
            d = doc[at]
            row = part.column("row").to_numpy(zero_copy_only=False)[d]
            place = (at - bounds[d]).astype(np.int32)
            rest = np.where(at + 2 * k <= bounds[d + 1], keys[np.minimum(at + k, len(keys) - 1)], _U(0))
            salt = np.zeros(len(at), np.int64)
            if hot is not None:
                many = _in(hot.value, keys[at])
                salt[many] = (mix64(row.view(_U) ^ mix64(place.astype(_U)))[many] % _U(salts)).astype(np.int64) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(place), signed(keys[at]), pa.array(salt), signed(rest), pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(starts)).astype(np.int32)), signed(gram_hashes(words, least)[starts]))],
                names=["row", "at", "key", "salt", "next", "passages"])

    return docs.mapInArrow(run, "key long" if repeated is None else
                           "row long, at int, key long, salt long, next long, passages array<long>")


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables that cut no group of the columns ``by``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        columns = [table.column(c).to_numpy() for c in by]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0))
        if len(cuts):
            yield table.slice(0, cuts[-1] + 1)
            table = table.slice(cuts[-1] + 1)
        held, n = table.to_batches(), 0             # a group that goes on waits for as many rows again
    if held:
        yield pa.Table.from_batches(held)


def _chained(group: list[np.ndarray], holder: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Holders of the same group values one after the other (x before y, each pair once), and the places
    of every group's first holder. ``holder`` ascends."""
    order = np.lexsort((holder, *group))
    same = np.ones(len(order) - 1, bool) if len(order) else np.zeros(0, bool)
    for g in group:
        same &= g[order][1:] == g[order][:-1]
    pairs = np.unique(np.stack([holder[order][:-1][same], holder[order][1:][same]]), axis=1)
    return pairs[0], pairs[1], order[np.flatnonzero(np.concatenate([[True], ~same]))] if len(order) else order


def _links(row: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[pa.Array]:
    apart = (row[x] != row[y]) | (at[x] != at[y])
    x, y = x[apart], y[apart]
    return [pa.array(c) for c in (row[x], at[x], row[y], at[y])]


def neighbours(docs: DataFrame, least: int = LEAST_WORDS, window: int = WINDOW) -> DataFrame:
    """(row, at, other_row, other_at): suffixes that hold the same passage of ``least`` words, so that the holders of
    every passage are joined by links.

    The first pass over the texts only counts keys; the second gives the suffixes of those that repeat.
    """
    spark = docs.sparkSession
    counted = materialize(sparse_suffixes(docs, least, window).groupBy("key").count().where("count > 1")
                          .select("key", "count", F.shiftrightunsigned("key", 64 - _FILTER_BITS).alias("p")))
    bitmap = spark.sparkContext.broadcast(bitmap_of(counted, "p", _FILTER_BITS))
    most = counted.agg(F.max("count")).first()[0] or 0
    hot = None
    if most > _SALT_ROWS:
        hot = spark.sparkContext.broadcast(bitmap_of(counted.where(F.col("count") > _SALT_ROWS), "p", _FILTER_BITS))
    held = sparse_suffixes(docs, least, window, bitmap, hot, most // _SALT_ROWS + 1)

    def within(batches):
        for table in _whole_groups(batches, ["key", "salt"]):
            row, at, salt = (table.column(c).to_numpy() for c in ("row", "at", "salt"))
            passages = table.column("passages").combine_chunks()
            holder = np.repeat(np.arange(len(row)), passages.value_lengths().to_numpy())
            passage = passages.flatten().to_numpy()
            x, y, first = _chained([passage, salt[holder]], holder)
            links = _links(row, at, x, y)
            lead = first[salt[holder[first]] > 0]
            n, m = len(links[0]), len(lead)
            out = [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(passage[lead])]),
                   pa.concat_arrays([links[0], pa.array(row[holder[lead]])]),
                   pa.concat_arrays([links[1], pa.array(at[holder[lead]])]),
                   pa.concat_arrays([links[2], pa.nulls(m, pa.int64())]), pa.concat_arrays([links[3], pa.nulls(m, pa.int32())])]
            yield pa.RecordBatch.from_arrays(out, names=["passage", "row", "at", "other_row", "other_at"])

    def across(batches):
        for table in _whole_groups(batches, ["passage"]):
            row, at = table.column("row").to_numpy(), table.column("at").to_numpy()
            x, y, _ = _chained([table.column("passage").to_numpy()], np.arange(len(row)))
            yield pa.RecordBatch.from_arrays(_links(row, at, x, y), names=["row", "at", "other_row", "other_at"])

    found = (held.repartition("key", "salt").sortWithinPartitions("key", "salt", "next", "row", "at")
             .mapInArrow(within, "passage long, row long, at int, other_row long, other_at int"))
    if hot is None:
        return found.drop("passage")
    found = materialize(found)
    leads = found.where("passage is not null").select("passage", "row", "at")
    return found.where("passage is null").drop("passage").union(
        leads.repartition("passage").sortWithinPartitions("passage", "row", "at")
        .mapInArrow(across, "row long, at int, other_row long, other_at int"))


def _needed_words(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, words): half of each word's hash, as bytes, of the documents in ``rows``; a bitmap of fixed size tells which
    texts to read on. Extension compares words by these 32 bits (two different words agree once in four billion)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        bitmap_of(rows.select(F.pmod("row", F.lit(1 << _FILTER_BITS)).alias("p")), "p", _FILTER_BITS))

    def run(batches):
        bits = shared.value
        for batch in batches:
            p = batch.column("row").to_numpy(zero_copy_only=False) & ((1 << _FILTER_BITS) - 1)
            passed = batch.filter(pa.array((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1))
            for part, words, bounds, _, _ in _texts([passed]):
                body = (words >> _U(32)).astype(np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(
                    [body[a * 4:b * 4] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())],
                    names=["row", "words"])

    return docs.mapInArrow(run, "row long, words binary").join(rows, "row", "left_semi")


def _extend(x: np.ndarray, y: np.ndarray, anchors: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Maximal equal stretches (start in x, start in y, words) of at least ``least`` words through the anchors."""
    out, done = [], {}
    for a, b in sorted(anchors):
        if a < done.get(a - b, 0):
            continue
        n = min(len(x) - a, len(y) - b)
        unequal = np.flatnonzero(x[a:a + n] != y[b:b + n])
        right = int(unequal[0]) if len(unequal) else n
        m = min(a, b)
        unequal = np.flatnonzero(x[a - m:a] != y[b - m:b])
        left = m - 1 - int(unequal[-1]) if len(unequal) else m
        done[a - b] = a + max(right, 1)
        if left + right >= least:
            out.append((a - left, b - left, left + right))
    return out


def passages(docs: DataFrame, least: int = LEAST_WORDS, window: int = WINDOW) -> DataFrame:
    """(doc_id, first_word, n_words, other_doc_id, other_first_word): the longest stretch at every
    repeated place, found with one partner each.

    ``first_word`` counts words from 0. Stretches inside a longer one of the same document are left out; a
    document's own stretches may overlap. A document that repeats itself is its own partner.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("doc_id", F.xxhash64("text")).alias("row"))
    near = neighbours(docs, least, window)
    # the anchors of one pair of documents together (both directions meet)
    turned = F.col("row") > F.col("other_row")
    pairs = materialize(near.select(
        F.least("row", "other_row").alias("row"), F.greatest("row", "other_row").alias("other_row"),
        F.when(turned, F.col("other_at")).otherwise(F.col("at")).alias("at"),
        F.when(turned, F.col("at")).otherwise(F.col("other_at")).alias("other_at")).groupBy("row", "other_row").agg(
        F.collect_set(F.struct("at", "other_at")).alias("anchors")))
    rows = materialize(pairs.select(F.explode(F.array("row", "other_row")).alias("row")).distinct())
    names = docs.select("row", "doc_id").join(rows, "row", "left_semi").groupBy("row").agg(F.min("doc_id").alias("doc_id"))
    # both joins below read one exchange of these rows
    words = _needed_words(docs.select("row", "text"), rows).dropDuplicates(["row"])
    both = (pairs.join(words.select("row", F.col("words").alias("x")), "row")
            .join(words.select(F.col("row").alias("other_row"), F.col("words").alias("y")), "other_row")
            .select("row", "other_row", "anchors", "x", "y"))

    def run(batches):
        for batch in batches:
            found = []
            for r, o, anchors, x, y in zip(batch.column("row").to_pylist(), batch.column("other_row").to_pylist(),
                                           batch.column("anchors").to_pylist(), batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                pts = [(p["at"], p["other_at"]) for p in anchors]
                for a, b, n in _extend(x, y, pts, least):
                    found.append((r, a, n, o, b))
                    found.append((o, b, n, r, a))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], names=["row", "first", "n", "other_row", "other_first"])

    spans = both.mapInArrow(run, "row long, first long, n long, other_row long, other_first long").groupBy("row", "first").agg(
        F.max(F.struct("n", (-F.col("other_row")).alias("m"), "other_row", "other_first")).alias("s"))
    spans = spans.select("row", "first", "s.n", "s.other_row", "s.other_first")
    reach = F.max(F.col("first") + F.col("n")).over(
        Window.partitionBy("row").orderBy("first", F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("reach", reach).where("reach is null or first + n > reach")
    return (spans.join(names, "row").join(names.select(F.col("row").alias("other_row"), F.col("doc_id").alias("other_doc_id")), "other_row")
            .select("doc_id", F.col("first").alias("first_word"), F.col("n").alias("n_words"), "other_doc_id",
                    F.col("other_first").alias("other_first_word")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that stand in two places of the documents."""
    return passages(spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text"))
