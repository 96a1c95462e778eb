"""Repeated passages taken out by seed and extend.

Winnowing keeps, of every ``least`` consecutive words, the run of ``ANCHOR_WORDS`` words with the least hash (the last of equals): equal
stretches of ``least`` words keep the same one, so a repeated stretch always shares an anchor. Documents are
joined on anchors; matches are extended word by word both ways over the whole texts, and
those of ``least`` words or more are kept. The words that they cover in the later of the two places go: these are the words
of every stretch of ``least`` words that also starts earlier.

The first pass over the texts only counts anchors (partial counts per task). The second gives the places of those that repeat, each with the
hashes of the stretches that chose it; for each stretch, a place is paired with the one before it that
holds the stretch too. So a passage in n documents gives n - 1 pairs along the order of documents, never all pairs, and no document is
joined with all the others; still every stretch that starts earlier is met at each of its later places, however many texts share a
part of it. Anchors that more than ``_SALT_ROWS`` places hold are spread over sub-groups by document; the first
holder of each stretch in a sub-group is paired with those of the others in a second step, dealt by stretch.

Words are case-sensitive runs of other than space and control bytes 9 to 13, unchanged; white space does not matter. NULL and empty texts
have no words. Documents are ordered by ``doc_id``, NULL last; different texts under one ``doc_id`` are documents one after the
other, ordered by the texts' hash; rows that agree in id and text are one document, each row gets its result. Stretches may overlap themselves
(in "a a a ..." all but the first ``least`` words repeat). Other columns are not read. An empty table gives no rows.
Anchors and stretches are known by 64-bit hashes, words in the extension by 32 bits.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .lines import bitmap_of
from .suffixes import minimisers
from .textarrow import gram_hashes, mix64, raw, signed, slices, word_bounds, word_hashes

LEAST_WORDS, ANCHOR_WORDS = 20, 8
_SALT_ROWS = 2_000                     # places of one anchor in a sub-group, about
_FILTER_BITS = 27                      # bitmaps of 16 MB, whatever the input
_LAST_ID = (1 << 63) - 1
_U = np.uint64


def _texts(batches: Iterator[pa.RecordBatch]):
    """Slices of the batches with the word hashes, the word offsets of the documents, and the bytes with the words' starts and ends."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = raw(part.column("text"))
            starts, ends, bounds = word_bounds(data, offsets)
            yield part, word_hashes(data, starts, ends), bounds, data, starts, ends


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> _U(64 - _FILTER_BITS)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _bitmap(keys: DataFrame, column: str):
    """A broadcast bitmap of fixed size of the leading bits of the hashes in ``column``."""
    bits = bitmap_of(keys.select(F.shiftrightunsigned(column, 64 - _FILTER_BITS).alias("p")), "p", _FILTER_BITS)
    return keys.sparkSession.sparkContext.broadcast(bits)


def _anchor_places(words: np.ndarray, bounds: np.ndarray, least: int, anchor: int):
    """(starts, chosen, document) of every stretch of ``least`` words inside a document, and the anchors' keys by place."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(np.arange(len(words)) + least <= bounds[doc + 1])
    hashes = gram_hashes(words, anchor)
    chosen = minimisers(hashes, least - anchor + 1)
    # the least of several hashes is small: mixed again, the keys are even
    return starts, chosen[starts] if len(starts) else starts, doc, mix64(hashes ^ _U(0x5BD1E995))


def anchors(docs: DataFrame, least: int, anchor: int, repeated=None, hot=None, salts: int = 1) -> DataFrame:
    """(key, count) of the anchors, counted per slice of texts. With ``repeated``, a broadcast bitmap of keys, the places inside it:
    (id, row, at, key, salt, stretches), ``salt`` above 0 for keys in the bitmap ``hot``."""
    def run(batches):
        for part, words, bounds, _, _, _ in _texts(batches):
            starts, chosen, doc, keys = _anchor_places(words, bounds, least, anchor)
            if repeated is not None and len(starts):
                inside = _in(repeated.value, keys[chosen])
                starts, chosen = starts[inside], chosen[inside]
            if not len(starts):
                continue
            # stretches that choose one place follow each other
            first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
            at = chosen[first]
            if repeated is None:
                seen, count = np.unique(keys[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(seen), pa.array(count.astype(np.int64))], names=["key", "count"])
                continue
            d = doc[at]
            row = part.column("row").to_numpy(zero_copy_only=False)[d]
            salt = np.zeros(len(at), np.int32)
            if hot is not None:
                many = _in(hot.value, keys[at])
                # by document alone, so that copies meet the same partner at all their anchors
                salt[many] = (mix64(row.view(_U)) % _U(salts)).astype(np.int32)[many] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column("id").to_numpy(zero_copy_only=False)[d]), pa.array(row),
                 pa.array((at - bounds[d]).astype(np.int32)), signed(keys[at]), pa.array(salt), pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(starts)).astype(np.int32)), signed(gram_hashes(words, least)[starts]))],
                names=["id", "row", "at", "key", "salt", "stretches"])

    return docs.mapInArrow(run, "key long, count long" if repeated is None else
                           "id long, row long, at int, key long, salt int, stretches array<long>")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of sorted batches that cut no group of the columns ``by``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        changed = np.zeros(table.num_rows - 1, bool)
        for c in by:
            v = table.column(c).to_numpy()
            changed |= v[1:] != v[:-1]
        cuts = np.flatnonzero(changed)
        end = int(cuts[-1]) + 1 if len(cuts) else 0
        if end:
            yield table.slice(0, end)
        # a group that goes on waits, in one piece, for as many rows again
        held = table.slice(end).combine_chunks().to_batches() if end < table.num_rows else []
        if not end:
            rows *= 2
    if held:
        yield pa.Table.from_batches(held)


_PAIR = "id long, row long, at int, other_row long, other_at int"


def _chains(holder: np.ndarray, *group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(earlier, later, first): places of one group in pairs along their order, each pair once, and the entry that each
    group starts with. ``holder`` numbers the places in the order of documents."""
    order = np.lexsort((holder, *group))
    same = np.ones(max(len(order) - 1, 0), bool)
    for g in group:
        same &= g[order][1:] == g[order][:-1]
    pairs = np.unique(np.stack([holder[order][:-1][same], holder[order][1:][same]]), axis=1)
    first = order[np.flatnonzero(np.concatenate([[True], ~same]))] if len(order) else order
    return pairs[0], pairs[1], first


def _pair_arrays(ids, row, at, x, y) -> list[pa.Array]:
    """Pairs of the later place y with the earlier place x (a repeated row's own place is no pair)."""
    apart = (row[x] != row[y]) | (at[x] != at[y])
    x, y = x[apart], y[apart]
    return [pa.array(c) for c in (ids[y], row[y], at[y], row[x], at[x])]


def seeds(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(id, row, at, other_row, other_at): later anchor places, each with the place before it that holds the same stretch."""
    spark = docs.sparkSession
    counted = materialize(anchors(docs, least, anchor).groupBy("key").agg(F.sum("count").alias("count")).where("count > 1"))
    repeated = _bitmap(counted, "key")
    most = counted.agg(F.max("count")).first()[0] or 0
    hot = _bitmap(counted.where(F.col("count") > _SALT_ROWS), "key") if most > _SALT_ROWS else None
    held = anchors(docs, least, anchor, repeated, hot, most // _SALT_ROWS + 1)

    def within(batches):
        for table in _groups(batches, ["key", "salt"]):
            ids, row, at, salt = (table.column(c).to_numpy() for c in ("id", "row", "at", "salt"))
            stretches = table.column("stretches").combine_chunks()
            holder = np.repeat(np.arange(len(row)), stretches.value_lengths().to_numpy())
            stretch = stretches.flatten().to_numpy()
            x, y, first = _chains(holder, stretch, salt[holder])
            pairs = _pair_arrays(ids, row, at, x, y)
            lead = first[salt[holder[first]] > 0]
            n, m, h = len(pairs[0]), len(lead), holder[lead]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(stretch[lead])]),
                 *[pa.concat_arrays([c, pa.array(v[h])]) for c, v in zip(pairs[:3], (ids, row, at))],
                 pa.concat_arrays([pairs[3], pa.nulls(m, pa.int64())]), pa.concat_arrays([pairs[4], pa.nulls(m, pa.int32())])],
                names=["stretch", "id", "row", "at", "other_row", "other_at"])

    def across(batches):
        for table in _groups(batches, ["stretch"]):
            ids, row, at = (table.column(c).to_numpy() for c in ("id", "row", "at"))
            x, y, _ = _chains(np.arange(len(row)), table.column("stretch").to_numpy())
            yield pa.RecordBatch.from_arrays(_pair_arrays(ids, row, at, x, y), names=["id", "row", "at", "other_row", "other_at"])

    found = (held.repartition("key", "salt").sortWithinPartitions("key", "salt", "id", "row", "at")
             .mapInArrow(within, "stretch long, " + _PAIR))
    if hot is None:
        return found.drop("stretch")
    found = materialize(found)
    leads = found.where("stretch is not null").select("stretch", "id", "row", "at")
    return found.where("stretch is null").drop("stretch").union(
        leads.repartition("stretch").sortWithinPartitions("stretch", "id", "row", "at").mapInArrow(across, _PAIR))


def _extended(x: np.ndarray, y: np.ndarray, places: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """(start in x, words) of the maximal equal stretches through the pairs of places (in x, in y), ``least`` words at least."""
    out, reached = [], {}
    for a, b in sorted(places):
        if a < reached.get(a - b, 0):
            continue
        n, m = min(len(x) - a, len(y) - b), min(a, b)
        right = _until_unequal(x[a:a + n], y[b:b + n])
        left = _until_unequal(x[a - m:a][::-1], y[b - m:b][::-1])
        reached[a - b] = a + max(right, 1)
        if left + right >= least:
            out.append((a - left, left + right))
    return out


def _until_unequal(x: np.ndarray, y: np.ndarray) -> int:
    """The number of leading equal entries, looked for in growing steps."""
    at, step = 0, 64
    while at < len(x):
        unequal = np.flatnonzero(x[at:at + step] != y[at:at + step])
        if len(unequal):
            return at + int(unequal[0])
        at, step = at + step, step * 4
    return len(x)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, words) of the union of spans."""
    out: list[list[int]] = []
    for start, n in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + n)
        else:
            out.append([start, start + n])
    return [(a, b - a) for a, b in out]


def _word_halves(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, words): half of each word's hash, as bytes, of the documents in ``rows``; a bitmap tells which texts to read on."""
    wanted = _bitmap(rows, "row")

    def run(batches):
        for batch in batches:
            passed = batch.filter(pa.array(_in(wanted.value, batch.column("row").to_numpy(zero_copy_only=False).view(_U))))
            for part, words, bounds, _, _, _ in _texts([passed]):
                body = (words >> _U(32)).astype(np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(
                    [body[a * 4:b * 4] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())],
                    names=["row", "words"])

    return docs.select("row", "text").mapInArrow(run, "row long, words binary").join(rows, "row", "left_semi").dropDuplicates(["row"])


def later_spans(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(row, spans): per document with words to remove the stretches (first, n) that cover them, merged and in order.

    ``docs``: (id, row, text), where (id, row) orders documents.
    """
    pairs = materialize(seeds(docs, least, anchor).groupBy("row", "other_row").agg(
        F.collect_set(F.struct("at", "other_at")).alias("places")))
    rows = materialize(pairs.select(F.explode(F.array("row", "other_row")).alias("row")).distinct())
    words = _word_halves(docs, rows)                 # both joins read one exchange of these
    both = (pairs.join(words.select("row", F.col("words").alias("x")), "row")
            .join(words.select(F.col("row").alias("other_row"), F.col("words").alias("y")), "other_row")
            .select("row", "places", "x", "y"))

    def run(batches):
        for batch in batches:
            out_row, out_spans = [], []
            for row, places, x, y in zip(batch.column("row").to_pylist(), batch.column("places"), batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                inner = places.values
                spans = _extended(x, y, list(zip(inner.field("at").to_pylist(), inner.field("other_at").to_pylist())), least)
                if spans:
                    out_row.append(row)
                    out_spans.append([{"first": a, "n": n} for a, n in _merged(spans)])
            yield pa.RecordBatch.from_arrays([pa.array(out_row, pa.int64()), pa.array(out_spans, _SPANS)], names=["row", "spans"])

    found = both.mapInArrow(run, "row long, spans array<struct<first:int,n:int>>")
    return found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))


def _kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text, and perhaps spans)."""
    for part, words, bounds, data, starts, ends in _texts(batches):
        gone = np.zeros(len(words), bool)
        if "spans" in part.schema.names:
            for i, spans in enumerate(part.column("spans")):
                if spans.is_valid:
                    for a, n in zip(spans.values.field("first").to_pylist(), spans.values.field("n").to_pylist()):
                        gone[bounds[i] + a:bounds[i] + a + n] = True
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[bounds[1:]] - total[bounds[:-1]]
        stay = np.flatnonzero(~gone)
        # kept words, each followed by one space, as one run of bytes
        lengths = ends[stay] - starts[stay] + 1
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(starts[stay] - offsets[:-1], lengths) + np.arange(offsets[-1])
        body = np.append(data, np.uint8(32))[take] if len(take) else np.zeros(0, np.uint8)
        body[offsets[1:] - 1] = 32
        at = offsets[bounds - total[bounds]].tolist()
        text = body.tobytes()
        kept = [text[a:max(b - 1, a)].decode() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document of ``docs`` with the words left, joined by one space."""
    if not 0 < anchor <= least:
        raise ValueError("an anchor has at least one word and no more than a stretch")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("id"),
                        F.xxhash64("doc_id", F.xxhash64("text")).alias("row"))
    spans = materialize(later_spans(known.select("id", "row", "text"), least, anchor))
    wanted = _bitmap(spans, "row")

    def part_of(met: bool):
        def run(batches):
            for batch in batches:
                inside = _in(wanted.value, batch.column("row").to_numpy(zero_copy_only=False).view(_U))
                yield batch.filter(pa.array(inside if met else ~inside))
        return run

    def untouched(batches):
        return _kept_words(part_of(False)(batches))

    out = "doc_id long, n_words long, n_removed long, kept string"
    rows = known.select("doc_id", "row", "text")
    met = rows.mapInArrow(part_of(True), "doc_id long, row long, text string").join(spans, "row", "left")
    return rows.mapInArrow(untouched, out).union(met.select("doc_id", "text", "spans").mapInArrow(_kept_words, out))


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 20 words that stand earlier."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# The same words: every window is grouped with its equals, and a word goes if a window over it is not the first of its group.
OP13_SQL = """
with d as (select doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as ws from documents),
w as (select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from d where len(ws) > 0),
s as (select doc_id, unnest(range(1, len(ws) - 18)) as i, ws from d where len(ws) >= 20),
g as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') as stretch from s),
f as (select doc_id, i, row_number() over (partition by stretch order by doc_id, i) > 1 as later from g),
m as (select w.doc_id, w.i, word, coalesce(max(later::int) over (
        partition by w.doc_id order by w.i rows between 19 preceding and current row), 0) as gone
      from w left join f on f.doc_id = w.doc_id and f.i = w.i),
k as (select doc_id, sum(gone) as n_removed, coalesce(string_agg(word, ' ' order by i) filter (gone = 0), '') as kept from m group by doc_id)
select d.doc_id, coalesce(len(ws), 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join k on k.doc_id = d.doc_id
"""
