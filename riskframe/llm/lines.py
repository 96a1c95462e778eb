"""Line dedup: an exact set-similarity join of lines.

A line's set is its distinct A-Z-lower-cased words. A line goes if an earlier
line (by document id, then line number) has a Jaccard similarity of at least ``percent``
hundredths with it. Lines with equal sets are one class, so copies are never compared.

Classes are joined by prefix filtering: words are ordered by rarity (a table of bounded size has the counts of the most
frequent words over all lines; any other word is taken to be rarer than all of them and ordered by hash, which is one total order for all
lines). Two sets that reach the threshold share one of their first n - ceil(percent * n) + 1 words, their prefix. A word that
``HOT_LINES`` lines or more hold comes after all others and is no key alone: two lines whose first
common word is hot share a second one within the next longer prefix, and the pair of them is the key (in lines of up to ``PAIRED_WORDS`` words;
longer ones, and those that may meet them, have hot words alone as keys). So frequent words bring no large groups
but where many lines share their rarest words, and keys of words above ``KEY_BLOCK`` lines are dealt in pairs of blocks.

Rows of one key are first tested by classes of (size, place of the key): the length filter and the positional
filter need no more, and rows whose class fits no other are dropped without a comparison. The rest is compared in the order
of the corpus, each line with the ones before it, by length, position and parity bits of the words, which bound the
overlap from above. A line only needs one earlier match: of a key where it has more than ``_HELD`` candidates it gives the nearest, and stops at ``_MET``.
Its nearest candidate of all is verified on the full sets first. Lines that are not removed by then are tested against their other candidates, or,
if they had more, against all rows left of their keys, inside tasks and in blocks; only removed lines leave these. So no
candidate is lost, and no group of near copies emits its pairs.

Lines without words are never removed. NULL text has no lines. Documents with a NULL id come last and
count as one document; rows with one doc_id count as one document. Other columns are only carried.
An empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release_shuffles, remove_staged, scratch_path, stage_table
from .textarrow import ascii_lower, mix64, raw, seeded, signed, slices, word_bounds, word_hashes

PERCENT = 80
#: The most frequent words whose counts every task gets (16 bytes each).
FREQUENT_WORDS = 1 << 18
#: The most copied lines whose first place every task gets (16 bytes each).
COPIED_LINES = 1 << 16
#: Occurrences from which a word is hot: a key only together with a second word.
HOT_LINES = 2_000
#: Words up to which a line has pairs of words as keys.
PAIRED_WORDS = 64
#: Lines of a hot word that meet in one task; with more, its keys are dealt in pairs of blocks.
KEY_BLOCK = 1 << 16
_HELD = 4                              # candidates of a line and key that are all given
_MET = 24                              # candidates at which a line stops
_LONG = 64                             # words from which a line has 128 parity bits instead of 64
_HOT = 1 << 15                         # the level of rarity that hot words start at
_BLOCK_LINES = 1_500                   # lines of a key that the last test holds at once
_CHUNK_ROWS = 300_000                  # rows whose keys are compared at once
_PLACE_BITS = 27                       # bitmap over (document, line): 16 MB at most
_AT_BITS = 24                          # a place in the prefix, cut at the largest: the filter then only lets more through
_LAST_ID = (1 << 63) - 1
_U = np.uint64


def _place(ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The bit of a line (document id, line number) in a bitmap."""
    with np.errstate(over="ignore"):
        return (mix64(mix64(ids.astype(_U)) + number.astype(_U)) >> _U(64 - _PLACE_BITS)).astype(np.int64)


class LineSets:
    """The distinct words of the lines of a few documents, as flat arrays sorted by (line, word hash).

    ``wanted``: a bitmap of places; only lines in it are read on. ``known`` and ``known_counts``: the words met and how often;
    ``of_word``: the values of the function ``of_known`` of words, for every word of the lines.
    """

    def __init__(self, ids: pa.Array, texts: pa.Array, wanted: np.ndarray | None = None, of_known=None):
        data, offsets = raw(texts)
        present = pc.is_valid(texts).to_numpy(zero_copy_only=False)
        newlines = np.flatnonzero(data == 10)
        starts = np.concatenate([offsets[:-1][present], newlines + 1])
        # a document may start where another's trailing line does: order by document, then place
        doc = np.concatenate([np.flatnonzero(present), np.searchsorted(offsets, newlines, "right") - 1])
        order = np.lexsort((starts, doc))
        doc, bounds = doc[order], np.concatenate([starts[order], [len(data)]])
        self.per_doc = np.bincount(doc, minlength=len(offsets) - 1)
        first = np.cumsum(self.per_doc) - self.per_doc
        self.number = np.arange(len(doc)) - first[doc]
        self.id = pc.fill_null(ids, _LAST_ID).to_numpy(zero_copy_only=False)[doc] if len(doc) else np.zeros(0, np.int64)
        self.place = _place(self.id, self.number)
        if wanted is not None:
            chosen = _in(wanted, self.place)
            lengths = np.diff(bounds)
            data = data[np.repeat(chosen, lengths)]
            bounds = np.concatenate([[0], np.cumsum(lengths[chosen])])
            self.number, self.id, self.place = self.number[chosen], self.id[chosen], self.place[chosen]
        data = ascii_lower(data)
        begin, end, of_line = word_bounds(data, bounds)
        words = word_hashes(data, begin, end)
        line = np.repeat(np.arange(len(bounds) - 1), np.diff(of_line))
        order = np.argsort(words)
        words, line = words[order], line[order]
        first = np.flatnonzero(np.concatenate([words[:1] == words[:1], words[1:] != words[:-1]]))
        self.known, self.known_counts = words[first], np.diff(np.append(first, len(words)))
        order = np.argsort(line.astype(np.uint16) if len(bounds) <= 1 << 16 else line, kind="stable")
        words, line = words[order], line[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        self.words, self.line = words[new], line[new]
        if of_known is not None:
            self.of_word = np.repeat(of_known(self.known), self.known_counts)[order][new]
        self.sizes = np.bincount(self.line, minlength=len(bounds) - 1)
        self.ends = np.cumsum(self.sizes)

    def signature(self, seed: int) -> np.ndarray:
        """A 64-bit sum over each line's words."""
        with np.errstate(over="ignore"):
            words = self.words if seed == 0 else mix64(self.words ^ seeded(2, 53)[seed])
            c = np.concatenate([[_U(0)], np.cumsum(words, dtype=_U)])
            return c[self.ends] - c[self.ends - self.sizes]

    def keep(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, (renumbered) lines and values of the words of the chosen lines."""
        take = chosen[self.line]
        renumber = np.cumsum(chosen) - 1
        return self.words[take], renumber[self.line[take]], self.of_word[take]


def _over(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None, of_known=None) -> Iterator[tuple[pa.RecordBatch, LineSets]]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield part, LineSets(part.column("doc_id"), part.column("text"), wanted, of_known)


_DOCUMENT, _LINE, _WORD = 0, 1, 2


def survey(docs: DataFrame) -> DataFrame:
    """One pass over the texts: a row per document (kind 0: id, n = lines), per line with words (kind 1: id, line, n = words,
    s1, s2, place) and rows with words and their counts in arrays, added up per task (kind 2). Words that a task meets once are
    left out: counts only order words, and those that matter are met more often."""
    names = ["kind", "id", "line", "n", "s1", "s2", "place"]
    longs = pa.list_(pa.int64())

    def rows(kind: int, many: int, **columns) -> pa.RecordBatch:
        zero = pa.array(np.zeros(many, np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(many, kind, np.int32)), *[pa.array(columns[c]) if c in columns else zero for c in names[1:]],
             *[columns.get(c, pa.nulls(many, longs)) for c in ("words", "counts")]], names=[*names, "words", "counts"])

    def merged(parts):
        words, where = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)

    def told(words, counts):
        words, counts = words[counts > 1].view(np.int64), counts[counts > 1]
        cuts = np.append(np.arange(0, len(words), 1 << 14), len(words)).astype(np.int32)
        return rows(_WORD, len(cuts) - 1, words=pa.ListArray.from_arrays(pa.array(cuts), pa.array(words)),
                    counts=pa.ListArray.from_arrays(pa.array(cuts), pa.array(counts)))

    def run(batches):
        parts, held = [], 0
        for part, x in _over(batches):
            some = x.sizes > 0
            ids = pc.fill_null(part.column("doc_id"), _LAST_ID).to_numpy(zero_copy_only=False)
            yield rows(_DOCUMENT, len(ids), id=ids, n=x.per_doc.astype(np.int64))
            yield rows(_LINE, int(some.sum()), id=x.id[some], line=x.number[some], n=x.sizes[some],
                       s1=x.signature(0)[some].view(np.int64), s2=x.signature(1)[some].view(np.int64), place=x.place[some])
            parts.append((x.known, x.known_counts))
            held += len(x.known)
            if held > 2_000_000:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > 1_000_000:
                    yield told(*parts[0])
                    parts, held = [], 0
        if parts:
            yield told(*merged(parts))

    return docs.mapInArrow(run, "kind int, id long, line long, n long, s1 long, s2 long, place long, words array<long>, counts array<long>")


def most_frequent(counts: DataFrame, key: str, other: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``key`` (sorted, as hashes) and ``other`` of at most ``most`` rows of ``counts``: all those above a count ``n`` that a histogram sets."""
    level = F.floor(F.log2("n") * 8)
    total, floor = 0, 1 << 30
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        floor = r["level"]
    rows = counts.where(level >= floor).select(key, other).toPandas()
    keys = rows[key].to_numpy(np.int64).view(_U)
    order = np.argsort(keys)
    return keys[order], rows[other].to_numpy(np.int64)[order]


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, absent: int) -> np.ndarray:
    """The table's values of ``keys``, or ``absent``."""
    known, values = table
    if not len(known):
        return np.full(len(keys), absent)
    near = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[near] == keys, values[near], absent)


def bitmap_of(numbers: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap (2^bits bits, packed low bit first) of the numbers in a column; its size does not depend on the rows."""
    rows = (numbers.select((F.col(column) + 1).alias("v")).groupBy(F.bitmap_bucket_number("v").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")).toLocalIterator())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["n"] - 1) * 4096:(r["n"] - 1) * 4096 + len(part)] = part
    return out


def _in(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return (bitmap[numbers >> 3] >> (numbers & 7).astype(np.uint8)) & 1 == 1


def prefix_rows(docs: DataFrame, firsts, copied, table, hot, percent: int) -> DataFrame:
    """(k, m, id, parity, parity2): the prefix keys of every class's first line.

    ``firsts`` is a bitmap of their places; the most copied classes are also in the table ``copied``, so their
    copies never pass. Another copy that passes by chance only makes candidates. ``hot`` is a bitmap of the hot words. ``k`` has half of the
    key's hash above the line's number of words (a chance agreement only makes one more candidate), ``m`` the line's number
    above the key's place in the prefix. ``parity`` and, for lines of ``_LONG`` words, ``parity2`` have a bit per hash class of words,
    set if the line has an odd number of them.
    """
    def level(words):
        """Words by rarity: 16 bits, hot ones highest."""
        count = _look_up(table.value, words, 0)
        many = _in(hot.value, (words >> _U(64 - _PLACE_BITS)).astype(np.int64))
        return np.where(many, _HOT, 0).astype(np.uint16) | np.minimum(np.log2(count + 1) * 700, _HOT - 1).astype(np.uint16)

    def run(batches):
        for _, x in _over(batches, firsts.value, level):
            first = _look_up(copied.value, x.signature(0), -1)
            # a set of n words meets no other if even n of n + 1 words is too little
            chosen = (x.sizes * 100 >= percent * (x.sizes + 1)) & (x.sizes > 0) & ((first < 0) | (first == x.place))
            if not chosen.any():
                continue
            words, line, rarity = x.keep(chosen)
            n = x.sizes[chosen]
            starts = np.cumsum(n) - n
            bit = _U(1) << (words & _U(63))
            upper = (words & _U(64)) > 0
            long_ = n >= _LONG
            low, high = (np.bitwise_xor.reduceat(np.where(upper == h, bit, _U(0)), starts) for h in (False, True))
            parity, parity2 = np.where(long_, low, low ^ high), np.where(long_, high, _U(0))
            # by rarity, ties in hash order: words are sorted by hash within a line, and the sorts are stable
            order = np.argsort(rarity, kind="stable")
            order = order[np.argsort(line[order].astype(np.uint16) if len(n) <= 1 << 16 else line[order], kind="stable")]
            words, rarity = words[order], rarity[order]
            many = rarity >= _HOT
            at = np.arange(len(words)) - starts[line]
            prefix = (n - (percent * n + 99) // 100 + 1)[line]
            inside = at < prefix
            alone = np.flatnonzero(inside & ~many)
            of_words = n[line]
            # hot words: a key with each of the words after it, up to the longer prefix; alone where a line is too long for that, or meets one that is
            both = np.flatnonzero(inside & many & (of_words <= PAIRED_WORDS))
            times = np.minimum(prefix, of_words - 1)[both] - at[both]
            a = np.repeat(both, times)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
            single = np.flatnonzero(inside & many & (of_words * 100 >= percent * PAIRED_WORDS))
            pair = np.concatenate([mix64(words[a] ^ mix64(words[b])), mix64(words[single])])
            a = np.concatenate([a, single])
            blocks = 1 + _look_up(table.value, words[a], 0) // KEY_BLOCK
            if (blocks > 1).any():                  # a row for every block that its own one meets
                mine = (mix64(_place(x.id[chosen], x.number[chosen]).astype(_U))[line[a]] % blocks.astype(_U)).astype(np.int64)
                a, pair, mine, wide = (np.repeat(c, blocks) for c in (a, pair, mine, blocks))
                other = np.arange(len(a)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                unit = (np.minimum(mine, other) * wide + np.maximum(mine, other) + 1).astype(_U)
                pair = np.where(wide > 1, mix64(pair ^ mix64(unit)), pair)
            key, own = np.concatenate([words[alone], pair]), np.concatenate([alone, a])
            of = line[own]
            yield pa.RecordBatch.from_arrays(
                [signed((key & _U(0xFFFFFFFF << 32)) | n[of].astype(_U)),
                 pa.array((x.number[chosen][of] << _AT_BITS) | np.minimum(at[own], (1 << _AT_BITS) - 1)),
                 pa.array(x.id[chosen][of]), signed(parity[of]), signed(parity2[of])], names=["k", "m", "id", "parity", "parity2"])

    return docs.mapInArrow(run, "k long, m long, id long, parity long, parity2 long")


def _need(both: np.ndarray, percent: int) -> np.ndarray:
    """The words that two sets of together ``both`` words must share."""
    return (percent * both + 99 + percent) // (100 + percent)


def _fitting(k: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """The rows whose class (key and size ``k``, place ``at``) fits another row's by the length and the positional filter."""
    order = np.lexsort((at, k))
    new = np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (at[order][1:] != at[order][:-1])])
    first = np.flatnonzero(new)
    ck, room = k[order][first], at[order][first]
    key, n = ck >> 32, ck & 0xFFFFFFFF
    room = n - room
    fits = (np.diff(np.append(first, len(k))) > 1) & (room >= _need(2 * n, percent))
    here, lag = np.arange(len(ck)), 0
    while len(here):
        lag += 1
        here = here[here >= lag]
        a = here - lag
        alive = (key[a] == key[here]) & (n[a] * 100 >= percent * n[here])
        here, a = here[alive], a[alive]
        ok = np.minimum(room[a], room[here]) >= _need(n[a] + n[here], percent)
        fits[a[ok]] = fits[here[ok]] = True
    out = np.zeros(len(k), bool)
    out[order] = fits[np.cumsum(new) - 1]
    return out


def _candidates_in(key, n, at, ids, line, parity, parity2, percent: int):
    """(x, y, gap, stopped) among rows in the order of (key, id, line): for every row y its candidates of the key, going back from it,
    if there are ``_HELD`` at most; else it ``stopped``, and only the nearest of the first ``_MET`` is given."""
    room = n - at
    met = np.zeros(len(key), np.int32)
    found, here, lag = [], np.arange(len(key)), 0
    while len(here):
        lag += 1
        here = here[(here >= lag) & (met[here] < max(_MET, _HELD + 1))]
        a = here - lag
        alive = key[a] == key[here]
        here, a = here[alive], a[alive]
        if not len(here):
            break
        nx, ny = n[a], n[here]
        both = nx + ny
        need = _need(both, percent)
        ok = np.flatnonzero((np.minimum(room[a], room[here]) >= need) & (np.minimum(nx, ny) * 100 >= percent * np.maximum(nx, ny)))
        x, y, both, need = a[ok], here[ok], both[ok], need[ok]
        # words that only one of the two has flip a parity bit each; with a line that has half the bits, those of the other are folded
        low, high = parity[x] ^ parity[y], parity2[x] ^ parity2[y]
        full = np.minimum(n[x], n[y]) >= _LONG
        gap = (np.bitwise_count(np.where(full, low, low ^ high)) + np.where(full, np.bitwise_count(high), 0)).astype(np.int64)
        ok = ((both - gap) // 2 >= need) & ((ids[x] != ids[y]) | (line[x] != line[y]))
        if ok.any():
            met[y[ok]] += 1
            found.append((x[ok], y[ok], gap[ok]))
    stopped = met > _HELD
    if not found:
        e = np.zeros(0, np.int64)
        return e, e, e, stopped
    x, y, gap = (np.concatenate(c) for c in zip(*found))
    # a line that stopped is tested against its whole key if its nearest candidate is none
    order = np.lexsort((x, gap, y))
    nearest = np.zeros(len(y), bool)
    nearest[order] = np.concatenate([[True], y[order][1:] != y[order][:-1]])
    take = nearest | ~stopped[y]
    return x[take], y[take], gap[take], stopped


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of batches sorted by ``k`` in tables that cut no key."""
    held: list[pa.RecordBatch] = []
    many, wanted = 0, _CHUNK_ROWS
    for batch in batches:
        held.append(batch)
        many += batch.num_rows
        if many < wanted:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("k").to_numpy() >> 32
        cuts = np.flatnonzero(key[1:] != key[:-1])
        end = int(cuts[-1]) + 1 if len(cuts) else 0
        if end:
            yield table.slice(0, end)
        held = table.slice(end).combine_chunks().to_batches()
        many, wanted = sum(b.num_rows for b in held), _CHUNK_ROWS if end else 2 * wanted
    if many:
        yield pa.Table.from_batches(held)


_PAIR, _MEMBER = 0, 1
_FOUND = ["kind", "a_id", "a_line", "b_id", "b_line", "gap"]


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Kind 0: pairs of an earlier line a and a later line b with the ``gap`` of their parities; a pair may come several times.
    Kind 1: the rows left (b; a_id = key, ``gap`` = 1 if it stopped) of every key in which a line stopped."""
    parts = rows.repartition(F.shiftright("k", 32)).sortWithinPartitions("k")

    def run(batches):
        for table in _whole_keys(batches):
            k, m, ids, parity, parity2 = (table.column(c).to_numpy() for c in ("k", "m", "id", "parity", "parity2"))
            fit = np.flatnonzero(_fitting(k, m & ((1 << _AT_BITS) - 1), percent))
            fit = fit[np.lexsort((m[fit], ids[fit], k[fit] >> 32))]
            k, m, ids, parity, parity2 = (c[fit] for c in (k, m, ids, parity, parity2))
            key, line = k >> 32, m >> _AT_BITS
            x, y, gap, stopped = _candidates_in(key, k & 0xFFFFFFFF, m & ((1 << _AT_BITS) - 1), ids, line, parity.view(_U),
                                                parity2.view(_U), percent)
            if len(x):
                pair = np.unique(np.stack([np.zeros(len(x), np.int64), ids[x], line[x], ids[y], line[y], gap], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in pair.T], names=_FOUND)
            if stopped.any():
                new = np.concatenate([[True], key[1:] != key[:-1]])
                group = np.cumsum(new) - 1
                of = np.bincount(group, stopped)[group] > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (np.full(int(of.sum()), _MEMBER), key[of], np.zeros(int(of.sum()), np.int64), ids[of], line[of],
                                           stopped[of].astype(np.int64))], names=_FOUND)

    return parts.mapInArrow(run, ", ".join(f"{c} long" for c in _FOUND))


def _removed_in(ids, line, is_open, own, words: list[np.ndarray], percent: int) -> np.ndarray:
    """Of a unit's open lines those with an earlier line of the unit's own block that reaches the threshold, counted on all words."""
    sizes = np.array([len(x) for x in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    _, place, df = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
    posting, first = owner[np.argsort(place, kind="stable")], np.cumsum(df) - df
    starts = np.cumsum(sizes) - sizes
    gone = np.zeros(len(words), bool)
    for y in np.flatnonzero(is_open).tolist():
        mine = place[starts[y]:starts[y] + sizes[y]]
        lengths = df[mine]
        at = np.repeat(first[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(posting[at], minlength=len(words))
        earlier = own & ((ids < ids[y]) | ((ids == ids[y]) & (line < line[y])))
        gone[y] = (earlier & (100 * common >= percent * (sizes + sizes[y] - common))).any()
    return gone


def _words_of(body: pa.Scalar) -> np.ndarray:
    """The word hashes (48 bits) of a line from their bytes."""
    return (np.frombuffer(body.as_buffer(), np.uint8).reshape(-1, 6).astype(_U) << (_U(8) * np.arange(6, dtype=_U))).sum(axis=1, dtype=_U)


def _sets(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, line, words): 48 bits of each word hash, as bytes, of the lines (id, line). A bitmap tells which lines to read on, so a few
    more come along, and a repeated document gives its lines repeatedly: join them."""
    def placed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(*(batch.column(c).to_numpy() for c in ("id", "line"))))], names=["place"])

    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(bitmap_of(lines.mapInArrow(placed, "place long"), "place", _PLACE_BITS))

    def run(batches):
        for _, x in _over(batches, bitmap.value):
            chosen = x.sizes > 0
            if chosen.any():
                body = x.words.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.id[chosen]), pa.array(x.number[chosen]), pa.array([body[(e - s) * 6:e * 6] for e, s in zip(
                        x.ends[chosen].tolist(), x.sizes[chosen].tolist())], pa.binary())], names=["id", "line", "words"])

    return docs.mapInArrow(run, "id long, line long, words binary")


def _open_lines(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The open lines (id, line) that go. ``members``: (key, id, line, is_open), rows of keys that hold an open line. A key's rows are dealt
    in blocks, each a unit that one task tests in memory; its open lines visit every block. Only lines leave a unit."""
    members = materialize(members.groupBy("key", "id", "line").agg(F.max("is_open").alias("is_open")))
    blocks = members.groupBy("key").count().select("key", F.expr(f"int(count div {_BLOCK_LINES} + 1)").alias("blocks"))
    rows = (members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id", "line"), F.col("blocks")).cast("int"))
            .join(_sets(docs, members.select("id", "line")), ["id", "line"]))
    visits = F.when(F.col("is_open"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    units = rows.withColumn("unit", F.explode(visits)).select(
        "key", "unit", "id", "line", "is_open", (F.col("unit") == F.col("block")).alias("own"), "words")

    def run(unit: pa.Table) -> pa.Table:
        gone = np.zeros(unit.num_rows, bool)
        is_open = unit.column("is_open").to_numpy()
        if is_open.any():
            gone = _removed_in(unit.column("id").to_numpy(), unit.column("line").to_numpy(), is_open, unit.column("own").to_numpy(),
                               [_words_of(x) for x in unit.column("words")], percent)
        return unit.select(["id", "line"]).filter(pa.array(gone))

    return units.groupBy("key", "unit").applyInArrow(run, "id long, line long").distinct()


def _matching(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The later lines (id, line) of the pairs that reach the threshold on their full sets."""
    held = _sets(docs, pairs.select(F.explode(F.array(*[
        F.struct(*[F.col(f"{side}_{c}").alias(c) for c in ("id", "line")]) for side in "ab"])).alias("s")).select("s.id", "s.line"))
    both = pairs
    for side in "ab":
        both = both.join(held.select(F.col("id").alias(f"{side}_id"), F.col("line").alias(f"{side}_line"),
                                     F.col("words").alias(f"{side}_words")), [f"{side}_id", f"{side}_line"])
    both = both.select("b_id", "b_line", "a_words", "b_words")

    def check(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("a_words"), batch.column("b_words"))):
                x, y = _words_of(x), _words_of(y)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["b_id", "b_line"]).rename_columns(["id", "line"]).filter(pa.array(keep))

    return both.mapInArrow(check, "id long, line long").distinct()


def _near_lines(docs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The lines (id, line) that an earlier line comes near to, by what ``candidates`` found."""
    later = ["b_id", "b_line"]
    pairs = found.where(F.col("kind") == _PAIR)

    def but(rows: DataFrame, gone: DataFrame, id_: str, line: str) -> DataFrame:
        return rows.join(gone.select(F.col("id").alias(id_), F.col("line").alias(line)), [id_, line], "left_anti")

    best = materialize(pairs.groupBy(*later).agg(F.min(F.struct("gap", "a_id", "a_line")).alias("s"))
                       .select(*later, "s.a_id", "s.a_line"))
    gone = materialize(_matching(docs, best, percent))
    # second round: other candidates of the lines left, in groups by line, and lines that stopped, with all rows of their keys
    rest = materialize(but(pairs.select(*later, "a_id", "a_line"), gone, *later).distinct().join(best, [*later, "a_id", "a_line"], "left_anti"))
    members = found.where(F.col("kind") == _MEMBER).select(F.col("a_id").alias("key"), F.col("b_id").alias("id"), F.col("b_line").alias("line"),
                                                          (F.col("gap") == 1).alias("stopped"))
    open_ = materialize(but(members.where("stopped").select("key", "id", "line"), gone, "id", "line").distinct())
    many = rest.count()
    group = -1 - F.pmod(F.xxhash64(*later), F.lit(many // _BLOCK_LINES + 1))
    marked = rest.select(group.alias("key"), F.explode(F.array(
        F.struct(F.col("b_id").alias("id"), F.col("b_line").alias("line"), F.lit(True).alias("is_open")),
        F.struct(F.col("a_id").alias("id"), F.col("a_line").alias("line"), F.lit(False).alias("is_open")))).alias("s")).select("key", "s.*")
    if open_.take(1):
        marked = marked.unionByName(open_.withColumn("is_open", F.lit(True))).unionByName(
            members.select("key", "id", "line").join(open_.select("key").distinct(), "key", "left_semi").withColumn("is_open", F.lit(False)))
    elif not many:
        return gone
    return materialize(gone.union(_open_lines(docs, marked, percent)).distinct())


def repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_lines, removed): per document its number of lines and the numbers (from 0) of those that go."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    staged = {name: scratch_path(spark, f"line-{name}") for name in ("survey", "classes", "found")}
    seen = stage_table(survey(docs), "line-survey", path=staged["survey"])
    lines = seen.where(F.col("kind") == _LINE).select("id", "line", "s1", "s2", "place")
    classes = stage_table(
        lines.groupBy("s1", "s2").agg(F.min(F.struct("id", "line", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
        .select("s1", "s2", "first.id", "first.line", "first.place", "n"), "line-classes", path=staged["classes"])
    counts = materialize(seen.where(F.col("kind") == _WORD).select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
                         .groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n")))
    share = spark.sparkContext.broadcast
    firsts = share(bitmap_of(classes, "place", _PLACE_BITS))
    copied = share(most_frequent(classes.where("n > 1"), "s1", "place", COPIED_LINES))
    table = share(most_frequent(counts, "word", "n", FREQUENT_WORDS))
    hot = share(bitmap_of(counts.where(F.col("n") >= HOT_LINES).select(
        F.shiftrightunsigned("word", 64 - _PLACE_BITS).alias("p")), "p", _PLACE_BITS))
    found = stage_table(candidates(prefix_rows(docs, firsts, copied, table, hot, percent), percent), "line-found", path=staged["found"])
    release_shuffles(spark)
    gone = _near_lines(docs, found, percent)
    # only lines of these classes can go
    near = classes.join(gone.withColumn("near", F.lit(True)), ["id", "line"], "left").where("near or n > 1").select(
        "s1", "s2", F.col("id").alias("first_id"), F.col("line").alias("first_line"), "near")
    marked = lines.join(near, ["s1", "s2"]).where(
        F.coalesce("near", F.lit(False)) | (F.struct("id", "line") > F.struct("first_id", "first_line")))
    per = seen.where(F.col("kind") == _DOCUMENT).select("id", "n", F.lit(None).cast("long").alias("line")).union(
        marked.select("id", F.lit(None).cast("long").alias("n"), "line"))
    out = stage_table(per.groupBy("id").agg(F.max("n").alias("n_lines"), F.sort_array(F.collect_set("line")).alias("removed")).select(
        F.nullif("id", F.lit(_LAST_ID)).alias("doc_id"), "n_lines", "removed"), "repeated-lines")
    for path in staged.values():
        remove_staged(spark, path)
    release_shuffles(spark)
    return out


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (``n_chars``, if present, follows).

    Documents that keep no line with words though they had one go; untouched ones stay as they are.
    """
    columns = docs.columns
    gone = repeated_lines(docs.select("doc_id", "text"), percent).where(F.size("removed") > 0).select(
        F.coalesce("doc_id", F.lit(_LAST_ID)).alias("__id"), F.col("removed").alias("__removed"))
    both = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID))).join(
        gone, F.col("__key") == F.col("__id"), "left")
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda l, i: ~F.array_contains("__removed", i.cast("long"))), "\n")
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(left)
    out = both.withColumn("text", text).where(F.col("__removed").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents that repeat an earlier line."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text")
    return repeated_lines(docs).select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                                       F.array_join("removed", ",").alias("removed"))


# The same lines: candidates share a prefix word in rarity order, and are counted on all words.
OP8_SQL = """
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as k
  from documents where text is not null),
t as (
  select doc_id, k, list_sort(list_distinct(regexp_extract_all(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'))) as words
  from l),
sets as (
  select words, min((doc_id, k)) as first, len(words) as n, row_number() over (order by min((doc_id, k))) as id
  from t where len(words) > 0 group by words),
u as (select id, n, unnest(words) as word from sets),
df as (select word, count(*) as df from u group by word),
ranked as (select u.id, u.n, u.word, row_number() over (partition by u.id order by df.df, u.word) as pos from u join df using (word)),
prefix as (select * from ranked where pos <= n - (80 * n + 99) // 100 + 1),
pairs as (select distinct a.id as x, b.id as y, a.n as nx, b.n as ny from prefix a join prefix b on a.word = b.word and a.id < b.id
          where least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n)),
gone as (select distinct y from (
  select x, y, nx, ny, count(*) as common from pairs join u a on a.id = x join u b on b.id = y and b.word = a.word group by all)
  where 100 * common >= 80 * (nx + ny - common)),
marked as (
  select t.doc_id, t.k from t join sets using (words) left join gone on gone.y = sets.id
  where gone.y is not null or (t.doc_id, t.k) > sets.first),
r as (select doc_id, count(*) as n_removed, string_agg(k::varchar, ',' order by k) as removed from marked group by doc_id),
c as (select doc_id, count(*) as n_lines from l group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, coalesce(removed, '') as removed
from (select distinct doc_id from documents) d left join c using (doc_id) left join r using (doc_id)
"""
