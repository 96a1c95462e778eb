"""Language identification with interpolated Kneser-Ney character models.

One model of order 4 per language, over lower-cased letters with every run of
other characters as one space. The 4-gram counts cover all learning texts and none is left out; continuation counts,
contexts and discounts of the lower orders follow from them in Spark. Models are sorted arrays of packed n-grams (16 bits
per character) with the languages that hold each, searched by bisection; they are cut by ranges of contexts into
parts of about ``PART_GRAMS``, and a task reads one part after the other. A text's language is
the one of lowest cross-entropy per character. The score is a softmax of the differences at a
temperature fitted on all learning texts; ``accepted`` is false where the cross-entropy is above the exact
``REJECT_ABOVE`` quantile of all learning texts of the predicted language, plus a margin.

NULL texts and texts without letters are ``und`` with score 0. Without learning texts, all are. Languages whose
learning texts hold no letters are never predicted. Ties go to the first language by name. Rows without language or id are not learned from; other columns are not read; repeated rows
count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ntile import exact_quantiles
from ..session import materialize
from .textarrow import slices

ORDER = 4
#: (language, gram) rows of one part of a model, about.
PART_GRAMS = 1_000_000
#: Parts that a task keeps in memory, in bytes together; it reads the others again for every group of texts.
HELD_BYTES = 256 << 20
_CELLS = 1_000_000                     # grams times languages that are worked on at once
_GROUP_GRAMS = 16_000_000              # characters of a group of texts
REJECT_ABOVE = 0.999
UNKNOWN = "und"
_U = np.uint64


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def gram_keys(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of every text end to end, and their offsets; texts without letters have none.

    A text is read as a space, its letters with single spaces between runs, and a
    closing space; the first grams reach into spaces before it.
    """
    low = [(t or "").lower() for t in texts]
    sizes = np.fromiter((len(t) for t in low), np.int64, len(low))
    points = np.frombuffer("".join(f"{t} " for t in low).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes + 1)
    small = points < 1 << 16
    letter = letters[np.where(small, points, 32)]
    for c in np.unique(points[~small]):
        letter |= (points == c) & chr(c).isalpha()
    symbol = np.where(letter, points & 0xFFFF, 32).astype(_U)
    doc = np.repeat(np.arange(len(low)), sizes + 1)
    first = ends - sizes - 1
    any_letter = np.add.reduceat(letter, first) > 0 if len(first) else np.zeros(0, bool)
    previous_letter = np.zeros(len(letter), bool)
    previous_letter[1:] = letter[:-1]
    previous_letter[first] = False
    keep = (letter | previous_letter) & any_letter[doc]
    symbol, doc = symbol[keep], doc[keep]
    counts = np.bincount(doc, minlength=len(low))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(len(symbol)) - offsets[:-1][doc]
    keys = symbol.copy()
    for back in range(1, ORDER):
        before = np.full(len(symbol), _U(32))
        before[back:] = symbol[:-back]
        before[at < back] = _U(32)
        keys |= before << _U(16 * back)
    return keys, offsets


def gram_counts(texts: DataFrame, languages: list[str]) -> DataFrame:
    """(language, gram, n): 4-gram counts of all texts (columns text, lang), added up per task first."""
    place = {name: i for i, name in enumerate(languages)}

    def merged(held):
        keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([c for _, c in held])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        held: list[list] = [[] for _ in languages]

        def flush(least: int):
            for i, h in enumerate(held):
                if sum(len(k) for k, _ in h) > least:
                    held[i] = [merged(h)]
                    if len(held[i][0][0]) > least:
                        keys, counts = held[i][0]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys), i, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)],
                            names=["language", "gram", "n"])
                        held[i] = []

        for batch in batches:
            for part in slices(batch, "text"):
                lang = np.array([place[x] for x in part.column("lang").to_pylist()])
                keys, offsets = gram_keys(part.column("text").to_pylist(), letters)
                owner = np.repeat(lang, np.diff(offsets))
                for i in np.unique(lang):
                    held[i].append(np.unique(keys[owner == i], return_counts=True))
                yield from flush(1_000_000)
        yield from flush(0)

    return texts.mapInArrow(run, "language int, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))


def _packed(rows: DataFrame, place: np.ndarray, parts: int) -> DataFrame:
    """(part): the rows (language, gram, n) of one order as pickled arrays, each part a range of contexts.

    The grams and the contexts are sorted, each with the place of its first row; rows hold the language
    (``place`` numbers the languages that have grams) and the count, or the total and the number of followers.
    """
    def firsts(sorted_keys):
        first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
        return sorted_keys[first], np.append(first, len(sorted_keys)).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("language", "gram", "n")] for b in batches if b.num_rows]
        if not held:
            return
        language, gram, n = [np.concatenate(c) for c in zip(*held)]
        language, gram = place[language].astype(np.int32), gram.view(_U)
        order = np.argsort(gram, kind="stable")
        keys, first = firsts(gram[order])
        context = gram >> _U(16)
        by = np.lexsort((language, context))
        pair = np.flatnonzero(np.concatenate([[True], (context[by][1:] != context[by][:-1]) | (language[by][1:] != language[by][:-1])]))
        contexts, context_first = firsts(context[by][pair])
        body = pickle.dumps((
            (keys, first, language[order], n[order].astype(np.float32)),
            (contexts, context_first, language[by][pair], np.add.reduceat(n[by].astype(np.float64), pair).astype(np.float32),
             np.diff(np.append(pair, len(by))).astype(np.float32))), protocol=5)
        yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["part"])

    return rows.repartitionByRange(parts, F.shiftrightunsigned("gram", 16)).mapInArrow(run, "part binary")


class KneserNey:
    """The models of all languages that have grams: per order, parts with the sorted n-grams and contexts.

    ``parts`` are (order, broadcast, held) from order 1 on; a context and its grams are in one part. ``symbols`` is the
    size of the alphabet of all languages together, one more for unseen characters.
    """

    def __init__(self, names: list[str], symbols: int, discounts: dict[int, np.ndarray], parts: list[tuple]):
        self.names, self.symbols, self.discounts, self.parts = names, symbols, discounts, parts
        self.languages = len(names)
        self.whole = all(held for _, _, held in parts)

    @staticmethod
    def _read(part, held: bool):
        # a broadcast keeps its value; the worker's file of it can be read without
        return part.value if held or not getattr(part, "_path", None) else part.load_from_path(part._path)

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def _columns(self, at: np.ndarray, seen, first: np.ndarray, language: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        """The values of the rows of entries ``at`` with a column per language; 0 where there is none."""
        lengths = np.where(seen, first[at + 1] - first[at], 0).astype(np.int64)
        row = np.repeat(np.arange(len(at)), lengths)
        i = np.repeat(first[at] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        out = [np.zeros((len(at), self.languages)) for _ in values]
        for o, v in zip(out, values):
            o[row, language[i]] = v[i]
        return out

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Natural log of P(last character | the three before) for each packed gram and language."""
        p = np.full((len(grams), self.languages), 1.0 / self.symbols)
        step = max(1, _CELLS // self.languages)
        for k, part, held in self.parts:
            (keys, *key_rows), (contexts, *context_rows) = self._read(part, held)
            short = grams & _U((1 << (16 * k)) - 1) if k < 4 else grams
            at, known = self._find(contexts, short >> _U(16))
            found = np.flatnonzero(known)
            discount = self.discounts[k]
            for begin in range(0, len(found), step):
                rows = found[begin:begin + step]
                den, kinds = self._columns(at[rows], True, *context_rows)
                where, seen = self._find(keys, short[rows])
                c, = self._columns(where, seen, *key_rows)
                with np.errstate(divide="ignore", invalid="ignore"):
                    mixed = np.maximum(c - discount, 0) / den + discount * kinds / den * p[rows]
                p[rows] = np.where(den > 0, mixed, p[rows])
        return np.log(p)

    def cross_entropies(self, texts: list[tuple]) -> list[np.ndarray]:
        """Mean negative log probability per character of each text and language (infinite without letters), for
        several slices of texts: (sorted grams, the place of each character's gram, offsets)."""
        every = texts[0][0] if len(texts) == 1 else np.unique(np.concatenate([grams for grams, _, _ in texts]))
        logs = self.log_probabilities(every) if len(every) else None
        results = []
        for grams, where, offsets in texts:
            out = np.full((len(offsets) - 1, self.languages), np.inf)
            full = np.flatnonzero(np.diff(offsets) > 0)
            if len(full):
                mine = logs if grams is every else logs[np.searchsorted(every, grams)]
                for i in range(self.languages):
                    out[full, i] = -np.add.reduceat(mine[where, i], offsets[:-1][full])
                out[full] /= np.diff(offsets)[full][:, None]
            results.append(out)
        return results


def train(texts: DataFrame, languages: list[str]) -> KneserNey | None:
    """Fit the models on all ``texts`` (columns text, lang; lang is one of ``languages``); None without any letters."""
    spark = texts.sparkSession
    rows = materialize(gram_counts(texts, languages))
    levels, discounts, place = [], {}, None
    for k in range(ORDER, 0, -1):
        facts = {r["language"]: r for r in rows.groupBy("language").agg(
            F.count(F.lit(1)).alias("grams"), F.count_if(F.col("n") == 1).alias("ones"),
            F.count_if(F.col("n") == 2).alias("twos")).collect()}
        if not facts:
            return None
        if place is None:
            present = sorted(facts)
            place = np.full(len(languages), -1)
            place[present] = np.arange(len(present))
        ones, twos = (np.array([facts[i][c] for i in present]) for c in ("ones", "twos"))
        discounts[k] = np.clip(np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.05, 0.95)
        levels.append((k, rows, -(-sum(r["grams"] for r in facts.values()) // PART_GRAMS)))
        if k > 1:
            # the order below counts the different characters before each shorter gram
            short = F.col("gram").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1))
            rows = materialize(rows.groupBy("language", short.alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    symbols = rows.select("gram").distinct().count() + 1
    parts, size = [], 0
    for k, rows, n in reversed(levels):
        for r in _packed(rows, place, n).toLocalIterator():
            size += len(r["part"])
            parts.append((k, spark.sparkContext.broadcast(pickle.loads(r["part"])), size <= HELD_BYTES))
    return KneserNey([languages[i] for i in present], symbols, discounts, parts)


def _entropies(texts: DataFrame, model: KneserNey, keep: dict[str, str]) -> DataFrame:
    """``keep`` columns and ``ce``: cross-entropies per language (NULL without letters)."""
    def run(batches):
        letters = _letters()
        group = []

        def flush():
            for (columns, _), ce in zip(group, model.cross_entropies([t for _, t in group])):
                some = np.isfinite(ce).all(axis=1)
                column = pa.array([r if s else None for r, s in zip(ce.tolist(), some.tolist())], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*columns, column], names=[*keep, "ce"])
            group.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                keys, offsets = gram_keys(part.column("text").to_pylist(), letters)
                grams, where = np.unique(keys, return_inverse=True)
                group.append(([part.column(c) for c in keep], (grams, where.astype(np.int32), offsets)))
                # parts that are not held are read once for many texts
                if (model.whole or sum(len(t[0]) for _, t in group) * model.languages >= 8 * _CELLS
                        or sum(len(t[1]) for _, t in group) >= _GROUP_GRAMS):
                    yield from flush()
        if group:
            yield from flush()

    return texts.select(*keep, "text").mapInArrow(
        run, ", ".join(f"`{c}` {k}" for c, k in keep.items()) + (", " if keep else "") + "ce array<double>")


def _calibrate(scored: DataFrame, languages: list[str]) -> tuple[float, list[float]]:
    """Temperature at which the mean score of right answers is likeliest, and the rejection level per language, from
    the cross-entropies ``ce`` of all learning texts and their ``lang``."""
    truth = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int")
    rows = materialize(scored.where("ce is not null").select("ce", F.array_min("ce").alias("best"), truth.alias("truth"))
                       .where("truth > 0").withColumn("own", F.element_at("ce", F.col("truth"))))
    temperatures = [float(2.0 ** e) for e in np.arange(0, 9, 0.5)]

    def loss(t: float):
        total = F.aggregate("ce", F.lit(0.0), lambda a, c: a + F.exp((F.col("best") - c) * t))
        return F.avg(F.log(total) + (F.col("own") - F.col("best")) * t)
    losses = rows.agg(*[loss(t).alias(f"t{i}") for i, t in enumerate(temperatures)]).first()
    if losses[0] is None:
        return 20.0, [float("inf")] * len(languages)
    levels = exact_quantiles(rows, [F.when(F.col("truth") == i + 1, F.col("own")) for i in range(len(languages))], [REJECT_ABOVE])
    return (min(zip(losses, temperatures))[1],
            [float("inf") if level is None or level[0] is None else level[0] + 0.05 for level in levels])


def predict_languages(docs: DataFrame, learn: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score, accepted, cross_entropy) of every row of ``docs`` (doc_id, text), with models of
    ``learn`` (doc_id, text, lang)."""
    learn = learn.where("lang is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    languages = sorted(r["lang"] for r in learn.select("lang").distinct().collect())
    kind = {"doc_id": docs.schema["doc_id"].dataType.simpleString()}
    model = train(learn, languages) if languages else None
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("accepted"), F.lit(None).cast("double").alias("cross_entropy"))
    languages = model.names
    temperature, levels = _calibrate(_entropies(learn, model, {"lang": "string"}), languages)
    best = F.array_min("ce")
    place = F.array_position("ce", best).cast("int")
    scored = _entropies(docs, model, kind).withColumn("best", best).withColumn("place", place)
    names, most = F.array(*[F.lit(x) for x in languages]), F.array(*[F.lit(x) for x in levels])
    total = F.aggregate("ce", F.lit(0.0), lambda a, c: a + F.exp((F.col("best") - c) * temperature))
    some = F.col("ce").isNotNull()
    return scored.select(
        "doc_id", F.when(some, F.element_at(names, F.col("place"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(some, 1.0 / total).otherwise(0.0).alias("score"),
        F.when(some, F.col("best") <= F.element_at(most, F.col("place"))).otherwise(False).alias("accepted"),
        F.col("best").alias("cross_entropy"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; those whose id's crc32 leaves 2 modulo 4 are not learned from."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    def fold():
        return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    out = predict_languages(docs.select("doc_id", "text"), docs.select("doc_id", "text", "lang").where(fold() != 2))
    return out.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
                      "accepted", "cross_entropy")
