"""Quality classifier by co-training of two views.

View one reads a document's text (its characters, word shapes, word repetition), view two
its page metadata (source, language, length and layout). Each view has a logistic
model, fitted on labelled documents. Over some rounds each model labels all unlabelled documents that it is surest of, by its calibrated
probability and up to a share of the corpus that grows from round to round in the class proportions of the labels, for the other one to learn
from. Pseudo-labels together weigh ``PSEUDO_WEIGHT`` times as much as the labels, and a view only takes its new model if that is no
worse on labelled documents kept aside; the exchange ends when neither does. Both are then calibrated on the documents kept aside, and one
logistic combination of the calibrated views scores all documents; those scored below ``threshold`` are rejected.

Labels are read from a bounded sample: ``MOST_LABELLED`` labelled documents (least hash of the id), wholly read. Unlabelled documents have no
bound: their features are written once, and every round reads them all on Spark, once for the distribution of the scores and once per Newton
step, for which each task adds up gradient and curvature. Scoring covers every document with its whole text.

NULL text counts as empty, NULL source and language as values of their own. Several labels of one id are averaged (half or
more is good); labels that are NULL or of unknown documents are left out. With labels of one class or
none, all documents are kept, with that class's share (1 without labels) as score. Repeated rows score alike; an empty
table gives no rows; other columns are only carried.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import materialize, remove_staged, scratch_path, stage_table
from .textarrow import ascii_lower, raw, slices, word_bounds, word_hashes

MOST_LABELLED = 6_000
ROUNDS = 3
SURE = 0.97
#: What all pseudo-labels weigh together, as a multiple of the labels, and the share of unlabelled documents that the last round may label.
PSEUDO_WEIGHT, MOST_PSEUDO = 0.5, 0.5
_NEWTON_STEPS = 2
_FAR = 8.0
_LEVELS = 1000                         # steps of probability in the distribution of scores
#: Labelled documents in every five that calibrate instead of train.
_CALIBRATE_EVERY = 5
_NAMES = 24                            # hashed places of source and language each


def text_view(texts: pa.Array) -> np.ndarray:
    """Per text: shares of printable ASCII bytes, shapes of words, and repetition."""
    data, offsets = raw(texts)
    docs = len(offsets) - 1
    sizes = np.maximum(np.diff(offsets), 1)
    doc = np.repeat(np.arange(docs), np.diff(offsets))
    classes = np.where(data < 32, 0, np.where(data < 127, data - 31, 96)).astype(np.int64)
    share = np.bincount(doc * 97 + classes, minlength=docs * 97).reshape(docs, 97) / sizes[:, None]
    starts, ends, words = word_bounds(data, offsets)
    n = np.maximum(np.diff(words), 1)
    word_doc = np.repeat(np.arange(docs), np.diff(words))
    low = ascii_lower(data)
    hashes = word_hashes(low, starts, ends)
    length = (ends - starts).astype(float)

    def mean(x) -> np.ndarray:
        return np.bincount(word_doc, x, docs) / n

    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_doc[1:] == word_doc[:-1])
    first, last = data[starts] if len(starts) else data[:0], data[ends - 1] if len(ends) else data[:0]
    alone = length == 1
    order = np.lexsort((hashes, word_doc))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (word_doc[order][1:] != word_doc[order][:-1])
    distinct = np.bincount(word_doc[order], new, docs) / n
    upper = np.cumsum(np.concatenate([[0], (data >= 65) & (data <= 90)]))
    shouted = (upper[ends] - upper[starts]) * 2 > length
    odd = (first < 128) & ~(((low[starts] if len(starts) else first) >= 97) & ((low[starts] if len(starts) else first) <= 122))
    closing = (last < 128) & ~((last >= 97) & (last <= 122)) & ~((last >= 65) & (last <= 90))
    shapes = [mean(again), distinct, mean(alone), mean(length) / 10, mean(shouted), mean(odd), mean(closing),
              mean(length > 15), mean(length <= 3), np.log1p(np.diff(words)) / 10, distinct * np.log1p(np.diff(words)) / 5]
    return np.concatenate([np.sqrt(share), np.stack(shapes, axis=1)], axis=1)


def page_view(texts: pa.Array, source: pa.Array, lang: pa.Array) -> np.ndarray:
    """Per document: hashed source and language, length and layout of the page."""
    data, offsets = raw(texts)
    docs = len(offsets) - 1
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(docs), sizes)
    lines = np.bincount(doc, data == 10, docs) + 1
    out = np.zeros((docs, 2 * _NAMES + 5))
    for base, names in ((0, source), (_NAMES, lang)):
        for i, name in enumerate(names.to_pylist()):
            out[i, base + (0 if name is None else 1 + crc32(str(name).encode()) % (_NAMES - 1))] = 1
    blank = np.zeros(len(data), bool)
    blank[1:] = (data[1:] == 10) & (data[:-1] == 10)
    spaces = np.bincount(doc, data == 32, docs)
    out[:, -5] = np.log1p(sizes) / 10
    out[:, -4] = np.log1p(lines) / 5
    out[:, -3] = np.log1p(sizes / lines) / 8
    out[:, -2] = np.bincount(doc, blank, docs) / lines
    out[:, -1] = spaces / np.maximum(sizes, 1) * 4
    return out


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12, spread: tuple | None = None) -> Logistic:
        """Fitted on rows; ``spread``: mean and deviation to standardise by (default: those of the rows)."""
        mean, scale = spread or (x.mean(axis=0), x.std(axis=0))
        model = cls(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(x.shape[1] + 1))
        for _ in range(steps):
            model, moved = model.stepped(*model.sums(x, y), ridge)
            if moved < 1e-4:
                break
        return model

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the loss over rows."""
        z = np.concatenate([self.standard(x), np.ones((len(x), 1))], axis=1)
        p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
        return z.T @ (p - y), (z * (p * (1 - p) + 1e-6)[:, None]).T @ z

    def stepped(self, gradient: np.ndarray, curvature: np.ndarray, ridge: float = 1.0) -> tuple[Logistic, float]:
        """The model after a Newton step on the sums, and the largest change of a weight."""
        penalty = np.full(len(self.weights), ridge)
        penalty[-1] = 1e-6
        move = np.linalg.solve(curvature + np.diag(penalty), gradient + penalty * self.weights)
        return Logistic(self.mean, self.scale, self.weights - move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-9))), float(np.abs(move).max())

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        p = np.clip(self.probability(x), 1e-9, 1 - 1e-9)
        return float(-np.mean(np.where(y > 0.5, np.log(p), np.log(1 - p))))

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Standardised features; one far off counts no more than ``_FAR`` deviations."""
        return np.clip((x - self.mean) / self.scale, -_FAR, _FAR)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.standard(x) @ self.weights[:-1] + self.weights[-1], -30, 30)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def _calibration(model: Logistic, x: np.ndarray, y: np.ndarray) -> Logistic:
    """A logistic model of the label by the model's logit."""
    return Logistic.fit(model.logit(x)[:, None], y)


class Pool:
    """The unlabelled documents' views (a, b), read wholly on Spark in every pass."""

    def __init__(self, features: DataFrame):
        self.features = features

    def spread(self) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Mean and deviation of every feature of both views over all documents (None without any)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, None
            for batch in batches:
                if batch.num_rows:
                    x = np.concatenate(_arrays(batch), axis=1)
                    part = np.stack([x.sum(axis=0), (x * x).sum(axis=0)])
                    n, sums = n + len(x), part if sums is None else sums + part
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1])), pa.array(np.full(sums.shape[1], n)), pa.array(sums[0]), pa.array(sums[1])],
                                                 names=["i", "n", "s", "q"])

        rows = self.features.mapInArrow(run, "i long, n long, s double, q double").groupBy("i").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("i").collect()
        if not rows:
            return None
        mean = np.array([r["s"] / r["n"] for r in rows])
        scale = np.sqrt(np.maximum(np.array([r["q"] / r["n"] for r in rows]) - mean ** 2, 0))
        cut = len(mean) - 2 * _NAMES - 5         # the page view's features come last
        return [(mean[:cut], scale[:cut]), (mean[cut:], scale[cut:])]

    def levels(self, models: list[Logistic], calibrations: list[Logistic]) -> np.ndarray:
        """Per view the number of documents by step of calibrated probability."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum((level_counts(_arrays(batch), models, calibrations) for batch in batches if batch.num_rows),
                        np.zeros((2, _LEVELS), np.int64))
            view, level = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(view), pa.array(level), pa.array(total[view, level])], names=["view", "level", "n"])

        out = np.zeros((2, _LEVELS), np.int64)
        for r in self.features.mapInArrow(run, "view long, level long, n long").groupBy("view", "level").agg(F.sum("n").alias("n")).collect():
            out[r["view"], r["level"]] = r["n"]
        return out

    def sums(self, models: list[Logistic], calibrations: list[Logistic], candidates: list[Logistic], limits: np.ndarray) -> list[tuple]:
        """Per view the number of documents that the other view is sure of, and the gradient and curvature of the candidate there."""
        sizes = [len(c.weights) for c in candidates]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = pseudo_sums(_arrays(batch), models, calibrations, candidates, limits)
                    total = part if total is None else [tuple(a + b for a, b in zip(x, y)) for x, y in zip(total, part)]
            for view, (n, gradient, curvature) in enumerate(total or []):
                # a row per row of the curvature, with the gradient and the number behind it
                rows = np.concatenate([curvature, gradient[None, :]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), view)), pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), n)),
                     pa.array(list(rows), pa.list_(pa.float64()))], names=["view", "row", "n", "s"])

        def added(table: pa.Table) -> pa.Table:
            s = np.stack([np.asarray(x.as_py()) for x in table.column("s")]).sum(axis=0)
            return pa.table({"view": table.column("view").slice(0, 1), "row": table.column("row").slice(0, 1),
                             "n": [int(sum(table.column("n").to_pylist()))], "s": pa.array([s], pa.list_(pa.float64()))})

        schema = "view long, row long, n long, s array<double>"
        got = {(r["view"], r["row"]): r for r in self.features.mapInArrow(run, schema).groupBy("view", "row").applyInArrow(added, schema).collect()}
        out = []
        for view, size in enumerate(sizes):
            rows = [np.array(got[view, i]["s"]) if (view, i) in got else np.zeros(size) for i in range(size + 1)]
            out.append((got[view, 0]["n"] if (view, 0) in got else 0, rows[-1], np.stack(rows[:-1])))
        return out


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float) for c in ("a", "b")]


def _sure(views, models, calibrations) -> list[np.ndarray]:
    """The calibrated probabilities of both views."""
    return [c.probability(m.logit(x)[:, None]) for x, m, c in zip(views, models, calibrations)]


def level_counts(views, models, calibrations) -> np.ndarray:
    return np.stack([np.bincount(np.minimum((p * _LEVELS).astype(int), _LEVELS - 1), minlength=_LEVELS) for p in _sure(views, models, calibrations)])


def pseudo_sums(views, models, calibrations, candidates, limits) -> list[tuple]:
    """Per view (number, gradient, curvature) of the candidate over the documents that the other view labels: level at most
    ``limits[other, 0]`` is bad, at least ``limits[other, 1]`` good."""
    levels = [np.minimum((p * _LEVELS).astype(int), _LEVELS - 1) for p in _sure(views, models, calibrations)]
    out = []
    for v, other in ((0, 1), (1, 0)):
        bad, good = levels[other] <= limits[other, 0], levels[other] >= limits[other, 1]
        taken = bad | good
        out.append((int(taken.sum()), *candidates[v].sums(views[v][taken], good[taken].astype(float))))
    return out


def sure_limits(counts: np.ndarray, share: float, part: float, sure: float = SURE) -> np.ndarray:
    """Per view the highest level that is labelled bad and the lowest that is labelled good: at least ``sure``, and no more
    documents of a class than ``part`` of all, in the proportion ``share`` of good ones (whole levels)."""
    limits = np.zeros((2, 2), np.int64)
    for v in (0, 1):
        total = counts[v].sum()
        bad, good = np.cumsum(counts[v]), np.cumsum(counts[v][::-1])
        fit_bad = np.flatnonzero(bad <= part * (1 - share) * total)
        fit_good = np.flatnonzero(good <= part * share * total)
        limits[v, 0] = min(int(fit_bad[-1]) if len(fit_bad) else -1, int((1 - sure) * _LEVELS) - 1)
        limits[v, 1] = max(_LEVELS - 1 - int(fit_good[-1]) if len(fit_good) else _LEVELS, int(np.ceil(sure * _LEVELS)))
    return limits


def co_train(views: list[np.ndarray], y: np.ndarray, aside: list[np.ndarray], y_aside: np.ndarray, pool: Pool, rounds: int = ROUNDS,
             sure: float = SURE) -> list[Logistic]:
    """One model per view, after at most ``rounds`` of handing the surest pseudo-labels to the other view."""
    spread = pool.spread() or [None, None]
    models = [Logistic.fit(x, y, spread=s) for x, s in zip(views, spread)]
    share = float(y.mean())
    for r in range(rounds):
        calibrations = [_calibration(m, x, y_aside) for m, x in zip(models, aside)]
        limits = sure_limits(pool.levels(models, calibrations), share, MOST_PSEUDO * (r + 1) / rounds, sure)
        fresh, many = list(models), [0, 0]
        for _ in range(_NEWTON_STEPS):
            for v, (n, gradient, curvature) in enumerate(pool.sums(models, calibrations, fresh, limits)):
                many[v] = n
                if n:
                    weight = PSEUDO_WEIGHT * len(y) / n
                    own = fresh[v].sums(views[v], y)
                    fresh[v], _ = fresh[v].stepped(own[0] + weight * gradient, own[1] + weight * curvature)
        better = [n > 0 and f.loss(x, y_aside) <= m.loss(x, y_aside) for n, f, m, x in zip(many, fresh, models, aside)]
        if not any(better):
            break
        models = [f if b else m for f, b, m in zip(fresh, better, models)]
    return models


@dataclass
class Scorer:
    """The two views' models, their calibrations and the combination; or one score for all."""

    constant: float | None = None
    models: list[Logistic] | None = None
    calibrations: list[Logistic] | None = None
    combination: Logistic | None = None

    def __call__(self, views: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        if self.constant is not None:
            same = np.full(len(views[0]), self.constant)
            return same, [same, same]
        logits = [c.logit(m.logit(x)[:, None]) for m, c, x in zip(self.models, self.calibrations, views)]
        both = self.combination.probability(np.stack(logits, axis=1))
        return both, [1 / (1 + np.exp(-z)) for z in logits]


def _views(part: pa.RecordBatch) -> list[np.ndarray]:
    return [text_view(part.column("text")), page_view(part.column("text"), part.column("source"), part.column("lang"))]


def _features(rows: DataFrame) -> DataFrame:
    """(id, y, a, b) of rows (id, y, text, source, lang): both views as lists of floats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                columns = []
                for v in _views(part):
                    ends = np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.float32).ravel())))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), *columns], names=["id", "y", "a", "b"])

    return rows.mapInArrow(run, "id long, y double, a array<float>, b array<float>")


def _sample(docs: DataFrame, votes: DataFrame):
    """Views and labels of the sampled labelled documents: (text view, page view, label)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct()
    chosen = materialize(votes.join(ids, "id").orderBy(F.xxhash64("id"), "id").limit(MOST_LABELLED))
    # at most MOST_LABELLED rows of 16 bytes
    rows = _inputs(docs).drop("y").join(F.broadcast(chosen), "id").select("id", "y", "text", "source", "lang")
    got = _features(rows).toPandas().drop_duplicates("id").sort_values("id")
    if not len(got):
        return np.zeros((0, 1)), np.zeros((0, 1)), np.zeros(0)
    return np.stack(got["a"].tolist()).astype(float), np.stack(got["b"].tolist()).astype(float), got["y"].to_numpy(float)


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.lit(None).cast("double").alias("y"), "text",
                       F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))


def split_aside(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(train, aside): every fifth document of each class calibrates; all train if else a class would be missing."""
    aside = np.concatenate([np.flatnonzero(y == c)[::_CALIBRATE_EVERY] for c in (0, 1)])
    train = np.setdiff1d(np.arange(len(y)), aside)
    return (train if len(np.unique(y[train])) == 2 else np.arange(len(y))), aside


def fit_scorer(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Scorer:
    """Co-train, calibrate and combine."""
    votes = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        (F.avg("quality") >= 0.5).cast("double").alias("y"))
    a, b, y = _sample(docs, votes)
    if not len(y) or y.min() == y.max():
        return Scorer(constant=float(y[0]) if len(y) else 1.0)
    train, aside = split_aside(y)
    path = scratch_path(docs.sparkSession, "quality-views")
    known = checked_broadcast(votes.select("id"))
    pool = Pool(stage_table(_features(_inputs(docs).join(known, "id", "left_anti")).select("a", "b"), "quality-views", path=path))
    models = co_train([a[train], b[train]], y[train], [a[aside], b[aside]], y[aside], pool, rounds)
    remove_staged(docs.sparkSession, path)
    calibrations = [_calibration(m, x[aside], y[aside]) for m, x in zip(models, (a, b))]
    logits = [c.logit(m.logit(x[aside])[:, None]) for m, c, x in zip(models, calibrations, (a, b))]
    return Scorer(None, models, calibrations, Logistic.fit(np.stack(logits, axis=1), y[aside]))


ADDED = {"quality_text": "double", "quality_page": "double", "quality": "double", "kept": "boolean"}


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with quality_text, quality_page, quality (combined) and kept (quality >= threshold); clashing columns are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit_scorer(docs, labels, rounds))
    added = ADDED
    keep = [c for c in docs.columns if c not in added]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("source").cast("string").alias("__source"),
                      F.col("lang").cast("string").alias("__lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                view = pa.RecordBatch.from_arrays([part.column("text"), part.column("__source"), part.column("__lang")],
                                                  names=["text", "source", "lang"])
                both, each = shared.value(_views(view))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(each[0]), pa.array(each[1]), pa.array(both),
                     pa.array(both >= threshold)], names=[*keep, *added])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema if f.name in keep} | added
    return src.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in kinds.items()))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that are not rejected, in ``docs``'s columns."""
    columns = docs.columns
    # columns named like the scores step aside meanwhile
    aside = {c: f"__own_{c}" for c in columns if c in ADDED}
    marked = score_documents(docs.withColumnsRenamed(aside), labels, threshold).where("kept")
    return marked.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in columns])


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the co-trained quality classifier."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return score_documents(docs, labels).select("doc_id", "quality_text", "quality_page", "quality", "kept")
