"""Spelling variants by composition of finite-state machines.

The words that occur often enough form a vocabulary. Two words are near if one inserted, deleted or replaced code point
turns one into the other: the pairs that the vocabulary acceptor, a one-edit transducer and
the acceptor again accept when composed. Each word's form is its most frequent near word that occurs
``ratio`` times as often as itself, if there is one; its root is where the chain of forms ends.

Enumeration is dealt by initial states. A pair whose shorter word has ``m`` code points has its edit at one place (the length of the
two words' common beginning) from 0 to m. For a range of places [lo, hi) both words share what comes before ``lo`` and what comes after
``hi``, so all such pairs of one shared beginning and end start in one state of the composed machine. Words
are dealt by that state (a hash of it) for the two halves of the places; a state that more than ``GROUP_WORDS`` words start from
is counted beforehand and dealt again by the halves of its range, until the part that may differ is one code point. So no group grows with
the vocabulary, no pair is lost, and each is met once. Within a group the words' middle parts form minimised acceptors (same length,
and one longer), which are composed with the transducer state by state; only one row per word leaves it
(number of near words, best one), never pairs.

NULL and empty texts have no words. A NULL document id counts as empty text in the typing-error rule. Repeated rows count
each time. Other columns are not read. Very long runs are words like others. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import materialize, stage_table

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One run in so many loses a code point, by a checksum of document and run (the contract's fixed rule).
DELETE_ONE_IN = 31
#: Words that may start from one state before its range of edit places is halved.
GROUP_WORDS = 400
_RUN = "[A-Za-zÀ-ÿ]+"
_HELD_WORDS = 300_000


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word, n): the vocabulary with its counts. Counts are added up per task before the shuffle, in a table of bounded size."""
    pattern = re.compile(_RUN[:-1] + "{%d,}" % least_length)

    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                # bytes.lower() changes A-Z only
                runs = Counter(pattern.findall(text.as_buffer().to_pybytes().lower().decode()))
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in runs.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    held[word] += n
            if len(held) > _HELD_WORDS:
                yield out(held)
                held = Counter()
        yield out(held)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _state_rows(rows: DataFrame) -> DataFrame:
    """(word, n, m, lo, hi, state): ``rows`` with the hash of the shared beginning and end for edit places [lo, hi) of pairs whose
    shorter word has ``m`` code points."""
    after = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    return rows.withColumn("state", F.xxhash64("m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")),
                                               F.substring("word", F.length("word") - after + 1, after)))


def _halves(lo: str, hi: str):
    """The two halves of the range [lo, hi) of edit places, as an array of (lo, hi)."""
    mid = f"int(({lo} + {hi}) div 2)"
    return F.expr(f"array(struct(int({lo}) as lo, {mid} as hi), struct({mid} as lo, int({hi}) as hi))")


def start_states(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, m, lo, hi, state): every word at each state that it may share with a near word.

    ``words`` (word, n) is read several times. States with many words are found by a count (partial per task), and only their
    words are dealt again.
    """
    each = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m"))
    rows = _state_rows(each.select("word", "n", "m", F.explode(_halves("0", "m + 1")).alias("r"))
                       .select("word", "n", "m", "r.lo", "r.hi"))
    done = None
    while True:
        many = materialize(rows.where("hi - lo > 1").groupBy("state").count().where(F.col("count") > group_words).select("state"))
        if not many.take(1):
            return rows if done is None else done.unionByName(rows)
        side = checked_broadcast(many)
        kept = rows.join(side, "state", "left_anti").select("word", "n", "m", "lo", "hi", "state")
        done = kept if done is None else done.unionByName(kept)
        # a range of one place is never in ``many``, so every state dealt again has two halves
        again = rows.where("hi - lo > 1").join(side, "state", "left_semi").select("word", "n", "m", F.explode(_halves("lo", "hi")).alias("r"))
        rows = stage_table(_state_rows(again.select("word", "n", "m", "r.lo", "r.hi")), "spelling-states")


class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct words: ``arcs[state][symbol]`` is the next state, ``final`` the accepting ones."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: set[int] = set()
        self._known: dict[tuple, int] = {}
        path: list[int] = [0]                       # states of the last word; only these may still change
        last = ""
        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            self._settle(path, last, common)
            for symbol in word[common:]:
                self.arcs.append({})
                self.arcs[path[-1]][symbol] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final.add(path[-1])
            last = word
        self._settle(path, last, 0)

    def _settle(self, path: list[int], word: str, depth: int) -> None:
        """Replace the states of ``path`` below ``depth`` by known ones with the same arcs and acceptance."""
        while len(path) > depth + 1:
            state = path.pop()
            same = (state in self.final, tuple(self.arcs[state].items()))
            self.arcs[path[-1]][word[len(path) - 1]] = self._known.setdefault(same, state)


def _common(x: Acceptor, y: Acceptor, p: int, q: int, memo: dict) -> list[str]:
    """The words that ``x`` accepts from ``p`` and ``y`` from ``q``: the copying state of the transducer after its edit.

    Pairs of states that have none are all remembered; of the others only the first, and no long words.
    """
    found = memo.get((p, q))
    if found is not None:
        return found
    found, met, path = [], [], []
    open_ = [(p, q, 0, "")]
    while open_:
        p1, q1, depth, symbol = open_.pop()
        if (p1, q1) in memo and not memo[p1, q1]:
            continue
        del path[max(depth - 1, 0):]
        path.append(symbol)
        met.append((p1, q1))
        if p1 in x.final and q1 in y.final:
            found.append("".join(path))
        there = y.arcs[q1]
        for c, p2 in x.arcs[p1].items():
            if c in there:
                open_.append((p2, there[c], depth + 1, c))
    if not found:
        memo.update(dict.fromkeys(met, found))
    elif len(met) < 1000:
        memo[p, q] = found
    return found


def one_edit_pairs(short: list[str], longer: list[str], last_place: int) -> Iterator[tuple[str, str]]:
    """The pairs that ``short``'s acceptor, the one-edit transducer and the acceptors of ``short`` (replaced symbol) and ``longer`` (inserted
    symbol) accept: each once, insertions at their first place and at most at ``last_place``. Words of ``short`` have one
    length, those of ``longer`` one more; both are sorted."""
    x, y = Acceptor(short), Acceptor(longer)
    replaced: dict = {}
    inserted: dict = {}
    open_: list[tuple[int, int | None, str]] = [(0, 0 if longer else None, "")]
    while open_:                                    # (state, state, what both have read): before the edit
        p, q, read = open_.pop()
        arcs = list(x.arcs[p].items())
        for i, (a, p_a) in enumerate(arcs):
            for b, p_b in arcs[i + 1:]:
                for rest in _common(x, x, p_a, p_b, replaced):
                    yield read + a + rest, read + b + rest
        there = y.arcs[q] if q is not None else {}
        if len(read) <= last_place:
            for b, q_b in there.items():
                if p in x.final and q_b in y.final:
                    yield read, read + b
                after = y.arcs[q_b]
                for a, p_a in arcs:
                    if a != b and a in after:       # after the same symbol the pair comes from a later place
                        for rest in _common(x, y, p_a, after[a], inserted):
                            yield read + a + rest, read + b + a + rest
        for a, p_a in arcs:
            open_.append((p_a, there.get(a), read + a))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, form, form_n): the number of near words of each word that has one, and the most frequent (ties: the first)."""
    names = ["word", "n", "m", "lo", "hi", "state"]

    def groups(batches: Iterator[pa.RecordBatch]):
        held: list[tuple] = []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in names]):
                if held and held[0][5] != r[5]:
                    if len(held) > 1:
                        yield held
                    held = []
                held.append(r)
        if len(held) > 1:
            yield held

    def run(batches):
        out: list[tuple] = []
        for group in groups(batches):
            same: dict[tuple, dict[str, int]] = {}
            for word, n, m, lo, hi, _ in group:     # two states may share a hash
                after = max(m - hi, 0)
                same.setdefault((m, lo, hi, word[:lo], word[len(word) - after:]), {})[word] = n
            for (m, lo, hi, start, end), counts in same.items():
                cut = len(end)
                short = sorted(w[lo:m - cut] for w in counts if len(w) == m)
                longer = sorted(w[lo:m + 1 - cut] for w in counts if len(w) == m + 1)
                if len(short) + len(longer) < 2 or not short:
                    continue
                best: dict[str, list] = {}
                for a, b in one_edit_pairs(short, longer, hi - 1 - lo):
                    a, b = start + a + end, start + b + end
                    for u, v in ((a, b), (b, a)):
                        b_u = best.get(u)
                        new = (-counts[v], v)
                        if b_u is None:
                            best[u] = [1, new]
                        else:
                            b_u[0] += 1
                            if new < b_u[1]:
                                b_u[1] = new
                out += [(u, k, -n, v) for u, (k, (n, v)) in best.items()]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["word", "k", "form_n", "form"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["word", "k", "form_n", "form"])

    dealt = start_states(words, group_words).repartition("state").sortWithinPartitions("state")
    found = dealt.mapInArrow(run, "word string, k long, form_n long, form string")
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def chain_ends(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form), whose chains have no loops: each round doubles the step."""
    ends = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = ends.select(F.col("word").alias("via"), F.col("root").alias("end"))
        step = materialize(ends.join(on, F.col("root") == F.col("via"), "left").select("word", "root", "end"))
        if not step.where("end is not null").take(1):
            return ends
        ends = materialize(step.select("word", F.coalesce("end", "root").alias("root")))


def spelling_forms(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                   delete_one_in: int = DELETE_ONE_IN, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of ``docs`` (doc_id, text)."""
    words = stage_table(count_words(docs, least_length, least_count, delete_one_in), "spelling-words")
    near = near_words(words, group_words)
    all_ = words.join(near, "word", "left").withColumn("is_form", F.col("form_n") >= ratio * F.col("n"))
    all_ = stage_table(all_.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("is_form"), F.col("form")).alias("form"), F.when(F.col("is_form"), F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = chain_ends(all_.where("form is not null").select("word", "form"))
    return all_.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_forms(spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text"))
