"""Spelling variants, whitening and substring dedup against brute force, on whole small tables and on awkward ones."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from riskframe.llm import spelling, substrings, whitening
from tests.conftest import SF001
from tests.llm.conftest import awkward_rows

WORD = re.compile("[^\x20\x09-\x0D]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def forms(rows, least_length=7, least_count=2):
    counts = collections.Counter()
    for i, text in rows:
        for r in RUN.findall((text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            counts[r[:h % len(r)] + r[h % len(r) + 1:] if h % 31 == 0 else r] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_edit(w, v)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in form.items() if n[v] >= 10 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_spelling_of_the_smallest_scale_factor(spark):
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{SF001}/documents.parquet')").fetchall()
    want = forms(rows)
    assert found(spelling.op11_spelling(spark, SF001)) == want
    assert any(f for f, *_ in want.values())


@pytest.mark.parametrize("group_words", [spelling.GROUP_WORDS, 3])
def test_spelling_of_crowded_states(spark, group_words):
    """A third of the words share a beginning, a third an end; chains of forms; accents; ties; doubled letters."""
    rng = random.Random(5)
    letters = "abcéÿ"
    words = {"abcdefg" + "".join(rng.choices(letters, k=rng.randrange(4))) for _ in range(60)}
    words |= {"".join(rng.choices(letters, k=rng.randrange(5))) + "hijklmn" for _ in range(60)}
    words |= {"".join(rng.choices("ab", k=rng.randrange(6, 10))) for _ in range(120)}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa"}
    text = [w for w in sorted(words) for _ in range(rng.choice([1, 2, 2, 3, 25, 300]))]
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::30])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = forms(rows)
    assert found(spelling.spelling_forms(docs, group_words=group_words)) == want
    assert any(f and r != f for f, r, *_ in want.values())


def test_spelling_edges(spark, awkward, nothing):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert found(spelling.spelling_forms(awkward)) == forms(rows)
    assert found(spelling.spelling_forms(awkward, least_length=1, least_count=1)) == forms(rows, 1, 1)
    assert found(spelling.spelling_forms(nothing)) == {}
    long_ = "ab" * 20_000
    rows = [(1, f"{long_} {long_}x"), (2, f"{long_} {long_}x y{long_} {long_[:-1]}"), (3, f"{long_[:9999]}q{long_[10000:]}"),
            (4, f"{long_[:9999]}q{long_[10000:]} {long_[:-1]} y{long_}"), (None, None)]
    got = found(spelling.spelling_forms(spark.createDataFrame(rows, "doc_id long, text string"), delete_one_in=1 << 40))
    assert {w: r[3] for w, r in got.items()} == {
        long_: 4, long_ + "x": 1, "y" + long_: 1, long_[:-1]: 1, f"{long_[:9999]}q{long_[10000:]}": 1}


def test_acceptor_is_minimal_and_pairs_are_met_once():
    rng = random.Random(2)
    short = sorted({"".join(rng.choices("abc", k=5)) for _ in range(120)})
    longer = sorted({"".join(rng.choices("abc", k=6)) for _ in range(200)})
    made = spelling.Acceptor(short)
    reached, open_ = {0}, [0]
    while open_:
        for s in made.arcs[open_.pop()].values():
            if s not in reached:
                reached.add(s)
                open_.append(s)
    right = collections.Counter(frozenset(w[len(p):] for w in short if w.startswith(p)) for p in {w[:i] for w in short for i in range(6)})
    assert len(reached) == len(right)                # one state per set of endings
    pairs = list(spelling.one_edit_pairs(short, longer, 5))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in short for b in short if a < b and one_edit(a, b)} | {
        (a, b) for a in short for b in longer if one_edit(a, b)}


def fitted(vectors):
    """What whitening should give: (n, sums, whole vectors, eigenvalues, eigenvectors) by numpy."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return n, s, x, e[::-1], v[:, ::-1].T


def test_whitening_of_the_smallest_scale_factor(spark):
    rows = duckdb.sql(f"select vec_id, embedding from read_parquet('{SF001}/embeddings.parquet')").fetchall()
    n, s, x, e, v = fitted([r[1] for r in rows])
    got = collections.defaultdict(dict)
    for r in whitening.op12_whitening(spark, SF001).collect():
        got[r["vec_id"]][r["component"]] = r
    assert set(got) == {r[0] for r in rows}
    sign = {}
    for (i, _), y in zip(rows, x):
        want = ((n * y - s) / n) @ v[:16].T / np.sqrt(e[:16])
        assert sorted(got[i]) == list(range(1, 17))
        for k, r in got[i].items():
            sign.setdefault(k, np.sign(want[k - 1] * r["whitened"]))
            assert r["whitened"] * sign[k] == pytest.approx(want[k - 1], abs=1e-9)
            assert r["deviation"] == ((n * y - s) ** 2).sum() and r["n"] == n and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(e[k - 1] / e.sum(), rel=1e-9)


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    base = [[float(c) for c in rng.standard_normal(4)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(base)] + [(3, base[3]), (None, base[4])] + [(100 + i, base[0]) for i in range(40)]
    out = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 2.0, 3.0]), (204, [float("inf"), 0.0, 0.0, 0.0]),
           (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, component int, n string, whitened string"
    table = spark.createDataFrame([(i, v, 7, "n", "w") for i, v in rows + out], schema)
    got, made = whitening.whiten(table)
    got = got.collect()
    assert sorted(r["vec_id"] for r in got if r["vec_id"] is not None) == sorted(i for i, _ in rows if i is not None)
    assert len(got) == len(rows) and all(len(r["whitened"]) == 4 for r in got)
    n, s, _, e, _ = fitted(base)
    assert made.centre.n == n == 30 and made.identity_error < 1e-9 and np.allclose(made.values, e)
    assert whitening.op12_whitening.__doc__ and whitening.whiten(table.limit(0))[0].count() == 0
    one, made = whitening.whiten(table.where("vec_id >= 100 and vec_id < 200"))
    assert one.count() == 0 and made.centre.n == 1
    # two dimensions that say the same and one that does not vary
    flat = spark.createDataFrame([(i, [v[0], v[0], 5.0]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    got, made = whitening.whiten(flat)
    assert len(made.values) == 1 and made.explained[0] == pytest.approx(1) and made.identity_error < 1e-9
    # past the largest long
    wide = spark.createDataFrame([(i, [v[0] * 2 ** 38, v[1]]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    got, made = whitening.whiten(wide)
    assert {r["deviation"] for r in got.collect()} == {None} and made.identity_error < 1e-6


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1, 0, 0], [3, 3 - 1e-12, 3 - 2e-12, 1, 1e-9, 0, 0, 0], [1] * 8, [0] * 8, [7], [9, 1e-20]])
def test_eigenvectors_of_clusters(values):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    for matrix in (v, np.diag(np.array(values, float))):
        e, rows = whitening.leading_eigenvectors(matrix, 6)
        scale = max(values) or 1
        assert np.allclose(e, sorted(values, reverse=True)[:6], atol=1e-13 * scale, rtol=0)
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)
        assert np.allclose(rows @ matrix, e[:, None] * rows, atol=1e-12 * scale)


def later_words(rows, least=20):
    """Per row of (doc_id, text), in order, the words left after the passages that stand earlier."""
    texts = [WORD.findall(t or "") for _, t in rows]
    first, gone = {}, [[False] * len(w) for w in texts]
    for k, w in enumerate(texts):
        for i in range(len(w) - least + 1):
            if first.setdefault(tuple(w[i:i + least]), (k, i)) != (k, i):
                gone[k][i:i + least] = [True] * least
    return [(rows[k][0], len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for k, (w, g) in enumerate(zip(texts, gone))]


def left(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("salt_rows", [substrings._SALT_ROWS, 7])
def test_substrings_of_shared_passages(spark, monkeypatch, salt_rows):
    """Boilerplate that most texts hold whole or in part, with more words shared by a few on either side, copies, and repeats inside a text."""
    monkeypatch.setattr(substrings, "_SALT_ROWS", salt_rows)
    rng = random.Random(9)

    def prose(n, vocabulary=50):
        return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]

    boiler, sides = prose(60), [prose(12) for _ in range(6)]
    rows = []
    for i in range(120):
        a, b = sorted(rng.sample(range(60), 2))
        w = prose(rng.randrange(40)) + rng.choice(sides) + boiler[a // 2:max(b, a // 2 + 14)] + rng.choice(sides) + prose(rng.randrange(30), 4)
        if i % 10 == 0:
            w += w[3:rng.randrange(20, 60)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w) if i % 7 else rows[-1][1] if rows else ""))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert left(substrings.remove_repeats(docs)) == sorted(later_words(rows), key=str)
    assert left(substrings.remove_repeats(docs, 9, 9)) == sorted(later_words(rows, 9), key=str)


def test_substrings_edges(spark, awkward, nothing):
    rows = sorted(((r[0], r[1]) for r in awkward_rows()), key=lambda r: (r[0] is None, r[0]))
    once = list(dict.fromkeys(rows))                 # repeated rows are one document, and each row gets its result
    want = dict(zip(once, later_words(once)))
    assert left(substrings.remove_repeats(awkward)) == sorted((want[r] for r in rows), key=str)
    assert substrings.remove_repeats(nothing).count() == 0
    runs = [(1, "a " * 5_000), (2, "a " * 30), (3, "a b " * 4_000 + "c"), (None, "b a " * 12), (4, "Ünï " * 19), (5, "Ünï " * 20 + "x")]
    docs = spark.createDataFrame(runs, "doc_id long, text string")
    ordered = sorted(runs, key=lambda r: (r[0] is None, r[0]))
    assert left(substrings.remove_repeats(docs)) == sorted(later_words(ordered), key=str)
    with pytest.raises(ValueError):
        substrings.remove_repeats(docs, 5, 6)
