"""Registered queries against brute force on the smallest scale factor."""

import collections
import hashlib
import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from riskframe.llm import lines, minhash, mixing, quality, queries
from tests.conftest import SF001

WORD = re.compile("[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang, source from read_parquet('{SF001}/documents.parquet') order by doc_id").fetchall()


def run(spark, name):
    return queries.QUERIES[name](spark, SF001).collect()


def components(texts, percent=85):
    """(set size, least reachable id) of every document, by an inverted index of its shingles."""
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    holders, common, parent = collections.defaultdict(list), collections.Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            common.update((j, i) for j in holders[g])
            holders[g].append(i)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def later_lines(texts):
    """Numbers of the lines that have an earlier line of Jaccard 0.8 or more."""
    seen, holders, known, gone = [], collections.defaultdict(list), {}, collections.defaultdict(list)
    for i, t in texts:
        for k, line in enumerate(t.split("\n")):
            s = frozenset(WORD.findall(line.translate(LOW)))
            if not s:
                continue
            if s in known:
                gone[i].append(k)
                continue
            common = collections.Counter(j for w in s for j in holders[w])
            if any(100 * n >= 80 * (len(s) + len(seen[j]) - n) for j, n in common.items()):
                gone[i].append(k)
            known[s] = len(seen)
            seen.append(s)
            for w in s:
                holders[w].append(known[s])
    return gone


def test_op1_accuracy(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op1_quality")}
    truth = duckdb.sql(f"select doc_id, quality from read_parquet('{SF001}/labels.parquet')").fetchall()
    right = [got[i]["kept"] == (q == 1) for i, q in truth if i in got]
    assert len(got) == len(docs) and np.mean(right) > 0.95


def test_op1_held_out(spark):
    from pyspark.sql import functions as F

    from riskframe.llm import quality
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score_documents(d, labels.where("doc_id % 3 <> 0")).join(labels.select("doc_id", F.col("quality").alias("q")), "doc_id")
    r = got.where("doc_id % 3 = 0").agg(F.avg((F.col("kept") == (F.col("q") == 1)).cast("double"))).first()
    assert r[0] > 0.95


def test_op3_covers_every_repeat(spark, docs):
    words = {i: WORD.findall(t) for i, t, _, _ in docs}
    places = collections.defaultdict(list)
    for i, w in words.items():
        for k in range(len(w) - 49):
            places[tuple(w[k:k + 50])].append((i, k))
    must = collections.defaultdict(set)
    for found in places.values():
        for i, k in found if len(found) > 1 else ():
            must[i].update(range(k, k + 50))
    mine = collections.defaultdict(set)
    for r in run(spark, "op3_suffix_dedup"):
        a = words[r["doc_id"]][r["first_word"]:r["first_word"] + r["n_words"]]
        b = words[r["other_doc_id"]][r["other_first_word"]:r["other_first_word"] + r["n_words"]]
        assert a == b and len(a) == r["n_words"] >= 50
        mine[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert set(mine) == set(must)
    assert not any(mine[i] - must[i] for i in mine)
    assert not any(must[i] - mine[i] for i in must)


def test_op4_targets(spark, docs):
    got = run(spark, "op4_mixing")
    sizes = {i: len(WORD.findall(t)) for i, t, _, _ in docs}
    source = {i: s for i, _, _, s in docs}
    totals = collections.Counter()
    for i, s in source.items():
        totals[s] += sizes[i]
    names = sorted(totals)
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:                                    # share, stop at the cap, share the rest again
        rest = 1.5 * sum(totals.values()) - sum(2 * totals[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        target = {s: 2 * totals[s] if s in capped else rest * weights[s] / sum(weights[x] for x in open_) for s in names}
        above = {s for s in open_ if target[s] > 2 * totals[s]}
        if not above:
            break
        capped |= above
    taken = collections.Counter()
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == totals[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(tuple, got)) == sorted(map(tuple, run(spark, "op4_mixing")))


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        p = mixing.Permutation(n, 1, 2, 3)
        assert sorted(p(np.arange(n))) == list(range(n)) and (p.inverse(p(np.arange(n))) == np.arange(n)).all()


def test_op5_components(spark, docs):
    truth = components([(i, t) for i, t, _, _ in docs])
    for r in run(spark, "op5_minhash"):
        assert (r["n_shingles"], r["component_id"]) == truth[r["doc_id"]] and r["kept"] == (r["component_id"] == r["doc_id"])


def test_op5_open_buckets(spark):
    # near copies of one text, many of them below the threshold with each other: every link must survive
    import random
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(120)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    truth = components(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == truth


def test_op6_recall(spark):
    got = collections.defaultdict(dict)
    for r in run(spark, "op6_ann"):
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    rows = duckdb.sql(f"select vec_id, embedding from read_parquet('{SF001}/embeddings.parquet')").fetchall()
    ids, v = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]])
        mine = [got[q][k] for k in sorted(got[q])]
        assert [k for k in sorted(got[q])] == list(range(1, 21)) and all(a[1] >= b[1] for a, b in zip(mine, mine[1:]))
        hits, total = hits + len(best & {i for i, _ in mine}), total + 20
    assert hits / total >= 0.9


def test_op7_against_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in run(spark, "op7_bpe")}
    for i, text, _, _ in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("held,hot,block", [(0, 5, 2), (1, 40, 5), (lines._HELD, lines.HOT_LINES, lines._BLOCK_LINES)])
def test_op8_lines(spark, docs, monkeypatch, held, hot, block):
    """Also with few candidates held, so that the later rounds have work to do, many hot words, and small blocks."""
    monkeypatch.setattr(lines, "_HELD", held)
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    monkeypatch.setattr(lines, "KEY_BLOCK", 3 * hot)
    monkeypatch.setattr(lines, "_BLOCK_LINES", block)
    truth = later_lines([(i, t) for i, t, _, _ in docs])
    got = {r["doc_id"]: r["removed"] for r in run(spark, "op8_line_dedup")}
    assert got == {i: ",".join(map(str, truth[i])) for i, _, _, _ in docs}


@pytest.mark.parametrize("held,hot,block", [(0, 3, 2), (lines._HELD, 30, 20), (lines._HELD, lines.HOT_LINES, lines._BLOCK_LINES)])
def test_op8_near_threshold_groups(spark, monkeypatch, held, hot, block):
    """Groups of lines at, just below and above the threshold, over few words and few lengths; long lines."""
    monkeypatch.setattr(lines, "_HELD", held)
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    monkeypatch.setattr(lines, "KEY_BLOCK", 4 * hot)
    monkeypatch.setattr(lines, "_BLOCK_LINES", block)
    rng, rows = np.random.default_rng(4), []
    for g in range(12):
        size = [5, 9, 10, 18, 45, 150][g % 6]
        core = [f"g{g if g < 6 else 99}w{j}" for j in range(size)]
        for _ in range(25):
            words = list(core)
            for _ in range(rng.integers(0, size // 5 + 2)):
                words[rng.integers(size)] = f"x{rng.integers(40)}"
            rows.append(" ".join(words[:size - rng.integers(0, 2)]))
    rng.shuffle(rows)
    texts = [(i, "\n".join(rows[3 * i:3 * i + 3])) for i in range(100)]
    truth = later_lines(texts)
    got = {r["doc_id"]: r["removed"] for r in lines.repeated_lines(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert got == {i: truth[i] for i, _ in texts}


@pytest.mark.parametrize("own,template", [(1, 4), (2, 6), (3, 30)])
def test_op8_many_lines_of_one_template(spark, own, template):
    """20,000 lines of words of their own and common words: a group that no pair comes from, or where all but one go."""
    common = " ".join(f"t{i}" for i in range(template))
    texts = [(i, "\n".join(" ".join(f"o{i}x{k}x{j}" for j in range(own)) + " " + common for k in range(20))) for i in range(1_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    start = time.time()
    gone = sum(len(r["removed"]) for r in lines.repeated_lines(docs).collect())
    assert gone == (0 if 100 * template < 80 * (template + 2 * own) else 19_999)
    assert time.time() - start < 120


def test_op9_held_out(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op9_langid")}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _, _ in docs)
    out = [(got[i]["lang_pred"], lang) for i, _, lang, _ in docs if got[i]["held_out"]]
    assert np.mean([a == b for a, b in out]) > 0.95


def test_op10_fingerprints(spark, docs):
    from riskframe.llm import simhash
    got = {r["doc_id"]: r for r in run(spark, "op10_simhash")}
    order = [(i, t or "") for i, t, _, _ in reversed(docs)]
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[1][:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        apart = bin(int(got[i]["fingerprint"], 16) ^ int(got[after[0]]["fingerprint"], 16)).count("1")
        assert got[i]["near_next"] == pytest.approx(1 - apart / 128)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.95
    classes = spark.createDataFrame([(1, 0), (1, 7), (-1, 0), (3, 15), (1, 1 << 62)], "f1 long, f2 long")
    links = {(r["a1"], r["a2"], r["b1"], r["b2"], r["distance"]) for r in simhash.links_within(classes, 3).collect()}
    assert links == {(1, 0, 1, 7, 3), (1, 7, 3, 15, 2), (1, 0, 1, 1 << 62, 1)}


def test_pipeline_stages_against_brute_force(spark):
    """Near copies and later lines are gone after their stages, and the last stage counts what mixing gives."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    read = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, read, SF001).collect(), docs.schema)
        rows = sorted((r["doc_id"], r["text"]) for r in read.collect())
        if name == "line dedup":
            gone = later_lines(rows)
            want = {}
            for i, t in rows:
                left = [x for k, x in enumerate(t.split("\n")) if k not in set(gone[i])]
                if not gone[i] or any(WORD.search(x) for x in left):
                    want[i] = "\n".join(left)
            assert {r["doc_id"]: r["text"] for r in out.collect()} == want
        if name == "MinHash near-dedup":
            assert {r["doc_id"] for r in out.collect()} == {i for i, (_, root) in components(rows, 80).items() if i == root}
        if name == "quality classifier":
            scored = {r["doc_id"]: r["kept"] for r in quality.score_documents(read, spark.read.parquet(f"{SF001}/labels.parquet")).collect()}
            assert {r["doc_id"] for r in out.collect()} == {i for i, k in scored.items() if k}
            assert {r["doc_id"]: r["text"] for r in out.collect()}.items() <= {r["doc_id"]: r["text"] for r in read.collect()}.items()
        if name == "source mixing":
            # each source gives its target, to the word, from its own documents' words in order
            got, by_source, texts = out.collect(), collections.Counter(), {r["doc_id"]: WORD.findall(r["text"] or "") for r in read.collect()}
            source = {r["doc_id"]: r["source"] for r in read.collect()}
            for r in got:
                words = WORD.findall(r["text"])
                by_source[r["source"]] += len(words)
                assert r["source"] == source[r["doc_id"]] and not collections.Counter(words) - collections.Counter(texts[r["doc_id"]])
            target = {r["source"]: r["target"] for r in mixing.source_targets(mixing.document_sizes(read)).collect()}
            assert set(target) == set(source.values()) and all(abs(by_source[s] - t) <= 1 for s, t in target.items())
        assert out.columns == docs.columns
        read = out
    last = corpus_pipeline.STAGES[-1][1](spark, read, SF001)
    from tokenizers import Tokenizer
    from riskframe.llm import bpe
    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = sorted((r["doc_id"], hashlib.sha256(" ".join(map(str, library.encode(r["text"] or "", add_special_tokens=False).ids)).encode()).hexdigest())
                  for r in read.collect())
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in last.collect()) == want


def test_near_stage_between_80_and_85(spark):
    """Copies whose shingles agree to 80 to 85 percent go, and those just below 80 percent stay."""
    texts, want = [], set()
    for i in range(40):
        words = [f"t{i}x{j}" for j in range(104)]        # 100 shingles
        # the last words replaced: 100 - n of 100 shingles agree, of 100 + n
        n = (9, 10, 11, 12)[i % 4]
        assert (100 * (100 - n) >= 80 * (100 + n)) == (n <= 11) and 100 * (100 - n) < 85 * (100 + n)
        texts += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-n] + [f"u{i}x{j}" for j in range(n)]))]
        want |= {2 * i} if n <= 11 else {2 * i, 2 * i + 1}
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, SF001).collect()} == want


def test_registered():
    assert {n.split("_")[0] for n in queries.QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.SQL) <= set(queries.QUERIES) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    from scripts.check_oracle import compare, duck
    assert not compare(spark, duck(SF001), queries.QUERIES[name], queries.SQL[name], SF001)


def noisy_pages(spark, n=3_000, seed=6):
    """Documents whose text is clearly good or bad, whose source says so often, and whose labels are few."""
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for i in range(n):
        good = rng.random() < 0.6
        words = [f"w{rng.integers(300)}" for _ in range(rng.integers(20, 60))]
        if not good:
            words = [w if rng.random() < 0.8 else rng.choice(["!!!", "BUY", "$$$", words[0]]) for w in words]
        source = f"s{rng.integers(3) + (0 if good ^ (rng.random() < 0.15) else 3)}"
        rows.append((i, " ".join(words), "en", source))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    labels = spark.createDataFrame([(i, truth[i]) for i in range(0, n, 20)], "doc_id long, quality int")
    return docs, labels, truth


def test_op1_exchange_helps(spark):
    """Held-out accuracy after the rounds is at least that of none, for the combination and both views."""
    from riskframe.llm import quality
    docs, labels, truth = noisy_pages(spark)
    right = {}
    for rounds in (0, quality.ROUNDS):
        got = quality.score_documents(docs, labels, rounds=rounds).where("doc_id % 20 > 0").collect()
        right[rounds] = [np.mean([(r[c] >= 0.5) == truth[r["doc_id"]] for r in got]) for c in ("quality", "quality_text", "quality_page")]
    assert all(b >= a - 0.002 for a, b in zip(right[0], right[quality.ROUNDS])) and right[quality.ROUNDS][0] > 0.95


def test_op1_one_round_by_brute_force(spark):
    """The models after one round equal those of a plain computation over all unlabelled documents at once."""
    from riskframe.llm import quality
    docs, labels, truth = noisy_pages(spark, 600, 7)
    feats = quality._features(quality._inputs(docs)).orderBy("id").toPandas()
    a, b = (np.stack(feats[c].tolist()).astype(float) for c in ("a", "b"))
    known = np.arange(0, 600, 20)
    y = np.array([truth[i] for i in known], float)
    train, aside = quality.split_aside(y)
    free = np.setdiff1d(np.arange(600), known)
    views, far = [a[known][train], b[known][train]], [a[known][aside], b[known][aside]]
    pool = quality.Pool(spark.createDataFrame([(a[i].tolist(), b[i].tolist()) for i in free], "a array<float>, b array<float>").repartition(5))
    got = quality.co_train(views, y[train], far, y[aside], pool, 1, sure=0.8)
    models = [quality.Logistic.fit(x, y[train], spread=(u[free].mean(axis=0), u[free].std(axis=0))) for x, u in zip(views, (a, b))]
    p = [quality.Logistic.fit(m.logit(x)[:, None], y[aside]).probability(m.logit(u[free])[:, None]) for m, x, u in zip(models, far, (a, b))]
    share = y[train].mean()
    for v, other in ((0, 1), (1, 0)):
        level = np.minimum((p[other] * 1000).astype(int), 999)
        order = np.sort(level)
        most = {0: quality.MOST_PSEUDO * (1 - share) * len(free), 1: quality.MOST_PSEUDO * share * len(free)}
        bad = [q for q in range(1000) if (order <= q).sum() <= most[0] and q < round((1 - 0.8) * 1000)]
        good = [q for q in range(1000) if (order >= q).sum() <= most[1] and q >= 800]
        taken_bad = level <= max(bad) if bad else np.zeros(len(free), bool)
        taken_good = level >= min(good) if good else np.zeros(len(free), bool)
        taken, t = taken_bad | taken_good, taken_good.astype(float)
        assert taken.any()
        m, u = models[v], (a, b)[v][free][taken]
        z = [np.concatenate([np.clip((x - m.mean) / m.scale, -8, 8), np.ones((len(x), 1))], axis=1) for x in (views[v], u)]
        w, penalty = m.weights.copy(), np.append(np.ones(len(m.weights) - 1), 1e-6)
        weight = quality.PSEUDO_WEIGHT * len(train) / taken.sum()
        for _ in range(2):
            q = [1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in z]
            grad = z[0].T @ (q[0] - y[train]) + weight * z[1].T @ (q[1] - t[taken]) + penalty * w
            curve = sum(f * (x * (r * (1 - r) + 1e-6)[:, None]).T @ x for f, x, r in zip((1, weight), z, q)) + np.diag(penalty)
            move = np.linalg.solve(curve, grad)
            w = w - move * min(1.0, 5.0 / np.abs(move).max())
        new = quality.Logistic(m.mean, m.scale, w)
        kept = new if new.loss(far[v], y[aside]) <= m.loss(far[v], y[aside]) else m
        assert np.allclose(got[v].weights, kept.weights, atol=1e-6)


@pytest.mark.parametrize("kind", ["clusters", "wide clusters", "gaussian"])
def test_op6_prunes_with_recall(spark, kind):
    """Registered parameters on 50,000 vectors: recall against brute force, and the share of vectors verified."""
    from riskframe.llm import ann
    rng = np.random.default_rng(8)
    n, d = 50_000, 64
    centres = rng.standard_normal((200, d))
    x = rng.standard_normal((n, d)) if kind == "gaussian" else centres[rng.integers(200, size=n)] + {"clusters": 0.1, "wide clusters": 0.3}[kind] * rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)}), "vec_id long, embedding array<double>").repartition(8)
    asked = np.arange(0, n, 250)
    got = collections.defaultdict(dict)
    verified = {}
    for r in ann.nearest(table, table.where("vec_id % 250 = 0")).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
        verified[r["query_id"]] = r["verified"]
    hits = 0
    for i in asked.tolist():
        s = x @ x[i]
        s[i] = -np.inf
        best = np.argpartition(-s, 20)[:20]
        hits += len(set(best.tolist()) & set(got[i].values()))
        assert sorted(got[i]) == list(range(1, 21))
    recall, share = hits / (20 * len(asked)), np.mean(list(verified.values())) / n
    print(kind, "recall", recall, "share verified", share)
    assert recall >= 0.9 and share < {"clusters": 0.05, "wide clusters": 0.2, "gaussian": 1.0}[kind]


def test_op7_very_long_words(spark):
    """A word of 200,000 letters, and long fragments of every kind, as the library encodes them, within seconds."""
    from tokenizers import Tokenizer
    from riskframe.llm import bpe
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list(letters), size)) for letters, size in (("abcdefghijklmnopqrstuvwxyz", 200_000), ("ab", 3_000), ("a", 20_001), ("the", 5_000))]
    own = bpe.ForcedBoundaryBpe(bpe.vocabulary_path())
    library = Tokenizer.from_file(bpe.vocabulary_path())
    start = time.time()
    for w in words:
        assert own.encode(w) == " ".join(map(str, library.encode(w, add_special_tokens=False).ids))
    assert time.time() - start < 60
    for _ in range(300):
        ids = [own.byte_id[b] for b in "".join(rng.choice(list("aeinorst"), 60)).encode()]
        plain, order = list(ids), None
        while True:
            order = [(own.merge[a << 20 | b], i) for i, (a, b) in enumerate(zip(plain, plain[1:])) if a << 20 | b in own.merge]
            if not order:
                break
            m, i = min(order)
            plain[i:i + 2] = [m & 0xFFFFF]
        assert own._merge_long(list(ids)) == plain
