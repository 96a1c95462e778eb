"""Every operator and pipeline stage over the awkward table and the empty one."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import ann, bpe, chat, langid, lines, minhash, mixing, quality, simhash, suffixes
from tests.llm.conftest import awkward_rows

ROWS = awkward_rows()


def test_quality(awkward, nothing, labels):
    got = quality.score_documents(awkward, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["quality"] <= 1 and r["kept"] is not None for r in got)
    assert quality.score_documents(nothing, labels).count() == 0
    kept = quality.keep_good(awkward, labels.limit(0))
    assert kept.columns == awkward.columns and sorted(map(str, kept.collect())) == sorted(map(str, awkward.collect()))
    one_class = labels.where("quality = 1")
    assert {r["quality"] for r in quality.score_documents(awkward, one_class).collect()} == {1.0}


def test_chat(spark):
    turns = spark.createDataFrame(
        [(1, 2, "user", None, 5), (1, 1, None, "a", 5), (1, None, "user", "[b] <s> ~0 ~", 5), (1, 2, "user", "b", 5),
         (None, 0, "assistant", "", 5), (2, 0, "assistant", "x[/]y", 5), (2, 1, "assistant", "[|]", 5), (2, 1, "assistant", "[|]", 5),
         (3, 0, "|", "/", 5), (3, 1, "/", "|", 5)], "conv_id long, turn long, role string, text string, turns int")
    made = chat.format_chats(turns)
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert back == {1: [("user", "[b] <s> ~0 ~"), ("", "a"), ("user", ""), ("user", "b")], None: [("assistant", "")],
                    2: [("assistant", "x[/]y"), ("assistant", "[|]"), ("assistant", "[|]")], 3: [("|", "/"), ("/", "|")]}
    two = chat.chat_digests(made).where("conv_id = 2").first()
    assert two["loss_sha256"] == hashlib.sha256(b"x[/]y[|][|]").hexdigest() and two["loss_chars"] == 11
    assert made.where("conv_id = 2").first()["formatted"].count("[:assistant]") == 1
    assert chat.chat_digests(chat.format_chats(turns.limit(0))).count() == 0


def test_passages(spark, awkward, nothing):
    got = suffixes.passages(awkward).collect()
    # the long text repeats itself: one stretch from its start and one to its end
    assert {r["doc_id"] for r in got} == {5}
    assert suffixes.passages(nothing).count() == 0
    twice = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(60))), (1, " ".join(f"a{i}" for i in range(60))),
                                   (2, "x " + " ".join(f"a{i}" for i in range(55)) + " y"), (3, None), (None, "")], "doc_id long, text string")
    spans = {(r["doc_id"], r["first_word"], r["n_words"]) for r in suffixes.passages(twice).collect()}
    assert spans == {(1, 0, 55), (2, 1, 55)}          # the repeated row is no partner of itself


@pytest.mark.parametrize("salt_rows", [suffixes._SALT_ROWS, 7])
def test_passages_of_a_shared_key(spark, monkeypatch, salt_rows):
    """Fifty texts hold a boilerplate; pairs of them share a few words more on its right, its left or both sides."""
    monkeypatch.setattr(suffixes, "_SALT_ROWS", salt_rows)
    for seed in range(3):
        rng = random.Random(seed)
        own = lambda n: [f"o{rng.random()}" for _ in range(n)]
        shared, texts, want = own(45), {}, {}
        for i in range(50):
            texts[i] = (own(30), own(30))
        for x, y, left, right in ((3, 31, 0, 10), (8, 44, 10, 0), (12, 27, 2, 3), (15, 40, 4, 4)):
            a, b = own(left), own(right)
            for i in (x, y):
                before, after = texts[i]
                texts[i] = (before[:30 - left] + a, b + after)
                want[i] = (30 - left, 45 + left + right)
        docs = spark.createDataFrame([(i, " ".join(before + shared + after)) for i, (before, after) in texts.items()],
                                     "doc_id long, text string")
        got = {r["doc_id"]: (r["first_word"], r["n_words"]) for r in suffixes.passages(docs).collect()}
        assert got == want


def test_mixing(awkward, nothing):
    got = mixing.taken_words(mixing.mix(awkward.select("doc_id", "source", "text"))).collect()
    assert len(got) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.taken_words(mixing.mix(nothing)).count() == 0
    mixed = mixing.mix_documents(awkward)
    assert mixed.columns == awkward.columns
    assert sum(len(r["text"].encode().split()) for r in mixed.collect()) == sum(r["taken"] for r in got)
    assert mixing.mix_documents(nothing).count() == 0


def test_minhash(awkward, nothing):
    got = minhash.near_duplicates(awkward).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[2]["kept"]
    assert by[7]["component_id"] == by[8]["component_id"] == by[None]["component_id"] == 6 and not by[None]["kept"]
    assert by[9]["component_id"] == 9 and by[13]["component_id"] == 12 and not by[13]["kept"]
    assert minhash.near_duplicates(nothing).count() == 0
    kept = minhash.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns and 7 not in {r["doc_id"] for r in kept.collect()}


def test_ann(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, [float("inf"), 1.0]), (8, [1.0, 1.0, 1.0]), (None, [5.0, 5.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (9, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = ann.nearest(v, v.where("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert ann.nearest(v.limit(0), v.limit(0)).count() == 0
    assert ann.nearest(v, v.where("vec_id = 4")).count() == 0


def test_bpe(awkward, nothing):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.vocabulary_path())
    got = {r["doc_id"]: r for r in bpe.encode_documents(awkward, with_ids=True).collect()}
    for r in ROWS:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        assert got[r[0]]["ids"] == ids and got[r[0]]["n_tokens"] == len(ids)
        assert got[r[0]]["decoded"] == t.decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(nothing).count() == 0


def test_lines(awkward, nothing):
    got = {r["doc_id"]: r for r in lines.repeated_lines(awkward).collect()}
    assert got[1]["n_lines"] == 1 and got[2]["n_lines"] == 0 and got[3]["removed"] == []
    assert got[7]["removed"] == [0] and got[8]["removed"] == [0] and got[None]["removed"] == [0] and got[9]["removed"] == [1]
    assert got[12]["removed"] == [] and got[13]["removed"] == [0]
    clean = lines.dedup_lines(awkward)
    assert clean.columns == awkward.columns
    left = {r["doc_id"]: r for r in clean.collect()}
    assert {7, 8, 13, None}.isdisjoint(left) and left[9]["text"].count("única") == 1 and left[9]["n_chars"] == len(left[9]["text"])
    assert left[1]["text"] == "" and left[2]["text"] is None
    assert lines.repeated_lines(nothing).count() == 0


def test_near_stage_without_ids_and_with_repeated_rows(spark):
    """Of copies one stays, also where ids are NULL or rows repeat."""
    words = [" ".join(f"a{k}x{i}" for i in range(60)) for k in range(4)]
    rows = [(None, words[0], 1), (None, words[0], 2), (3, words[0] + " more", 3), (3, words[0] + " more", 4), (7, words[1], 5), (7, words[1], 6),
            (None, words[2], 7), (None, words[2], 8), (None, words[2] + " end", 9), (None, words[3], 10), (None, None, 11), (None, None, 12), (8, "", 13)]
    got = minhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n int"), percent=80, bands=34).collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in got) == [(0, ""), (0, "a2x"), (0, "a3x"), (3, "a0x"), (7, "a1x"), (8, "")]


def test_langid(awkward, nothing):
    got = langid.predict_languages(awkward, awkward).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ROWS)
    assert by[2]["lang_pred"] == by[1]["lang_pred"] == by[10]["lang_pred"] == "und" and by[2]["score"] == 0.0
    assert by[9]["lang_pred"] == "es" and 0 < by[9]["score"] <= 1
    assert {r["lang_pred"] for r in langid.predict_languages(awkward, nothing).collect()} == {"und"}
    assert langid.predict_languages(nothing, awkward).count() == 0


def test_langid_whole_models(spark, monkeypatch):
    """Every gram of every language counts, in models of many parts, and a language without letters is no candidate."""
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(["haus", "hund", "baum", "und", "der"]) for _ in range(40)), "de") for i in range(30)]
    texts += [(100 + i, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)), "en") for i in range(60)]
    texts += [(200, "piiri ja talo", "fi"), (201, "123 - 456", "zz"), (202, "...", "zz")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")

    counts = collections.defaultdict(collections.Counter)
    for _, t, lang in texts[:-2]:
        padded = "   " + t + " "
        counts[lang].update(padded[i - 3:i + 1] for i in range(3, len(padded)))
    alphabet = {g[3] for c in counts.values() for g in c}

    def entropy(lang, text):
        level, levels = counts[lang], []
        for _ in range(4):
            levels.append(level)
            level = collections.Counter(g[1:] for g in level)
        padded, total = "   " + text + " ", 0.0
        for i in range(3, len(padded)):
            p = 1 / (len(alphabet) + 1)
            for k, level in zip((1, 2, 3, 4), reversed(levels)):
                ones, twos = (sum(n == m for n in level.values()) for m in (1, 2))
                d = min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones + twos else 0.5
                gram = padded[i + 1 - k:i + 1]
                after = [n for g, n in level.items() if g[:-1] == gram[:-1]]
                if after:
                    p = max(level[gram] - d, 0) / sum(after) + d * len(after) / sum(after) * p
            total -= math.log(p)
        return total / (len(padded) - 3)

    whole = {r["doc_id"]: r for r in langid.predict_languages(docs, docs).collect()}
    assert {i: r["lang_pred"] for i, r in whole.items()} == {i: "und" if lang == "zz" else lang for i, _, lang in texts}
    monkeypatch.setattr(langid, "PART_GRAMS", 200)
    monkeypatch.setattr(langid, "HELD_BYTES", 5_000)
    parts = {r["doc_id"]: r for r in langid.predict_languages(docs, docs).collect()}
    for i in (0, 29, 100, 159, 200):
        want = entropy(whole[i]["lang_pred"], next(t for j, t, _ in texts if j == i))
        assert whole[i]["cross_entropy"] == pytest.approx(want, rel=1e-4)
    assert {i: r["lang_pred"] for i, r in parts.items()} == {i: r["lang_pred"] for i, r in whole.items()}
    assert all(r["cross_entropy"] == pytest.approx(whole[i]["cross_entropy"]) for i, r in parts.items())


def test_langid_calibrates_on_all_learning_texts(spark):
    """The rejection level is the quantile of all texts of a language, the rare odd ones included."""
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choice(["house", "tree", "river", "stone"]) for _ in range(rng.randint(5, 20))), "en") for i in range(4_000)]
    texts += [(5_000 + i, " ".join(["house"] * (12 - i) + ["".join(rng.choice("qxzjkvw") for _ in range(9)) for _ in range(3 + i)]), "en") for i in range(8)]
    texts += [(6_000 + i, " ".join(rng.choice(["haus", "baum", "fluss", "stein"]) for _ in range(9)), "de") for i in range(1_500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    got = langid.predict_languages(docs, docs).collect()
    for lang in ("en", "de"):
        mine = [r for r in got if r["lang_pred"] == lang]
        assert len(mine) == sum(x == lang for _, _, x in texts)
        level = np.quantile([r["cross_entropy"] for r in mine], langid.REJECT_ABOVE) + 0.05
        assert [r["accepted"] for r in mine] == [r["cross_entropy"] <= level for r in mine]


def test_simhash(awkward, nothing, spark):
    got = simhash.fingerprint_documents(awkward).collect()
    assert len(got) == len(ROWS) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    prints = {}
    for r, row in zip(sorted(got, key=str), ROWS):
        assert len(r["fingerprint"]) == 32
    for r in got:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[1] == prints[2] and prints[12] == prints[13] and len(prints[9]) == 1
    assert simhash.fingerprint_documents(nothing).count() == 0
    alone = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert simhash.fingerprint_documents(alone).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, awkward, nothing, tmp_path_factory, name, stage, labels):
    sf_dir = str(tmp_path_factory.mktemp("stage"))
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    for docs in (awkward, nothing):
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        rows = out.collect()
        assert bool(rows) == (docs is awkward)
