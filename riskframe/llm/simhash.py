"""Document fingerprints: SimHash, with DataFrame functions only.

A text's terms are its adjacent word pairs (and its last word), each as often as
it occurs. Every term's 128-bit hash votes +1 or -1 on each bit; the sign of the sum is the
fingerprint's bit (a tie gives 0), written as 32 hex digits. The votes are partial
sums: one row per text and task, however long the text. Bits j and j + 32 share one long sum.

Fingerprints within Hamming radius r are found with block tables: r + 1 blocks of
bits, one table led by each; two fingerprints within r agree on one block at least,
so a join on (table, leading block) followed by an exact distance test loses nothing.
Equal fingerprints are one class before the join.

NULL text is empty text; an empty text has the fingerprint of the one empty
word. Repeated rows are documents of their own; rows with equal ids are ordered by
text. A NULL id sorts after all others. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

WORDS = "[ \\t-\\r]+"
BITS = 128
_LANES = 0x0000000100000001
_LOWEST = -(1 << 63)
#: Range parts at most; their boundaries are held on the driver (8 bytes each).
MOST_PARTS = 20_000
_ROWS_PER_PART = 5_000


def _terms(text: Column) -> Column:
    words = F.split(text, WORDS)
    return F.explode(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b")))


def _vote_columns() -> list[Column]:
    """Sums of set bits, two to a long, for both hash halves, and the number of terms."""
    out = [F.count(F.lit(1)).alias("terms")]
    for h in ("h1", "h2"):
        for j in range(32):
            lane = F.shiftrightunsigned(F.col(h), j).bitwiseAND(F.lit(_LANES))
            out.append(F.sum(lane).alias(f"{h}_{j}"))
    return out


def _half(h: str) -> Column:
    bits = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"{h}_{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"{h}_{j}"), 32)
        for count, at in ((low, j), (high, j + 32)):
            value = (1 << at) - (1 << 64 if at == 63 else 0)
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("terms"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return bits


def fingerprint_halves(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys``, f1, f2: the two 64-bit halves of each text's fingerprint. ``keys`` identify a text and are not strings
    (so that the votes add up in a hash table)."""
    k = [F.col(c) for c in keys]
    terms = texts.select(*k, _terms(F.col(text)).alias("t")).select(
        *k, F.xxhash64(F.col("t").getField("a"), F.col("t").getField("b")).alias("h1"))
    votes = terms.select(*k, "h1", F.xxhash64("h1").alias("h2")).groupBy(*keys).agg(*_vote_columns())
    return votes.select(*k, _half("h1").alias("f1"), _half("h2").alias("f2"))


def as_hex(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def distance(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def links_within(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a1, a2, b1, b2, distance) of different fingerprints (columns f1, f2, each once) within ``radius`` bits, a before b."""
    tables = radius + 1
    width = BITS // tables

    def block(i: int) -> Column:
        # bits [i * width, ...) of the 128, led by the table number: the permuted order's first block
        first, last = i * width, BITS if i == tables - 1 else (i + 1) * width
        parts = []
        for half, base in (("f1", 0), ("f2", 64)):
            lo, hi = max(first, base), min(last, base + 64)
            if lo < hi:
                mask = ((1 << (hi - lo)) - 1) << (lo - base)
                parts.append(F.col(half).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))
        return F.struct(*[F.coalesce(p, F.lit(0)).alias(f"p{n}") for n, p in enumerate((parts + [F.lit(0).cast("long")])[:2])])

    rows = classes.select("f1", "f2", F.posexplode(F.array(*[block(i) for i in range(tables)])).alias("table", "block"))
    rows = rows.select("f1", "f2", "table", "block.p0", "block.p1")
    a = rows.withColumnsRenamed({"f1": "a1", "f2": "a2"})
    b = rows.withColumnsRenamed({"f1": "b1", "f2": "b2", "table": "tb", "p0": "q0", "p1": "q1"})
    gap = distance(F.col("a1"), F.col("a2"), F.col("b1"), F.col("b2"))
    before = (F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") < F.col("b2")))
    pairs = a.join(b, (F.col("table") == F.col("tb")) & (F.col("p0") == F.col("q0")) & (F.col("p1") == F.col("q1"))
                   & before & (gap <= radius))
    return pairs.select("a1", "a2", "b1", "b2", gap.alias("distance")).distinct()


def _part_of(value: Column, bounds: list[int]):
    """Columns for a binary search, one level each: the number of ``bounds`` below ``value``."""
    levels = max(1, len(bounds)).bit_length()
    padded = F.lit(bounds + [(1 << 63) - 1] * ((1 << levels) - len(bounds)))
    def step(df: DataFrame, name: str) -> DataFrame:
        df = df.withColumn(name, F.lit(0))
        for level in reversed(range(levels)):
            jump = 1 << level
            df = df.withColumn(name, F.col(name) + F.when(
                F.get(padded, F.col(name) + (jump - 1)) < value, F.lit(jump)).otherwise(F.lit(0)))
        return df
    return step


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with the next one's text, in descending id order (after the last: the first).

    The order is cut into range parts at quantiles of the ids; a window finds the next
    document inside a part, and the first documents of the parts (one per part) are joined
    to the part before. Returns the rows (part, rn, id, text, after) and the links (part, follower part).
    """
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("id"),
                        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.count()
    parts = min(MOST_PARTS, max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // _ROWS_PER_PART))
    shares = [(i + 1) / parts for i in range(parts - 1)]
    found = keyed.agg(F.percentile_approx("id", shares, max(10_000, 5 * parts)).alias("q")).first()["q"] if shares else []
    bounds = sorted(set(found or []))
    keyed = _part_of(F.col("id"), bounds)(keyed, "part")
    heads = sorted(((r["part"], r["id"]) for r in keyed.groupBy("part").agg(F.max("id").alias("id")).collect()), reverse=True)
    order = Window.partitionBy("part").orderBy(F.desc("id"), F.desc("text"))
    inside = keyed.withColumn("rn", F.row_number().over(order)).withColumn("after", F.lead("text").over(order))
    # part -> the part that follows it in the order, and that one's first id
    links = spark.createDataFrame(
        [(p, heads[(i + 1) % len(heads)][0], heads[(i + 1) % len(heads)][1]) for i, (p, _) in enumerate(heads)],
        "part int, follower int, head long")
    first = Window.partitionBy("lp").orderBy(F.desc("first_text"))
    firsts = (keyed.select("id", F.col("text").alias("first_text"))
              .join(F.broadcast(links.select(F.col("part").alias("lp"), "head")), F.col("id") == F.col("head"))
              .withColumn("n", F.row_number().over(first)).where("n = 1").select("lp", "first_text"))
    joined = inside.join(firsts.hint("merge"), F.col("part") == F.col("lp"), "left")
    return joined.select("part", "rn", "doc_id", "text", F.coalesce("after", "first_text").alias("after")), links


def fingerprint_documents(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, their likeness, and the links within ``radius``.

    The edited text has the last half of the code points replaced by the first as
    many of the next document in descending id order. Likeness is the share of equal bits. ``copies``
    counts the documents with this fingerprint, ``links`` the other fingerprints within ``radius`` bits.
    """
    linked, links = _linked(docs)
    n = F.length("text")
    half = (n - n % 2) / 2
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")),
                      F.substring(F.col("after"), F.lit(1), half.cast("int")))
    both = linked.select("part", "rn", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    digest = F.sha2("edited", 256)
    # the digest travels as four longs, so that every grouping key has a fixed width
    parts = [F.conv(F.substring(F.col("sha"), 16 * i + 1, 16), 16, -10).cast("long").alias(f"s{i}") for i in range(4)]
    both = both.withColumn("sha", digest).select("part", "rn", "doc_id", "n_chars", *parts, "text", "edited")
    keys = ["part", "rn", "doc_id", "n_chars", "s0", "s1", "s2", "s3"]
    texts = both.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))).alias("v")).select(*keys, "v.which", "v.body")
    prints = fingerprint_halves(texts, "body", [*keys, "which"])
    pick = lambda c, w: F.max(F.when(F.col("which") == w, F.col(c)))
    wide = prints.groupBy(*keys).agg(pick("f1", 0).alias("f1"), pick("f2", 0).alias("f2"),
                                     pick("f1", 1).alias("e1"), pick("f2", 1).alias("e2"))
    done = materialize(wide)
    order = Window.partitionBy("part").orderBy("rn")
    firsts = done.where("rn = 1").select(F.col("part").alias("fp"), F.col("f1").alias("x1"), F.col("f2").alias("x2"))
    heads = firsts.join(F.broadcast(links.select(F.col("part").alias("hp"), "follower")),
                        F.col("fp") == F.col("follower")).select("hp", "x1", "x2")
    out = (done.withColumn("l1", F.lead("f1").over(order)).withColumn("l2", F.lead("f2").over(order))
           .join(heads, F.col("part") == F.col("hp"), "left")
           .withColumn("g1", F.coalesce("l1", "x1")).withColumn("g2", F.coalesce("l2", "x2")))
    classes = materialize(done.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("copies")))
    near = links_within(classes.select("f1", "f2"), radius)
    counted = near.select(F.explode(F.array(F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2")),
                                            F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2")))).alias("k")
                          ).groupBy("k.k1", "k.k2").agg(F.count(F.lit(1)).alias("links"))
    counts = classes.join(counted, (F.col("f1") == F.col("k1")) & (F.col("f2") == F.col("k2")), "left").select(
        F.col("f1").alias("c1"), F.col("f2").alias("c2"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    out = out.join(counts, (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")))

    def like(a: str, b: str) -> Column:
        return F.lit(1.0) - distance(F.col("f1"), F.col("f2"), F.col(a), F.col(b)) / F.lit(float(BITS))

    sha = F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 16, "0") for i in range(4)]))
    return out.select("doc_id", "n_chars", sha.alias("edited_sha256"), as_hex(F.col("f1"), F.col("f2")).alias("fingerprint"),
                      as_hex(F.col("e1"), F.col("e2")).alias("edited_fingerprint"), like("e1", "e2").alias("near_edited"),
                      like("g1", "g2").alias("near_next"), "copies", "links")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select("doc_id", "text"))
