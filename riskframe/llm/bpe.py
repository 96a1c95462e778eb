"""BPE encoding and decoding with forced-boundary splitting.

A vocabulary token can only span the boundary between two adjacent symbols if
that pair of symbols occurs side by side inside some token. Pairs that occur in
none are certain cuts: no merge ever crosses them, so the fragments between
them are encoded independently and the ids concatenated. Symbols are the
printable stand-ins of bytes; the last symbol of a word carries the word-end
mark, so a fragment is encoded as (bytes, ends its word).

The input rules (special strings, NFC, lower case, word pattern) are those of
the vocabulary file; texts with characters whose classes depend on the Unicode
version go through the file's own normaliser and splitter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textarrow import slices

VOCABULARY = "word_bpe_49k.json"
#: Words and fragments remembered by one task at most (about 250 bytes each); the tables start anew beyond.
REMEMBERED = 400_000

# Fixed value: the word pattern of the vocabulary file is
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+
# Below U+0250 every character is in NFC and its class is the same in all Unicode versions.
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-\u024f"
_DIGITS = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t-\r -~\x80-\u024f]*")
_PLAIN_WORD = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}\t-\r \x85\xa0]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The place of an installed public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    visible Latin-1 character, else the next free one from U+0100 on."""
    out, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out

_SHORT = 48                            # symbols up to which a plain search for the next merge is faster than a heap


class _Remembered(dict):
    """A table filled on demand; it starts anew when ``most`` entries are held."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        if len(key) <= 64:                      # a long run of letters is not worth its place
            self[key] = value
        return value


class ForcedBoundaryBpe:
    """Encoder and decoder of one vocabulary file; built once per task."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], _byte_symbols()
        end, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_split = (re.compile("(" + "|".join(re.escape(s) for s in
                              sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None)
        self.token = {str(i): t for t, i in [*vocab.items(), *self.specials.items()]}
        self.byte_id = [vocab[s] for s in symbols]
        self.last_id = [vocab[s + end] for s in symbols]
        # (left id, right id) as one number -> rank and merged id as one number: the least is the next merge
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[left] << 20 | vocab[right]] = rank << 20 | vocab[left + right]
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.byte_of = byte_of
        # together[a][b]: byte b follows byte a inside some token; any other pair is a certain cut
        self.together = [bytearray(256) for _ in range(256)]
        for token in vocab:
            body = token[:-len(end)] if end and token.endswith(end) and token != end else token
            for a, b in zip(body, body[1:]):
                self.together[byte_of[a]][byte_of[b]] = 1
        self.library = Tokenizer.from_file(path)
        self.words = _Remembered(self._encode_word, remembered)

    def cut(self, word: bytes) -> list[bytes]:
        """Fragments of a word between certain cuts."""
        together, out, start = self.together, [], 0
        for i, (a, b) in enumerate(zip(word, word[1:]), 1):
            if not together[a][b]:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def _encode_fragment(self, fragment: bytes, last: bool) -> list[int]:
        """Ids of one fragment: merge the best-ranked neighbouring pair until none is left."""
        ids = [self.byte_id[b] for b in fragment]
        if last:
            ids[-1] = self.last_id[fragment[-1]]
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        merge, none = self.merge, 1 << 60
        order = [merge.get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while order:
            best = min(order)
            if best == none:
                break
            i = order.index(best)
            ids[i] = new = best & 0xFFFFF
            del ids[i + 1], order[i]
            if i < len(order):
                order[i] = merge.get(new << 20 | ids[i + 1], none)
            if i:
                order[i - 1] = merge.get(ids[i - 1] << 20 | new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges by a heap of pairs over a linked list, in n log n steps: best rank first, then leftmost."""
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (m := merge.get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            # an entry counts only while its pair is still there
            if ids[i] < 0 or j >= n or merge.get(ids[i] << 20 | ids[j]) != m:
                continue
            ids[i], ids[j] = m & 0xFFFFF, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := merge.get(ids[i] << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := merge.get(ids[h] << 20 | ids[i])) is not None:
                heapq.heappush(heap, (new, h))
        return [x for x in ids if x >= 0]

    def _encode_word(self, word: str) -> str:
        pieces = self.cut(word.encode("utf-8"))
        out = []
        for i, piece in enumerate(pieces, 1):
            out += self._encode_fragment(piece, i == len(pieces))
        return " ".join(map(str, out))

    def _words(self, text: str) -> list[str]:
        if text.isascii() or _PLAIN.fullmatch(text):
            return _PLAIN_WORD.findall(text.lower())
        low = self.library.normalizer.normalize_str(text)
        # the file's own split gives byte symbols: back to characters
        return [bytes([self.byte_of[c] for c in w]).decode("utf-8")
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(low)]

    def encode(self, text: str) -> str:
        """The ids of a text, in decimal, joined by one space."""
        out: list[str] = []
        for part in self.special_split.split(text) if self.special_split else [text]:
            if part in self.specials:
                out.append(str(self.specials[part]))
            else:
                out.extend(map(self.words.__getitem__, self._words(part)))
        return " ".join(out)

    def decode(self, ids: str) -> str:
        """The text of space-joined ids: the file has no decoder, so tokens joined by one space."""
        return " ".join(map(self.token.__getitem__, ids.split(" "))) if ids else ""


def encode_documents(docs: DataFrame, path: str | None = None, text: str = "text", keep: list[str] | None = None,
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole ``text``: one row per row, no shuffle.

    Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (and with ``with_ids``
    ``ids`` as an array and ``decoded``) to the columns ``keep`` (default: all but the text).
    NULL text is empty text and has no ids. Rows repeat as they are; an empty table gives no rows.
    Columns whose names clash with the added ones are dropped from the kept ones.
    """
    path = path or vocabulary_path()
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if with_ids else [])
    keep = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c not in added]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("__text"))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
                       + (["ids array<int>", "decoded string"] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(path)
        for batch in batches:
            for part in slices(batch, "__text"):
                counts, ids, decoded, id_lists, texts = [], [], [], [], []
                for t in part.column("__text").to_pylist():
                    got = bpe.encode(t or "")
                    back = bpe.decode(got)
                    counts.append(got.count(" ") + 1 if got else 0)
                    ids.append(hashlib.sha256(got.encode()).hexdigest())
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                    if with_ids:
                        id_lists.append([int(x) for x in got.split(" ")] if got else [])
                        texts.append(back)
                columns = [part.column(c) for c in keep]
                columns += [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    columns += [pa.array(id_lists, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=keep + added)

    return src.mapInArrow(run, schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the public word BPE file and decoded again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    return encode_documents(docs, keep=["doc_id"])
