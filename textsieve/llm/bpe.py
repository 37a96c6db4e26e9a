"""BPE encoding and decoding with a public vocabulary file (tokenizers JSON, word ends marked by a suffix).

Encoding merges the symbols of a word with a priority queue of merge ranks over
a doubly linked list of symbols; entries whose symbols have changed meanwhile
are stale and skipped.  That is O(n log n) for a word of any length.  Words
repeat, so each task keeps a bounded table of words already encoded.  Decoding
concatenates vocabulary strings, with the separator that the file's (absent)
decoder stands for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import id_and_text, table

#: words kept per task, and the longest word (in characters) that is kept
CACHE_WORDS, CACHE_CHARS = 200_000, 64

# The White_Space characters of Unicode, and the file's split pattern over them.
SPACE = r"\t-\r \x85\xa0  -     　"
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next free code point from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class WordBpe(dict):
    """Encoder and decoder; as a dict it maps a word to its ids (little-endian unsigned 32-bit), made when missing."""

    def __init__(self, spec: str):
        super().__init__()
        j = json.loads(spec)
        model = j["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.separator = "" if j.get("decoder") else " "
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {}
        for t in j["added_tokens"]:
            self.special[t["content"]] = t["id"]
            self.strings[t["id"]] = t["content"]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + self.suffix] for s in symbols]
        # (left id, right id) -> (rank, id of the merged symbol)
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])

    def word_ids(self, word: str) -> list[int]:
        """Merge the pair of least rank, leftmost first, until no pair has a rank."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, found[1], ids[i], ids[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, merged, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # stale: one of the two symbols is gone
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((merged, ids[k])):
                    heapq.heappush(queue, (found[0], i, found[1], merged, ids[k]))
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], merged))):
                heapq.heappush(queue, (found[0], h, found[1], ids[h], merged))
        return [x for x in ids if x >= 0]

    def __missing__(self, word: str) -> bytes:
        out = np.array(self.word_ids(word), dtype="<u4").tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens: NFC, lower case by character, split into words."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join(map(self.__getitem__, SPLIT.findall(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; strings of special tokens in the text become their ids."""
        if not text:
            return b""
        if self.cut is None or "<|" not in text and not self.cut.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.plain(text[at:m.start()]), np.uint32(self.special[m[0]]).astype("<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        return self.separator.join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(spec: str) -> WordBpe:
    return WordBpe(spec)


def read_spec(path: str | None = None) -> str:
    """The vocabulary file's text; read once on the driver and sent to the tasks (a fixed, small size)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           ids: bool = True, digests: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, and on request ids (array of int), ids_sha256 and decoded_sha256.

    A null text is empty and an empty text has no ids; rows are never merged, so
    repeated rows stay; an empty table gives no rows; extra columns are
    ignored; a null id stays null.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    schema = "id long, n_tokens long" + ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for b in batches:
            raw = [codec.encode(t.as_py()) for t in b.column("text")]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
            cols = {"id": b.column("id"), "n_tokens": pa.array(sizes)}
            if ids:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                cols["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            if digests:
                cols["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string())
                cols["decoded_sha256"] = pa.array([hashlib.sha256(codec.decode(x).encode("utf-8")).hexdigest() for x in raw], pa.string())
            yield pa.RecordBatch.from_pydict(cols)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) of rows with ids; null ids decode to an empty text."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for b in batches:
            texts = [codec.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select(F.col("id").cast("long"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "id long, text string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return (encode(table(spark, sf_dir, "documents"), ids=False, digests=True)
            .withColumnRenamed("id", "doc_id"))
