"""Byte-pair encoding with word ends, and decoding.

Words are cut out of the normalised text and encoded one by one: a priority
queue holds (rank, place, symbols) of mergeable neighbours in a doubly linked
symbol list, and entries whose symbols have changed since are skipped.  Encoded
words are remembered in a store of bounded size, because words repeat.
Decoding puts the vocabulary strings of the ids together.

Defined results: a null or empty text has no ids and decodes to the empty text;
the tokenizer's special strings inside a text become their own ids; repeated
rows are encoded alike; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The characters with the Unicode property White_Space.
BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"

SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte value."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, limit: int = 500_000):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        chars = byte_chars()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + self.end] for c in chars]
        pattern = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", BLANK))
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def word(self, word: str) -> list[int]:
        """Ids of one word: merges by rank, from the queue."""
        raw = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        n, merges = len(symbols), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, merged = heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # stale: one of the two has been merged since
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                found = merges.get((merged, symbols[after[i]]))
                if found:
                    heappush(queue, (found[0], i, merged, symbols[after[i]], found[1]))
            if before[i] >= 0:
                p = before[i]
                found = merges.get((symbols[p], merged))
                if found:
                    heappush(queue, (found[0], p, symbols[p], merged, found[1]))
        return [s for s in symbols if s >= 0]

    def plain(self, text: str) -> bytes:
        """Ids of a text without special strings, as little-endian 32-bit integers."""
        text = unicodedata.normalize("NFC", text)
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        if SEPARATORS.search(text):  # no white space for the tokenizer, but for str.split
            return b"".join(map(self.remembered, self.words.findall(text)))
        pieces, out = self.pieces, []
        for piece in text.split():  # no word crosses white space
            ids = pieces.get(piece)
            if ids is None:
                ids = b"".join(map(self.remembered, self.words.findall(piece)))
                if len(piece) <= 64:
                    if len(pieces) >= self.limit:
                        pieces.clear()
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def remembered(self, word: str) -> bytes:
        """Ids of one word, from the store if it is there."""
        ids = self.known.get(word)
        if ids is None:
            ids = np.array(self.word(word), "<u4").tobytes()
            if len(word) <= 64:
                if len(self.known) >= self.limit:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text."""
        text = text or ""
        if self.split is None or "<|" not in text:
            return np.frombuffer(self.plain(text), "<u4")
        parts = []
        for part in self.split.split(text):
            one = self.special.get(part)
            parts.append(self.plain(part) if one is None else one.to_bytes(4, "little"))
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings of the ids, set apart by blanks: the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    """One encoder per Python worker and file; its word store lives as long as the worker."""
    return WordBpe(path)


def encoded_batches(batches: Iterator[pa.RecordBatch], path: str, text: str):
    """Each batch with the ids and the decoded text of its rows."""
    bpe = loaded(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = [bpe.encode(t) for t in part.column(text).to_pylist()]
            yield part, ids, [bpe.decode(i) for i in ids]


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of integers) and ``decoded`` (text).

    ``path`` names the tokenizer file, which every executor must be able to
    read.  Columns of these names are replaced.
    """
    kept = docs.drop("token_ids", "decoded")
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, decoded in encoded_batches(batches, path, text):
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends), flat)
            names = [*part.schema.names, "token_ids", "decoded"]
            yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(decoded, pa.string())], names=names)

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of tokens, and digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, decoded in encoded_batches(batches, path, text):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(doc_id),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for d in decoded], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kept = docs.select(doc_id, text)
    kind = kept.schema[doc_id].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
