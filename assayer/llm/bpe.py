"""Byte-level BPE by a pair occurrence index, and the decoder for it.

The distinct pre-tokens of a batch are laid out in one list of symbols. An index maps every mergeable pair, by its rank, to
all positions where it occurs in the batch. Active ranks are applied in ascending order: each occurrence is merged once, and
only the two pairs beside it enter the index anew. A merge never makes a pair of a lower rank (checked when the file is
read), so the global order gives each word the merges it would get alone.

A worker keeps the ids of the pieces it has seen, up to ``CACHE_ENTRIES`` and, as a piece may be a whole text, up to
``CACHE_BYTES``; beyond either it starts an empty cache with the next batch. Texts are encoded whole, whatever their length. A null text counts as empty; an empty text has no ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from assayer.llm.common import picked

CACHE_ENTRIES = 800_000
CACHE_BYTES = 128_000_000  # of pieces and their ids
BATCH_CHARS = 4_000_000  # texts merged in one index
SHIFT = 20  # bits of an id in a pair key
GAP, GONE = -1, -2  # between two words; merged into the symbol to its left
# Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
_EDGE = regex.compile(r"^\s|\s$")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others counted on from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PairIndex:
    """Merges of a vocabulary, applied to many words at once."""

    def __init__(self, start: list[int], pairs: list[tuple[int, int, int]]):
        """``start``: the ids of the 256 bytes; ``pairs``: (left, right, merged) ids in the order of their ranks."""
        self.start = np.array([*start, GAP], dtype=np.int64)
        self.pairs = pairs
        made = {merged: rank for rank, (_, _, merged) in enumerate(pairs)}
        if any(max(made.get(a, -1), made.get(b, -1)) >= rank for rank, (a, b, _) in enumerate(pairs)):
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = np.array([left << SHIFT | right for left, right, _ in pairs], dtype=np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[self.ranks], np.iinfo(np.int64).max)

    def _occurrences(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each rank among the pairs, with the positions that have it."""
        wanted = left << SHIFT | right
        found = np.searchsorted(self.keys, wanted)
        known = np.flatnonzero(self.keys[found] == wanted)
        if len(known):
            rank, at = self.ranks[found[known]], at[known]
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            begins = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            yield from zip(rank[begins].tolist(), np.split(at, begins[1:]), strict=True)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        codes = np.full(int(size.sum()) + 1, len(self.start) - 1)
        inside = np.ones(len(codes), dtype=bool)
        inside[0] = inside[np.cumsum(size)] = False
        codes[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.start[codes]
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        places: dict[int, list[np.ndarray]] = {
            rank: [at] for rank, at in self._occurrences(symbols[:-1], symbols[1:], before[1:])
        }
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            first, second, merged = self.pairs[rank]
            at = places.pop(rank)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
            at = at[(symbols[at] == first) & (symbols[after[at]] == second)]
            if first == second:  # aaa: the left pair takes the middle one
                at = _not_overlapping(at, after)
            if not len(at):
                continue
            gone = after[at]
            right = after[gone]
            symbols[at], symbols[gone] = merged, GONE
            after[at], before[right] = right, at
            left = before[at]
            beside = np.concatenate([left, at])
            for new, found in self._occurrences(symbols[beside], symbols[after[beside]], beside):
                if new not in places:
                    heapq.heappush(active, new)
                    places[new] = []
                places[new].append(found)
        flat = symbols[symbols != GONE]
        gaps = np.flatnonzero(flat == GAP).tolist()
        raw = flat.astype("<u4").tobytes()
        return [raw[4 * a + 4 : 4 * b] for a, b in zip(gaps, gaps[1:], strict=False)]


def _not_overlapping(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    kept, taken = [], -1
    for i, j in zip(at.tolist(), after[at].tolist(), strict=True):
        if i != taken:
            kept.append(i)
            taken = j
    return np.array(kept, dtype=np.int64)


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, pre = stated["model"], stated["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or stated["normalizer"] or model["end_of_word_suffix"]:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        vocab = model["vocab"]
        letters = byte_letters()
        values = {letter: b for b, letter in enumerate(letters)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.index = PairIndex([vocab[x] for x in letters], [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        self.added = {text: np.array([i], dtype="<u4").tobytes() for text, i in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pieces = {i: bytes(values[x] for x in token) for token, i in vocab.items()}
        self.pieces |= {i: text.encode() for text, i in added.items()}
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.held = 0  # bytes in both, a character counted as four

    def _keep(self, cache: dict[str, bytes], new: list[str], ids: list[bytes]) -> None:
        cache.update(zip(new, ids, strict=True))
        self.held += 4 * sum(map(len, new)) + sum(map(len, ids))

    def _learn(self, words: Iterable[str]) -> None:
        new = list(set(words).difference(self.words))
        self._keep(self.words, new, self.index.merge([w.encode() for w in new]))

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens.

        A piece between two single blanks stands alone: no pre-token reaches beyond it, unless white space lies at its edge.
        Texts with such edges are split as a whole.
        """
        if len(self.words) + len(self.spaced) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self.words, self.spaced, self.held = {}, {}, 0
        parts = [text.split(" ") for text in texts]
        new = {p for part in parts for p in part[1:] if p not in self.spaced}
        split = {p: _SPLIT.findall(" " + p) for p in new if p and not _EDGE.search(p)}
        self._learn(w for ws in split.values() for w in ws)
        word, join = self.words.__getitem__, b"".join
        self._keep(self.spaced, list(split), [join(map(word, ws)) for ws in split.values()])
        piece, found, whole = self.spaced.__getitem__, [], {}
        for i, (head, *rest) in enumerate(parts):
            try:
                found.append(join(map(piece, rest)))
            except KeyError:
                found.append(b"")
                head = texts[i]
            if head != texts[i] and _EDGE.search(head):
                found[i], head = b"", texts[i]
            whole[i] = _SPLIT.findall(head)
        self._learn(w for ws in whole.values() for w in ws)
        return [join(map(word, whole[i])) + rest for i, rest in enumerate(found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers; added tokens in a text are found first."""
        if self.cut is None or not any(t in text for text in texts for t in self.added):
            return self._plain(texts)
        parts = [self.cut.split(text) for text in texts]
        ids = iter(self._plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(next(ids) if k % 2 == 0 else self.added[p] for k, p in enumerate(ps)) for ps in parts]

    def decode(self, ids: bytes) -> str:
        """The text of ids, added tokens as their strings; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode(errors="replace")


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The encoder of a worker: read once, with its cache."""
    return ByteBpe(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, text: str) -> Iterator[tuple[pa.RecordBatch, list[str], list[bytes]]]:
    """Slices of the batches with their texts and ids; a slice holds about ``BATCH_CHARS`` characters, or one longer text."""
    coder = byte_bpe(path)
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        begin = size = 0
        for end, t in enumerate(texts, 1):
            size += len(t)
            if size >= BATCH_CHARS or end == len(texts):
                yield batch.slice(begin, end - begin), texts[begin:end], coder.encode(texts[begin:end])
                begin, size = end, 0


def round_trip(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode every text: id, n_tokens, ids_sha256, decoded_sha256.

    One row per input row, repeated rows included; a null id stays null. Other columns are not read, so their names don't
    matter. Neither a shuffle nor a gathered group: every batch stands alone.
    """

    def run(batches):
        coder = byte_bpe(path)
        for batch, _, ids in encoded(batches, path, "text"):
            decoded = [coder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = picked(documents, id=id_column, text=text_column)
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_column)
