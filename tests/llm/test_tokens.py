"""Tokenizer operators against the library, on odd texts and on whole documents."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assayer.llm import bpe, packing, token_counts
from assayer.llm.bpe import ByteBpe
from assayer.llm.ids import fast_encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "e\u0301", "Σ", "ΑΣ", "İ", "'s", "'", "1", "²", "Ⅷ", "<|endoftext|>", "<|startoftext|>"]
PARTS += ["\x1c", "\x85", "\u2003", "\u3000", "日本", "🙂", "!!", "_", "aaaa", "the", " the", "\r\n", "\x00", "\u200b", "\u180e", "ʼ", "DE", "12"]


def odd_texts(count, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(count)]


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def edge_rows():
    texts = [None, "", " ", "word " * 5000, "word " * 5000, *odd_texts(60)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "again"), (3, "again")]


def edge_cases(spark):
    """Nulls, empty and long texts, repeated rows, and columns that clash with results and differ only by case."""
    rows = [(*r, "x", 7, "y") for r in edge_rows()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, id int, TEXT string")


def test_pair_index_gives_the_ids_of_the_library():
    library = Tokenizer.from_file(BYTE)
    texts = odd_texts(20_000)
    ids = ByteBpe(BYTE).encode(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [w.ids for w in want]


def test_decoding_follows_the_library():
    library, coder = Tokenizer.from_file(BYTE), ByteBpe(BYTE)
    draw = random.Random(5)
    for _ in range(500):  # ids that are no whole characters too
        ids = [draw.randrange(50_257) for _ in range(12)]
        assert coder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_fast_ids_are_those_of_the_library():
    library, encode = Tokenizer.from_file(BYTE), fast_encoder(BYTE)
    texts = odd_texts(5_000)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == [w.ids for w in want]


@pytest.mark.parametrize("source", [edge_cases, documents])
def test_round_trip(spark, source):
    df = source(spark)
    library = Tokenizer.from_file(BYTE)
    want = []
    for doc_id, text in (tuple(r)[:2] for r in df.collect()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    found = bpe.round_trip(df, BYTE)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("source", [edge_cases, documents])
def test_token_counts(spark, source):
    df = source(spark)
    library = Tokenizer.from_file(WORD)
    want = []
    for doc_id, text in (tuple(r)[:2] for r in df.collect()):
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), count, count > 2048))
    assert sorted(map(tuple, token_counts.counted(df, WORD).collect()), key=repr) == sorted(want, key=repr)


def test_pieces_between_white_space_add_up():
    library = Tokenizer.from_file(WORD)
    texts = odd_texts(5_000, seed=11)
    common = dict(zip(["the", "a"], token_counts.lengths(WORD, ["the", "a"]), strict=True))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts._counts(texts, WORD, common, {}) == want


def test_frequent_pieces_are_counted_over_all_texts(spark):
    rows = [("common other " * 3 + f"w{i}",) for i in range(500)]
    assert token_counts.frequent(spark.createDataFrame(rows, "text string").repartition(40), 2) == ["common", "other"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(empty, BYTE).collect() == []
    assert token_counts.counted(empty, WORD).collect() == []
    assert packing.best_fit(empty, BYTE).collect() == []


def check_packed(rows, texts, capacity):
    library = Tokenizer.from_file(BYTE)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    have = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    return len(bins), sum(w[3] for w in want)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    for df in (edge_cases(spark), documents(spark)):
        rows = packing.best_fit(df, BYTE, capacity).collect()
        bins, tokens = check_packed(rows, [tuple(r)[:2] for r in df.collect()], capacity)
        assert bins <= 1.05 * tokens / capacity + 2


def fewest_bins(items, capacity):
    """By search, for a handful of items."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k, room in enumerate(bins):
            if room >= items[i] and room not in bins[:k]:
                place(i + 1, [*bins[:k], room - items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


def test_plan_is_close_to_the_fewest_bins():
    draw = random.Random(2)
    for case in range(150):
        capacity = 30
        low = 11 if case % 2 else 1  # only lengths above a third: greedy matching is exact there
        items = sorted((draw.randint(low, capacity) for _ in range(9)), reverse=True)
        counts = {n: items.count(n) for n in items}
        rows = packing.plan(counts, capacity)
        used = {}
        for n, a, b, sequence, per, at in rows:
            for rank in range(a, b):
                used.setdefault(sequence + (rank - a) // per, []).append((at + (rank - a) % per * n, n))
        assert sorted(n for held in used.values() for _, n in held) == sorted(items)
        for held in used.values():
            ends = [at + n for at, n in sorted(held)]
            assert [at for at, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert len(used) <= fewest_bins(items, capacity) + (low == 1)


def test_plan_takes_no_longer_for_more_documents():
    counts = {n: 10**12 + n for n in range(1, 2049)}
    rows = packing.plan(counts, 2048)
    assert len(rows) < 20_000
    assert all(sum(b - a for m, a, b, *_ in rows if m == n) == counts[n] for n in (1, 700, 2048))


def test_long_pieces_stay_out_of_tables(spark):
    texts = ["日本語" * 100, "x" * 5000, "x" * 5000, "short words", "y" * 65 + " short", "x" * 3000 + "\x1c" + "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert token_counts.frequent(df.select("text")) == ["short", "words", "z"]
    cache = {}
    library = Tokenizer.from_file(WORD)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts._counts(texts, WORD, {}, cache) == want
    assert sorted(cache) == ["short", "words"]
    assert [r["n_tokens"] for r in token_counts.counted(df, WORD).orderBy("doc_id").collect()] == want


def test_caches_of_pieces_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    texts = ["é" * 9000, "a b c", "x" * 7000 + " y", "a b c"]
    fast, plain = ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for text in texts * 2:
        ids = np.frombuffer(fast.encode([text])[0], dtype="<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids
        assert fast.held == sum(4 * len(p) + len(i) for cache in (fast.words, fast.spaced) for p, i in cache.items())
    fast.encode(["é" * 9000])
    fast.encode(["z"])
    assert list(fast.words) == ["z"] and fast.held == 8
