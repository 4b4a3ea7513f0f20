"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from assayer.llm import resampling

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def features(text, width):
    words = WORD.findall((text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def expected(rows, target, width, buckets, percent, least):
    def counts(texts):
        found = [0] * buckets
        for text in texts:
            for feature in features(text, width)[1]:
                found[zlib.crc32(feature.encode()) % buckets] += 1
        return found

    s, t = counts(text for _, text in rows), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    found = []
    for doc_id, text in rows:
        words, own = features(text, width)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in own) // len(own) if own else 0
        name = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(own), weight, score, len(words) >= least])
    usable = sorted((f for f in found if f[4]), key=lambda f: (-f[3], f[0] is None, f[0] or 0))
    for rank, f in enumerate(usable[: percent * len(usable) // 100], 1):
        f[4] = rank
    return sorted(((*f[:4], f[4] if f[4] is not True and f[4] else None) for f in found), key=repr)


def texts():
    draw = np.random.default_rng(2)
    words = ["Alpha", "beta", "ÄPFEL", "straße", "naïve", "x1", "42", "日本語", "K", "gamma"]
    rows = [(i, " ".join(draw.choice(words, draw.integers(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "... !!! \x00 \x7f"), (903, "a\x80b　c d\x0be A_B-C"), (None, "beta " * 30), (904, "x1 42\n" * 20_000)]
    return rows + [(5, "gamma beta " * 15)] * 2 + [(905, "w" * 100_000 + " tail")]


@pytest.mark.parametrize(("width", "buckets"), [(1, 10_000), (1, 7), (3, 100_000)])
def test_resampling(spark, width, buckets):
    rows = texts()
    target = ["beta gamma 42", None, "", "Straße straße NAÏVE unseen", "alpha " * 50]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id bigint, text string, features string, place int").repartition(5)
    other = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resampled(df, other, width=width, buckets=buckets, percent=30, least_words=20)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, target, width, buckets, 30, 20)


def test_resampling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert resampling.resampled(empty, empty).collect() == []
    rows = [(1, "a b"), (2, None)]
    found = resampling.resampled(spark.createDataFrame(rows, "doc_id bigint, text string"), empty, least_words=1, percent=100)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, [], 1, 10_000, 100, 1)


def test_words_are_cut_as_the_pattern_says():
    split = resampling.Features(1, 10)
    for text in ["a.b", "Hé llo", "a\x00b\x1fc", "ZZ__top", "é" * 10, "/0:9@A[Z`a{z}", "\x80￿\U0010ffff"]:
        lowered = text.encode().lower().decode()
        assert [w for w, _ in split.split.pre_tokenize_str(lowered)] == WORD.findall(lowered)
