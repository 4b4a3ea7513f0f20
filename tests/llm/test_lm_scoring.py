"""Scores against a model that counts and looks up in plain Python, over whole documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import lm_scoring
from assayer.llm.queries import QUERIES
from assayer.llm.lm_scoring import PRIOR, remainder, words_of

COLUMNS = "doc_id bigint, text string"


def expected(rows, order):
    """doc_id -> (tokens, known, base, score), by recursion over ever shorter contexts."""
    learned = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 != 1]
    counts = Counter()
    sequences = {id(r): ["<s>", *words_of(r[1] or ""), "</s>"] for r in rows}
    for r in learned:
        s = sequences[id(r)]
        for n in range(1, order + 1):
            for i in range(1, len(s)):
                if i - n + 1 >= 0:
                    counts[tuple(s[i - n + 1 : i + 1])] += 1
        counts[("<s>",)] += 1
    ends = {g for g in counts if len(g) == 1 and g != ("<s>",)}
    tokens, types = sum(counts[g] for g in ends), len(ends)

    def p(context, word):
        if not context:
            return (counts[(word,)] + 0.5) / (tokens + 0.5 * (types + 1))
        return (counts[(*context, word)] + PRIOR * p(context[1:], word)) / (counts[context] + PRIOR)

    found = []
    for r in rows:
        s = sequences[id(r)]
        steps = range(1, len(s))
        score = sum(math.log10(p(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in steps)
        base = sum(math.log10(p((), s[i])) for i in steps)
        found.append((r[0], len(s) - 1, sum(counts[(s[i],)] > 0 for i in steps), tokens, base, score))
    return found


def check(spark, rows, order):
    df = spark.createDataFrame([(*r, "x") for r in rows], COLUMNS + ", score string")
    found = lm_scoring.scored(df, remainder(F.col("doc_id"), 5) != 1, order).drop("learned").collect()
    want = sorted(expected(rows, order), key=repr)
    assert [tuple(r)[:4] for r in sorted(map(tuple, found), key=repr)] == [w[:4] for w in want]
    for have, should in zip(sorted(map(tuple, found), key=repr), want, strict=True):
        assert have[4:] == pytest.approx(should[4:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_small_cases(spark, order):
    texts = ["a b a b a", "A B c", None, "", "  \t\n ", "a b a b a", "zz É é yy", "a " * 400, "new words only here"]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    check(spark, rows, order)


@pytest.mark.parametrize("order", [2, 3])
def test_whole_documents(spark, order, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 20_000)
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("doc_id", "text").collect()]
    check(spark, rows, order)


def test_probabilities_sum_to_one(spark):
    rows = [(2, "a b c"), (3, "a b"), (4, "b b a")]
    every = [(i, t) for i, t in enumerate(["a a", "a b", "a c", "a", "a unseen"], 100)]
    df = spark.createDataFrame(rows + every, COLUMNS)
    one = {r["doc_id"]: r for r in lm_scoring.scored(df, F.col("doc_id") < 100).collect()}
    stay = one[103]["score"]  # <s> a </s>
    first = one[103]["score"] - math.log10((2 + PRIOR * 10 ** (math.log10((3 + 0.5) / (11 + 0.5 * 5)))) / (3 + PRIOR))
    assert stay < first < 0


def test_empty_and_unlearned(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert lm_scoring.scored(empty, F.lit(True)).collect() == []
    nothing = lm_scoring.scored(spark.createDataFrame([(1, "a b")], COLUMNS), F.lit(False)).first()
    assert (nothing["train_tokens"], nothing["n_known"], nothing["score"]) == (0, 0, 0.0)


def test_registered_query_scores_trigrams(spark, tmp_path):
    rows = [(i, "a b c d a b d c b a") for i in range(20)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["score"] for r in QUERIES["op8_lm_scoring"](spark, str(tmp_path)).collect()}
    assert found == pytest.approx({r[0]: r[5] for r in expected(rows, 3)})
    assert found[0] != pytest.approx(expected(rows, 2)[0][5])


def test_only_shared_contexts_are_asked_for():
    """A trigram is asked for if another block has its context and a training text has it; others are known without."""
    lengths = np.array([4], dtype=np.int64)
    hashes = np.arange(1, 5, dtype=np.uint64)
    grams = lm_scoring.Grams(np.array([1, 2, 3, 0]), lengths, hashes, 3)  # "a b c", then the end
    pairs = len(grams.hashes[1])

    def answer(level, doubled):
        places = np.argsort(grams.hashes[level - 1])
        return {"level": level, "range": 0, "totals": lm_scoring._packed(np.array(doubled, dtype="<i8")[places])}

    nowhere_else = [answer(1, [2 * 1 + 1] * 4), answer(2, [2 * 1 + 1] * pairs)]
    assert not lm_scoring.Totals(grams, np.array([True]), nowhere_else, 2).asked(3).any()
    not_learned = [answer(1, [2] * 4), answer(2, [0] * pairs)]
    assert not lm_scoring.Totals(grams, np.array([False]), not_learned, 2).asked(3).any()
    shared = [answer(1, [2 * 5] * 4), answer(2, [2 * 5] * pairs)]
    totals = lm_scoring.Totals(grams, np.array([True]), shared, 2)
    assert totals.asked(3).all() and totals.found[1].tolist() == [5] * pairs


def test_packed_arrays_come_back():
    for kind in ("u1", "<u4", "<i4", "<i8", "<u8"):
        for values in ([], [0], [1, 255, 7], range(200)):
            values = np.array(values, dtype=kind)
            assert lm_scoring._array(lm_scoring._packed(values), kind).tolist() == values.tolist()
