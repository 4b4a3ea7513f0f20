"""Skills, pairs, text vectors, models and match scores against plain Python, on odd rows too."""

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.functions.ranking import placed, shares_up_to
from assayer.matching import models, pairs, skills, text_vectors
from assayer.matching.score import match_scores

WORD = re.compile(r"[\w+#]+")


def words_of(text):
    return WORD.findall((text or "").lower().replace("_", " "))


def texts(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"id {kind}, text string")


# Ranking


def test_positions_and_shares(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(50), i) for i in range(700)] + [(None, 900)]
    df = spark.createDataFrame(rows, "v bigint, id bigint").repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    found = placed(df, ["v", "id"]).collect()
    assert {r["id"]: r["place"] for r in found} == {r[1]: k for k, r in enumerate(order)}
    values = sorted(r[0] for r in rows if r[0] is not None)
    shares = {r["v"]: r["s"] for r in shares_up_to(df, "v", "s").collect()}
    assert shares == {v: sum(x <= v for x in values) / len(values) for v in set(values)}
    assert placed(df.limit(0), ["v"]).count() == shares_up_to(df.limit(0), "v", "s").count() == 0


# Skills


def expected_matches(text, vocabulary):
    split = words_of(text)
    found = []
    for i in range(len(split)):
        ends = [j for j in range(i + 1, min(i + 6, len(split)) + 1) if " ".join(split[i:j]) in vocabulary]
        if ends:
            found.append((i, max(ends)))
    ends = dict(found)
    kept = [(a, b) for a, b in found if not any(ends.get(c, 0) >= b for c in range(a - 6, a))]
    return Counter(" ".join(split[a:b]) for a, b in kept)


PHRASES = ["Machine Learning", "learning", "deep  learning systems", "systems design", "c++", "c#", "Big DATA", "data", "a b c d e", "b c", "c d e f"]


@pytest.mark.parametrize("block_bytes", [1 << 24, 100])
def test_extraction(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(skills, "BLOCK_BYTES", block_bytes)
    draw = random.Random(2)
    alphabet = "machine learning deep systems design C++ c# big data a b c d e f other, Über".split(" ")
    rows = [(i, " ".join(draw.choice(alphabet) for _ in range(draw.randrange(40)))) for i in range(60)]
    rows += [(None, "data"), (70, None), (71, ""), (72, "..."), (5, "a b c d e f"), (73, "a b c d e f " * 3000)]
    vocabulary = spark.createDataFrame([(p,) for p in [*PHRASES, None, "", "--", "data"]], "phrase string")
    found = skills.extracted(texts(spark, rows), vocabulary, "id").collect()
    plain = {" ".join(words_of(p)) for p in PHRASES}
    want = sorted(((i, p, n) for i, t in rows for p, n in expected_matches(t, plain).items()), key=repr)
    assert sorted(map(tuple, found), key=repr) == want
    assert skills.extracted(texts(spark, []), vocabulary, "id").collect() == []
    assert skills.extracted(texts(spark, rows), vocabulary.limit(0), "id").collect() == []


def test_phrases(spark):
    rows = [(1, "One two, three one"), (2, None), (3, "two")]
    found = {r["phrase"] for r in skills.phrases(texts(spark, rows)).collect()}
    assert found == {"one", "two", "three", "one two", "two three", "three one", "one two three", "two three one"}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_normalisation(spark):
    draw = random.Random(3)
    known = ["python", "pyton", "java", "", "a", "ab", "kubernetes", "naïve bayes", *("".join(draw.choice("abc") for _ in range(n)) for n in range(1, 45))]

    def damaged(name, times):
        for _ in range(times):
            at = draw.randrange(len(name) + 1)
            name = draw.choice([name[:at] + draw.choice("abcx") + name[at:], name[:at] + name[at + 1 :], name[:at] + "z" + name[at + 1 :]])
        return name

    names = [damaged(k, draw.randrange(4)) for k in known for _ in range(4)] + ["", "q", "unrelated words", None, "PYTHON"]
    left = spark.createDataFrame([(n,) for n in names], "name string")
    right = spark.createDataFrame([(k,) for k in [*known, None, "java"]], "skill string")
    for most in (1, 2):
        want = set()
        for name in set(names) - {None}:
            best = min((edits(name, k), k) for k in known)
            want.add((name, best[1], best[0]) if best[0] <= most else (name, None, None))
        assert {tuple(r) for r in skills.normalised(left, right, most=most).collect()} == want
    assert skills.normalised(left.limit(0), right).collect() == []
    assert {r["skill"] for r in skills.normalised(left, right.limit(0)).collect()} == {None}


# Pairs


def sides():
    draw = random.Random(4)
    names = [f"s{i}" for i in range(30)]
    left = [(i, s) for i in range(80) for s in draw.sample(names, draw.randrange(1, 12))] + [(i, "hot") for i in range(0, 80, 2)]
    right = [(i, s) for i in range(40) for s in draw.sample(names, draw.randrange(1, 6))] + [(i, "hot") for i in range(0, 40, 3)]
    right += [(i, s) for i in range(40, 50) for s in {x for j, x in left if j == i}]
    return left + left[:20] + [(None, "s1"), (3, None)], right + [(None, "s1")]


@pytest.mark.parametrize(("measure", "percent"), [("coverage", 60), ("jaccard", 40), ("coverage", 100)])
def test_pairs(spark, monkeypatch, measure, percent):
    monkeypatch.setattr(pairs, "SPLIT_ROWS", 5)
    left, right = sides()
    frames = [spark.createDataFrame(rows, "id bigint, skill string") for rows in (left, right)]
    sets = pairs.skill_sets(*frames, ("id", "id"))
    a, b = defaultdict(set), defaultdict(set)
    for found, rows in ((a, left), (b, right)):
        for i, s in rows:
            if i is not None and s is not None:
                found[i].add(s)
    want = {}
    for i, x in a.items():
        for j, y in b.items():
            whole = len(y) if measure == "coverage" else len(x | y)
            if x & y and 100 * len(x & y) >= percent * whole:
                want[i, j] = (len(x & y), len(x), len(y))
    found, candidates = pairs.matched_pairs(sets, percent, measure)
    rows = found.collect()
    assert {(r["left_id"], r["right_id"]): (r["shared"], r["left_n"], r["right_n"]) for r in rows} == want
    assert len(rows) == len(want) <= candidates.count() < len(a) * len(b)
    frequency = Counter(s for side in (a, b) for x in side.values() for s in x)
    weight = {s: math.floor(1e6 * math.log((1 + len(a) + len(b)) / (1 + f))) for s, f in frequency.items()}
    for r in pairs.pair_features(found, sets).collect():
        x, y = a[r["left_id"]], b[r["right_id"]]
        assert r["coverage_left"] == len(x & y) / len(x) and r["coverage_right"] == len(x & y) / len(y)
        assert r["jaccard"] == len(x & y) / len(x | y)
        assert r["weighted_coverage"] == pytest.approx(sum(weight[s] for s in x & y) / sum(weight[s] for s in y))
        assert r["missing"] == "; ".join(sorted(y - x)) and r["missing_n"] == len(y - x)
    assert pairs.pair_features(found, sets).count() == len(want)


def test_pairs_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, skill string")
    sets = pairs.skill_sets(empty, empty, ("id", "id"))
    assert pairs.matched_pairs(sets, 50)[0].collect() == []
    with pytest.raises(ValueError, match="threshold"):
        pairs.matched_pairs(sets, 0)


def test_match_scores(spark):
    draw = random.Random(5)
    rows = [(i % 9, i, draw.randrange(5) / 4, draw.random() if i % 7 else None) for i in range(200)]
    found = match_scores(spark.createDataFrame(rows, "left_id bigint, right_id bigint, a double, b double"), 3, {"a": 3.0, "b": 1.0}).collect()
    known = [[r[k] for r in rows if r[k] is not None] for k in (2, 3)]

    def share(k, v):
        return 0.0 if v is None else sum(x <= v for x in known[k]) / len(known[k])

    scores = [(left, round((3 * share(0, a) + share(1, b)) / 4, 9), right) for left, right, a, b in rows]
    want = set()
    for left in range(9):
        best = sorted((-s, right) for own, s, right in scores if own == left)[:3]
        want |= {(left, right, round(-s, 9), k) for k, (s, right) in enumerate(best, 1)}
    assert {(r["left_id"], r["right_id"], round(r["score"], 9), r["rank"]) for r in found} == want


# Text vectors


def corpus():
    draw = random.Random(6)
    topics = [[f"t{k}w{i}" for i in range(15)] for k in range(5)]
    common = [f"c{i}" for i in range(8)]
    rows = []
    for i in range(120):
        topic = topics[i % 5]
        rows.append((i, " ".join(draw.choice(topic) if draw.random() < 0.6 else draw.choice(common) for _ in range(draw.randrange(3, 40)))))
    return rows + [(500, None), (501, ""), (502, rows[0][1]), (503, rows[0][1]), (504, "c0 " * 5000)]


def plain_vectors(rows, model_rows):
    df = Counter(t for _, text in model_rows for t in set(words_of(text)))
    found = {}
    for i, text in rows:
        raw = {t: n * (math.log((1 + len(model_rows)) / (1 + df[t])) + 1) for t, n in Counter(words_of(text)).items() if t in df}
        length = math.sqrt(sum(x * x for x in raw.values()))
        if raw:
            found[i] = {t: x / length for t, x in raw.items()}
    return found, df


def built(spark, rows, model=None, n=None):
    counts = text_vectors.term_counts(texts(spark, rows), "id")
    model = model or text_vectors.fitted(counts, len(rows) if n is None else n)
    return text_vectors.vectors(counts, model), model


def test_tfidf_and_cosines(spark, monkeypatch):
    monkeypatch.setattr(text_vectors, "SPLIT_ROWS", 10)
    rows = corpus()
    right, model = built(spark, rows)
    want, df = plain_vectors(rows, rows)
    names = {r["term_id"]: r["term"] for r in model.terms.collect()}
    assert [names[k] for k in range(len(names))] == sorted(df, key=lambda t: (-df[t], t))
    found = defaultdict(dict)
    for r in right.collect():
        found[r["id"]][names[r["term_id"]]] = r["weight"]
    assert found.keys() == want.keys()
    for i, vector in want.items():
        assert found[i] == pytest.approx(vector)

    draw = random.Random(7)
    queries = [(i, " ".join(draw.sample(rows[i][1].split(), 3)) + " unknown") for i in range(0, 60, 3)] + [(900, "nothing known"), (901, rows[0][1])]
    left, _ = built(spark, queries, model)
    asked, _ = plain_vectors(queries, rows)
    result = defaultdict(list)
    for r in sorted(text_vectors.cosine_top(left, right, 4).collect(), key=lambda r: (r["left_id"], r["rank"])):
        result[r["left_id"]].append((r["right_id"], round(r["score"], 8)))
    for i, vector in asked.items():
        scores = {d: round(sum(x * other.get(t, 0) for t, x in vector.items()), 9) for d, other in want.items()}
        best = sorted((-s, d) for d, s in scores.items() if s > 0)[:4]
        assert result.pop(i) == [(d, round(-s, 8)) for s, d in best]
    assert not result


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(text_vectors, "PASSES", 2)
    rows = corpus()
    sparse, _ = built(spark, rows)
    found, values = text_vectors.embedded(sparse, 4)
    want, df = plain_vectors(rows, rows)
    terms, ids = sorted(df), sorted(want)
    full = np.array([[want[i].get(t, 0.0) for t in terms] for i in ids])
    u, s, _ = np.linalg.svd(full, full_matrices=False)
    assert values == pytest.approx(s[:4].tolist(), rel=0.01)
    vectors = {r["id"]: r["embedding"] for r in found.collect()}
    assert sorted(vectors) == ids
    mine, best = np.array([vectors[i] for i in ids]), u[:, :4] * s[:4]
    assert np.abs(mine @ mine.T - best @ best.T).max() < 0.02


# Models


def test_naive_bayes(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice([f"{'ab'[i % 2]}{draw.randrange(9)}", f"c{draw.randrange(5)}"]) for _ in range(draw.randrange(1, 12))), "ab"[i % 2]) for i in range(90)]
    rows += [(200, None, "a"), (201, "a1 zzz", None), (202, "unseen only", "b"), (203, "", None), (209, "a1 a2", None)]
    counts = text_vectors.term_counts(texts(spark, [r[:2] for r in rows]), "id")
    labelled = spark.createDataFrame([(r[0], r[2]) for r in rows], "id bigint, kind string")
    found = {r["id"]: r for r in models.classified(counts, labelled, "kind", F.col("id") % 3 != 0).collect()}
    learned = [r for r in rows if r[0] % 3 != 0 and r[2] is not None]
    by = {c: Counter(w for _, t, k in learned if k == c for w in words_of(t)) for c in "ab"}
    size = len(set(by["a"]) | set(by["b"]))
    assert len(found) == len(rows)
    for i, text, label in rows:
        scores = {}
        for c in "ab":
            base = sum(by[c].values()) + size + 1
            scores[c] = math.log(sum(k == c for *_, k in learned) / len(learned)) + sum(math.log((by[c][w] + 1) / base) for w in words_of(text))
        best = min("ab", key=lambda c: (-round(scores[c], 9), c))
        r = found[i]
        assert (r["learned"], r["label"], r["predicted"]) == (i % 3 != 0, label, best)
        assert r["score"] == pytest.approx(scores[best])
        assert r["margin"] == pytest.approx(scores[best] - min(scores.values()), abs=1e-9)
    none = models.classified(counts, labelled, "kind", F.lit(False)).collect()
    assert len(none) == len(rows) and {r["predicted"] for r in none} == {None}


def test_regression(spark):
    draw = np.random.default_rng(9)
    n = 400
    a, b = draw.normal(1e4, 5, n), draw.normal(size=n)
    c = [["x", "y", None, "z z"][i % 4] for i in range(n)]
    effect = {"x": 0.0, "y": 2.0, "z z": -1.0, None: 5.0}
    y = 3 + 0.5 * a - 2 * b + np.array([effect[k] for k in c]) + 0.1 * draw.normal(size=n)
    rows = [(float(p), float(q), float(2 * p - q + 1), k, float(t), "same") for p, q, k, t in zip(a, b, c, y, strict=True)]
    bad = [(math.nan, 1.0, 1.0, "x", 1.0, "same"), (1.0, None, 1.0, "x", 1.0, "same"), (1.0, 1.0, 1.0, "x", math.inf, "same")]
    df = spark.createDataFrame(rows + bad, "a double, `b.b` double, sum double, c string, y double, one string").repartition(5)
    found = models.regression(df, "y", ["a", "b.b", "sum"], ["c", "one"])
    design = np.column_stack([np.ones(n), a, b, *[np.array([k == level for k in c]) for level in ("y", "z z", None)]])
    best, *_ = np.linalg.lstsq(design, y, rcond=None)
    got = {r["term"]: (r["coefficient"], r["status"]) for r in found.coefficients.collect()}
    for term, value in zip(["intercept", "a", "b.b", "c=y", "c=z z", "c=null"], best, strict=True):
        assert got[term] == (pytest.approx(value, rel=1e-6), "fitted")
    assert got["sum"] == (None, "collinear") and got["c=x"] == got["one=same"] == (None, "baseline")
    fit = found.diagnostics.first()
    residual = y - design @ best
    assert (fit["n"], fit["left_out"]) == (n, 3)
    assert fit["rmse"] == pytest.approx(math.sqrt((residual**2).mean()), rel=1e-6)
    assert fit["r2"] == pytest.approx(1 - (residual**2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    penalised = {r["term"]: r["status"] for r in models.regression(df, "y", ["a", "b.b", "sum"], ["c"], ridge=1.0).coefficients.collect()}
    assert penalised["sum"] == "fitted"
    nothing = models.regression(df.limit(0), "y", ["a"], ["c"])
    assert [r["coefficient"] for r in nothing.coefficients.collect()] == [None, None]
    assert nothing.diagnostics.first()["n"] == 0


# What is stored and shuffled


def recorded(monkeypatch, module):
    """The plans and row counts of what a module stores."""
    kept, store = [], module.pinned

    def spy(df):
        found = store(df)
        kept.append((df._jdf.queryExecution().executedPlan().toString(), found.count()))
        return found

    monkeypatch.setattr(module, "pinned", spy)
    return kept


def test_cosines_store_no_pairs(spark, monkeypatch):
    rows = [(i, f"common words a{i % 40} b{i % 7}") for i in range(600)]
    right, model = built(spark, rows)
    left, _ = built(spark, [(i, f"common words a{i}") for i in range(40)], model)
    kept = recorded(monkeypatch, text_vectors)
    found = text_vectors.cosine_top(left, right, 2).collect()
    assert len(found) == 80 and {r["right_id"] for r in found if r["left_id"] == 3} == {3, 43}
    tasks = right.rdd.getNumPartitions()
    assert sum(n for _, n in kept) <= 600 + 40 + 2 * 40 * max(tasks, 8)


def test_words_are_counted_without_a_shuffle(spark, monkeypatch):
    kept = recorded(monkeypatch, text_vectors)
    rows = [(1, "a b a"), (2, None), (3, "b"), (4, "...")]
    found = text_vectors.term_counts(texts(spark, rows), "id")
    assert {r["id"]: dict(zip(r["terms"], r["tfs"], strict=True)) for r in found.collect()} == {1: {"a": 2, "b": 1}, 3: {"b": 1}}
    assert "Exchange" not in kept[-1][0]
    again = text_vectors.term_counts(texts(spark, [*rows, (3, "c b"), (None, "a"), (None, "a d")]), "id")
    merged = {r["id"]: dict(zip(r["terms"], r["tfs"], strict=True)) for r in again.collect()}
    assert merged == {1: {"a": 2, "b": 1}, 3: {"b": 2, "c": 1}, None: {"a": 2, "d": 1}}


@pytest.mark.parametrize("common", [1, 5, 50_000])
def test_rare_terms_by_joins(spark, monkeypatch, common):
    want, _ = plain_vectors(corpus(), corpus())
    monkeypatch.setattr(text_vectors, "COMMON_TERMS", common)
    kept = recorded(monkeypatch, text_vectors)
    right, model = built(spark, corpus())
    assert kept[-1][0].count("Exchange hashpartitioning") <= (1 if common == 50_000 else 3)
    names = {r["term_id"]: r["term"] for r in model.terms.collect()}
    found = defaultdict(dict)
    for r in right.collect():
        found[r["id"]][names[r["term_id"]]] = r["weight"]
    assert found.keys() == want.keys() and all(found[i] == pytest.approx(v) for i, v in want.items())


def test_one_automaton_needs_no_shuffle(spark):
    rows = texts(spark, [(1, "big data and c++"), (None, "data"), (1, "data data"), (2, None)])
    vocabulary = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    found = skills.extracted(rows, vocabulary, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "big data", 1), (1, "c++", 1), (None, "data", 1), (1, "data", 2)], key=repr)
    packed = skills.extracted(rows, vocabulary, "id", packed=True).collect()
    assert sorted(((r["id"], sorted(r["phrases"])) for r in packed), key=repr) == sorted([(1, ["big data", "c++"]), (None, ["data"]), (1, ["data"])], key=repr)


@pytest.mark.parametrize("table_bytes", [0, 1 << 24])
def test_pairs_of_packed_sets_without_a_shuffle(spark, monkeypatch, table_bytes):
    monkeypatch.setattr(pairs, "TABLE_BYTES", table_bytes)
    left = spark.createDataFrame([(1, ["a", "b", None]), (2, ["c"]), (1, ["b", "d"]), (None, ["a"]), (3, [])], "id bigint, skill array<string>")
    right = spark.createDataFrame([("x", ["a", "d"]), ("y", ["c", "e"])], "id string, skill array<string>")
    sets = pairs.skill_sets(left, right, ("id", "id"))
    found, candidates = pairs.matched_pairs(sets, 50)
    assert sorted(map(tuple, found.collect())) == [(1, "x", 2, 3, 2), (2, "y", 1, 1, 2)]
    for df in (found, candidates):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    rows = {r["left_id"]: r.asDict() for r in pairs.pair_features(found, sets).collect()}
    assert (rows[1]["missing"], rows[2]["missing"], rows[2]["coverage_right"]) == ("", "e", 0.5)
    assert "missing" not in pairs.pair_features(found, sets, missing=False).columns


def test_cosines_of_listed_pairs(spark, monkeypatch):
    monkeypatch.setattr(text_vectors, "SPLIT_ROWS", 10)
    left, model = built(spark, corpus())
    right, _ = built(spark, corpus()[:20], model)
    vectors, _ = plain_vectors(corpus(), corpus())
    asked = [(i, j) for i in vectors for j in range(20) if (i + j) % 3 == 0]
    pairs_of = spark.createDataFrame(asked, "left_id bigint, right_id bigint")
    kept = recorded(monkeypatch, text_vectors)
    found = {(r["left_id"], r["right_id"]): r["score"] for r in text_vectors.cosines(pairs_of, left, right).collect()}
    scores = {(i, j): sum(x * vectors[j].get(t, 0) for t, x in vectors[i].items()) for i, j in asked}
    assert found == {p: pytest.approx(s, abs=1e-8) for p, s in scores.items() if s > 0}
    assert sum(n for _, n in kept) <= 3 * len(vectors)  # texts with their lists, no terms of pairs


def test_embeddings_with_rare_terms(spark, monkeypatch):
    monkeypatch.setattr(text_vectors, "PASSES", 2)
    sparse, _ = built(spark, corpus())
    want, values = text_vectors.embedded(sparse, 4)
    monkeypatch.setattr(text_vectors, "COMMON_ROWS", 12)
    kept = recorded(monkeypatch, text_vectors)
    found, again = text_vectors.embedded(sparse, 4)
    assert again == pytest.approx(values, rel=1e-6)
    mine, best = ({r["id"]: np.array(r["embedding"]) for r in df.collect()} for df in (found, want))
    assert mine.keys() == best.keys()
    assert max(abs(mine[i] @ mine[j] - best[i] @ best[j]) for i in mine for j in mine) < 1e-5
    assert kept


def test_embeddings_in_blocks_leave_no_tables(spark, monkeypatch):
    """Terms in every task, in several blocks, and in one text only; some ids null. Passes leave nothing but the result."""
    for name, value in {"PASSES": 2, "COMMON_ROWS": 12, "BLOCK_TERMS": 8, "BLOCK_POSTINGS": 90, "_BUCKET": 4, "_CHUNK": 5, "_BUCKET_TEXTS": 10}.items():
        monkeypatch.setattr(text_vectors, name, value, raising=False)
    rows = [(i, f"{t or ''} own{i} {'mine' * (i % 3)}{i}") for i, t in corpus()]
    packed, _ = built(spark, [*rows, (None, "t1w1 c1 c2 lonely")])
    packed = text_vectors.pinned(packed)
    folder = Path(packed.inputFiles()[0].removeprefix("file://")).parents[1]
    before = set(folder.iterdir())
    found, values = text_vectors.embedded(packed, 4)
    vectors = {r["id"]: r["embedding"] for r in found.collect()}
    assert len(set(folder.iterdir()) - before) == 2  # its own form of the vectors, and the result
    assert not spark.catalog.listTables()
    weights = defaultdict(dict)
    for r in packed.collect():
        weights[r["id"]][r["term_id"]] = r["weight"]
    ids = list(weights)
    full = np.array([[weights[i].get(t, 0.0) for t in range(1 + max(map(max, weights.values())))] for i in ids])
    u, s, _ = np.linalg.svd(full, full_matrices=False)
    assert values == pytest.approx(s[:4].tolist(), rel=0.01)
    assert vectors.keys() == weights.keys()
    # the same passes over the whole matrix at once
    basis = text_vectors._start(np.arange(full.shape[1]), 14, 7)
    for _ in range(3):
        basis = np.linalg.qr(full.T @ (full @ basis))[0]
    u, s, _ = np.linalg.svd(full @ basis, full_matrices=False)
    assert values == pytest.approx(s[:4].tolist(), rel=1e-9)
    mine, best = np.array([vectors[i] for i in ids]), u[:, :4] * s[:4]
    assert np.abs(mine @ mine.T - best @ best.T).max() < 1e-9


def test_decomposition_starts_from_hashes(spark):
    terms = np.array([0, 1, 77, 250_000, 3_000_000_000])
    uniform = "pmod(xxhash64(7, {0}, {1}, id), 1048576) / 524288D - 1"
    sums = [F.expr(" + ".join(uniform.format(i, j) for j in range(4))) for i in range(3)]
    want = spark.createDataFrame([(int(t),) for t in terms], "id bigint").select(F.array(*sums).alias("row")).collect()
    assert text_vectors._start(terms, 3, 7) == pytest.approx(np.array([r["row"] for r in want]))


@pytest.mark.parametrize("common", [0, 12])
def test_naive_bayes_with_rare_terms(spark, monkeypatch, common):
    monkeypatch.setattr(models, "COMMON_WEIGHTS", common)
    test_naive_bayes(spark)
