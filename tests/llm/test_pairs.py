"""Operators on pairs against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from assayer.llm import embedding_links, ngram_join
from assayer.llm.components import components
from assayer.session import pinned


def classes(nodes, edges):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "cliques", "none"])
def test_components(spark, shape):
    draw = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(900, i) for i in range(200)],
        "random": [(draw.randrange(300), draw.randrange(300)) for _ in range(200)],
        "cliques": [(10 * g + i, 10 * g + j) for g in range(9) for i in range(5) for j in range(5)],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert {r["node"]: r["component"] for r in found} == classes(linked, edges)
    assert len(found) == len(linked)



@pytest.mark.parametrize("at_once", [0, 10_000])
def test_components_of_few_edges_take_few_queries(spark, monkeypatch, at_once):
    draw = random.Random(2)
    nodes = [draw.randrange(-(1 << 62), 1 << 62) for _ in range(3000)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(2000)] + [(draw.choice(nodes[2001:]), draw.choice(nodes[2001:])) for _ in range(900)]
    edges += edges[:500]
    rows = spark.createDataFrame(edges, "a bigint, b bigint")
    stored = []
    monkeypatch.setattr("assayer.llm.components.EDGES_AT_ONCE", at_once)
    monkeypatch.setattr("assayer.llm.components.pinned", lambda df: stored.append(df) or pinned(df))
    found = components(rows).collect()
    assert {r["node"]: r["component"] for r in found} == classes({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert len(stored) == 2 if at_once else len(stored) > 6


def expected_vectors(rows):
    usable = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and rows[k][0] is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=float)
            usable[k] = x / np.linalg.norm(x)
    links, edges = defaultdict(int), []
    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.98:
                links[a] += 1
                links[b] += 1
                edges.append((rows[a][0], rows[b][0]))
    named = classes({r[0] for r in rows if r[0] is not None}, edges)
    return sorted(((r[0], links[k], named.get(r[0]), named.get(r[0]) == r[0]) for k, r in enumerate(rows)), key=repr)


def test_embedding_links(spark):
    draw = np.random.default_rng(3)
    rows = []
    for group in range(3):
        centre = draw.standard_normal(16)
        for _ in range(150 if group == 0 else 20):  # the first is larger than a block
            rows.append((centre + 0.03 * draw.standard_normal(16)).tolist())
    rows += [draw.standard_normal(16).tolist() for _ in range(100)]
    rows += [rows[0]] * 40 + [(np.array(rows[1]) * 1e30).tolist()] + [rows[5][:8]] * 2
    table = [(1000 - i, v, i % 2 if i > 320 else 0) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf, *rows[0][1:]], [None, *rows[0][1:]], rows[0], rows[0]]
    table += [(2000 + i, v, 0) for i, v in enumerate(odd)] + [(None, rows[0], 0), (3000, rows[0], None), (3001, rows[0], None)]
    df = spark.createDataFrame([(*r, "k", 5) for r in table], "vec_id bigint, embedding array<double>, label int, keys string, n int")
    found = embedding_links.linked(df).collect()
    assert sorted(map(tuple, found), key=repr) == expected_vectors(table)
    assert embedding_links.linked(df.limit(0)).collect() == []


def test_embedding_links_without_labels(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 2), (3, [0.0, 1.0], None)], "vec_id bigint, embedding array<float>, x int")
    found = embedding_links.linked(df, label_column=None).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


def test_recall_at_the_threshold():
    hashes, tables = embedding_links.hashes_and_tables(50_000, 0.98)
    draw = np.random.default_rng(9)
    first = draw.standard_normal((1500, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = draw.standard_normal((1500, 64))
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    second = 0.98 * first + math.sqrt(1 - 0.98**2) * other
    group = np.zeros(1500, dtype=np.int64)
    a, b = (embedding_links.bucket_keys(v, group, hashes, tables) for v in (first, second))
    assert (a == b).any(axis=1).mean() >= 0.985
    unrelated = embedding_links.bucket_keys(other, group, hashes, tables)
    assert (a == unrelated).mean() <= 1e-3


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def expected_documents(rows, percent, width):
    sets = [shingles(t, width) for _, t in rows]
    edges = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                edges.append((rows[i][0], rows[j][0]))
    named = classes({r[0] for r in rows if r[0] is not None}, edges)
    return sorted(((r[0], len(s), named.get(r[0])) for r, s in zip(rows, sets, strict=True)), key=repr)


def check_documents(spark, rows, percent, width):
    df = spark.createDataFrame([(*r, "d", 3) for r in rows], "doc_id bigint, text string, digest string, size int")
    found = ngram_join.joined(df, percent, width).collect()
    assert sorted(map(tuple, found), key=repr) == expected_documents(rows, percent, width)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[at] = f"new{draw.randrange(10**6)}"
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"more{draw.randrange(10**6)}")
    return words


@pytest.mark.parametrize(("percent", "width"), [(90, 3), (80, 5), (50, 2)])
def test_ngram_join_around_the_threshold(spark, percent, width):
    draw = random.Random(percent)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "two one", "É é", "a\u00a0b c d"]
    for size in (3, 4, 8, 12, 20, 35, 60, 120, 300, 900):
        base = [f"w{draw.randrange(2 * size)}" for _ in range(size)]
        limit = max(1, size * (100 - percent) // (100 * width))
        texts += [" ".join(edited(draw, base, draw.randint(0, 2 * limit))) for _ in range(7)]
        shared = " ".join(f"p{k}" for k in range(60))  # a passage that many documents hold
        texts += [shared + " " + " ".join(f"x{draw.randrange(10**6)}" for _ in range(size)) for _ in range(5)]
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(None, texts[-1]), (None, None), (7, "again a b"), (7, "again a b"), (7, "c d e f")]
    check_documents(spark, rows, percent, width)


def test_ngram_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 6)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    draw = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join(edited(draw, base, draw.randint(0, 4))) for _ in range(60)]
    other = [f"v{k}" for k in range(80)]
    texts += [" ".join([*base[:70], *edited(draw, other, 2)]) for _ in range(30)]
    check_documents(spark, list(enumerate(texts)), 90, 3)


def test_linked_sets_share_a_key():
    draw = np.random.default_rng(4)
    for percent in (80, 90):
        levels = ngram_join.Levels(percent)
        for size in (1, 2, 5, 9, 10, 11, 19, 40, 100, 333, 2000):
            for _ in range(20):
                first = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
                drop = draw.integers(0, size * (100 - percent) // 100 + 1)
                add = draw.integers(0, size * (100 - percent) // 100 + 1)
                second = np.unique(np.concatenate([first[drop:], draw.integers(0, 2**63, add).astype(np.uint64)]))
                union = len(np.union1d(first, second))
                if 100 * len(np.intersect1d(first, second)) >= percent * union and len(second):
                    assert set(levels.keys(first)) & set(levels.keys(second))


def test_shared_keys_take_one_shuffle(spark, monkeypatch):
    """All documents of each key that several have, also where one document repeats it, in many ranges and parts of batches."""
    monkeypatch.setattr(ngram_join, "RANGE_KEYS", 50)
    draw = random.Random(3)
    rows = [(k, [draw.randrange(-(2**63), 2**63) for _ in range(9)] + [draw.randrange(200) << 50, 7]) for k in range(300)]
    rows += [(300, [5, 5]), (301, []), (302, [rows[0][1][0], rows[1][1][1]]), (0, [5 << 40])]
    holders = defaultdict(set)
    for doc, keys in rows:
        for key in keys:
            holders[key].add(doc)
    want = sorted((key, doc) for key, docs in holders.items() if len(docs) > 1 for doc in docs)
    signed = spark.createDataFrame(rows, "doc_id bigint, keys array<bigint>")
    found = ngram_join.shared_keys(signed.repartition(5))
    assert sorted(map(tuple, found.collect())) == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 2  # by range, then sorted there
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_bitmaps_count_once():
    """Two sets without a common shingle stay apart beside a much longer one; links of all sizes still show."""
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (200, 200, 210, 5000)]
    sets.append(sets[0][5:])
    bits = [ngram_join.bitmap(s, ngram_join.bitmap_words(len(s))) for s in sets]
    words = max(len(b) for b in bits)
    nodes = [ngram_join.single(i, len(s), b.tobytes(), False, words) for i, (s, b) in enumerate(zip(sets, bits, strict=True))]
    able = {(i, j) for i in range(5) for j in range(i) if ngram_join.may_link(nodes[i], nodes[j], 80)}
    assert able == {(4, 0)}
    top = ngram_join.tree(nodes)
    assert list(ngram_join.traverse(top, top, ngram_join.Sets(5), 80)) in ([(4, 0)], [(0, 4)])


def test_ngram_join_brings_only_likely_sets_together(spark, monkeypatch):
    """Long documents with one passage in common share keys, but their sets do not travel."""
    given = []
    compared = ngram_join.connected
    monkeypatch.setattr(ngram_join, "connected", lambda m, p, exact: given.append((exact, m.count())) or compared(m, p, exact))
    draw = random.Random(12)
    shared = " ".join(f"p{k}" for k in range(200))
    texts = [shared + " " + " ".join(f"x{draw.randrange(10**9)}" for _ in range(5000)) for _ in range(12)]
    rows = list(enumerate([*texts, texts[0] + " more", "a short one", "a short one too"]))
    check_documents(spark, rows, 80, 5)
    assert [n for exact, n in given if exact] == [2]


def test_ngram_join_of_nothing(spark):
    assert ngram_join.joined(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("block", [2048, 7])
def test_ngram_links_are_all_counted(spark, monkeypatch, block):
    """Every link counts, not only those of a spanning forest; copies, repeated ids and missing ids are rows like others."""
    monkeypatch.setattr(ngram_join, "LINK_BLOCK", block)
    draw = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join(edited(draw, base, draw.randint(0, 5))) for _ in range(40)]
    texts += [texts[0]] * 5 + [f"alone {k} and different" for k in range(5)] + ["", None, " ", "one", "ONE"]
    ids = [1000 - k for k in range(len(texts))]
    ids[3] = ids[4] = None
    ids[7] = ids[8] = ids[-6]
    sets = [shingles(t, 3) for t in texts]
    edges = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    ]
    named = classes(range(len(texts)), edges)
    least = defaultdict(list)
    for k, c in named.items():
        least[c] += [ids[k]] if ids[k] is not None else []
    degree = [sum(k in e for e in edges) for k in range(len(texts))]
    want = [(ids[k], len(sets[k]), min(least[named[k]], default=None), degree[k]) for k in range(len(texts))]
    assert sum(degree) > 4 * len(texts)
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")
    found = ngram_join.linked(df, 90, 3).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_overlaps_of_few_and_many(monkeypatch):
    draw = np.random.default_rng(2)
    left, right = ([np.unique(draw.integers(0, 60, 25).astype(np.uint64)) for _ in range(n)] for n in (30, 20))
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    for light in (0, 100, 10**9):
        monkeypatch.setattr(ngram_join, "LIGHT", light)
        monkeypatch.setattr(ngram_join, "COLUMNS", 7)
        assert ngram_join.overlaps(left, right).tolist() == want


def test_classes_near_a_part_outside(spark):
    rows = [(1, 5, 3, 0), (1, 6, 2, 2), (1, 7, 1, 0), (1, 8, 4, 0), (2, 5, 9, 0)]
    found = ngram_join._neighbours(spark.createDataFrame(rows, "family bigint, class bigint, n int, rest int")).collect()
    code = ngram_join.CLASS_CODES
    numbers = {c: [c * code + i for i in range(n)] for f, c, n, _ in rows if f == 1}
    have = {(r["family"], r["class"]): (r["n"], r["rest"], sorted(r["blocks_near"]), sorted(r["parts_near"])) for r in found}
    parts = [6 * code, 6 * code + 1]
    assert have == {
        (1, 5): (3, 0, numbers[5] + numbers[6], parts),
        (1, 6): (2, 2, numbers[5] + numbers[6] + numbers[7], parts),
        (1, 7): (1, 0, numbers[6] + numbers[7] + numbers[8], parts),
    }
