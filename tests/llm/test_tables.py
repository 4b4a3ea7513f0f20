"""Exact de-duplication, sharding, URL rules and the quality classifier against brute force."""

import bisect
import hashlib
import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayer.llm import common, exact_dedup, quality, sharding, url_rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(1, "A b É"), (2, "a B É"), (3, "a b é"), (4, None), (5, ""), (6, "x" * 200_000), (7, "X" * 200_000), (None, "n")]
ROWS += [(None, "a b É"), (8, "same"), (8, "same"), (9, " "), (10, "same ")]
SCHEMA = "doc_id bigint, text string, kept string, digest int, TEXT string"


def table(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "k", 1, "t") for r in rows], SCHEMA)


def plain(text):
    return (text or "").translate(LOWER)


def expected_copies(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    found = []
    for doc_id, text in rows:
        ids = groups[plain(text)]
        keep = max((i for i in ids if i is not None), default=None)
        found.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(found, key=repr)


def test_exact_dedup(spark):
    found = exact_dedup.deduplicated(table(spark), exact_dedup.DigestIndex(spark))
    assert sorted(map(tuple, found.collect()), key=repr) == expected_copies(ROWS)


def test_exact_dedup_against_an_index(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.deduplicated(table(spark), index).collect()
    later = exact_dedup.deduplicated(table(spark, [(20, "SAME"), (21, "new"), (22, "new")]), index)
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in later.collect()}
    assert found == {20: (8, 1, False), 21: (22, 2, False), 22: (22, 2, True)}
    assert index.rows().count() == len({plain(t) for _, t in ROWS}) + 1
    assert exact_dedup.deduplicated(table(spark, []), index).collect() == []


def test_index_is_joined_by_merging_sorted_buckets(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.deduplicated(table(spark), index).collect()
    groups = exact_dedup.digests(table(spark)).groupBy("digest").count()
    plan = groups.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def shard_rows(spark, rows, shards, slack=0.0):
    return sharding.sharded(table(spark, rows), shards, slack).collect()


def test_sharding_law(spark):
    rows = ROWS + [(i, f"text {i % 7}") for i in range(100, 3000)]
    found = shard_rows(spark, rows, 24)
    have = sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr)
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    assert have == sorted(want, key=repr)
    by_shard = {}
    for r in found:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by_shard[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["shard"], r["slot"])
    again = shard_rows(spark, random.Random(1).sample(rows, len(rows)), 24)
    unique = lambda rs: sorted((key(r) for r in rs if r["doc_id"] not in (None, 8)))
    assert unique(again) == unique(found)


def test_sharding_moves_few_rows(spark):
    rows = [(i, "t") for i in range(4000)]
    for slack, most in ((0.25, 0.2), (0.0, 0.6)):
        old = {r["doc_id"]: r["shard"] for r in shard_rows(spark, rows, 24, slack)}
        new = {r["doc_id"]: r["shard"] for r in shard_rows(spark, rows, 25, slack)}
        assert sum(old[i] != new[i] for i in old) <= most * len(rows)
        counts = [list(new.values()).count(s) for s in range(25)]
        assert max(counts) <= (1 + slack) * len(rows) / 25 + 1
    assert shard_rows(spark, [], 24) == []


def walked(positions, shards, slack=0.0):
    """Every key on its own: (arc, shard) counts, by walking clockwise in rounds until a shard has room."""
    points = sharding.ring(shards)
    ends = [p for p, _ in points]
    room = sharding.bounds(len(positions), shards, slack)
    waiting = sorted(bisect.bisect_left(ends, p) % len(ends) for p in positions)
    found, step = Counter(), 0
    while waiting:
        left = []
        for arc in waiting:
            shard = points[(arc + step) % len(points)][1]
            if room[shard]:
                room[shard] -= 1
                found[arc, shard] += 1
            else:
                left.append(arc)
        waiting, step = left, step + 1
    return found


def positions_of(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", F.xxhash64("doc_id").alias("h"))
    return {r["doc_id"]: r["h"] + sharding.RING // 2 for r in rows.collect()}


@pytest.mark.parametrize(("shards", "slack"), [(24, 0.0), (24, 0.1), (5, 0.0), (1, 0.0)])
def test_every_arc_overflows_as_a_plain_walk_says(spark, shards, slack):
    at = positions_of(spark, range(3000))
    ends = [p for p, _ in sharding.ring(shards)]
    rows = shard_rows(spark, [(i, "t") for i in at], shards, slack)
    found = Counter((bisect.bisect_left(ends, at[r["doc_id"]]) % len(ends), r["shard"]) for r in rows)
    assert found == walked(at.values(), shards, slack)


@pytest.mark.parametrize("slack", [0.0, 0.1, 0.25])
def test_only_taken_and_overflowing_rows_move(spark, slack):
    """A row that is in the shard of its own arc before and after a shard is added moves only if the new shard owns that arc.
    So no more rows move than those the new shard owns and those that overflow before or after."""
    at = positions_of(spark, range(3000))

    def homes(shards):
        points = sharding.ring(shards)
        ends = [p for p, _ in points]
        return {i: points[bisect.bisect_left(ends, p) % len(ends)][1] for i, p in at.items()}

    before, after = homes(24), homes(25)
    old = {r["doc_id"]: r["shard"] for r in shard_rows(spark, [(i, "t") for i in at], 24, slack)}
    new = {r["doc_id"]: r["shard"] for r in shard_rows(spark, [(i, "t") for i in at], 25, slack)}
    over = {i for i in at if old[i] != before[i] or new[i] != after[i]}
    assert {i for i in at if old[i] != new[i]} <= over | {i for i in at if after[i] == 24}


def test_overflow_goes_on_clockwise():
    points = sorted((p, s) for s, p in enumerate([100, 200, 300]))
    assert sharding.flow({0: 5}, points, [2, 2, 1]) == [(0, 0, 2, 0, 0), (0, 2, 4, 1, 0), (0, 4, 5, 2, 0)]


def judge(url, rules, default="allow"):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [i for i, c in enumerate(after) if c in "/?#"]
    host = after[: ends[0]] if ends else after
    rest = after[len(host) :]
    path = rest[: min([i for i, c in enumerate(rest) if c in "?#"], default=len(rest))]
    host = host.translate(LOWER)
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h is not None and p is not None and (host == h.translate(LOWER) or host.endswith("." + h.translate(LOWER))) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return (host, path, best[3] if best else None, best[4] if best else default)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


@pytest.mark.parametrize("block", [500_000, 2])
def test_url_rules(spark, monkeypatch, block):
    monkeypatch.setattr(url_rules, "BLOCK_RULES", block)
    draw = random.Random(4)
    names = ["com", "net", "a", "b", "example", "www", "exa", "", "É"]
    hosts = [".".join(draw.choice(names) for _ in range(draw.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/en/", "/e", "/en/x", "/es/", "/en/x/y", "en"]
    rules = RULES + [(draw.choice(hosts), draw.choice(paths), draw.choice(["allow", "block"])) for _ in range(40)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    more = [(None, "/", "block"), ("com", None, "block")]
    urls = [None, "", "no scheme", "http://", "://x", "http://com", "HTTP://WWW.Example.COM/en/?q", "a://b://com/en/", "http://com#/en/"]
    urls += ["http://example.com:80/en/", "http://u@example.com/en/x?y#z", "http://com\nx/y\nz", "http://x" + ".y" * 3000 + ".com/" + "p" * 9000]
    urls += [f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?q=://', '#f', 'x'])}" for _ in range(800)]
    pages = [(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, urls[6], "h", "v"), (3, "http://com/", "h", "v")] * 2
    df = spark.createDataFrame(pages, "page_id bigint, url string, host string, verdict string").repartition(5)
    known = spark.createDataFrame(rules + more, "host string, path string, verdict string")
    found = url_rules.judged(df, known).collect()
    want = [(p[0], *judge(p[1], rules)) for p in pages]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_url_rules_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert [tuple(r) for r in url_rules.judged(pages, none, "block").collect()] == [(1, "a.com", "/", None, "block")]
    assert url_rules.judged(pages.limit(0), spark.createDataFrame(RULES, none.schema)).collect() == []


def test_quality_learns_and_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    found = quality.scored(docs, labels.where(fold != 1)).join(labels, "doc_id").where(fold == 1)
    rows = found.select("predicted", "quality", "score").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.97
    clean = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in clean) / len(clean) >= 0.98


def test_quality_edge_cases(spark):
    good, bad = "plain words in a row. ", "%%% ### $$$ &&& "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5)) for i in range(40)]
    rows += [(None, good), (50, None), (51, ""), (52, " \n"), (53, "x" * 100_000), (1, good), (1, good)]
    docs = spark.createDataFrame([(*r, 1.0, "t") for r in rows], "doc_id bigint, text string, score double, TEXT string")
    labels = [(i, i % 2, 0) for i in range(30)] + [(31, None, 0), (33, 7, 0), (None, 1, 0)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = quality.scored(docs, known).collect()
    assert len(found) == len(rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in found if r["doc_id"] is not None and r["doc_id"] < 40)
    assert len({r["score"] for r in found if r["doc_id"] in (50, 51, 52)}) == 1
    kept = quality.filtered(docs, known)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 40").count() == sum(r[0] is not None and r[0] < 40 and r[0] % 2 for r in rows)
    untaught = quality.scored(docs, known.limit(0)).collect()
    assert {r["score"] for r in untaught} == {0.5}
    assert quality.scored(docs.limit(0), known).collect() == []


def test_subword_features():
    word, feature = quality.features(["ab", "abc"])
    assert sorted(word.tolist()).count(0) == 1 + 2 + 1  # <ab>: itself, 3-grams <ab ab>, 4-gram
    assert set(feature[word == 0]) & set(feature[word == 1])  # <ab is in both
    assert len(set(quality.pair_features(quality.hashed(["a", "b", "a", "b", "b"])[2]).tolist())) == 3  # ab, ba, bb


def test_quality_scores_are_averages_of_parts():
    """The worker's sums against a plain average over all features of a text."""
    draw = random.Random(5)
    parts = np.random.default_rng(3).normal(size=quality.FEATURES)
    scorer = quality.Scorer(parts, 0.25)
    for n in (0, 1, 2, 3, 50, 400):
        words = [draw.choice(["a", "bc", "déf", "x" * 150, "%%", "word"]) for _ in range(n)]
        distinct, counts = quality.bag(" ".join(words))
        logit = float(parts[distinct] @ counts / counts.sum()) + 0.25
        assert scorer.scores(pa.array([" ".join(words)]))[0] == pytest.approx(1 / (1 + math.exp(-logit)))


def test_quality_sample_has_both_labels_and_one_row_per_document(spark):
    docs = spark.createDataFrame([(i % 500, f"t{i % 7} x") for i in range(1000)] + [(7, "x")] * 50, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i >= 5)) for i in range(500)] * 2, "doc_id bigint, label int")
    bags, taught, prior = quality.sample(docs, labels, 40)
    assert Counter(taught) == {0: 5, 1: 35}
    assert prior == pytest.approx(math.log(495 / 5) - math.log(35 / 5))
    bags, taught, prior = quality.sample(docs, labels.withColumn("label", F.col("doc_id").cast("int") % 2), 40)
    assert Counter(taught) == {0: 20, 1: 20} and prior == 0
    assert quality.sample(docs, labels.where("label = 1"), 40)[0] == []


def test_lower_az_and_picked(spark):
    df = spark.createDataFrame([("ÀB",), ("ÀÉ",), ("AZ",), (None,)], "t string")
    assert [r[0] for r in df.select(common.lower_az(F.col("t"))).collect()] == ["Àb", "ÀÉ", "az", None]


@pytest.mark.parametrize("block", [500_000, 1])
def test_url_rules_of_equal_length(spark, monkeypatch, block):
    """The longer host wins, within a block of rules and across blocks; then block over allow."""
    monkeypatch.setattr(url_rules, "BLOCK_RULES", block)
    rules = [("example.com", "/abc/", "block"), ("www.example.com", "/", "allow"), ("a.b", "/", "allow"), ("a.b", "/", "block"), ("x", "", "block")]
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = ["http://www.example.com/abc/", "http://q.example.com/abc/", "http://a.b/", "http://y.x"]
    found = url_rules.judged(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), known).collect()
    want = [("www.example.com/", "allow"), ("example.com/abc/", "block"), ("a.b/", "block"), ("x", "block")]
    assert [(r["rule"], r["verdict"]) for r in sorted(found, key=lambda r: r["page_id"])] == want


def test_digest_index_stays(spark, tmp_path):
    """A batch that comes again, an index that is opened by its path, and one in fewer files."""
    from assayer.session import clear_scratch

    path = f"{tmp_path}/index"

    def run(index, rows, batch):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        return sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.deduplicated(df, index, batch=batch).collect())

    first = [(1, "a"), (2, "A"), (3, "b")]
    index = exact_dedup.DigestIndex(spark, path=path)
    once = run(index, first, "one")
    assert once == [(1, 2, False), (2, 2, True), (3, 3, True)]
    assert run(index, first, "one") == once
    assert index.rows().count() == 2
    assert run(index, first, "two") == [(1, 2, False), (2, 2, False), (3, 3, False)]
    clear_scratch(spark)
    spark.sql(f"DROP TABLE {index.table}")
    again = exact_dedup.DigestIndex(spark, path=path)
    assert again.rows().count() == 2 and again.buckets == index.buckets
    assert run(again, [(9, "B"), (10, "c")], "three") == [(9, 3, False), (10, 10, True)]
    small = again.compacted(f"{tmp_path}/small")
    assert sorted(map(tuple, small.rows().collect())) == sorted(map(tuple, again.rows().collect()))
    assert run(small, first, "one") == once


def test_quality_sample_is_learned_from_outside_the_driver(spark, monkeypatch):
    text = F.expr("concat_ws(' ', transform(sequence(0, 99), i -> hash(id, i)))").alias("text")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), text)
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("quality"))
    bags, taught, prior = quality.sample(docs, labels.withColumnRenamed("quality", "label"))
    scorer = quality.Scorer(quality.trained(bags, taught), prior)
    wanted = {r["doc_id"]: scorer.scores(pa.array([r["text"]]))[0] for r in docs.collect()}
    came, kind = [], type(docs)
    for name in ("collect", "toPandas", "toArrow"):
        monkeypatch.setattr(kind, name, lambda self, f=getattr(kind, name): came.append(out := f(self)) or out)
    found = quality.scored(docs, labels)
    monkeypatch.undo()
    assert sum(len(pickle.dumps(out)) for out in came) < 16 * quality.FEATURES  # the sample has several times that
    assert {r["doc_id"]: r["score"] for r in found.collect()} == wanted
