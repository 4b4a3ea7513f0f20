"""The registered queries of the subpackage on whole small tables: columns, checking SQL, and the pipeline by stages."""

import duckdb
import pytest

import corpus_pipeline
from assayer.llm import ngram_join
from assayer.llm.queries import QUERIES, SQL
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "vec_id n_links component_id kept",
    "op2": "page_id host path rule verdict",
    "op3": "doc_id n_shingles component_id",
    "op4": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5": "doc_id n_bytes n_tokens over_limit",
    "op6": "doc_id keep_id group_size kept text_sha256",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op9": "doc_id held_out score predicted",
    "op10": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11": "query_id rank vec_id score",
    "op12": "doc_id n_features weight score rank",
    "op13": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    database = duckdb.connect()
    for t in TABLES:
        database.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    outcome = compare(QUERIES[name], SQL.get(name), spark, database, FOLDER, [])
    assert outcome.startswith("ok" if name in SQL else "rows only"), outcome
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(QUERIES[name](spark, FOLDER).columns)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_classifier"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert sum(labels.get(r["doc_id"]) == 1 and r["doc_id"] not in ids for r in rows) <= 0.02 * len(rows)

    unique = stages["exact_dedup"](spark, docs, FOLDER)
    largest = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        largest[r["text"]] = r["doc_id"]
    assert unique.columns == docs.columns
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(largest.values())

    found = stages["ngram_jaccard_join"](spark, docs, FOLDER)
    classes = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(docs, 80, 5).collect()}
    assert found.columns == docs.columns
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(set(classes.values()))

    packed = stages["best_fit_packing"](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows}


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, repeated rows, and no rows at all."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (3, "same text", None, "s", 9)]
    rows += [(4, "SAME text", "de", "s", 9), (5, "x " * 4000, "en", "s", 8000), (5, "x " * 4000, "en", "s", 8000)]
    for odd in (rows, []):
        docs = spark.createDataFrame(odd, schema)
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, FOLDER)
            if name != "best_fit_packing":
                assert found.columns == docs.columns
                assert found.count() <= len(odd)
            else:
                assert found.count() >= len(odd)
    only = corpus_pipeline.exact_dedup_stage(spark, spark.createDataFrame(rows, schema), FOLDER)
    assert sorted((r["doc_id"] or 0) for r in only.collect()) == [0, 2, 4, 5, 5]


def test_pipeline_runs(spark):
    assert set(COLUMNS["op4"].split()) <= set(corpus_pipeline.run(spark, FOLDER).columns)


def test_pipeline_stages_drop_rows_not_ids(spark, tmp_path):
    """An id with two texts loses only the copy; copies without an id are copies too. From memory and from files."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(i, t, "en", "s", 1) for i, t in [(7, a), (7, b), (9, a), (None, c), (None, c), (None, b)]]
    docs = spark.createDataFrame(rows, schema)
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    for given in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        exact = corpus_pipeline.exact_dedup_stage(spark, given, FOLDER).collect()
        assert sorted((r["doc_id"] or 0, r["text"]) for r in exact) == [(0, c), (7, b), (9, a)]
        near = corpus_pipeline.ngram_join_stage(spark, given, FOLDER).collect()
        assert sorted((r["doc_id"] or 0, r["text"]) for r in near) == [(0, c), (7, a), (7, b)]


def test_pipeline_stages_with_clashing_names(spark, tmp_path):
    """Extra columns that are named as what stages add or as what Spark keeps of files. From memory and from files."""
    extra = ["path", "place", "file", "_metadata", "component_id", "digest", "family", "size", "keep_id", "row_key"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in extra)
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(i, t, "en", "s", 1, *extra) for i, t in [(1, a), (2, a), (3, b), (4, b + " more"), (None, a)]]
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/docs")
    for given in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        for name, stage in corpus_pipeline.STAGES[1:3]:
            found = stage(spark, given, FOLDER)
            assert found.columns == given.columns
            assert sorted(r["doc_id"] for r in found.collect()) == ([2, 3, 4] if name == "exact_dedup" else [1, 3])
            assert {tuple(r[c] for c in extra) for r in found.collect()} == {tuple(extra)}
