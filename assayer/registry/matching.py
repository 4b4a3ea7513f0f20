"""Queries over skills, pairs, text vectors, models and match scores.

Skills are the one- to three-word phrases of ``benchmark``; resumes are all ``documents``, jobs all ``benchmark`` texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.matching import models, pairs, skills, text_vectors
from assayer.matching.score import WEIGHTS, match_scores
from assayer.registry.catalog import query
from assayer.registry.inputs import stored
from assayer.session import lean, pinned, removed

PERCENT = 3  # of a job's skills that a pair shares at least
TOP = 10
DIMENSIONS = 16


def _split(identifier: str, table: str) -> str:
    return f"SELECT {identifier} AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}+#]+') AS w FROM {table}"


def _runs(split: str) -> str:
    return f"""SELECT id, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
        FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM ({split}) s, (SELECT unnest([1, 2, 3]) AS n) l)"""


_DOCUMENTS, _JOBS = _split("doc_id", "documents"), _split("item_id", "benchmark")
_VOCABULARY = f"vocabulary AS MATERIALIZED (SELECT DISTINCT phrase FROM ({_runs(_JOBS)}))"


def _matches(split: str, name: str) -> str:
    """The longest match from each place, without those that lie in the match of one of the two places before."""
    return f"""{name}_at AS MATERIALIZED (SELECT id, p, max(n) AS n, arg_max(phrase, n) AS phrase FROM ({_runs(split)})
        WHERE phrase IN (SELECT phrase FROM vocabulary) GROUP BY id, p),
    {name} AS MATERIALIZED (SELECT id, phrase, count(*) AS n FROM {name}_at a
        WHERE NOT EXISTS (SELECT 1 FROM {name}_at b WHERE b.id = a.id AND b.p = a.p - 1 AND b.n > a.n)
        AND NOT EXISTS (SELECT 1 FROM {name}_at b WHERE b.id = a.id AND b.p = a.p - 2 AND b.n > a.n + 1) GROUP BY id, phrase)"""


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return skills.phrases(stored(spark, folder, "benchmark"))


def found_skills(spark: SparkSession, folder: str, table: str, id_column: str, packed: bool = False) -> DataFrame:
    return skills.extracted(stored(spark, folder, table), vocabulary(spark, folder), id_column, packed=packed)


@query("j3_skill_extraction", f"WITH {_VOCABULARY}, {_matches(_DOCUMENTS, 'found')} SELECT id AS doc_id, phrase, n FROM found")
def skill_extraction(spark, folder):
    return found_skills(spark, folder, "documents", "doc_id")


# The checking engine measures edits in bytes, so each letter beyond ASCII becomes one that no lower-case word has.
_BYTES = "translate({0}, 'éèñßêçíöüóäáàâîïôûùúëœæå', 'ABCDEFGHIJKLMNOPQRSTUVWX')"


@query(
    "j3_skill_normalisation",
    f"""WITH names AS (SELECT DISTINCT unnest(w) AS name FROM ({_DOCUMENTS})),
    skills AS (SELECT DISTINCT unnest(w) AS skill FROM ({_JOBS})),
    near AS (SELECT name, skill, levenshtein({_BYTES.format('name')}, {_BYTES.format('skill')}) AS distance
        FROM names JOIN skills ON abs(len(name) - len(skill)) <= 2)
    SELECT n.name, b.skill, CAST(b.distance AS INTEGER) AS distance FROM names n LEFT JOIN
        (SELECT name, skill, distance FROM near WHERE distance <= 2
         QUALIFY row_number() OVER (PARTITION BY name ORDER BY distance, skill) = 1) b ON b.name = n.name""",
)
def skill_normalisation(spark, folder):
    names = stored(spark, folder, "documents").select(F.explode(skills.words(F.col("text"))).alias("name"))
    known = stored(spark, folder, "benchmark").select(F.explode(skills.words(F.col("text"))).alias("skill"))
    return skills.normalised(names, known)


def sets_of(spark: SparkSession, folder: str) -> pairs.SkillSets:
    resumes = found_skills(spark, folder, "documents", "doc_id", True).withColumnRenamed("phrases", "skill")
    jobs = found_skills(spark, folder, "benchmark", "item_id", True).withColumnRenamed("phrases", "skill")
    return pairs.skill_sets(resumes, jobs, ("doc_id", "item_id"))


_SETS = f"""WITH {_VOCABULARY}, {_matches(_DOCUMENTS, 'resumes')}, {_matches(_JOBS, 'jobs')},
    total AS (SELECT (SELECT count(DISTINCT id) FROM resumes) + (SELECT count(DISTINCT id) FROM jobs) AS total),
    known AS MATERIALIZED (SELECT phrase, count(*) AS f, row_number() OVER (ORDER BY count(*), phrase) AS place,
        CAST(floor(1000000 * ln((1 + (SELECT total FROM total)) / (1 + count(*)))) AS BIGINT) AS weight
        FROM (SELECT phrase FROM resumes UNION ALL SELECT phrase FROM jobs) GROUP BY phrase),
    left_n AS (SELECT id, count(*) AS n FROM resumes GROUP BY id),
    right_n AS (SELECT id, count(*) AS n, sum(weight) AS weight FROM jobs JOIN known USING (phrase) GROUP BY id),
    met AS MATERIALIZED (SELECT r.id AS left_id, j.id AS right_id, count(*) AS shared, sum(weight) AS weight
        FROM resumes r JOIN jobs j USING (phrase) JOIN known USING (phrase) GROUP BY r.id, j.id),
    pairs AS MATERIALIZED (SELECT left_id, right_id, shared, a.n AS left_n, b.n AS right_n, met.weight AS shared_weight,
        b.weight AS weight FROM met JOIN left_n a ON a.id = left_id JOIN right_n b ON b.id = right_id
        WHERE 100 * shared >= {PERCENT} * b.n)"""


@query("j4_pairs", f"{_SETS} SELECT left_id, right_id, CAST(shared AS INTEGER) AS shared, left_n, right_n FROM pairs")
def matched(spark, folder):
    return pairs.matched_pairs(sets_of(spark, folder), PERCENT)[0]


@query(
    "j4_candidates",
    f"""{_SETS}, prefix AS (SELECT id, phrase, place FROM (SELECT j.id, phrase, place, k.n,
        row_number() OVER (PARTITION BY j.id ORDER BY place) AS nth FROM jobs j JOIN known USING (phrase) JOIN
        right_n k ON k.id = j.id) WHERE nth <= n - (({PERCENT} * n + 99) // 100) + 1)
    SELECT r.id AS left_id, p.id AS right_id, arg_min(phrase, place) AS skill FROM resumes r JOIN prefix p USING (phrase)
    GROUP BY r.id, p.id""",
)
def candidates(spark, folder):
    sets = sets_of(spark, folder)
    found = pairs.matched_pairs(sets, PERCENT)[1]
    return found.join(sets.skills, F.col("first") == F.col("code")).select("left_id", "right_id", "skill")


_FEATURES = f"""{_SETS}, absent AS (SELECT left_id, right_id, string_agg(phrase, '; ' ORDER BY phrase) AS missing FROM pairs JOIN jobs j
        ON j.id = right_id WHERE NOT EXISTS (SELECT 1 FROM resumes r WHERE r.id = left_id AND r.phrase = j.phrase) GROUP BY ALL),
    features AS (SELECT left_id, right_id, shared, left_n, right_n, shared / left_n AS coverage_left, shared / right_n AS coverage_right,
        shared / (left_n + right_n - shared) AS jaccard, CASE WHEN weight > 0 THEN shared_weight / weight ELSE 0 END AS weighted_coverage,
        right_n - shared AS missing_n, coalesce(missing, '') AS missing FROM pairs LEFT JOIN absent USING (left_id, right_id))"""
_SHARES = ("coverage_left", "coverage_right", "jaccard", "weighted_coverage")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def features(spark: SparkSession, folder: str, sets: pairs.SkillSets) -> DataFrame:
    return pairs.pair_features(pairs.matched_pairs(sets, PERCENT)[0], sets)


@query(
    "j4_pair_features",
    f"""{_FEATURES} SELECT left_id, right_id, shared, left_n, right_n, {', '.join(f'round({c}, 6) AS {c}' for c in _SHARES)},
    missing_n, missing FROM features""",
)
def pair_features(spark, folder):
    return _rounded(features(spark, folder, sets_of(spark, folder)), *_SHARES)


_TERMS = f"""doc_terms AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM ({_DOCUMENTS})) GROUP BY ALL),
    job_terms AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM ({_JOBS})) GROUP BY ALL),
    model AS MATERIALIZED (SELECT term, count(*) AS df, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS term_id
        FROM doc_terms GROUP BY term)"""


def _vectors(name: str, counts: str) -> str:
    return f"""{name}_raw AS (SELECT id, term_id, tf, df, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS raw
        FROM {counts} JOIN model USING (term)),
    {name} AS MATERIALIZED (SELECT id, term_id, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM {name}_raw)"""


def text_model(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, text_vectors.TermModel]:
    documents = stored(spark, folder, "documents")
    counts = text_vectors.term_counts(documents, "doc_id")
    model = text_vectors.fitted(counts, documents.count())
    return counts, text_vectors.packed_vectors(counts, model), model


@query(
    "j5_tfidf",
    f"WITH {_TERMS}, {_vectors('v', 'doc_terms')} SELECT id AS doc_id, term_id, tf, df, round(weight, 6) AS weight FROM v",
)
def tfidf(spark, folder):
    return _rounded(text_vectors.unpacked(text_model(spark, folder)[1]).withColumnRenamed("id", "doc_id"), "weight")


_COSINES = f"""{_TERMS}, {_vectors('v', 'doc_terms')}, {_vectors('q', 'job_terms')}"""


@query(
    "j5_cosine_top",
    f"""WITH {_COSINES}, scores AS (SELECT q.id AS item_id, v.id AS doc_id, round(sum(q.weight * v.weight), 9) AS score
        FROM q JOIN v USING (term_id) GROUP BY q.id, v.id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id,
        round(score, 6) AS score FROM scores QUALIFY rank <= {TOP}""",
)
def cosine_top(spark, folder):
    _, right, model = text_model(spark, folder)
    left = text_vectors.packed_vectors(text_vectors.term_counts(stored(spark, folder, "benchmark"), "item_id"), model)
    found = text_vectors.cosine_top(left, right, TOP)
    return _rounded(found.toDF("item_id", "rank", "doc_id", "score"), "score")


@query("j5_embeddings")
def embeddings(spark, folder):
    """No SQL: the tests hold the singular values and the space against a full decomposition."""
    with lean(spark):
        counts, packed, model = text_model(spark, folder)
    removed(counts, model.terms)
    found, values = text_vectors.embedded(packed, DIMENSIONS, spent=True)
    strengths = F.array(*[F.lit(v) for v in values])
    return found.select(F.col("id").alias("doc_id"), "embedding", strengths.alias("singular_values"))


_LEARNED = "coalesce(pmod(id, 5) <> 0, false)"


@query(
    "j6_category",
    f"""WITH {_TERMS}, learned AS (SELECT doc_id AS id, lang AS label FROM documents WHERE doc_id % 5 <> 0 AND lang IS NOT NULL),
    counted AS MATERIALIZED (SELECT label, term, sum(tf) AS n FROM doc_terms JOIN learned USING (id) GROUP BY ALL),
    classes AS MATERIALIZED (SELECT label, count(*) AS texts, (SELECT sum(n) FROM counted c WHERE c.label = l.label)
        + (SELECT count(DISTINCT term) FROM counted) + 1.0 AS base FROM learned l GROUP BY label),
    gains AS (SELECT id, c.label, sum(tf * (ln((c.n + 1) / base) - ln(1 / base))) AS gain
        FROM doc_terms JOIN counted c USING (term) JOIN classes k ON k.label = c.label GROUP BY ALL),
    lengths AS (SELECT id, sum(tf) AS words FROM doc_terms GROUP BY id),
    scores AS (SELECT d.doc_id AS id, k.label, ln(texts / (SELECT count(*) FROM learned)) + coalesce(words, 0) * ln(1 / base)
        + coalesce(gain, 0) AS score FROM documents d CROSS JOIN classes k LEFT JOIN lengths l ON l.id = d.doc_id
        LEFT JOIN gains g ON g.id = d.doc_id AND g.label = k.label),
    best AS (SELECT id, label AS predicted, score, score - lead(score) OVER w AS margin, row_number() OVER w AS place FROM scores
        WINDOW w AS (PARTITION BY id ORDER BY score DESC, label))
    SELECT doc_id AS id, coalesce(doc_id % 5 <> 0, false) AS learned, lang AS label, predicted, round(score, 3) AS score,
        round(margin, 3) AS margin FROM documents LEFT JOIN best ON id = doc_id AND place = 1""",
)
def category(spark, folder):
    documents = stored(spark, folder, "documents")
    counts = text_vectors.term_counts(documents, "doc_id")
    texts = documents.select(F.col("doc_id").alias("id"), "lang")
    found = models.classified(counts, texts, "lang", F.expr(_LEARNED))
    return found.withColumns({"score": F.round("score", 3), "margin": F.round("margin", 3)})


@query(
    "j6_regression",
    # Within levels the means fall out, which leaves two numbers to solve for.
    """WITH t AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y, l_returnflag AS c FROM lineitem),
    m AS (SELECT c, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM t GROUP BY c),
    s AS (SELECT sum((a - ma) ** 2) AS aa, sum((b - mb) ** 2) AS bb, sum((a - ma) * (b - mb)) AS ab, sum((a - ma) * (y - my)) AS ay,
        sum((b - mb) * (y - my)) AS byy FROM t JOIN m USING (c)),
    k AS (SELECT (ay * bb - byy * ab) / (aa * bb - ab * ab) AS ka, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS kb FROM s),
    i AS (SELECT c, my - ka * ma - kb * mb AS i, row_number() OVER (ORDER BY c) AS n FROM m, k),
    fit AS (SELECT sum((y - i - ka * a - kb * b) ** 2) AS residual, count(*) AS n, var_pop(y) * count(*) AS spread
        FROM t JOIN i USING (c), k),
    rows AS (SELECT 0 AS ordinal, 'intercept' AS term, (SELECT i FROM i WHERE n = 1) AS coefficient, 'fitted' AS status
        UNION ALL SELECT 1, 'l_quantity', ka, 'fitted' FROM k UNION ALL SELECT 2, 'l_discount', kb, 'fitted' FROM k
        UNION ALL SELECT 2 + n, 'l_returnflag=' || c, CASE WHEN n > 1 THEN i - (SELECT i FROM i WHERE n = 1) END,
        CASE WHEN n > 1 THEN 'fitted' ELSE 'baseline' END FROM i)
    SELECT CAST(ordinal AS INTEGER) AS ordinal, term, round(coefficient, 4) AS coefficient, status, fit.n, round(1 - residual / spread, 6) AS r2,
        round(sqrt(residual / fit.n), 4) AS rmse FROM rows, fit""",
)
def amount_regression(spark, folder):
    found = models.regression(stored(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], ["l_returnflag"])
    fit = found.diagnostics.select("n", F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"))
    return found.coefficients.withColumn("coefficient", F.round("coefficient", 4)).join(F.broadcast(fit))


_SCORE = " + ".join(f"{w} * {c}_share" for c, w in WEIGHTS.items())
_PLACES = ", ".join(f"cume_dist() OVER (ORDER BY {c}) AS {c}_share" for c in WEIGHTS)


@query(
    "j7_match_score",
    f"""{_FEATURES}, {_COSINES}, cosines AS (SELECT v.id AS left_id, q.id AS right_id, round(sum(q.weight * v.weight), 9) AS cosine
        FROM q JOIN v USING (term_id) GROUP BY v.id, q.id),
    all_features AS (SELECT f.*, coalesce(cosine, 0) AS cosine FROM features f LEFT JOIN cosines USING (left_id, right_id)),
    placed AS (SELECT *, {_PLACES} FROM all_features),
    scored AS (SELECT *, round({_SCORE}, 9) AS score FROM placed)
    SELECT left_id, right_id, missing, round(cosine, 6) AS cosine, round(weighted_coverage, 6) AS weighted_coverage,
        round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS INTEGER) AS rank
    FROM scored QUALIFY rank <= {TOP}""",
)
def match_score(spark, folder):
    sets = sets_of(spark, folder)
    found = pinned(pairs.matched_pairs(sets, PERCENT)[0])
    documents = stored(spark, folder, "documents")
    counts = text_vectors.term_counts(documents, "doc_id")
    model = text_vectors.fitted(counts, documents.count())
    # the model is that of all documents; vectors are needed of those in a pair
    paired = pinned(found.select(F.col("left_id").alias("id")).distinct())
    right = text_vectors.packed_vectors(counts.join(paired, "id", "left_semi"), model)
    jobs = text_vectors.packed_vectors(text_vectors.term_counts(stored(spark, folder, "benchmark"), "item_id"), model)
    cosines = text_vectors.cosines(found.select("left_id", "right_id"), right, jobs)
    # the missing skills are looked up for the best pairs only
    found = pairs.pair_features(found, sets, missing=False).join(cosines.withColumnRenamed("score", "cosine"), ["left_id", "right_id"], "left")
    found = found.select("left_id", "right_id", "cosine", "weighted_coverage", "coverage_left", "coverage_right")
    scores = pinned(match_scores(found.fillna(0.0, ["cosine"]), TOP))
    missing = pairs.pair_features(scores, sets).select("left_id", "right_id", "missing")
    kept = scores.join(missing, ["left_id", "right_id"])
    kept = kept.select("left_id", "right_id", "missing", "cosine", "weighted_coverage", "score", "rank")
    return _rounded(kept, "cosine", "weighted_coverage", "score")
