"""Queries over the search index, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import hybrid
from corpusloom.plans.fixture import read
from corpusloom.sources.scratch import new_path

QUERIES, ORACLES = {}, {}
WORDS, PHRASE, PROBE = "the theable ertionst lech", "the the", 7


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


def index(spark, sf_dir, vectors=False):
    path = new_path(spark, "index")
    built = hybrid.build(read(spark, sf_dir, "documents"), path, attributes=("lang", "source"))
    if vectors:
        hybrid.build_vectors(read(spark, sf_dir, "embeddings"), path)
    return built


_W = r"""w AS (SELECT doc_id, lang, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents)"""
_BM25 = f"""{_W}, st AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w),
p AS (SELECT doc_id, lang, l, term, count(*) AS tf FROM (SELECT doc_id, lang, len(w) AS l, unnest(w) AS term FROM w) WHERE term IN ({", ".join(f"'{x}'" for x in WORDS.split())}) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (
  SELECT doc_id, lang, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))) AS score FROM p JOIN df USING (term), st GROUP BY ALL)"""


@query(f"WITH {_BM25} SELECT doc_id, round(score, 6) AS score FROM s ORDER BY round(score, 9) DESC, doc_id LIMIT 50")
def search_words(spark, sf_dir):
    return index(spark, sf_dir).by_words(WORDS, 50).select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"""WITH {_W} SELECT doc_id, CAST(count(*) AS BIGINT) AS places FROM (SELECT doc_id, unnest(list_zip(w, w[2:])) AS pair FROM w WHERE lang = 'en') WHERE pair[1] = 'the' AND pair[2] = 'the' GROUP BY doc_id""")
def search_phrase(spark, sf_dir):
    return index(spark, sf_dir).by_phrase(PHRASE, F.col("lang") == "en").select(F.col("key").alias("doc_id"), "places")


@query(f"""WITH {_BM25},
a AS (SELECT doc_id, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS word_rank FROM s WHERE lang = 'en' QUALIFY word_rank <= 100),
q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {PROBE}),
b AS (
  SELECT vec_id AS doc_id, row_number() OVER (ORDER BY round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) DESC, vec_id) AS vector_rank
  FROM embeddings, q WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en') QUALIFY vector_rank <= 100)
SELECT doc_id, round(coalesce(1.0 / (60 + word_rank), 0) + coalesce(1.0 / (60 + vector_rank), 0), 6) AS score, CAST(word_rank AS INTEGER) AS word_rank, CAST(vector_rank AS INTEGER) AS vector_rank
FROM a FULL JOIN b USING (doc_id) ORDER BY round(coalesce(1.0 / (60 + word_rank), 0) + coalesce(1.0 / (60 + vector_rank), 0), 9) DESC, doc_id LIMIT 50""")
def search_hybrid(spark, sf_dir):
    """Words, a vector and a filter on metadata; all cells are searched, so that the result is exact."""
    vector = read(spark, sf_dir, "embeddings").where(F.col("vec_id") == PROBE).first()["embedding"]
    found = index(spark, sf_dir, vectors=True).hybrid(WORDS, vector, 50, F.col("lang") == "en")
    return found.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"), "word_rank", "vector_rank")
