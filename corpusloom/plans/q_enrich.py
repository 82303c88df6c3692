"""Categories and personal data over the documents, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import categories, pii
from corpusloom.plans.fixture import texts

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


_MODEL = r"""b AS (SELECT doc_id, lang, doc_id % 4 = 2 AS held, list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), lambda w: CAST('0x' || left(md5(w), 4) AS INTEGER)) AS ws FROM documents),
t AS (SELECT lang, unnest(ws) AS w FROM b WHERE NOT held AND lang IS NOT NULL), n AS (SELECT lang, w, count(*) AS n FROM t GROUP BY ALL),
p AS (SELECT lang, count(*) AS docs, coalesce((SELECT sum(n) FROM n WHERE n.lang = b.lang), 0) AS words FROM b WHERE NOT held AND lang IS NOT NULL GROUP BY lang),
d AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w FROM b) GROUP BY ALL),
s AS (
  SELECT b.doc_id, p.lang AS label, ln(p.docs / (SELECT sum(docs) FROM p)) + coalesce(sum(tf * ln((coalesce(n.n, 0) + 1.0) / (p.words + 65536.0))), 0) AS score
  FROM b CROSS JOIN p LEFT JOIN d ON d.doc_id = b.doc_id LEFT JOIN n ON n.lang = p.lang AND n.w = d.w GROUP BY b.doc_id, p.lang, p.docs),
c AS (SELECT doc_id, arg_max(label, score) AS category FROM s GROUP BY doc_id)"""


def _categorised(spark, sf_dir):
    docs = texts(spark, sf_dir)
    return categories.categorised(docs, categories.trained(docs.where("doc_id % 4 <> 2"), "lang"))


@query(f"WITH {_MODEL} SELECT doc_id, held, category FROM b JOIN c USING (doc_id)")
def auto_category(spark, sf_dir):
    """Each document's category, learnt from the languages of three quarters of them."""
    return _categorised(spark, sf_dir).select("doc_id", (F.col("doc_id") % 4 == 2).alias("held"), "category")


@query(f"WITH {_MODEL}, h AS (SELECT lang, category FROM b JOIN c USING (doc_id) WHERE held) SELECT count(*) AS documents, round(avg(CAST(lang = category AS INTEGER)), 6) AS accuracy, round((SELECT max(n) FROM (SELECT count(*) AS n FROM h GROUP BY lang)) / count(*), 6) AS majority FROM h")
def category_accuracy(spark, sf_dir):
    """Accuracy on the documents held out, beside the share of the commonest category among them."""
    held = _categorised(spark, sf_dir).where("doc_id % 4 = 2")
    by = held.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("category")).alias("right"))
    return by.agg(F.sum("n").alias("documents"), F.round(F.sum("right") / F.sum("n"), 6).alias("accuracy"), F.round(F.max("n") / F.sum("n"), 6).alias("majority"))


@query()
def pii_spans(spark, sf_dir):
    """Every span of personal data: where it is in the original and in the redacted text, and that the way back is exact."""
    docs = texts(spark, sf_dir).select("doc_id", "text", pii.spans("text").alias("found"))
    whole = docs.withColumns({"redacted": pii.redacted(F.col("text"), F.col("found")), "table": pii.offsets(F.col("found")), "held": pii.values(F.col("text"), F.col("found"))})
    exact = pii.restored(F.col("redacted"), F.col("table"), F.col("held")) == F.col("text")
    return whole.select("doc_id", exact.alias("exact"), F.posexplode(F.arrays_zip("table", "held")).alias("nth", "x")).select("doc_id", "nth", "x.table.*", F.col("x.held").alias("value"), "exact")
