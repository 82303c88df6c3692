"""How the sources of a language differ in their words: exact distances of all pairs and the terms a source over-uses.

Three steps. Each task counts the terms of its texts with DuckDB, so a frequent term leaves it as one row a source and language;
the counts are hashed by language and term into shards, where DuckDB adds them up and keeps the terms in at least `MIN_DOCS`
documents of their language. The kept counts are written to the shared folder. Then, per shard, DuckDB works out every source's
smoothed shares of the shard's terms, partial sums of their differences for each pair of sources, and each source's best terms.
Spark adds up the partial sums and ranks.

A language, source or term with a third of all rows is spread over shards by term, and meets as one partial count a task. A shard holds
about `SHARD_ROWS` kept counts. The table of (language, source) groups is dealt to every shard through the shuffle; the pairs are as many
as the result's. Shares are whole numbers, so all sums are exact.

Defined cases: null texts, languages and sources are empty strings, which are values like any other; groups without terms take part
with counts of 0; a language without kept terms has distances of 0; ties go by the item's UTF-8 bytes; repeated rows count
each; ids do not matter; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_batches, pieces, table, written

MIN_DOCS, TOP, SHARD_ROWS = 30, 50, 50_000
#: Partial counts in a task before they are added up, or leave it.
PART_ROWS = 400_000
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

_COUNT = rf"""
WITH words AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, {_AZ}), '{TERM}')) AS term FROM texts),
  in_doc AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY id, lang, source, term)
SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, count(*) AS docs FROM in_doc GROUP BY lang, source, term"""
_MERGE = "SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, CAST(sum(docs) AS BIGINT) AS docs FROM part GROUP BY lang, source, term"
_KEEP = f"""
WITH merged AS ({_MERGE}), kept AS (SELECT lang, term FROM merged GROUP BY lang, term HAVING sum(docs) >= $least)
SELECT lang, source, term, n, docs FROM merged SEMI JOIN kept USING (lang, term)"""
#: A share in billionths: whole numbers of 128 bits until the division, so counts of any size are exact.
_SHARE = "CAST(1 + (CAST(1000000000 AS HUGEINT) * ({n} + 5)) // ({total} + 5 * CAST(vocabulary AS HUGEINT)) AS BIGINT)"
_PAIRS = f"""
WITH terms AS (SELECT DISTINCT lang, term FROM counts),
  shares AS (
    SELECT lang, term, source, {_SHARE.format(n="coalesce(n, 0)", total="total")} AS p
    FROM terms JOIN groups USING (lang) LEFT JOIN counts USING (lang, term, source))
SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
FROM shares a JOIN shares b USING (lang, term) WHERE a.source < b.source GROUP BY ALL"""
_TERMS = f"""
WITH whole AS (SELECT lang, term, sum(n) AS all_n FROM counts GROUP BY lang, term),
  excess AS (
    SELECT lang, source, term AS item, {_SHARE.format(n="n", total="total")} - {_SHARE.format(n="all_n", total="lang_total")} AS value
    FROM counts JOIN whole USING (lang, term) JOIN groups USING (lang, source) WHERE n > 0)
SELECT lang, source, item, value FROM excess WHERE value > 0
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= $top"""


def _connect() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"threads": 1, "memory_limit": "700MB"})
    con.execute("CREATE TABLE part (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)")
    return con


def _batches(con: duckdb.DuckDBPyConnection, sql: str, schema: pa.Schema, **params: int) -> Iterator[pa.RecordBatch]:
    rows = con.sql(sql, params=params).to_arrow_table().select(schema.names).cast(schema)
    yield from rows.to_batches(max_chunksize=20_000)


def _added(con: duckdb.DuckDBPyConnection, sql: str) -> int:
    con.execute(f"INSERT INTO part {sql}")
    return con.execute("SELECT count(*) FROM part").fetchall()[0][0]


def partial_counts(docs: DataFrame) -> DataFrame:
    """`_COUNTS` of each task's texts; docs are numbers of rows with the term."""
    bounded_batches(docs.sparkSession)
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect()
        for batch in batches:
            for part in pieces(batch, column=2):
                con.register("texts", pa.Table.from_batches([part.append_column("id", pa.array(range(part.num_rows), pa.int64()))]))
                rows = _added(con, _COUNT)
                con.unregister("texts")
                if rows > PART_ROWS:
                    yield from _batches(con, _MERGE, _COUNTS)
                    con.execute("TRUNCATE part")
        yield from _batches(con, _MERGE, _COUNTS)

    return src.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_counts(counts: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """Counts by lang, source and term, of terms in at least `least` documents of their language; shards by language and term."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, after = _connect(), PART_ROWS
        for batch in batches:
            con.register("more", pa.Table.from_batches([batch]))
            rows = _added(con, "SELECT * FROM more")
            con.unregister("more")
            if rows > after:
                con.execute(f"CREATE OR REPLACE TABLE merged AS {_MERGE}")
                con.execute("TRUNCATE part")
                after = max(PART_ROWS, 2 * _added(con, "SELECT * FROM merged"))
                con.execute("DROP TABLE merged")
        yield from _batches(con, _KEEP, _COUNTS, least=least)

    return counts.repartition("lang", "term").mapInArrow(keep, counts.schema)


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (lang, source): total and lang_total (kept terms' occurrences there and in the language), vocabulary."""
    here = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    words = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("vocabulary"))
    zero = F.lit(0).cast("long")
    return here.join(totals, ["lang", "source"], "left").join(words, "lang", "left").select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "vocabulary")])


def differences(kept: DataFrame, groups: DataFrame, shards: int, top: int = TOP) -> DataFrame:
    """Partial results of every shard: lang, source, item, value; part 'pair' once a pair, part 'term' at most `top` a group."""
    spread = kept.select(F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard"), "lang", "source", "term", "n")
    every = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = spread.unionByName(every, allowMissingColumns=True)
    out = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def work(rows: pa.Table) -> pa.Table:
        con = _connect()
        con.register("rows", rows)
        con.execute("CREATE TABLE groups AS SELECT lang, source, total, lang_total, vocabulary FROM rows WHERE term IS NULL")
        con.execute("CREATE TABLE counts AS SELECT lang, source, term, n FROM rows WHERE term IS NOT NULL")
        found = []
        for part, sql, params in (("pair", _PAIRS, {}), ("term", _TERMS, {"top": top})):
            t = con.sql(sql, params=params).to_arrow_table().select(out.names).cast(out)
            found.append(t.append_column("part", pa.array([part] * len(t), pa.string())))
        con.close()
        return pa.concat_tables(found)

    return rows.groupBy("shard").applyInArrow(work, "lang string, source string, item string, value long, part string")


def audit(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' has every other source of the language, 'term' at most `top` terms."""
    kept = written(kept_counts(partial_counts(docs), least), "counts")
    groups = written(groups_of(docs, kept), "groups")
    parts = written(differences(kept, groups, max(8, -(-kept.count() // SHARD_ROWS)), top), "differences")
    halves = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = halves.union(halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = groups.select("lang", "source")
    pairs = names.join(names.select("lang", F.col("source").alias("item")), "lang").where("source <> item").join(both, ["lang", "source", "item"], "left")
    terms = parts.where("part = 'term'").select("lang", "source", "item", "value", F.lit("term").alias("part"))
    every = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"), F.lit("pair").alias("part"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return every.withColumn("rank", F.row_number().over(order)).unionByName(best).select("lang", "source", "part", "item", "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def _share(n: str, total: str) -> str:
    return f"CAST(1 + (CAST(1000000000 AS HUGEINT) * ({n} + 5)) // ({total} + 5 * CAST(v AS HUGEINT)) AS BIGINT)"


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, {_AZ}), '{TERM}')) AS term FROM d),
keep AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN keep USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM keep GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(t, 0) AS t, coalesce(lt, 0) AS lt, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS t FROM c GROUP BY lang, source) USING (lang, source)),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, {_share("coalesce(n, 0)", "t")} AS p, {_share("ln", "lt")} AS q
  FROM g JOIN keep USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TOP}
"""
