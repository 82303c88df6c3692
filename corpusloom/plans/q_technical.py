"""Queries of code and formula validation, and of the relational engine beneath, with their checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import technical as tc
from corpusloom.operators import corpus as cp
from corpusloom.plans.fixture import read, texts
from corpusloom.plans.q_quality import quoted, sql_any

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_CODE = ["```go\npackage main\nfunc main() {}\n```", "```python\nimport os\ndef f(x):\n  return x\n```", "```\nplain text\n```", "```javascript\nlet a = {b: 1};\n// note\ntry { f(a) } catch (e) {}\n```", "```java\nclass A { int b = 1; \n```"]
_MATH = ["$x^2 + y = 1$", "$(a + b * 2$", "$log(-1) + 3 / 0$", "$x + 0 = y = 2$", "$\\frac{a}{b}$", "$sin(x) ÷ 2$"]


def _pick(xs, k):
    return F.element_at(F.array(*map(F.lit, xs)), (F.col("doc_id") % k + 1).cast("int"))


def samples(spark, sf_dir):
    """Documents as technical texts: code and formulas, and the whole text itself as the comment of a block of code."""
    body = F.translate(F.coalesce("text", F.lit("")), "\n`$", " ")
    pieces = (F.lit("Text\n"), _pick(_CODE, 5), F.lit("\nmore\n"), _pick(_CODE[::-1], 5), F.lit("\n```go\npackage main // "), body, F.lit("\n``` and "), _pick(_MATH, 6))
    return texts(spark, sf_dir).select("doc_id", F.concat(*pieces).alias("text"))


def _array(xs) -> str:
    return "[" + ", ".join(map(quoted, xs)) + "]"


_T = f"s AS (SELECT doc_id, 'Text' || chr(10) || {_array(_CODE)}[doc_id % 5 + 1] || chr(10) || 'more' || chr(10) || {_array(_CODE[::-1])}[doc_id % 5 + 1] || chr(10) || '```go' || chr(10) || 'package main // ' || translate(coalesce(text, ''), chr(10) || '`$', ' ') || chr(10) || '``` and ' || {_array(_MATH)}[doc_id % 6 + 1] AS text FROM documents)"
_B = f"{_T}, b AS (SELECT doc_id, unnest(list_zip(regexp_extract_all(text, '```(\\w*)\\n([\\s\\S]*?)\\n```', 1), regexp_extract_all(text, '```(\\w*)\\n([\\s\\S]*?)\\n```', 2), range(len(regexp_extract_all(text, '```(\\w*)\\n([\\s\\S]*?)\\n```', 1))))) AS p FROM s), c AS (SELECT doc_id, CAST(p[3] AS BIGINT) AS nth, CASE WHEN p[1] = '' THEN 'text' ELSE p[1] END AS language, p[2] AS code FROM b)"


@query(f"WITH {_B} SELECT * FROM c")
def code_blocks(spark, sf_dir):
    return samples(spark, sf_dir).select("doc_id", F.posexplode(tc.code_blocks(F.col("text"))).alias("nth", "b")).select("doc_id", F.col("nth").cast("long").alias("nth"), "b.language", "b.code")


_SYNTAX = "CASE language " + " ".join(f"WHEN '{k}' THEN regexp_matches(code, {quoted(tc.one_of(v))})" for k, v in tc.SYNTAX.items()) + " ELSE false END"
_BRACES = "(length(code) - length(replace(code, '{', '')) = length(code) - length(replace(code, '}', '')))"
_STOP = f"CASE WHEN {sql_any('lower(code)', tc.DANGEROUS)} THEN 'danger' WHEN language = 'python' AND {sql_any('lower(code)', tc.DANGEROUS_IMPORTS['python'])} THEN 'import' WHEN language NOT IN ('go', 'python', 'javascript', 'java') THEN 'language' END"


@query(f"""WITH {_B}, v AS (SELECT *, {_STOP} AS stop FROM c)
  SELECT language, coalesce(stop, 'none') AS stopped, stop IS NULL AND ({_SYNTAX} OR language = 'python' OR language = 'javascript' AND {_BRACES} OR language = 'java' AND contains(code, 'class ') AND {_BRACES}) AS syntax_valid, count(*) AS blocks FROM v GROUP BY 1, 2, 3""")
def code_safety(spark, sf_dir):
    blocks = code_blocks(spark, sf_dir)
    out = blocks.withColumns(tc.validated_code(F.col("code"), F.col("language")))
    why = F.when(F.contains("error", F.lit("pattern")), "danger").when(F.contains("error", F.lit("imports")), "import").when(F.contains("error", F.lit("supported")), "language").otherwise("none")
    return out.groupBy("language", why.alias("stopped"), "syntax_valid").agg(F.count("*").alias("blocks"))


@query(f"WITH {_T} SELECT formula, count(*) AS n FROM (SELECT unnest(list_transform(regexp_extract_all(text, '\\$([^$]+)\\$', 1), lambda x: trim(x))) AS formula FROM s) GROUP BY 1")
def formulas(spark, sf_dir):
    return samples(spark, sf_dir).select(F.explode(tc.formulas(F.col("text"))).alias("formula")).groupBy("formula").agg(F.count("*").alias("n"))


@query("""SELECT formula, valid, CAST(confidence AS DOUBLE) AS confidence, notation FROM (VALUES ('x^2 + y = 1', true, 0.9, 'ascii'), ('(a + b * 2', false, 0.5, 'ascii'), ('log(-1) + 3 / 0', false, 0.2, 'ascii'), ('x + 0 = y = 2', false, 0.7, 'ascii'), ('\\frac{a}{b}', true, 0.9, 'latex'), ('sin(x) ÷ 2', true, 0.9, 'ascii')) t(formula, valid, confidence, notation)""")
def formula_validity(spark, sf_dir):
    found = samples(spark, sf_dir).select(F.explode(tc.formulas(F.col("text"))).alias("formula")).distinct()
    return found.withColumns(tc.validated_formula(F.col("formula"))).select("formula", "valid", "confidence", "notation")


@query()
def technical_accuracy(spark, sf_dir):
    return samples(spark, sf_dir).select("doc_id", F.round(tc.technical_accuracy(F.col("text")), 6).alias("accuracy"), tc.is_technical(F.col("text")).alias("technical"))


# -- relational --------------------------------------------------------------------------------------------------------------


def tables(spark, sf_dir, *names):
    return [read(spark, sf_dir, n) for n in names]


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, o_orderdate FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderkey, o_orderdate ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, o_orderkey LIMIT 10""")
def top_orders(spark, sf_dir):
    c, o, li = tables(spark, sf_dir, "customer", "orders", "lineitem")
    joined = c.where("c_mktsegment = 'BUILDING'").join(o, c.c_custkey == o.o_custkey).join(li, li.l_orderkey == o.o_orderkey)
    out = joined.groupBy("o_orderkey", "o_orderdate").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return out.orderBy(F.desc("r"), "o_orderkey").limit(10).select("o_orderkey", F.round("r", 2).alias("revenue"), "o_orderdate")


@query("""SELECT r_name, n_name, round(sum(s_acctbal), 2) AS balance, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY CUBE (r_name, n_name)""")
def balance_cube(spark, sf_dir):
    s, n, r = tables(spark, sf_dir, "supplier", "nation", "region")
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.cube("r_name", "n_name").agg(F.round(F.sum("s_acctbal"), 2).alias("balance"), F.count("*").alias("suppliers"))


@query("SELECT c_custkey, c_nationkey, rn FROM (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 3")
def rank_in_nation(spark, sf_dir):
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    return read(spark, sf_dir, "customer").withColumn("rn", F.row_number().over(w).cast("long")).where("rn <= 3").select("c_custkey", "c_nationkey", "rn")


@query("SELECT count(*) FILTER (x) AS with_orders, count(*) FILTER (NOT x) AS without FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS x FROM customer)")
def semi_and_anti(spark, sf_dir):
    c, o = tables(spark, sf_dir, "customer", "orders")
    keys = o.select(F.col("o_custkey").alias("c_custkey"))
    with_, without = c.join(keys, "c_custkey", "left_semi"), c.join(keys, "c_custkey", "left_anti")
    both = with_.select(F.lit(1).alias("a"), F.lit(0).alias("b")).union(without.select(F.lit(0), F.lit(1)))
    return both.agg(F.sum("a").cast("long").alias("with_orders"), F.sum("b").cast("long").alias("without"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0")
def set_operations(spark, sf_dir):
    c, s, n = tables(spark, sf_dir, "customer", "supplier", "nation")
    return c.select(F.col("c_nationkey").alias("k")).intersect(s.select("s_nationkey")).exceptAll(n.where("n_regionkey = 0").select("n_nationkey")).distinct()


@query("SELECT a.event_id, (SELECT arg_max(b.value, b.ts) FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'view' AND b.ts <= a.ts) AS last_view FROM events a WHERE a.event_type = 'purchase'")
def asof_events(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    views = ev.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen"), F.col("value").alias("last_view"))
    return cp.as_of(ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, "user_id", "ts", "seen", "last_view").select("event_id", "last_view")


@query("SELECT user_id, last(event_type ORDER BY ts, event_id) AS event_type FROM events WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY 1")
def time_travel(spark, sf_dir):
    ev = read(spark, sf_dir, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("at"), "ts")
    return cp.as_of_time(ev.where("ts <= timestamp_ntz'2024-01-15'").drop("ts"), "user_id", "at", F.struct(F.lit("2024-01-15").cast("timestamp_ntz").alias("ts"), F.lit(1 << 60).alias("event_id"))).select("user_id", "event_type")
