"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the test questions and answers.

Items and documents are normalised alike (A-Z lower-cased, every other ASCII character that is no letter or digit
a break), and each document is scanned once. Hits are words, mapped back to character ranges of the original text.

The windows go to the executors in blocks of at most `block` windows, so an executor's automaton is bounded however
large the benchmark is; with more than one block, every batch of texts is scanned once per block.

Defined cases: null or wordless texts have no words and no hits; wordless items never occur; a null item id counts
as the empty string; items sharing a window, or an id, are all found. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import raw_bytes
from corpusloom.llm.common import arrow_scan, table

WINDOW = 10
BLOCK = 40_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})

RESULTS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])


def normalised(text: bytes) -> list[bytes]:
    """The words of a text, in UTF-8."""
    return text.translate(_FOLD).split()


def windows(text: str, size: int = WINDOW) -> set[str]:
    """Each run of `size` words, or all of a shorter text's words, with a space before and after."""
    words = normalised(text.encode())
    return {" " + b" ".join(words[i : i + size]).decode() + " " for i in range(max(1, len(words) - size + 1))} if words else set()


def item_blocks(items: DataFrame, item_id: str, text: str, size: int, block: int) -> list[list[tuple[str, list[str]]]]:
    """All windows with the ids of their items, in blocks. Rows come to the driver one partition at a time."""
    found: dict[str, set[str]] = {}
    for ident, t in items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        for w in windows(t, size):
            found.setdefault(w, set()).add(ident)
    listed = sorted((w, sorted(ids)) for w, ids in found.items())
    return [listed[i : i + block] for i in range(0, len(listed), block)]


def automaton(block: list[tuple[str, list[str]]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w, ids in block:
        a.add_word(w, (w.count(" ") - 1, ids))
    a.make_automaton()
    return a


@lru_cache(2)
def _built(key: tuple[str, int]) -> list:
    return []


def _only(sent: Broadcast, key: tuple[str, int]) -> ahocorasick.Automaton:
    """The automaton of the only block: built once in each worker."""
    kept = _built(key)
    if not kept:
        kept.append(automaton(sent.value))
    return kept[0]


def char_spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Character ranges in the original text of runs of word numbers (last included)."""
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [{"start": at[a][0], "end": at[b][1]} for a, b in runs]


def scan(docs: DataFrame, items: DataFrame, carry: dict[str, Column], text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Columns `row` (of `carry`) and `res`: n_words, n_hit, ids of the items found, character spans of hit words."""
    blocks = item_blocks(items, item_id, item_text, size, block)
    sent = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks]
    key = (hashlib.sha256(repr(blocks).encode()).hexdigest(), size)

    def run(arr: pa.Array) -> list[pa.Array]:
        data, at = raw_bytes(arr)
        data = data.tobytes()
        texts = [normalised(data[a:b]) for a, b in zip(at[:-1], at[1:])]
        hits: dict[int, tuple[list[list[int]], set[str]]] = {}
        for one in sent:
            found = _only(one, key) if len(sent) == 1 else automaton(one.value)
            for i, words in enumerate(texts):
                if not words:
                    continue
                joined = b" ".join(words).decode("utf-8", "replace")
                line = f" {joined} "
                last = seen = 0
                for end, (n, ids) in found.iter(line):
                    last += line.count(" ", seen, end)
                    seen = end
                    runs, items = hits.setdefault(i, ([], set()))
                    runs.append([last - n, last - 1])
                    items.update(ids)
        n_hit, names, spans = [0] * len(texts), [[]] * len(texts), [[]] * len(texts)
        for i, (runs, items) in hits.items():
            merged: list[list[int]] = []
            for a, b in sorted(runs):
                if merged and a <= merged[-1][1] + 1:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            n_hit[i] = sum(b - a + 1 for a, b in merged)
            names[i] = sorted(items)
            spans[i] = char_spans(data[at[i] : at[i + 1]].decode("utf-8", "replace"), merged)
        return [
            pa.array([len(w) for w in texts], pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ]

    return arrow_scan(docs, text, carry, RESULTS, run, limit=1 << 20 if len(sent) <= 1 else 16 << 20)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), {"doc_id": F.col("doc_id")})
    return found.select(
        "row.doc_id", "res.n_words", "res.n_hit", F.size("res.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("res.items", ","), 256).alias("items_sha256"), (F.col("res.n_hit") > 0).alias("contaminated"),
    )


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS x
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT r, dw.n, p, item_id FROM dw JOIN iw USING (x) WHERE dw.n = iw.n
), words AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r
), names AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN names USING (r)
"""
