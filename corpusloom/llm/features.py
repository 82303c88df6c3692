"""Point-in-time features: for every sale, what was known of its client at a time t, over windows of 2 and 14 days.

A click, sale or line counts at t while start <= t < expiry: it starts when it has happened and has been known for `DELAY`, and
expires a window after it happened. So a count at t is the number of starts up to t less the number of expiries up to t, and a
sum likewise. Rows are dealt by client and time into chunks; in a chunk, numpy sorts starts and expiries, sums them up from the left, and
finds each sale's t among both. An item's intervals are united first, so that an item counts once. Many chunks are worked on at once,
as one sorted array of (chunk, time).

A client of at most `LARGE` rows is one chunk. One with more, which may have a third of all rows, is cut into chunks of
about `CHUNK_ROWS` by time: its rows go to the chunks of their start and of both expiries, and a chunk starts from base totals, which Spark
sums up by chunk and carries along the client's chunks, as it does the last click before and the next sale after. The table of large
clients, of at most one row for each `LARGE` rows, is written, and Spark joins it by broadcast only if its file is small. Nothing else
is broadcast or goes to the driver. Lines are summed up by sale, item and day before they meet their sale, so a sale with a third of
all lines is a few rows a task.

Defined cases: clicks without client, time or arrival never count; clicks equal in all seven columns count once; sales without client or
sold_at have no row, and without arrival have a row and count for labels only; lines without shipped_at, or whose sale is unknown or has not
arrived, never count; a null kind is no purchase; null values are 0 cents; a null item is no item; a null click id is smaller than any
other; a null sale id has t = sold_at; several sales of one id each get a row, and each its id's lines; empty tables give an empty
table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import table, written

DAYS, LABEL_DAYS, DELAY, SPREAD = (2, 14), 7, 240, 259_200
LARGE, CHUNK_ROWS, BLOCK_ROWS = 100_000, 25_000, 200_000
DAY, HOUR, MINUTE, SECOND = 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000
CLICK, PURCHASE, SALE, LINE, ITEMS, BASE = 0, 1, 2, 3, 4, 9  # ITEMS + 0 and ITEMS + 1: united intervals of an item, by window
START, EXPIRE, SOLD, ASKED = 1, (2, 4), 8, 16
COUNTED = ("n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "line_cents", "n_items")
_LEAST, _MOST = -(2**63), 2**63 - 1
_ROW = "client long, kind int, a long, b long, t long, cents long, id long, item long, n long"
_OUT = pa.schema(
    [("sale_id", pa.int64()), ("d", pa.int32()), ("t_us", pa.int64()), ("label", pa.bool_())]
    + [(c, pa.int64()) for c in ("n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents")]
)


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time in UTC, whatever the session's zone is."""
    if df.schema[name].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(F.col(name))
    since = f"(`{name}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return F.expr(f"extract(DAY FROM {since}) * {DAY}L + extract(HOUR FROM {since}) * {HOUR}L + extract(MINUTE FROM {since}) * {MINUTE}L + CAST(extract(SECOND FROM {since}) * {SECOND}L AS BIGINT)")


def cents(value: str) -> Column:
    return F.coalesce(F.floor(100 * F.col(value) + 0.5), F.lit(0)).cast("long")


def events(clicks: DataFrame, sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Clicks, sales and lines as rows (client, kind, a: start, b: time, t: asked time, cents, id, item, n)."""
    none = F.lit(None).cast("long")
    c = clicks.where("client_id IS NOT NULL AND ts IS NOT NULL AND arrived_at IS NOT NULL").select("click_id", "ts", "arrived_at", "client_id", "kind", "value", "props").distinct()
    c = c.select("client_id", "click_id", F.coalesce(F.col("kind") == "purchase", F.lit(False)).cast("int").alias("kind"), micros(c, "ts").alias("b"), micros(c, "arrived_at").alias("known"), cents("value").alias("cents"))
    first = c.select(F.col("client_id").cast("long").alias("client"), "kind", F.greatest("b", F.col("known") + DELAY * MINUTE).alias("a"), "b", none.alias("t"), "cents", F.col("click_id").cast("long").alias("id"), none.alias("item"), F.lit(1).cast("long").alias("n"))
    s = sales.where("client_id IS NOT NULL AND sold_at IS NOT NULL")
    s = s.select(F.col("client_id").cast("long").alias("client"), F.col("sale_id").cast("long").alias("sale_id"), micros(s, "sold_at").alias("b"), (micros(s, "arrived_at") + DELAY * MINUTE).alias("known"), cents("total").alias("cents"))
    s = s.withColumn("a", F.when(F.col("known").isNotNull(), F.greatest("b", "known")))
    asked = F.col("b") + F.crc32(F.coalesce(F.col("sale_id").cast("string"), F.lit(""))) % SPREAD * SECOND
    second = s.select("client", F.lit(SALE).alias("kind"), "a", "b", asked.alias("t"), "cents", F.col("sale_id").alias("id"), none.alias("item"), F.lit(1).cast("long").alias("n"))
    l = lines.where("sale_id IS NOT NULL AND shipped_at IS NOT NULL").groupBy("sale_id", "item_id", "shipped_at").agg(F.count("*").alias("n"), F.sum(cents("amount")).alias("line_cents"))
    l = l.withColumn("shipped", micros(l, "shipped_at")).select("sale_id", F.col("item_id").cast("long").alias("item"), "shipped", "n", "line_cents")
    third = l.join(s.where("a IS NOT NULL").select("client", "sale_id", "a", "b"), "sale_id").select("client", F.lit(LINE).alias("kind"), F.greatest("a", "shipped").alias("a"), "b", none.alias("t"), F.col("line_cents").alias("cents"), none.alias("id"), "item", "n")
    return first.union(second).union(third)


def united(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals [a, e) of each key, overlapping or touching ones made one."""
    order = Window.partitionBy(*keys).orderBy("a", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = intervals.withColumn("apart", F.when(F.col("a") <= before, 0).otherwise(1)).withColumn("nth", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return apart.groupBy(*keys, "nth").agg(F.min("a").alias("a"), F.max("e").alias("e")).drop("nth")


def item_intervals(rows: DataFrame) -> DataFrame:
    """The times in which an item counts for a client, by window: as rows of kind ITEMS + window, b being the expiry.

    One interval a sale, then those that start on one day, then all: an item with a third of all lines is spread over sales and days.
    """
    one = rows.where((F.col("kind") == LINE) & F.col("item").isNotNull()).groupBy("client", "item", "b").agg(F.min("a").alias("a"))
    each = one.select("client", "item", "a", F.explode(F.array(*[F.struct(F.lit(ITEMS + i).alias("kind"), (F.col("b") + d * DAY).alias("e")) for i, d in enumerate(DAYS)])).alias("w")).select("client", "item", "a", "w.*").where("a < e")
    daily = united(each.withColumn("day", F.floor(F.col("a") / DAY)), ["client", "item", "kind", "day"]).drop("day")
    none = F.lit(None).cast("long")
    return united(daily, ["client", "item", "kind"]).select("client", "kind", "a", F.col("e").alias("b"), none.alias("t"), F.lit(0).cast("long").alias("cents"), none.alias("id"), none.alias("item"), F.lit(1).cast("long").alias("n"))


def _parts(rows: DataFrame) -> DataFrame:
    """A row for each time of a large client's row that a chunk must know: `at` and its role."""
    kind, role = F.col("kind"), lambda at, value: F.struct(at.alias("at"), F.lit(value).alias("role"))
    lasting = [role(F.col("b") + d * DAY, EXPIRE[i]) for i, d in enumerate(DAYS)]
    plain = F.when(F.col("a").isNotNull(), F.array(role(F.col("a"), START), *lasting)).otherwise(F.array().cast("array<struct<at:bigint,role:int>>"))
    sale = F.array(role(F.col("b"), SOLD), role(F.col("t"), ASKED))
    all_parts = F.when(kind >= ITEMS, F.array(role(F.col("a"), START), F.struct(F.col("b").alias("at"), F.when(kind == ITEMS, EXPIRE[0]).otherwise(EXPIRE[1]).alias("role"))))
    return rows.withColumn("part", F.explode(all_parts.when(kind == SALE, F.concat(plain, sale)).otherwise(plain))).select("*", "part.at", "part.role").drop("part")


def _bases(parts: DataFrame) -> DataFrame:
    """For every chunk of a large client: what has started and not expired before it, the last click before, the next sale after."""
    kind, role = F.col("kind"), F.col("role")
    click, one = kind.isin(CLICK, PURCHASE), F.col("n")
    values = [(click, one), (kind == PURCHASE, one), (click, F.col("cents")), (kind == SALE, one), (kind == SALE, F.col("cents")), (kind == LINE, one), (kind == LINE, F.col("cents")), None]
    sums = []
    for i, d in enumerate(DAYS):
        lasts = F.when(kind >= ITEMS, kind == ITEMS + i).otherwise(F.col("a") < F.col("b") + d * DAY)
        sign = F.when(lasts & (role == START), 1).when(lasts & (role == EXPIRE[i]), -1).otherwise(0)
        for v in values:
            which, what = v or (kind >= ITEMS, one)
            sums.append(F.coalesce(F.sum(F.when(which, sign * what)), F.lit(0)).alias(f"s{len(sums)}"))
    last = F.max(F.when(click & (role == START), F.struct("b", F.coalesce("id", F.lit(_LEAST)).alias("id")))).alias("last")
    chunks = parts.groupBy("client", "chunk").agg(*sums, last, F.min(F.when(role == SOLD, F.col("b"))).alias("sold"))
    order = Window.partitionBy("client").orderBy("chunk")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    carried = [F.coalesce(F.sum(f"s{i}").over(before), F.lit(0)) for i in range(len(sums))]
    latest = F.max("last").over(before)
    base = F.array(*carried, F.coalesce(latest["b"], F.lit(_LEAST)), F.coalesce(latest["id"], F.lit(_LEAST)), F.coalesce(F.min("sold").over(after), F.lit(_MOST)))
    return chunks.select("client", "chunk", F.lit(BASE).alias("kind"), F.lit(0).alias("role"), base.alias("base"))


def chunked(rows: DataFrame, large_rows: int = LARGE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`rows` with chunk and role, those of large clients once for each role, and base rows."""
    large = written(rows.groupBy("client").count().where(F.col("count") > large_rows).select("client"), "large")
    whole = START | sum(EXPIRE) | SOLD | ASKED
    small = rows.join(large, "client", "left_anti").select("*", F.lit(0).cast("long").alias("chunk"), F.lit(whole).alias("role"))
    most = rows.join(large, "client", "left_semi")
    # lines of one sale and day, and items that come and go together, are one row
    lasting = most.where(F.col("kind") == LINE).unionByName(item_intervals(most)).groupBy("client", "kind", "a", "b").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    rest = most.where(F.col("kind") != LINE).unionByName(lasting, allowMissingColumns=True).withColumn("item", F.lit(None).cast("long"))
    parts = _parts(rest).withColumn("hour", F.floor(F.col("at") / HOUR))
    sums = Window.partitionBy("client").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    cut = written(parts.groupBy("client", "hour").count().withColumn("chunk", F.floor(F.coalesce(F.sum("count").over(sums), F.lit(0)) / chunk_rows)).drop("count"), "hours")
    placed = written(parts.join(cut, ["client", "hour"]).drop("hour", "at"), "parts")
    return small.unionByName(placed).withColumn("base", F.lit(None).cast("array<long>")).unionByName(_bases(placed), allowMissingColumns=True)


def _columns(rows: pa.Table) -> dict[str, np.ndarray]:
    return {c: rows[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in ("kind", "role", "a", "b", "t", "cents", "n")}


class _Sums:
    """Sums of values up to a place, within a chunk: places sorted, values summed up from the left."""

    def __init__(self, places: np.ndarray, values: list[np.ndarray]):
        order = np.argsort(places, kind="stable")
        self.places, self.sums = places[order], [np.concatenate([[0], np.cumsum(v[order])]) for v in values]

    def upto(self, places: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        to, since = np.searchsorted(self.places, places, "right"), np.searchsorted(self.places, first, "left")
        return [s[to] - s[since] for s in self.sums]


def _united(group: np.ndarray, item: np.ndarray, a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunk, start and end of each interval after those of one chunk and item that overlap or touch have been made one."""
    order = np.lexsort((a, item, group))
    group, item, a, e = group[order], item[order], a[order], e[order]
    new = np.ones(len(a), bool)
    new[1:] = (group[1:] != group[:-1]) | (item[1:] != item[:-1])
    part = np.cumsum(new) - 1
    rank = np.unique(e, return_inverse=True)[1]
    upto = np.maximum.accumulate(part * (len(e) + 1) + rank)  # the latest end so far, as its rank, in the part
    latest = np.sort(e)[np.searchsorted(np.sort(rank), upto - part * (len(e) + 1))] if len(e) else e
    new[1:] |= a[1:] > latest[:-1]
    at = np.flatnonzero(new)
    return group[at], a[at], np.maximum.reduceat(e, at) if len(at) else e


def worked_out(rows: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The features asked for in some whole chunks; `group` numbers the chunk of each row from 0, ascending."""
    if not len(group):
        return
    x = _columns(rows)
    kind, role, a, b, t = x["kind"], x["role"], x["a"], x["b"], x["t"]
    click = kind <= PURCHASE
    real = kind != BASE
    started = np.asarray(rows["a"].combine_chunks().is_valid()) & (role & START > 0)
    asked = np.flatnonzero((kind == SALE) & (role & ASKED > 0))
    if not len(asked):
        return
    long = max(DAYS) * DAY
    low = int(min(b[real].min(), a[started].min() if started.any() else _MOST, t[asked].min()))
    high = int(max(b[real].max() + long, a[started].max() if started.any() else _LEAST, t[asked].max()))
    span, chunks = high - low + 1, int(group[-1]) + 1
    if chunks > 1 and chunks * span >= 2**62:  # times far apart: the chunks in two halves
        half = np.searchsorted(group, chunks // 2)
        yield from worked_out(rows.slice(0, half), group[:half])
        yield from worked_out(rows.slice(half), group[half:] - chunks // 2)
        return

    def place(times: np.ndarray, which: np.ndarray) -> np.ndarray:
        return which * span + (times - low)

    of = group[asked]
    at, first = place(t[asked], of), of * span
    bases = np.flatnonzero(~real)
    carried = np.zeros((chunks, 2 * len(COUNTED) + 3), np.int64)
    carried[:, -3:] = (_LEAST, _LEAST, _MOST)
    if len(bases):
        carried[group[bases]] = np.array(rows["base"].take(pa.array(bases)).to_pylist(), np.int64)
    # the latest click so far: by start, the greatest rank of (time, id)
    ids = rows["id"].combine_chunks().fill_null(_LEAST).to_numpy(zero_copy_only=False)
    c = np.flatnonzero(click & started)
    by_time = np.lexsort((ids[c], b[c]))
    rank = np.empty(len(c), np.int64)
    rank[by_time] = np.arange(len(c))
    order = np.argsort(place(a[c], group[c]), kind="stable")
    starts, best = place(a[c], group[c])[order], np.maximum.accumulate(group[c][order] * (len(c) + 1) + rank[order] + 1)
    to = np.searchsorted(starts, at, "right")
    seen = to > np.searchsorted(starts, first, "left")
    last_b, last_id = carried[of, -3].copy(), carried[of, -2].copy()
    if seen.any():
        found = c[by_time[best[to[seen] - 1] - of[seen] * (len(c) + 1) - 1]]
        later = (b[found] > last_b[seen]) | ((b[found] == last_b[seen]) & (ids[found] > last_id[seen]))
        which = np.flatnonzero(seen)[later]
        last_b[which], last_id[which] = b[found][later], ids[found][later]
    sold = np.flatnonzero((kind == SALE) & (role & SOLD > 0))
    sales = np.sort(place(b[sold], group[sold]))
    after = np.searchsorted(sales, at, "right")
    following = np.append(sales, _MOST)[after]
    upcoming = np.where(following < first + span, following - first + low, carried[of, -1])
    label = upcoming <= t[asked] + LABEL_DAYS * DAY
    sale_id = rows["id"].combine_chunks().take(pa.array(asked))
    is_purchase, is_sale, is_line = (kind == k for k in (PURCHASE, SALE, LINE))
    with_item = is_line & np.asarray(rows["item"].combine_chunks().is_valid())
    item = rows["item"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
    for i, d in enumerate(DAYS):
        expiry = b + d * DAY
        results = carried[of, i * len(COUNTED) : (i + 1) * len(COUNTED)].T.copy()
        lasting = np.asarray(rows["a"].combine_chunks().is_valid()) & (a < expiry)
        for firstcol, m, values in (
            (0, click, [x["n"], x["n"] * is_purchase, x["cents"]]), (3, is_sale, [x["n"], x["cents"]]), (5, is_line, [x["n"], x["cents"]]),
        ):
            s, e = np.flatnonzero(m & lasting & (role & START > 0)), np.flatnonzero(m & lasting & (role & EXPIRE[i] > 0))
            plus = _Sums(place(a[s], group[s]), [v[s] for v in values]).upto(at, first)
            minus = _Sums(place(expiry[e], group[e]), [v[e] for v in values]).upto(at, first)
            for k in range(len(values)):
                results[firstcol + k] += plus[k] - minus[k]
        m = np.flatnonzero(with_item & lasting)
        g, begin, end = _united(group[m], item[m], a[m], expiry[m])
        s, e = np.flatnonzero((kind == ITEMS + i) & (role & START > 0)), np.flatnonzero((kind == ITEMS + i) & (role & EXPIRE[i] > 0))
        begins, ends = np.concatenate([place(begin, g), place(a[s], group[s])]), np.concatenate([place(end, g), place(b[e], group[e])])
        own = np.ones(len(g), np.int64)
        results[7] += _Sums(begins, [np.concatenate([own, x["n"][s]])]).upto(at, first)[0] - _Sums(ends, [np.concatenate([own, x["n"][e]])]).upto(at, first)[0]
        last = pa.array(last_id, mask=(last_id == _LEAST) | (last_b <= t[asked] - d * DAY))
        got = dict(zip(COUNTED, map(pa.array, results))) | {"sale_id": sale_id, "d": pa.array(np.full(len(asked), d, np.int32)), "t_us": pa.array(t[asked]), "label": pa.array(label), "last_click_id": last}
        yield pa.RecordBatch.from_arrays([got[c].cast(_OUT.field(c).type) for c in _OUT.names], schema=_OUT)


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole chunks, as many at a time as make `BLOCK_ROWS` rows; a partition's rows come in the order of client and chunk."""

    def bounds(rows: pa.Table) -> np.ndarray:
        key = [rows[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("client", "chunk")]
        return np.concatenate([[True], (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])])

    waiting, n, most = [], 0, BLOCK_ROWS
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            n += batch.num_rows
        if n >= most:
            rows = pa.Table.from_batches(waiting)
            new = bounds(rows)
            to = int(np.flatnonzero(new)[-1])
            if to:
                yield from worked_out(rows.slice(0, to), np.cumsum(new[:to]) - 1)
            waiting, n = rows.slice(to).to_batches(), n - to
            most = max(BLOCK_ROWS, 2 * n)  # a chunk longer than a block
    if n:
        rows = pa.Table.from_batches(waiting)
        yield from worked_out(rows, np.cumsum(bounds(rows)) - 1)


def features(clicks: DataFrame, sales: DataFrame, lines: DataFrame, large_rows: int = LARGE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Two rows per sale, one a window."""
    rows = chunked(written(events(clicks, sales, lines), "events"), large_rows, chunk_rows)
    columns = ["client", "chunk", "kind", "role", "a", "b", "t", "cents", "id", "item", "n", "base"]
    dealt = rows.select(*columns).repartition("client", "chunk").sortWithinPartitions("client", "chunk")
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean"}
    return dealt.mapInArrow(_work, ", ".join(f"{f.name} {kinds[f.type]}" for f in _OUT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(*[table(spark, sf_dir, t) for t in ("clicks", "sales", "sale_lines")])


def _since(name: str) -> str:
    return f"epoch_us({name})"


ORACLE_SQL = f"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crcs
), s AS (
  SELECT row_number() OVER () AS r, sale_id, client_id, {_since("sold_at")} AS sold, {_since("arrived_at")} + {DELAY * MINUTE} AS known, CAST(coalesce(floor(100 * total + 0.5), 0) AS BIGINT) AS cents
  FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL
), q AS (
  SELECT r, sale_id, client_id, d, sold + xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(sale_id AS VARCHAR), ''), lambda x: ord(x))),
    lambda c, x: xor(c >> 8, crcs[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % {SPREAD} * {SECOND} AS t, d * {DAY} AS wide
  FROM s, tab, (VALUES ({DAYS[0]}), ({DAYS[1]})) AS w(d)
), c AS (
  SELECT client_id, click_id, kind, {_since("ts")} AS ts, {_since("arrived_at")} + {DELAY * MINUTE} AS known, CAST(coalesce(floor(100 * value + 0.5), 0) AS BIGINT) AS cents
  FROM (SELECT DISTINCT click_id, ts, arrived_at, client_id, kind, value, props FROM clicks)
), qc AS (
  SELECT r, d, count(*) AS n_clicks, count(*) FILTER (kind = 'purchase') AS n_purchases, sum(cents) AS click_cents, max({{'ts': ts, 'id': click_id}}).id AS last_click_id
  FROM q JOIN c ON q.client_id = c.client_id AND ts > t - wide AND ts <= t AND known <= t GROUP BY r, d
), qs AS (
  SELECT q.r, d, t, s.sale_id, cents FROM q JOIN s ON q.client_id = s.client_id AND sold > t - wide AND sold <= t AND known <= t
), ns AS (SELECT r, d, count(*) AS n_sales, sum(cents) AS sale_cents FROM qs GROUP BY r, d),
nl AS (
  SELECT r, d, count(*) AS n_lines, count(DISTINCT item_id) AS n_items, sum(CAST(coalesce(floor(100 * amount + 0.5), 0) AS BIGINT)) AS line_cents
  FROM qs JOIN sale_lines l ON l.sale_id = qs.sale_id AND {_since("l.shipped_at")} <= t GROUP BY r, d
), lab AS (SELECT DISTINCT q.r, d FROM q JOIN s ON q.client_id = s.client_id AND sold > t AND sold <= t + {LABEL_DAYS * DAY})
SELECT sale_id, CAST(q.d AS INTEGER) AS d, CAST(t AS BIGINT) AS t_us, lab.r IS NOT NULL AS label, coalesce(n_clicks, 0) AS n_clicks, coalesce(n_purchases, 0) AS n_purchases,
  CAST(coalesce(click_cents, 0) AS BIGINT) AS click_cents, last_click_id, coalesce(n_sales, 0) AS n_sales, CAST(coalesce(sale_cents, 0) AS BIGINT) AS sale_cents,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_items, 0) AS n_items, CAST(coalesce(line_cents, 0) AS BIGINT) AS line_cents
FROM q LEFT JOIN qc USING (r, d) LEFT JOIN ns USING (r, d) LEFT JOIN nl USING (r, d) LEFT JOIN lab USING (r, d)
"""
