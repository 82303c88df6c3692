"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact sorted-array intersection.

A document's set is its distinct k-word shingles, as sorted 64-bit hashes. Two sets link when 100 * |intersection| >=
percent * |union|. With tile keys, the default, every link between different sets is found:

1. Equal sets become one node, so copies are never compared.
2. Sizes fall into bands within a factor of 100 / percent, so sets that link lie in the same band or in neighbouring ones.
   For each such pair of bands, sets that link differ in at most `differences` shingles. A set is cut by ranges of its
   hashes into more tiles than that, so two linked sets agree in a whole tile; tiles without shingles are made up for by
   further ones, and a set with too many of those counts them as tiles like any other. The hash of a tile is a key.
   (`keys="minima"` uses `keys_of(percent)` keys of `ROWS` minimum hashes instead: fewer where the threshold is low, at a
   chance of less than 1e-9 a pair that a link is missed.)
3. Each node is compared with the least node of each of its keys, its hub. Copies of one text with small changes are
   connected by this alone, in time linear in their number. What is left are keys whose other nodes are not all connected.
4. Nodes that share such a key form groups. A group is cut into bands of sizes, and a band into tiles of bounded bytes by a
   hash of the node. Only tiles of the same or neighbouring bands can hold links. Each pair of tiles is a task of bounded
   memory, as is each hub with a bounded number of its nodes.
5. In a task, the bit counts of parity bitmaps bound the overlap from above; pairs that pass and are not yet connected
   are intersected exactly. A task emits only links that connect, at most one less than its nodes.

The components of the links, over all documents, give `component_id`. The large tables are written to the shared
folder between steps; what goes to every executor is a Bloom filter of the keys that nodes share, and one of the nodes that are
compared, each of at most 2^MOST_BLOOM bits: beyond its capacity it only lets more through than needed.

Defined cases: a null, empty or wordless text has n_shingles 0 and is a component of its own; fewer than k words make
one shingle. Rows of one doc_id with different texts are linked by their texts like any others; a null doc_id never
names a component unless all its ids are null. Columns that are not named are not read, whatever they are called. Shingles,
tiles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import SPACES, mixed, shingle_hashes, split
from corpusloom.llm.common import arrow_scan, bounded_batches, matrix_rows, pieces, stacked, summed_by_key, table, written
from corpusloom.llm.components import components

WORDS = 3
PERCENT = 90
ROWS, MISSED = 4, 1e-9
LEAST_BLOOM, MOST_BLOOM = 16, 28  # bits of the filter, as a power of two
BITMAP = 1024
TILE_ROWS, TILE_BYTES = 2048, 24 << 20


def keys_of(percent: int) -> int:
    """The number of keys, each of ROWS minima, of which sets at the threshold share none with a chance below MISSED."""
    return int(np.ceil(np.log(MISSED) / np.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else 1


def band_of(percent: int) -> float:
    """The factor between size bands: sets that link differ by 100 / percent at most, so by one band at most."""
    return 1.008 * 100 / percent


def bands(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Least sizes of the bands: a set links with none beyond the next band."""
    out = [1]
    while out[-1] < most:
        out.append(100 * out[-1] // percent + 1)
    return np.array(out)


def differences(percent: int, greatest: int) -> int:
    """The most shingles that are in one of two linked sets only, if the smaller has at most `greatest`."""
    return (greatest + 100 * greatest // percent) * (100 - percent) // (100 + percent)


_SETS = T.StructType([T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])


def shingle_sets(arr: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = split(arr, SPACES)
    h, first = shingle_hashes(w, w.hashes(), k)
    return [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]


def node_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(sets: list[np.ndarray], keys: int) -> np.ndarray:
    """The keys of each set (sets x keys): hashes of ROWS minima each. Sets are not empty."""
    rng = np.random.default_rng(77)
    flip, odd = rng.integers(0, 1 << 63, (2, keys * ROWS), dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    values = np.concatenate(sets)
    out = np.empty((len(sets), keys), np.uint64)
    for k in range(keys):
        acc = np.full(len(sets), np.uint64(k + 1), np.uint64)
        for r in range(k * ROWS, (k + 1) * ROWS):
            least = np.minimum.reduceat((values ^ flip[r]) * (odd[r] << np.uint64(1) | np.uint64(1)), starts)
            acc = mixed(acc * np.uint64(0x9FB21C651E98DF25) + least)
        out[:, k] = acc
    return out


def tiles_for(percent: int, band: int, least: np.ndarray) -> tuple[int, int]:
    """Number of tiles for links of a band with itself and the next one, and how many must agree at least."""
    d = differences(percent, int(least[band + 1]) - 1)
    spare = 1 + d // 16  # for tiles without shingles
    return d + spare, spare


def tile_keys(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """The keys of each set: hashes of its tiles, for links with the next band of sizes and with the one before."""
    least = bands(percent, max((len(s) for s in sets), default=1) + 1)
    out = []
    for s in sets:
        own = int(np.searchsorted(least, len(s), "right")) - 1
        keys, mixed_s = [], mixed(s)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed_s, dtype=np.uint64)])
        for band in (own - 1, own):
            if band < 0 or not differences(percent, int(least[band + 1]) - 1):
                continue  # sets of these sizes link only if they are equal
            many, agree = tiles_for(percent, band, least)
            tile = _tile_of(s, many)
            ends = np.searchsorted(tile, np.arange(many + 1))
            content = mixed((sums[ends[1:]] - sums[ends[:-1]]) + (np.arange(many, dtype=np.uint64) + np.uint64(band * 0x10001 + 1)) * np.uint64(0x9FB21C651E98DF25))
            filled = np.diff(ends) > 0
            # with fewer empty tiles than must agree, one that agrees has shingles; else the empty ones count, too
            keys.append(content[filled] if many - filled.sum() < agree else content)
        out.append(np.concatenate(keys) if keys else np.zeros(0, np.uint64))
    return out


def _tile_of(s: np.ndarray, many: int) -> np.ndarray:
    """The tile of each hash, by equal ranges of its upper 32 bits; the hashes are sorted, so tiles are runs."""
    return ((s >> np.uint64(32)) * np.uint64(many) >> np.uint64(32)).astype(np.int64)


def _blooms(h: np.ndarray, bits: int) -> np.ndarray:
    """Three bit numbers of each 64-bit key."""
    h = h.astype(np.int64).view(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    return np.stack([h & mask, (h >> np.uint64(18)) & mask, h >> np.uint64(64 - bits)]).astype(np.int64)


def bloom_of(keys: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of 2^bits bits over the column `key`: it only spares later work, and errs by letting more through."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.zeros(1 << bits, np.uint8)
        for b in batches:
            mask[_blooms(b["key"].to_numpy(), bits).ravel()] = 1
        if mask.any():
            yield matrix_rows(np.packbits(mask).reshape(-1, 1), 1 << bits - 7)

    return stacked(summed_by_key(keys.mapInPandas(run, "slot int, vec binary"), "u1", np.bitwise_or), (-1,), "u1")


def linked_pairs(sets: list[np.ndarray], right: int, percent: int, roots: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Index pairs that connect: within sets[:right] if right is len(sets), else between sets[:right] and the rest.

    Sets with the same root are connected already.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    at = np.repeat(np.arange(m), sizes) * BITMAP + (np.concatenate(sets) & np.uint64(BITMAP - 1)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=m * BITMAP) & 1).astype(np.uint8).reshape(m, BITMAP), axis=1).view(np.uint64)
    label, out = np.arange(m) if roots is None else np.unique(roots, return_inverse=True)[1], []
    for i in range(right):
        low = right if right < m else i + 1
        if low >= m:
            break
        apart = np.bitwise_count(bits[low:] ^ bits[i]).sum(1, dtype=np.int64)
        both = sizes[low:] + sizes[i]
        most = np.minimum((both - apart) // 2, np.minimum(sizes[low:], sizes[i]))
        for j in low + np.flatnonzero(((100 + percent) * most >= percent * both) & (label[low:] != label[i])):
            if label[j] == label[i]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                label[label == label[j]] = label[i]
                out.append((i, int(j)))
    return out


def shared_keys(rows: DataFrame) -> DataFrame:
    """Columns key, node and hub (the least node of the key) of the keys that several nodes have; `rows` has node and keys, copies and all.

    Most keys are one node's alone. They meet only as partial minima; a Bloom filter of the others lets few of them into the join.
    """
    spark = rows.sparkSession
    ends = rows.select("node", F.explode("keys").alias("key")).groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    hubs = written(ends.where("hub <> last").select("key", "hub"), "shared")
    bits = min(MOST_BLOOM, max(LEAST_BLOOM, hubs.count().bit_length() + 4))
    bloom = spark.sparkContext.broadcast(bloom_of(hubs.select("key"), bits))
    bounded_batches(spark)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = bloom.value
        for batch in batches if len(mask) else ():
            lists = batch.column(1)
            keys, owner = lists.flatten(), pc.list_parent_indices(lists)
            at = _blooms(keys.to_numpy(zero_copy_only=False), bits)
            kept = pa.array(np.all(mask[at >> 3] >> (7 - (at & 7)) & 1, axis=0))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner.filter(kept)), keys.filter(kept)], ["node", "key"])

    posts = rows.select("node", "keys").mapInArrow(likely, "node long, key long").distinct()
    return posts.join(hubs, "key").select("key", "node", "hub")


def room_for(n: Column, factor: float) -> Column:
    """How many sets of about `n` shingles go into a tile of bounded bytes."""
    return F.greatest(F.lit(16.0), F.least(F.lit(float(TILE_ROWS)), TILE_BYTES / (8.0 * factor * n)))


def hub_tasks(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """One row per node of a task: node, root (its own), task, side. A task is a hub (side 0) with some of its nodes (side 1)."""
    counts = pairs.groupBy("hub").agg(F.count("*").alias("many")).join(sizes.select(F.col("node").alias("hub"), "n"), "hub")
    counts = counts.select("hub", F.ceil(F.col("many") / room_for(F.col("n"), band_of(percent))).cast("int").alias("k"))
    own = counts.select(F.col("hub").alias("node"), F.col("hub").alias("root"), F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.xxhash64("hub", j))).alias("task"), F.lit(0).alias("side"))
    tile = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    return own.unionByName(pairs.join(counts, "hub").select("node", F.col("node").alias("root"), F.xxhash64("hub", tile).alias("task"), F.lit(1).alias("side")))


def open_groups(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """Columns node, root and grp of the nodes, hubs apart, that share a key with a node which is not connected to them yet.

    `roots` has a and b as `components` gives them. Groups are components of the nodes by such keys.
    """
    rest = posts.where("node <> hub").select("key", "node").join(roots.select(F.col("a").alias("node"), "b"), "node", "left").select("key", "node", F.coalesce("b", "node").alias("root"))
    apart = rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("least")).where("low <> high").select("key", "least")
    rest = written(rest.join(apart, "key").select("node", "root", "least"), "open")
    found = components(rest.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")), "groups")
    grouped = found.select(F.col("a").alias("node"), F.col("b").alias("grp")).unionByName(found.select(F.col("b").alias("node"), F.col("b").alias("grp")).distinct())
    return rest.select("node", "root").distinct().join(grouped, "node")


def tile_tasks(members: DataFrame, percent: int) -> DataFrame:
    """One row per member and pair of tiles it belongs to: node, root, task, side (0 or 1). `members` has node, root, grp, n."""
    factor = band_of(percent)
    banded = members.select("node", "root", "grp", F.floor(F.log(F.col("n").cast("double")) / float(np.log(factor))).cast("int").alias("band"))
    w = Window.partitionBy("grp").orderBy("band")  # a row for each band of sizes, of which there are few
    bands = banded.groupBy("grp", "band").agg(F.count("*").alias("many")).withColumn("k", F.ceil(F.col("many") / room_for(F.pow(F.lit(factor), F.col("band") + 1), 1.0)).cast("int"))
    near = lambda f, d, c: F.when(f("band").over(w) == F.col("band") + d, f(c).over(w)).otherwise(0)
    bands = bands.select("grp", "band", "many", "k", near(F.lag, -1, "k").alias("below"), near(F.lead, 1, "k").alias("above"))
    sub = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    one = lambda band, kind, i, j, side: F.struct(band.alias("band"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    b, s, zero = F.col("band"), F.col("sub"), F.lit(0)
    same = F.when(F.col("many") > 1, F.transform(upto(F.col("k")), lambda j: one(b, 0, F.least(s, j), F.greatest(s, j), F.when(s > j, 1).otherwise(0)))).otherwise(F.array())
    up = F.transform(upto(F.col("above")), lambda j: one(b, 1, s, j, zero))
    down = F.transform(upto(F.col("below")), lambda i: one(b - 1, 1, i, s, F.lit(1)))
    dealt = banded.join(bands, ["grp", "band"]).withColumn("sub", sub).select("node", "root", "grp", F.explode(F.concat(same, up, down)).alias("t"))
    return dealt.select("node", "root", F.xxhash64("grp", "t.band", "t.kind", "t.i", "t.j").alias("task"), "t.side")


def links(dealt: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of linked nodes that connect each task's components. `dealt`: task, side, node, root, shingles (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def solved() -> pa.RecordBatch | None:
            held.sort(key=lambda r: r[0])
            right = sum(1 for side, *_ in held if side == 0)
            if len(held) < 2 or not right:
                return None
            found = linked_pairs([np.frombuffer(x, np.uint64) for *_, x in held], right, percent, np.array([root for _, _, root, _ in held]))
            return pa.RecordBatch.from_arrays([pa.array([held[i][1] for i, _ in found], pa.int64()), pa.array([held[j][1] for _, j in found], pa.int64())], ["a", "b"]) if found else None

        for batch in batches:
            for task, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if task != current:
                    if (done := solved()) is not None:
                        yield done
                    current, held = task, []
                held.append(row)
        if (done := solved()) is not None:
            yield done

    return dealt.select("task", "side", "node", "root", "shingles").repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _linked(docs: DataFrame, key: str, text: str, k: int, percent: int, keys: str, carry: dict) -> tuple[DataFrame, DataFrame]:
    """One row per document (id, what is carried, n, node: null without words), and the roots of nodes: a, b as `components` gives them."""
    spark = docs.sparkSession

    def keyed(arr: pa.Array) -> list[pa.Array]:
        sets = shingle_sets(arr, k)
        some = [s for s in sets if len(s)]
        found = iter(tile_keys(some, percent) if keys == "tiles" else band_keys(some, keys_of(percent)) if some else [])
        each = [next(found) if len(s) else np.zeros(0, np.uint64) for s in sets]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
        return [
            pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each).view(np.int64) if each else np.zeros(0, np.int64))),
        ]

    rows = written(arrow_scan(docs, text, {"id": F.col(key)} | carry, _SETS, keyed).select("row.*", "res.*"), "sets")
    worded = rows.where("node is not null")
    posts = written(shared_keys(worded), "posts")
    nodes = worded.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    pairs = written(posts.where("node <> hub").select("node", "hub").distinct(), "pairs")
    named = pairs.select(F.explode(F.array("node", "hub")).alias("node")).distinct()
    members = written(nodes.select("node", "id", "n").join(named, "node"), "members")
    sets = written(_sets_of(spark, docs, key, text, k, members), "shingles")
    first = written(links(hub_tasks(pairs, members, percent).join(sets, "node"), percent), "hub-links")
    roots = components(first, "hubs")
    rest = open_groups(posts, roots).join(members.select("node", "n"), "node")
    second = links(tile_tasks(written(rest, "rest"), percent).join(sets, "node"), percent)
    return rows.drop("keys"), components(roots.unionByName(second), "links")


def _sets_of(spark: SparkSession, docs: DataFrame, key: str, text: str, k: int, members: DataFrame) -> DataFrame:
    """Columns node and shingles (bytes) of the members, each once: made from their texts again, not kept for all documents."""
    bits = min(MOST_BLOOM, max(LEAST_BLOOM, members.count().bit_length() + 4))
    bloom = spark.sparkContext.broadcast(bloom_of(members.select(F.xxhash64("id").alias("key")), bits))
    bounded_batches(spark)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Node and set of the documents that the filter lets through; one Python step, so one worker a task."""
        mask = bloom.value
        for batch in batches if len(mask) else ():
            at = _blooms(batch.column(1).to_numpy(), bits)
            kept = batch.filter(pa.array(np.all(mask[at >> 3] >> (7 - (at & 7)) & 1, axis=0)))
            for part in pieces(kept, column=0):
                sets = shingle_sets(part.column(0), k)
                nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(1), nodes, pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "node", "shingles"])

    src = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("key")).where("text is not null")
    sets = src.mapInArrow(whole, "key long, node long, shingles binary")
    ids = members.select("node", F.xxhash64("id").alias("id_key"))
    return sets.join(ids, "node").where("key = id_key").dropDuplicates(["node"]).select("node", "shingles")


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT, keys: str = "tiles") -> DataFrame:
    """One row per document: `key`, n_shingles, component_id."""
    rows, roots = _linked(docs, key, text, k, percent, keys, {})
    # copies meet only as partial minima, and in a last join whose hot keys can be split
    least = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    placed = least.join(roots.select(F.col("a").alias("node"), "b"), "node", "left").select("node", "id", F.coalesce("b", "node").alias("root"))
    named = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = placed.join(named, "root").select("node", "component_id")
    return rows.select("id", "n", "node").join(by_node, "node", "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def representatives(docs: DataFrame, mark: Column, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT, keys: str = "tiles") -> DataFrame:
    """Column mark: that of one document of each component, by least `key` (nulls last), then by least mark.

    `mark` is a number that tells documents apart; those without words are components of their own, one for each mark.
    """
    rows, roots = _linked(docs, key, text, k, percent, keys, {"mark": mark})
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")
    least = rows.where("node is not null").groupBy("node").agg(F.min(order).alias("first"))
    placed = least.join(roots.select(F.col("a").alias("node"), "b"), "node", "left").select("first", F.coalesce("b", "node").alias("root"))
    chosen = placed.groupBy("root").agg(F.min("first").alias("first")).select("first.mark")
    return chosen.unionByName(rows.where("node is null").select("mark")).distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))
