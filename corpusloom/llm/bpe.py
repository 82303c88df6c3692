"""BPE encoding and decoding by contiguous rank arrays.

A word is a row of parts (token ids) and a row of the merge ranks of neighbouring parts. Each step scans a row for
its least rank (the leftmost where equal), replaces the pair by its merge, deletes the boundary between them, and
looks up the ranks on either side anew; a row without a rank left is done. Rows of equal length class are stepped
together in numpy. Words of over `LONG` bytes, for which scanning would be quadratic, use a heap instead.

The tokenizer is a `tokenizers` JSON file of the word-BPE kind (NFC, white space, lower case; a word-end suffix);
its path is a parameter and its content goes to the executors as a broadcast of fixed size. Words recur, so each
worker keeps a bounded cache.

Defined cases: null counts as empty and has no tokens; strings of special tokens inside a text become those tokens,
as in the library. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_scan, table

LONG = 96
CACHE = 150_000
_NONE = np.int32(2**31 - 1)


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible in Latin-1, else from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges and patterns of a tokenizer file."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = t
        end = model.get("end_of_word_suffix") or ""
        chars = byte_chars()
        self.inner = np.array([self.ids[c] for c in chars], np.int32)
        self.last = np.array([self.ids[c + end] for c in chars], np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        made = np.array([self.ids[a + b] for a, b in pairs], np.int32)
        self._table(left << 20 | right, made)
        pattern = next(p["pattern"]["Regex"] for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def _table(self, keys: np.ndarray, made: np.ndarray) -> None:
        """An open hash table from pairs of ids to ranks and merged ids."""
        self.bits = 18
        n = 1 << self.bits
        self.keys, self.ranks, self.made = np.full(n, -1, np.int64), np.full(n, _NONE, np.int32), np.zeros(n, np.int32)
        slots = self._slot(keys)
        self.probes = 1
        for rank, (k, s, m) in enumerate(zip(keys.tolist(), slots.tolist(), made.tolist())):
            steps = 1
            while self.keys[s] != -1 and self.keys[s] != k:
                s = (s + 1) & (n - 1)
                steps += 1
            if self.keys[s] == -1:
                self.keys[s], self.ranks[s], self.made[s] = k, rank, m
                self.probes = max(self.probes, steps)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged ids of pairs; the largest int32 where there is no merge."""
        keys = left.astype(np.int64) << 20 | right
        slots = self._slot(keys)
        rank = np.full(keys.shape, _NONE, np.int32)
        made = np.zeros(keys.shape, np.int32)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            at = open_[hit]
            rank[at], made[at] = self.ranks[slots[at]], self.made[slots[at]]
            open_ = open_[~hit & (found != -1)]
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
        return rank, made

    # -- merging ---------------------------------------------------------------------------------------------------

    def merge_rows(self, parts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Merges rows of parts in place; returns the new lengths."""
        n, width = parts.shape
        lengths = lengths.copy()
        if width < 2 or not n:
            return lengths
        cols = np.arange(width)
        ranks = np.full((n, width - 1), _NONE, np.int32)
        made = np.zeros((n, width - 1), np.int32)
        row, col = np.nonzero(cols[None, : width - 1] < lengths[:, None] - 1)
        ranks[row, col], made[row, col] = self.lookup(parts[row, col], parts[row, col + 1])
        live = np.arange(n)
        while True:
            best = ranks[live].argmin(1)
            some = ranks[live, best] != _NONE
            live, best = live[some], best[some]
            if not len(live):
                return lengths
            p, r, m = parts[live], ranks[live], made[live]
            p[np.arange(len(live)), best] = m[np.arange(len(live)), best]
            # delete the boundary after `best`: everything beyond moves one to the left
            take = np.minimum(cols + (cols > best[:, None]), width - 1)
            p = np.take_along_axis(p, take, 1)
            take = take[:, : width - 1]
            gone = take >= width - 1
            take = np.minimum(take, width - 2)
            r, m = np.take_along_axis(r, take, 1), np.take_along_axis(m, take, 1)
            r[gone] = _NONE
            lengths[live] -= 1
            k = lengths[live]
            for side in (best - 1, best):
                ok = np.flatnonzero((side >= 0) & (side < k - 1))
                r[ok, side[ok]], m[ok, side[ok]] = self.lookup(p[ok, side[ok]], p[ok, side[ok] + 1])
                off = np.flatnonzero((side >= 0) & (side >= k - 1) & (side < width - 1))
                r[off, side[off]] = _NONE
            parts[live], ranks[live], made[live] = p, r, m

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same result for one long word, with a heap of (rank, position) and links over deleted parts."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: np.ndarray) -> None:
            rank, made = self.lookup(np.array([parts[i] for i in at]), np.array([parts[after[i]] for i in at]))
            for i, k, m in zip(at, rank.tolist(), made.tolist()):
                if k != _NONE:
                    heapq.heappush(heap, (k, i, parts[i], parts[after[i]], m))

        offer(range(n - 1))
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer([k for k in (before[i], i) if k >= 0 and after[k] < n])
        return [p for p in parts if p >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list[bytes] = [b""] * len(raw)
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 48, LONG):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for s in range(0, len(at), 8192):
                some = at[s : s + 8192]
                k = sizes[some]
                width = int(k.max())
                data = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in some), np.uint8).reshape(-1, width)
                parts = self.inner[data]
                parts[np.arange(len(some)), k - 1] = self.last[data[np.arange(len(some)), k - 1]]
                k = self.merge_rows(parts, k)
                flat = parts[np.arange(width) < k[:, None]].astype("<u4").tobytes()
                ends = (np.cumsum(k) * 4).tolist()
                for i, a, b in zip(some.tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
        for i in np.flatnonzero(sizes > LONG):
            data = np.frombuffer(raw[i], np.uint8)
            out[i] = np.array(self.merge_long([*self.inner[data[:-1]].tolist(), int(self.last[data[-1]])]), "<u4").tobytes()
        return out

    # -- texts -----------------------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # character by character, a final sigma has no rule of its own
        return self.word.findall(text.lower())

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        split: list[list[str | int]] = []
        for t in texts:
            if self.marks is not None and "<|" in t and self.marks.search(t):
                got: list[str | int] = []
                for k, part in enumerate(self.marks.split(t)):
                    got += [self.special[part]] if k % 2 else self.words(part)
                split.append(got)
            else:
                split.append(self.words(t))
        cache = self.cache
        fresh: dict[str | int, None] = {}
        for got in split:
            fresh.update((w, None) for w in got if w not in cache)
        if len(cache) + len(fresh) > CACHE:
            cache.clear()
            fresh = {w: None for got in split for w in got}
        plain = [w for w in fresh if isinstance(w, str)]
        cache.update(zip(plain, self.encode_words(plain)))
        cache.update((w, int(w).to_bytes(4, "little")) for w in fresh if isinstance(w, int))
        out = [b"".join([cache[w] for w in got]) for got in split]
        if len(cache) > CACHE:
            cache.clear()
        return out

    def decode(self, ids: bytes) -> str:
        """Token strings with a space between, as the library joins them where a file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def vocabulary(spec: str) -> Vocabulary:
    return Vocabulary(spec)


_held: dict[str, Vocabulary] = {}


def _vocabulary(sent: Broadcast, key: str) -> Vocabulary:
    if key not in _held:
        _held.clear()
        _held[key] = Vocabulary(sent.value)
    return _held[key]


RESULTS = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
])


def encoded(df: DataFrame, path: str, carry: dict[str, Column], text: str = "text", keep: bool = True) -> DataFrame:
    """Columns `row` and `res`: ids (little-endian 32-bit numbers) and decoded text if `keep`, their digests, n_tokens."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    sent, key = df.sparkSession.sparkContext.broadcast(spec), hashlib.sha256(spec.encode()).hexdigest()

    def run(arr: pa.Array) -> list[pa.Array]:
        v = _vocabulary(sent, key)
        ids = v.encode_batch(arr.to_pylist())
        counts, id_digests, decoded, digests = [], [], [], []
        for x in ids:
            back = v.decode(x)
            counts.append(len(x) // 4)
            id_digests.append(hashlib.sha256(x).hexdigest())
            digests.append(hashlib.sha256(back.encode()).hexdigest())
            decoded.append(back if keep else None)
        return [
            pa.array(counts, pa.int64()), pa.array(ids if keep else [None] * len(ids), pa.binary()), pa.array(decoded, pa.string()),
            pa.array(id_digests, pa.string()), pa.array(digests, pa.string()),
        ]

    return arrow_scan(df, text, carry, RESULTS, run)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), {"doc_id": F.col("doc_id")}, keep=False)
    return found.select("row.doc_id", "res.n_tokens", "res.ids_sha256", "res.decoded_sha256")
