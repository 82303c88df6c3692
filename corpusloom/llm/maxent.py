"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(group | history) * P(class | group, history) * P(part | class, history) * P(word | part). A class is
one of the `SINGLES` commonest tokens (which have no parts), or one of `ENDINGS` buckets of word endings; a group is
sixteen classes, and a bucket has sixteen parts by a word's hash. Each of the three softmaxes over sixteen outcomes is
log-linear in hashed features of the history together with what is chosen above: the previous word, the word before it
(a skip) and the previous two classes; parts see the previous word only. The last factor has biases only, whose maximum-likelihood solution with
add-one smoothing is the count ratio (c + 1) / (N_part + V_part + 1), one share being that of unseen words; so the
probabilities of all continuations sum to 1.

Counts are exact and cover all training texts. Training: each partition takes AdaGrad steps over minibatches of all its
training texts, and the tables are averaged, weighted per feature by how often a partition saw it. The feature table grows
with the vocabulary (`slot_bits`), from 2^14 to at most 2^MOST_BITS rows of sixteen weights. Scoring: sparse numpy batches.
Counts of the commonest words (at most 2^HEAD_BITS, all above one count) are broadcast with the feature table; the rest are
joined by a shuffle, so no executor or driver ever holds the vocabulary.

Defined cases: a null text counts as empty and has one token, the end; with no training texts the base score is 0 and
outcomes are equally likely. Rows with one doc_id and different texts are scored apart, and repeated rows repeatedly.
Columns other than the id and the text are not read, whatever their names. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import SPACES, mixed, split
from corpusloom.llm.common import arrow_scan, fold, matrix_rows, pieces, stacked, summed_by_key, table, written

WAYS = 16  # outcomes of each softmax
SINGLES, ENDINGS = 96, 160
CLASSES = SINGLES + ENDINGS
LEAST_BITS, MOST_BITS = 14, 17  # rows of the feature table, as a power of two
HEAD_BITS = 18
BATCH = 8192
RATE = 0.45
LARGEST = 15.0  # a weight's size
END = np.uint64(0x51ED270B7F4A7C15)


#: Bucket of each pair of last bytes: the group by the last byte, the place in it by both.
_PAIR = np.arange(1 << 16, dtype=np.uint64)
_ENDING = ((mixed((_PAIR & np.uint64(255)) + np.uint64(1)) >> np.uint64(32)) % np.uint64(ENDINGS // WAYS) * np.uint64(WAYS) + (mixed(_PAIR + np.uint64(1)) >> np.uint64(32)) % np.uint64(WAYS)).astype(np.int64)


@dataclass
class Tokens:
    h: np.ndarray  # hashes, each text's words and then END
    ending: np.ndarray  # bucket of the ending; of END 0
    place: np.ndarray  # place in the text, from 0
    first: np.ndarray  # bounds per text


def tokens(arr: pa.Array) -> Tokens:
    w = split(arr, SPACES)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    h = np.empty(first[-1], np.uint64)
    ending = np.zeros(first[-1], np.int64)
    ends = first[1:] - 1
    word = np.ones(first[-1], bool)
    word[ends] = False
    h[ends] = END
    h[word] = w.hashes()
    last = w.data[w.ends - 1]
    before = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0)
    ending[word] = _ENDING[before.astype(np.int64) << 8 | last]
    return Tokens(h, ending, np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first)), first)


class Head:
    """Counts of the commonest words by hash: an open table searched for many words at once."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, singles: np.ndarray):
        self.bits = max(4, int(len(hashes)).bit_length() + 2)
        n = 1 << self.bits
        self.h, self.c, self.s = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.full(n, -1, np.int16)
        taken = np.zeros(n, bool)
        single = {int(x): i for i, x in enumerate(singles)}
        rest = np.arange(len(hashes))
        slot = self._slot(hashes)
        self.probes = 0
        while len(rest):  # place all that find their slot free, one per slot; the others move on
            self.probes += 1
            at = slot[rest]
            free = ~taken[at]
            _, one = np.unique(at[free], return_index=True)
            won = rest[free][one]
            self.h[slot[won]], self.c[slot[won]] = hashes[won], counts[won]
            taken[slot[won]] = True
            keep = np.ones(len(hashes), bool)
            keep[won] = False
            rest = rest[keep[rest]]
            slot[rest] = (slot[rest] + 1) & (n - 1)
        for x, i in single.items():
            at = int(self._slot(np.array([x], np.uint64))[0])
            while self.h[at] != np.uint64(x):
                at = (at + 1) & (n - 1)
            self.s[at] = i

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (mixed(h) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0: not here) and numbers of single classes (-1: none)."""
        slot = self._slot(h)
        count, single = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int16)
        open_ = np.arange(len(h))
        for _ in range(self.probes):
            at = slot[open_]
            hit = self.h[at] == h[open_]
            count[open_[hit]], single[open_[hit]] = self.c[at[hit]], self.s[at[hit]]
            open_ = open_[~hit & (self.c[at] > 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.h) - 1)
        return count, single


@dataclass
class Lexicon:
    """What every executor gets: sizes are fixed."""

    total: int
    types: int
    hashes: np.ndarray
    counts: np.ndarray
    singles: np.ndarray  # hashes
    mass: np.ndarray  # tokens of each part (classes x 16); a single's are all in part 0
    kinds: np.ndarray  # words of each part of a bucket

    def head(self) -> Head:
        if not hasattr(self, "_head"):
            self._head = Head(self.hashes, self.counts, self.singles)
        return self._head

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_head"}

    @property
    def bits(self) -> int:
        return slot_bits(self.types)

    def biases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log shares of groups (1 x 16), of classes in groups (16 x 16) and of parts in classes (256 x 16)."""
        by_class = self.mass.sum(1).reshape(WAYS, WAYS)
        return tuple(np.log((m + 1) / (m.sum(1, keepdims=True) + WAYS)).astype(np.float32) for m in (by_class.sum(1)[None], by_class, self.mass))


def slot_bits(types: int) -> int:
    """A row of the feature table for every sixteen different words, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, int(types).bit_length() - 4))


def vocabulary(train: DataFrame, text: str) -> DataFrame:
    """All training tokens: h, ending, c. Partitions count first, in bounded memory."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, s, c = (np.concatenate(x) for x in zip(*parts))
        u, at, back = np.unique(h, return_index=True, return_inverse=True)
        return u, s[at], np.bincount(back, c, minlength=len(u)).astype(np.int64)

    def batches_of(h: np.ndarray, s: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(h), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[i : i + 50_000].view(np.int64)), pa.array(s[i : i + 50_000].astype(np.int32)), pa.array(c[i : i + 50_000])], ["h", "ending", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for part in pieces(batch, column=0):
                t = tokens(part.column(0))
                held.append(merged([(t.h, t.ending, np.ones(len(t.h)))]))
                size += len(held[-1][0])
                if size > 3_000_000:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > 2_000_000:
                        yield from batches_of(*held[0])
                        held, size = [], 0
        if held:
            yield from batches_of(*merged(held))

    src = train.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return written(src.mapInArrow(run, "h long, ending int, c long").groupBy("h").agg(F.first("ending").alias("ending"), F.sum("c").alias("c")), "vocab")


def lexicon(vocab: DataFrame) -> Lexicon:
    step = F.floor(F.log2("c") * 64).cast("int")
    levels = sorted(((r[0], r[1]) for r in vocab.groupBy(step.alias("level")).count().collect()), reverse=True)
    room, least = (1 << HEAD_BITS) - 1, None
    for level, many in levels:
        if many > room:
            break
        room, least = room - many, level
    end = int(END.astype(np.int64))
    head = vocab.where((step >= (least if least is not None else 1 << 20)) | (F.col("h") == end)).select("h", "c", "ending").toArrow()
    h, c, s = (head.column(i).to_numpy() for i in range(3))
    order = np.lexsort((h, -c))
    h, c, s = h[order].view(np.uint64), c[order], s[order]
    chosen = np.concatenate([np.flatnonzero(h == END), np.flatnonzero(h != END)[: SINGLES - 1]])
    mass, kinds = np.zeros((CLASSES, WAYS), np.int64), np.zeros((CLASSES, WAYS), np.int64)
    total = types = 0
    for k, part, n, v in vocab.groupBy("ending", F.shiftrightunsigned("h", 60).alias("part")).agg(F.sum("c"), F.count("*")).collect():
        mass[SINGLES + k, part], kinds[SINGLES + k, part] = n, v
        total, types = total + n, types + v
    for i, at in enumerate(chosen):
        mass[i, 0] = c[at]
        mass[SINGLES + s[at], int(h[at] >> np.uint64(60))] -= c[at]
        kinds[SINGLES + s[at], int(h[at] >> np.uint64(60))] -= 1
    return Lexicon(int(total), int(types), h, c, h[chosen], mass, kinds)


@dataclass
class Choices:
    """One softmax over sixteen outcomes for some tokens: rows of the feature table, rows of the bias, outcomes."""

    tokens: np.ndarray  # numbers of the tokens
    slots: np.ndarray  # features x tokens
    node: np.ndarray  # what is chosen above
    outcome: np.ndarray


def choices(t: Tokens, cls: np.ndarray, bits: int) -> list[Choices]:
    """The three softmaxes of all tokens; places before a text's start count as a value of their own."""
    n = len(t.h)

    def back(x: np.ndarray, d: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        out[d:] = x[: n - d] if d <= n else x[:0]
        out[t.place < d] = np.uint64(0xABCDEF)
        return out

    c = (cls + 1).astype(np.uint64)
    c1, c2 = back(c, 1), back(c, 2)
    history = [mixed(x + np.uint64(0x632BE59BD9B4E019 * (k + 1) % 2**64)) for k, x in enumerate((back(t.h, 1), back(t.h, 2), c1 << np.uint64(32) | c2))]

    def slots(some: np.ndarray | slice, kinds: int, node: np.ndarray, level: int) -> np.ndarray:
        above = mixed((node + (level << 32)).astype(np.uint64))
        return np.stack([((history[k][some] ^ above) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(64 - bits)).astype(np.int64) for k in range(kinds)])

    every, bucket = np.arange(n), np.flatnonzero(cls >= SINGLES)
    group, root = cls >> 4, np.zeros(n, np.int64)
    return [
        Choices(every, slots(slice(None), 3, root, 1), root, group), Choices(every, slots(slice(None), 3, group, 2), group, cls & 15),
        Choices(bucket, slots(bucket, 1, cls[bucket], 3), cls[bucket], (t.h[bucket] >> np.uint64(60)).astype(np.int64)),
    ]


def classes(t: Tokens, lex: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Class and count in the head (0: not there) of each token."""
    count, single = lex.head().find(t.h)
    return np.where(single >= 0, single, SINGLES + t.ending).astype(np.int64), count


def exponentials(w: np.ndarray, bias: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the logits and their sums. Weights within LARGEST and biases of at most 0 leave no room for overflow."""
    z = bias
    for one in slots:
        z += np.take(w, one, axis=0)
    np.exp(z, out=z)
    return z, z @ np.ones(WAYS, np.float32)


def log_probabilities(w: np.ndarray, bias: np.ndarray, slots: np.ndarray, outcome: np.ndarray) -> np.ndarray:
    """Log softmax at each row's outcome; `bias` is used up."""
    e, total = exponentials(w, bias, slots)
    return np.log(e[np.arange(len(e)), outcome] / total)


def segment_sums(rows: np.ndarray, starts: np.ndarray, halvings: int = 4) -> np.ndarray:
    """Sums of runs of rows: neighbours within all runs are added at once, which halves the runs; then one sum a run."""
    size = np.diff(np.append(starts, len(rows)))
    out = np.take(rows, starts, axis=0)
    long = np.flatnonzero(size > 1)
    if not len(long):
        return out
    size = size[long]
    begin = np.cumsum(size) - size
    rows = np.take(rows, np.repeat(starts[long] - begin, size) + np.arange(size.sum()), axis=0)
    for _ in range(halvings):
        half = size + 1 >> 1
        place = np.cumsum(half) - half
        left = np.repeat(begin - 2 * place, half) + 2 * np.arange(half.sum())
        right = left + 1
        right[(place + half - 1)[size & 1 == 1]] = len(rows)  # a run's last row without a neighbour: a row of zeros
        rows = np.take(rows, left, axis=0) + np.take(np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)]), right, axis=0)
        size, begin = half, place
    out[long] = np.add.reduceat(rows, begin, axis=0)
    return out


def gradient(w: np.ndarray, bias: np.ndarray, slots: np.ndarray, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the table that a minibatch touches, how often, and the sums of the log loss's gradient for them; `bias` is used up."""
    g, total = exponentials(w, bias, slots)
    g /= total[:, None]
    g[np.arange(len(g)), outcome] -= 1
    flat = slots.ravel()
    keys = np.sort(flat << 32 | np.arange(len(flat)))  # unique keys: sorting them is an argsort
    rows = keys >> 32
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[starts], np.diff(np.append(starts, len(rows))), segment_sums(np.take(g, (keys & 0xFFFFFFFF) % len(g), axis=0), starts)


def descend(w: np.ndarray, seen: np.ndarray, squares: np.ndarray, bias: np.ndarray, slots: np.ndarray, outcome: np.ndarray) -> None:
    """One AdaGrad step on a minibatch, in place."""
    at, many, sums = gradient(w, bias, slots, outcome)
    sums /= np.sqrt(many, dtype=np.float32)[:, None]
    seen[at] += many
    squares[at] += np.einsum("ij,ij->i", sums, sums) / 8
    sums *= (RATE / np.sqrt(squares[at] + np.float32(1e-6)))[:, None]
    w[at] = np.clip(np.take(w, at, axis=0) - sums, -LARGEST, LARGEST)


def partition_table(texts: Iterator[pa.Array], lex: Lexicon) -> np.ndarray:
    """The feature table that the texts train, and in a last column how often each row was seen."""
    n = 1 << lex.bits
    w, seen, squares = np.zeros((n, WAYS), np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32)
    biases = lex.biases()
    for arr in texts:
        t = tokens(arr)
        cls, _ = classes(t, lex)
        for bias, c in zip(biases, choices(t, cls, lex.bits)):
            # interleave far-apart tokens: a batch of one text alone would pull too far
            steps = max(1, -(-len(c.tokens) // BATCH))
            for s in range(steps if len(c.tokens) else 0):
                some = slice(s, None, steps)
                descend(w, seen, squares, np.take(bias, c.node[some], axis=0), c.slots[:, some], c.outcome[some])
    return np.concatenate([w, seen[:, None]], 1)


def trained(train: DataFrame, text: str, lex: Lexicon) -> np.ndarray:
    sent = train.sparkSession.sparkContext.broadcast(lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = partition_table((part.column(0) for batch in batches for part in pieces(batch, 1 << 20, column=0)), sent.value)
        if out[:, -1].any():
            out[:, :-1] *= out[:, -1:]
            yield from pa.Table.from_pandas(matrix_rows(out, 1 << 12), preserve_index=False).to_batches()

    src = train.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    sums = stacked(summed_by_key(src.mapInArrow(run, "slot int, vec binary"), "f4"), (-1, WAYS + 1), "f4")
    if not len(sums):
        return np.zeros((1 << lex.bits, WAYS), np.float32)
    return sums[:, :-1] / np.maximum(sums[:, -1:], 1)


_DOC = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()),
    T.StructField("model", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType())),
])


def scored(docs: DataFrame, vocab: DataFrame, lex: Lexicon, w: np.ndarray, carry: dict[str, Column], text: str = "text") -> DataFrame:
    """Per document: `carry`, n_tokens, n_known, train_tokens, base_score, score."""
    sent = docs.sparkSession.sparkContext.broadcast((lex, w))

    def run(arr: pa.Array) -> list[pa.Array]:
        out: list[list] = [[], [], [], [], [], []]
        for part in pieces(pa.RecordBatch.from_arrays([arr], ["text"]), 1 << 20, column=0):
            for kept, new in zip(out, chunk(part.column(0))):
                kept.append(new)
        return [pa.concat_arrays(x) if x else pa.array([], k.dataType) for x, k in zip(out, _DOC)]

    def chunk(arr: pa.Array) -> list[pa.Array]:
        lex, w = sent.value
        t = tokens(arr)
        n = len(arr)
        doc = np.repeat(np.arange(n), np.diff(t.first))
        cls, count = classes(t, lex)
        model = np.zeros(len(t.h))
        for bias, c in zip(lex.biases(), choices(t, cls, lex.bits)):
            for s in range(0, len(c.tokens), BATCH):
                some = slice(s, s + BATCH)
                model[c.tokens[some]] += log_probabilities(w, np.take(bias, c.node[some], axis=0), c.slots[:, some], c.outcome[some])
        model /= np.log(10)
        size = np.log10(lex.mass + lex.kinds + 1)
        logs = np.log10(count + 1)
        bucket = cls >= SINGLES
        model[bucket] += logs[bucket] - size[cls[bucket], (t.h[bucket] >> np.uint64(60)).astype(np.int64)]
        rare = np.flatnonzero(count == 0)
        order = np.lexsort((t.h[rare], doc[rare]))
        rare = rare[order]
        new = np.ones(len(rare), bool)
        new[1:] = (t.h[rare][1:] != t.h[rare][:-1]) | (doc[rare][1:] != doc[rare][:-1])
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(rare)))
        ends = pa.array(np.searchsorted(doc[rare[starts]], np.arange(n + 1)).astype(np.int32))
        return [
            pa.array(np.diff(t.first)), pa.array(np.bincount(doc, count > 0, minlength=n).astype(np.int64)), pa.array(np.bincount(doc, logs, minlength=n)),
            pa.array(np.bincount(doc, model, minlength=n)), pa.ListArray.from_arrays(ends, pa.array(t.h[rare[starts]].view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
        ]

    found = arrow_scan(docs, text, carry, _DOC, run).select("row.*", "res.*")
    rows = written(found.withColumn("rid", F.monotonically_increasing_id()), "scored")
    rare = rows.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("rid", F.col("r.rare").alias("h"), F.col("r.times").alias("times"))
    late = rare.join(vocab.select("h", "c"), "h").groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("seen"))
    more = F.coalesce("more", F.lit(0.0))
    per_token = float(np.log10(lex.total + lex.types + 1))
    return rows.join(late, "rid", "left").select(
        *carry, "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * per_token).alias("base_score"), (F.col("model") + more).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold(F.col("doc_id"), 7) == 2
    train = docs.where(~held)
    vocab = vocabulary(train, "text")
    lex = lexicon(vocab)
    return scored(docs, vocab, lex, trained(train, "text", lex), {"doc_id": F.col("doc_id"), "held_out": held})
