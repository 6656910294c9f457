"""Language-model scoring with a probabilistic suffix tree over words.

Words are counted over all training documents. The tree's contexts are runs of up to ``depth``
words (a start mark may come first). A run is a candidate while it occurs at least ``support``
times, which is found level by level: a run can only be that frequent if its first and last
parts are. A context is kept if its next-word distribution diverges from that of its longest
kept suffix: the gain in training log-likelihood must pass a description-length price.

A kept context gives its frequent next words their discounted share and passes the rest of the
mass on to the suffix context, down to the root, which is the add-one word distribution. Each
state's distribution sums to one. A word is scored by the longest kept suffix of what precedes it.

Support grows as the square root of the corpus and nothing else limits a level: N / support runs
at most, so the broadcast tree grows with the input, as sqrt(N) / c0. The counts of at least
total / ``MOST`` words are broadcast too; those of the others are joined. Words are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm import hashing
from paytide.session import stored

U = np.uint64
MOST = 1 << 22
END = hashing.mixed(np.array([0xE0D], dtype=U))[0]
START = hashing.mixed(np.array([0x57A27], dtype=U))[0]
HELD = 1 << 20


@dataclass
class Level:
    """Runs of one length: key = first part's id << 32 | last word's id, sorted."""

    keys: np.ndarray
    counts: np.ndarray
    suffix: np.ndarray  # id of the run without its first word, one level down
    logp: np.ndarray | None = None  # log10 P(last word | the words before), if those are kept
    back: np.ndarray | None = None  # log10 of the mass passed on when this run is the context; NaN: not kept


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _sequences(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, and word hash and row of start mark, words and end of each."""
    for at, data, offsets in hashing.slices(column):
        found, rows = hashing.words(data, offsets)
        n = len(offsets) - 1
        counts = np.bincount(rows, minlength=n) + 2
        last = np.cumsum(counts) - 1
        out = np.empty(int(counts.sum()), dtype=U)
        inner = np.ones(len(out), dtype=bool)
        first = last - counts + 1
        inner[first] = inner[last] = False
        out[first], out[last], out[inner] = START, END, found
        yield at, out, np.repeat(np.arange(n), counts)


class _Counter:
    """Counts of 64-bit keys; gives out what it holds when that grows past a bound."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> pa.RecordBatch | None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.size += len(self.parts[-1][0])
        if self.size > 2 * HELD:
            self._merge()
            if self.size > HELD:
                return self.give()
        return None

    def _merge(self) -> None:
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.parts = [(keys[heads], np.add.reduceat(counts, heads))]
        self.size = len(heads)

    def give(self) -> pa.RecordBatch:
        if self.parts:
            self._merge()
        keys, counts = self.parts[0] if self.parts else (np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64))
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["key", "c"])


def _counted(docs: DataFrame, keys_of) -> DataFrame:
    """(key, c) summed over all texts; ``keys_of`` maps hashes and rows to the keys to count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for _, tokens, rows in _sequences(batch.column("text")):
                full = counter.add(keys_of(tokens, rows))
                if full is not None:
                    yield full
        yield counter.give()

    return docs.select("text").mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _collected(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted, unsigned) and counts; only called on tables that support or MOST bounds."""
    found = counts.select("key", "c").toArrow()
    keys = found.column("key").to_numpy().astype(np.int64).view(U)
    order = np.argsort(keys)
    return keys[order], found.column("c").to_numpy()[order]


def _ids(tokens: np.ndarray, rows: np.ndarray, vocabulary: np.ndarray, levels: list[Level]) -> list[np.ndarray]:
    """For every length, the id of the run that ends at each place, or -1."""
    out = [_found(vocabulary, tokens)]
    for k, level in enumerate(levels, start=1):
        ids = np.full(len(tokens), -1, dtype=np.int64)
        at = np.flatnonzero((out[-1][:-1] >= 0) & (out[0][1:] >= 0) & (rows[1:] == rows[:-1])) + 1
        if k > 1:
            at = at[out[k - 1][at] >= 0]
        keys = (out[-1][at - 1].astype(U) << U(32)) | out[0][at].astype(U)
        ids[at] = _found(level.keys, keys)
        out.append(ids)
    return out


@dataclass
class Model:
    total: int  # N, all training tokens
    distinct: int  # V
    vocabulary: np.ndarray  # hashes of frequent words, sorted; holds START and END
    counts: np.ndarray
    levels: list[Level]
    frequent: np.ndarray  # hashes of the words whose counts are broadcast, sorted
    frequent_counts: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))


def _shared(docs: DataFrame, value):
    return docs.sparkSession.sparkContext.broadcast(value)


def fit(training: DataFrame, words: DataFrame, documents: int, depth: int = 3, c0: float = 0.02, discount: float = 0.5) -> Model:
    """Grow the tree over (text) rows whose word counts are ``words`` (key, c)."""
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).head()
    support = max(2, math.ceil(c0 * math.sqrt(total)))
    # the tree needs all words of its support; of the others, at most MOST can be as frequent as total / MOST
    frequent, frequent_counts = _collected(words.filter(F.col("c") >= min(support, max(1, -(-total // MOST)))))
    keep = frequent_counts >= support
    vocabulary = np.append(frequent[keep], START)
    counts = np.append(frequent_counts[keep], documents)
    order = np.argsort(vocabulary)
    model = Model(total, distinct, vocabulary[order], counts[order], [], frequent, frequent_counts)
    for _ in range(depth):
        levels = model.levels
        shared = _shared(training, (model.vocabulary, levels))

        def runs(tokens: np.ndarray, rows: np.ndarray, shared=shared, k=len(levels)) -> np.ndarray:
            known, below = shared.value
            ids = _ids(tokens, rows, known, below)
            at = np.flatnonzero((ids[k][:-1] >= 0) & (ids[k][1:] >= 0) & (rows[1:] == rows[:-1]))
            return (ids[k][at].astype(U) << U(32)) | ids[0][at + 1].astype(U)

        keys, found = _collected(_counted(training, runs).filter(F.col("c") >= support))
        if not len(keys):
            break
        first, last = (keys >> U(32)).astype(np.int64), keys & U(0xFFFFFFFF)
        if levels:
            # a run's suffix is its first part's suffix and its last word
            below = levels[-1]
            suffix = _found(below.keys, (below.suffix[first].astype(U) << U(32)) | last)
        else:
            suffix = last.astype(np.int64)
        levels.append(Level(keys, found, suffix))
    _smooth(model, discount)
    return model


def _smooth(model: Model, discount: float) -> None:
    """Distributions and the choice of contexts, from short to long."""
    price = 0.5 * math.log(max(model.total, 2))
    backed = model.base(model.counts)  # log10 P(last word) at the longest kept suffix, a level down
    held = model.counts  # occurrences of the contexts of this level
    for level in model.levels:
        context = (level.keys >> U(32)).astype(np.int64)
        n = len(held)
        own = (level.counts - discount) / held[context]
        parent = 10.0 ** backed[level.suffix]
        used = np.bincount(context, own, minlength=n)
        lost = np.bincount(context, parent, minlength=n)
        entries = np.bincount(context, minlength=n)
        seen = np.bincount(context, level.counts, minlength=n)
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.log10((1 - used) / (1 - lost))
        gain = np.bincount(context, level.counts * (np.log(own) - np.log(parent)), minlength=n)
        gain = gain + (held - seen) * rest * math.log(10)
        kept = (entries > 0) & np.isfinite(rest) & (gain > price * entries)
        level.logp = np.where(kept[context], np.log10(own), np.nan)
        level.back = np.where(kept, rest, np.nan)
        # what a longer context falls back to: this entry if its context is kept, else the suffix's
        backed = np.where(kept[context], np.log10(own), backed[level.suffix])
        held = level.counts


def _scores(tokens: np.ndarray, rows: np.ndarray, n: int, model: Model):
    """Per row: what the tree adds to the base score; and per place whether it needs the root."""
    ids = _ids(tokens, rows, model.vocabulary, model.levels)
    gained = np.zeros(len(tokens))
    done = tokens == START
    for k in range(len(model.levels), 0, -1):
        level = model.levels[k - 1]
        before = np.full(len(tokens), -1, dtype=np.int64)
        same = rows[1:] == rows[:-1]
        before[1:][same] = ids[k - 1][:-1][same]
        state = np.flatnonzero(~done & (before >= 0))
        state = state[~np.isnan(level.back[before[state]])]
        entry = ids[k][state]
        hit = entry >= 0
        gained[state[hit]] += level.logp[entry[hit]]
        done[state[hit]] = True
        gained[state[~hit]] += level.back[before[state[~hit]]]
    return np.bincount(rows, gained, minlength=n), ~done


def score(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, held_out, text): its tokens, known tokens, base and model score.

    Counts of frequent words are at hand in every task; the other words of a document are
    looked up in the table of counts by a join.
    """
    shared = _shared(docs, model)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known_logp = m.base(m.frequent_counts)
        for batch in batches:
            if not batch.num_rows:
                continue
            outs = []
            for _, tokens, rows in _sequences(batch.column("text")):
                n = int(rows[-1]) + 1
                tree, root = _scores(tokens, rows, n, m)
                place = _found(m.frequent, tokens)
                real = tokens != START
                common = real & (place >= 0)
                base = np.zeros(len(tokens))
                base[common] = known_logp[place[common]]
                rare = np.flatnonzero(real & ~common)
                # a run of equal rows is one list; sign of the place says whether the tree used the root
                cuts = np.searchsorted(rows[rare], np.arange(n + 1))
                outs.append(
                    (
                        np.bincount(rows, real, minlength=n).astype(np.int64),
                        np.bincount(rows, common, minlength=n).astype(np.int64),
                        np.bincount(rows, base, minlength=n),
                        tree + np.bincount(rows, base * root, minlength=n),
                        tokens[rare].view(np.int64),
                        np.diff(cuts),
                    )
                )
            tokens_n, known, base, scored, rare, lengths = (np.concatenate(x) for x in zip(*outs, strict=True))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(rare, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(tokens_n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(scored, pa.float64()), lists],
                ["row", "doc_id", "held_out", "n_tokens", "known", "base", "tree", "rare"],
            )

    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    rows = stored(rows.mapInArrow(look, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, tree double, rare array<long>"), "scored")
    rare = rows.select("row", F.explode("rare").alias("key")).groupBy("key", "row").agg(F.count("*").alias("times"))
    seen = words.select("key", "c")
    floor = model.total + model.distinct + 1
    logp = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(floor)))
    more = rare.join(seen, "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"), F.sum(F.col("times") * logp).alias("rare_base")
    )
    # a rare word is never a next word of a kept context, so tree and base agree on it at the root
    return rows.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("tree") + F.coalesce("rare_base", F.lit(0.0))).alias("score"),
    )


def score_documents(docs: DataFrame, depth: int = 3, c0: float = 0.02) -> DataFrame:
    """Score all (doc_id, text) rows with a model of those whose crc32(doc_id) mod 7 is not 2.

    A null text is empty and has one token, its end. A null doc_id counts as the empty string.
    Equal rows are each scored and each counted. With no training row all counts are zero and
    every word has the root's one unseen share, log10(1) = 0. Other columns are not looked at.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    docs = docs.select("doc_id", held.alias("held_out"), "text")
    training = docs.filter(~F.col("held_out"))

    def every(tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return tokens[tokens != START]

    words = stored(_counted(training, every), "words")
    ends = words.filter(F.col("key") == F.lit(int(END.view(np.int64)))).agg(F.coalesce(F.sum("c"), F.lit(0))).head()[0]
    return score(docs, fit(training, words, ends, depth, c0), words)
