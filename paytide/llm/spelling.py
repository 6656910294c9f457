"""Spelling variants: words one edit apart, the more frequent one as form of the rarer.

Words are counted in Spark. Every word's edits are then probed against Bloom filters of the
vocabulary, one for each word length: a filter is made of 64-bit blocks, and a key sets and tests
``BITS`` bits of one block. Blocks are filled in the tasks, united by Spark with bit_or and
broadcast; ``MOST_BLOCKS`` bounds them whatever the vocabulary, and a fuller filter only lets more
false positives through. Edits that test positive meet the vocabulary in an exact join, which
removes these. Of a pair of words only one side is probed, the longer one or, of equal lengths, the
one of the smaller letter where they differ; the join gives both sides.

Rows: a null text has no words; a null doc_id is the empty string in its hash. Rows are never
merged, so repeated rows count repeatedly. Words of any length take part (those of ``LONG`` letters
and more share a filter, edits of long words are made in slices); an empty table gives an empty
one. Of near words of equal frequency the first in code-point order is the form. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm.common import lower_ascii
from paytide.llm.hashing import U, mixed, powers
from paytide.session import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: One in so many runs loses a letter.
DAMAGED = 97
#: Least letters and occurrences of a word, and how much more frequent its form must be.
LETTERS_LEAST, TIMES_LEAST, FORM_FACTOR = 5, 3, 2
#: Bits a key has in its block, filter bits a word, and blocks (8 bytes) of all filters together.
BITS, BITS_A_WORD, MOST_BLOCKS = 4, 16, 1 << 22
#: From so many letters on, lengths share a filter.
LONG = 64
#: Edits that are probed at once.
PROBED = 1 << 20

_BASE = 0xD1342543DE82EF95
_INVERSE = U(pow(_BASE, -1, 1 << 64))
_LENGTH = 0x9E3779B97F4A7C15
_CODES = mixed(np.arange(1, 257, dtype=U) * U(_LENGTH))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the vocabulary, over the whole texts."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= LETTERS_LEAST)
    # lower() also takes letters beyond ASCII, which stay as they are here
    ascii_only = F.octet_length("run") == F.length("run")
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(lower_ascii(F.col("run"))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "cast(h % length(run) AS int)"
    cut = F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")
    words = runs.select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= LETTERS_LEAST)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= TIMES_LEAST)


def _keys(raw: np.ndarray, length: int) -> np.ndarray:
    return mixed(raw + U(length * _LENGTH % 2**64))


def _blocks_and_masks(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key, of a power of two of them, and its bits there."""
    mask = np.zeros(len(keys), dtype=U)
    for i in range(BITS):
        mask |= U(1) << ((keys >> U(6 * i)) & U(63))
    return ((keys >> U(32)) & U(blocks - 1)).astype(np.int64), mask


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and letters (all below 256) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        step = max(1, PROBED // int(length))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            data = "".join(words[r] for r in some.tolist()).encode("latin-1")
            yield int(length), some, np.frombuffer(data, dtype=np.uint8).reshape(len(some), int(length))


def shard_of(length: int) -> int:
    return min(length, LONG)


def filter_sizes(counts: dict[int, int]) -> dict[int, int]:
    """Blocks of each shard, powers of two, ``MOST_BLOCKS`` together at most."""
    share = min(1.0, MOST_BLOCKS / 2 / max(1.0, sum(counts.values()) * BITS_A_WORD / 64))
    wanted = {s: max(8, math.ceil(n * BITS_A_WORD / 64 * share)) for s, n in counts.items()}
    return {s: 1 << (n - 1).bit_length() for s, n in wanted.items()}


class Filters:
    """The Bloom filters of all lengths in one array."""

    def __init__(self, sizes: dict[int, int], filled: np.ndarray, at: np.ndarray) -> None:
        self.sizes, self.starts = sizes, {}
        total = 0
        for shard in sorted(sizes):
            self.starts[shard] = total
            total += sizes[shard]
        self.bits = np.zeros(total, dtype=U)
        self.bits[at] = filled

    def hold(self, keys: np.ndarray, length: int) -> np.ndarray:
        shard = shard_of(length)
        if shard not in self.sizes:
            return np.zeros(len(keys), dtype=bool)
        block, mask = _blocks_and_masks(keys, self.sizes[shard])
        return self.bits[self.starts[shard] + block] & mask == mask


def filters(vocabulary: DataFrame) -> Filters:
    """Built by Spark; what reaches the driver are the blocks, ``MOST_BLOCKS`` at most."""
    shard = F.least(F.length("word"), F.lit(LONG))
    sizes = filter_sizes({r.shard: r["count"] for r in vocabulary.groupBy(shard.alias("shard")).count().collect()})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, letters in _by_length(batch.column(0).to_pylist()):
                raw = (_CODES[letters] * powers(_BASE, length)).sum(axis=1, dtype=U)
                block, mask = _blocks_and_masks(_keys(raw, length), sizes[shard_of(length)])
                shards = pa.array(np.full(len(block), shard_of(length), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([shards, pa.array(block), pa.array(mask.view(np.int64))], ["shard", "block", "mask"])

    united = vocabulary.select("word").mapInArrow(fill, "shard int, block long, mask long")
    united = united.groupBy("shard", "block").agg(F.bit_or("mask").alias("mask")).toArrow()
    made = Filters(sizes, np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64))
    starts = np.array([made.starts[s] for s in united.column("shard").to_pylist()], dtype=np.int64)
    made.bits[starts + united.column("block").to_numpy()] = united.column("mask").to_numpy().view(U)
    return made


def probed(words: list[str], alphabet: np.ndarray, held: Filters) -> Iterator[tuple[int, str]]:
    """(word, edit) of the edits that the filters hold: each deletion, and each later letter in place of one."""
    for length, rows, letters in _by_length(words):
        factors = powers(_BASE, length)
        terms = _CODES[letters] * factors
        until = np.cumsum(terms, axis=1, dtype=U)
        raw = until[:, -1:]
        if length > LETTERS_LEAST:
            shorter = (until - terms) + (raw - until) * _INVERSE
            fresh = np.ones(letters.shape, dtype=bool)
            fresh[:, 1:] = letters[:, 1:] != letters[:, :-1]  # of a run of equal letters one deletion is enough
            row, place = np.nonzero(fresh)
            hit = held.hold(_keys(shorter[row, place], length - 1), length - 1)
            for r, i in zip(row[hit].tolist(), place[hit].tolist(), strict=True):
                word = words[rows[r]]
                yield int(rows[r]), word[:i] + word[i + 1 :]
        step = max(1, PROBED // max(1, len(alphabet)))
        for i in range(length):
            for cut in range(0, len(rows), step):
                own = letters[cut : cut + step, i]
                row, code = np.nonzero(alphabet[None, :] > own[:, None])
                other = raw[cut + row, 0] + (_CODES[alphabet[code]] - _CODES[own[row]]) * factors[i]
                hit = held.hold(_keys(other, length), length)
                for r, c in zip((cut + row[hit]).tolist(), alphabet[code[hit]].tolist(), strict=True):
                    word = words[rows[r]]
                    yield int(rows[r]), word[:i] + chr(c) + word[i + 1 :]


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for both sides of every two words that are one edit apart."""
    spark = vocabulary.sparkSession
    held = spark.sparkContext.broadcast(vars(filters(vocabulary)))
    # at most the 90 letters that a word can hold
    used = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r.letter) for r in used), dtype=np.uint8)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = Filters.__new__(Filters)
        vars(given).update(held.value)
        for batch in batches:
            words, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: list[tuple[int, str]] = []
            room = 0

            def flush(found=found, words=words, numbers=numbers):
                columns = [[words[r] for r, _ in found], [numbers[r] for r, _ in found], [e for _, e in found]]
                kinds = [pa.string(), pa.int64(), pa.string()]
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "edit"])

            for r, edit in probed(words, alphabet, given):
                found.append((r, edit))
                room += len(edit)
                if room > PROBED:
                    yield flush()
                    found.clear()
                    room = 0
            if found:
                yield flush()

    edits = vocabulary.mapInArrow(probe, "word string, n long, edit string")
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = stored(edits.join(known, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n"), "near")
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root): the last of each word's forms, following twice as far in every round."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        onward = found.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        found = stored(found.join(onward, F.col("root") == F.col("via"), "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return found


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents."""
    vocabulary = stored(word_counts(docs), "vocabulary")
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    words = vocabulary.join(near, "word", "left")
    form = F.expr(f"IF(-best.n >= {FORM_FACTOR} * n, best, null)")
    words = words.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("best"))
    words = stored(words.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.n")).alias("form_n")), "forms")
    # each form is at least twice as frequent as its word, so chains are short
    most = vocabulary.agg(F.max("n")).first()[0] or TIMES_LEAST
    hops = int(math.log(most / TIMES_LEAST, FORM_FACTOR)) + 1
    rooted = roots(words.filter("form IS NOT NULL"), math.ceil(math.log2(hops + 1)))
    return words.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
