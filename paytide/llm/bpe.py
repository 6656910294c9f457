"""Byte-level BPE: texts to token ids and back, on padded matrices of the distinct pieces of a batch.

A text is cut into pieces by a pattern; each piece is encoded by itself. The distinct new pieces
of a batch are laid into matrices by the power of two above their length, one row a piece, padded
on the right. In every round each row merges its leftmost pair of least rank; ranks are looked up
for whole matrices at once in a hash table of token pairs; rows are compacted, and finished rows
leave the matrix. Pieces above ``WIDE`` bytes have a row of their own, in which a round also merges
the later places of the same pair, as long as no merge makes a pair of a lower rank: the ids are
those of one merge at a time.

Rows: null and empty texts have no ids; rows without ids (null) decode to null. Every row is
encoded by itself, so ties, repeated rows and repeated ids change nothing. Texts of any length are
read whole, their pieces as a stream; an empty table gives an empty one. Other columns stay; one
that has the name of the result is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

#: No pair: above every rank.
NONE = np.iinfo(np.int32).max
#: Bytes above which a piece has a row of its own.
WIDE = 1024
#: Cells of one matrix, and distinct pieces a task remembers between batches.
CELLS, REMEMBERED = 1 << 20, 1 << 18
#: Texts of more characters are cut piece by piece, never as a list.
LONG_TEXT = 1 << 20
#: Ids that are decoded at once.
DECODED = 1 << 20

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file; read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with linear probing, at most a quarter full."""
    size = 1 << max(4, int(4 * len(keys)).bit_length())
    table, ranks = np.full(size, _EMPTY), np.full(size, NONE, dtype=np.int32)
    slot = _slots(keys, size)
    left = np.arange(len(keys))
    while len(left):
        free = left[table[slot[left]] == _EMPTY]
        _, first = np.unique(slot[free], return_index=True)
        put = free[first]
        table[slot[put]], ranks[slot[put]] = keys[put], values[put]
        left = left[table[slot[left]] != keys[left]]
        slot[left] = (slot[left] + 1) & (size - 1)
    return table, ranks


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys * _SPREAD) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def tables(ranks: dict[bytes, int]) -> dict:
    """What tasks need of a vocabulary, as plain arrays: bounded by the rank file."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the single bytes {missing}")
    pairs = [
        (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    keys = np.array([k for k, _ in pairs], dtype=np.uint64)
    table, values = pair_table(keys, np.array([r for _, r in pairs], dtype=np.int32))
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    found = {
        "pairs": table,
        "ranks": values,
        "single": np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32),
        "data": np.frombuffer(b"".join(by_id), dtype=np.uint8),
        "ends": np.cumsum([0, *map(len, by_id)]),
        "whole": {},
    }
    # tokens that merging does not reach: a piece equal to one of them is that token
    tokens = list(ranks)
    ids, ends = Vocabulary(**found).merged(tokens)
    for i, token in enumerate(tokens):
        if ends[i + 1] - ends[i] != 1 or ids[ends[i]] != ranks[token]:
            found["whole"][token] = ranks[token]
    return found


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts`` and hold ``sizes``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class _Numbers(dict):
    """Pieces by number, in order of appearance."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Vocabulary:
    def __init__(self, pairs, ranks, single, data, ends, whole):
        self.pairs, self.ranks, self.single, self.data, self.ends, self.whole = pairs, ranks, single, data, ends, whole
        self.sizes = np.diff(ends)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.piece_ids, self.piece_ends = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair of ids, NONE where the pair is no token; negative ids are padding."""
        shape = left.shape
        keys = (left.ravel().astype(np.int64) << 32 | right.ravel()).view(np.uint64)
        slot = _slots(keys, len(self.pairs))
        seen = self.pairs[slot]
        out = np.where(seen == keys, self.ranks[slot], NONE)
        probe = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(probe):
            slot[probe] = (slot[probe] + 1) & (len(self.pairs) - 1)
            seen = self.pairs[slot[probe]]
            hit = seen == keys[probe]
            out[probe[hit]] = self.ranks[slot[probe[hit]]]
            probe = probe[~hit & (seen != _EMPTY)]
        out[(left.ravel() < 0) | (right.ravel() < 0)] = NONE
        return out.reshape(shape)

    def _rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and ids of the rows of a padded matrix, as they finish."""
        rows = np.arange(len(ids))
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            least = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            over = least == NONE
            if over.any():
                yield rows[over], ids[over]
                go = ~over
                rows, ids, ranks, at, least = rows[go], ids[go], ranks[go], at[go], least[go]
                if not len(rows):
                    return
            every = np.arange(len(rows))
            ids[every, at] = least
            ids = self._compact(ids, at)
            ranks = self._compact(ranks, at)
            # only the pairs before and behind the merged one are new
            for place in (at - 1, at):
                some = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                ranks[some, place[some]] = self.rank(ids[some, place[some]], ids[some, place[some] + 1])
            used = int((ids >= 0).sum(axis=1).max())
            ids, ranks = ids[:, :used], ranks[:, : max(used - 1, 0)]

    @staticmethod
    def _compact(cells: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Without the cell behind ``at`` in each row; as wide as before less one."""
        column = np.arange(cells.shape[1] - 1)
        return np.take_along_axis(cells, column + (column > at[:, None]), axis=1) if cells.shape[1] > 1 else cells[:, :0]

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """One row of many ids."""
        ranks = self.rank(ids[:-1], ids[1:])
        while len(ranks) and (low := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == low)
            # places of a run of neighbours overlap: every other one is merged
            run = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            behind = at[at + 2 < len(ids)] + 2
            passing = self.rank(np.full(len(behind), low, dtype=np.int32), ids[behind])
            new, fresh, place = self._merge_at(ids, at, low)
            if min(passing.min(initial=NONE), fresh.min(initial=NONE)) < low:
                at = at[:1]  # a new pair comes before the later places: only the leftmost is merged
                new, fresh, place = self._merge_at(ids, at, low)
            ids, ranks = new, np.delete(ranks, at)
            ranks[place] = fresh
        return ids

    def _merge_at(self, ids: np.ndarray, at: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids after merging at places that do not overlap, and the ranks of new pairs with their places."""
        new = ids.copy()
        new[at] = low
        new = np.delete(new, at + 1)
        merged = at - np.arange(len(at))
        place = np.unique(np.concatenate((merged - 1, merged)))
        place = place[(place >= 0) & (place < len(new) - 1)]
        return new, self.rank(new[place], new[place + 1]), place

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and where each piece's begin and end."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        data = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        starts = np.cumsum(sizes) - sizes
        done: list[tuple[np.ndarray, np.ndarray]] = []  # piece of each id, ids
        band = np.frompyfunc(int.bit_length, 1, 1)(np.maximum(sizes - 1, 0)).astype(np.int64)
        for b in np.unique(band):
            members = np.flatnonzero((band == b) & (sizes > 0))
            if (1 << int(b)) > WIDE:
                for i in members.tolist():
                    ids = self._long(data[starts[i] : starts[i] + sizes[i]])
                    done.append((np.full(len(ids), i), ids))
                continue
            step = max(1, CELLS >> int(b))
            for cut in range(0, len(members), step):
                some = members[cut : cut + step]
                column = np.arange(int(sizes[some].max(initial=0)))
                inside = column < sizes[some, None]
                padded = np.where(inside, data[np.where(inside, starts[some, None] + column, 0)], -1)
                for rows, ids in self._rows(padded):
                    real = ids >= 0
                    done.append((np.repeat(some[rows], real.sum(axis=1)), ids[real]))
        owner = np.concatenate([np.zeros(0, dtype=np.int64), *[i for i, _ in done]])
        ids = np.concatenate([np.zeros(0, dtype=np.int32), *[found for _, found in done]])
        flat = ids[np.argsort(owner, kind="stable")]
        ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(pieces)))))
        return flat, ends

    def _learn(self, pieces: list[bytes]) -> None:
        flat, ends = self.merged(pieces)
        special = [i for i, p in enumerate(pieces) if p in self.whole] if self.whole else []
        if special:
            runs = [flat[ends[i] : ends[i + 1]] for i in range(len(pieces))]
            for i in special:
                runs[i] = np.array([self.whole[pieces[i]]], dtype=np.int32)
            flat, ends = np.concatenate(runs), np.cumsum([0, *map(len, runs)])
        self.piece_ends = np.concatenate((self.piece_ends, self.piece_ends[-1] + ends[1:]))
        self.piece_ids = np.concatenate((self.piece_ids, flat))

    def encode(self, texts: list[str | None], pattern) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin and end."""
        if len(self.numbers) > REMEMBERED:
            self._forget()
        known = len(self.numbers)
        number, runs = self.numbers.__getitem__, []
        for text in texts:
            if not text:
                runs.append(np.zeros(0, dtype=np.int64))
            elif len(text) <= LONG_TEXT:
                runs.append(np.fromiter(map(number, pattern.findall(text)), dtype=np.int64))
            else:
                runs.append(np.fromiter((number(m[0]) for m in pattern.finditer(text)), dtype=np.int64))
        if len(self.numbers) > known:
            self._learn([p.encode() for p in list(self.numbers)[known:]])
        pieces = np.concatenate(runs) if runs else np.zeros(0, dtype=np.int64)
        starts = self.piece_ends[pieces]
        sizes = self.piece_ends[pieces + 1] - starts
        piece_ends = np.concatenate(([0], np.cumsum(sizes)))
        ends = piece_ends[np.cumsum([0, *map(len, runs)])]
        return self.piece_ids[gathered(starts, sizes)], ends

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise ValueError("an id is outside the vocabulary")
        parts = [
            self.data[gathered(self.ends[some], self.sizes[some])]
            for some in (ids[i : i + DECODED] for i in range(0, len(ids), DECODED))
        ]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint8)


def _widened(docs: DataFrame, column: str, into: str, kind: DataType, work: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``docs`` with one more column, worked out from ``column`` batch by batch.

    Columns travel under plain names, so that any name will do.
    """
    kept = [c for c in docs.columns if c != into]
    plain = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)]
    given = docs.select(F.col(f"`{column}`").alias("given"), *plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = work()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([done(batch.column(0)), *batch.columns[1:]], ["made", *batch.schema.names[1:]])

    made = given.mapInArrow(run, StructType([StructField("made", kind), *given.schema.fields[1:]]))
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], F.col("made").alias(into))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids (array of int) of the whole text; see the module for odd rows.

    The vocabulary is read on the driver and broadcast: its size is that of the rank file.
    """
    held = docs.sparkSession.sparkContext.broadcast(tables(read_ranks(ranks_path)))

    def work() -> Callable[[pa.Array], pa.Array]:
        vocabulary, cut = Vocabulary(**held.value), regex.compile(pattern)

        def done(texts: pa.Array) -> pa.Array:
            ids, ends = vocabulary.encode(texts.to_pylist(), cut)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

        return done

    return _widened(docs, text, into, ArrayType(IntegerType()), work)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes (binary) that the token ids stand for; null ids give null."""
    held = docs.sparkSession.sparkContext.broadcast(tables(read_ranks(ranks_path)))

    def work() -> Callable[[pa.Array], pa.Array]:
        vocabulary = Vocabulary(**held.value)

        def done(lists: pa.Array) -> pa.Array:
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            data = vocabulary.decode(flat).tobytes()
            ends = np.concatenate(([0], np.cumsum(vocabulary.sizes[flat])))[np.concatenate(([0], np.cumsum(counts)))].tolist()
            gone = lists.is_null().to_pylist()
            return pa.array([None if n else data[a:b] for n, a, b in zip(gone, ends[:-1], ends[1:], strict=True)], pa.binary())

        return done

    return _widened(docs, ids, into, BinaryType(), work)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token count and digests of every document, of its ids and of what they decode to."""
    encoded = encode(docs.select("doc_id", "text"), ranks_path, pattern)
    counted = encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"))
    decoded = decode(counted, ranks_path)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
