"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are dealt into blocks. A block's index holds, for every component, its postings (row,
value) in segments by quantised impact: the power of sqrt(2) that |value| reaches. A batch of
queries walks the segments from the highest impact down and adds up partial scores. What is
left of any score is at most (largest value left) * (sum of the query's absolute components), so
a row is a possible member only if its partial score plus that reaches the k-th best partial
score less that. The walk stops when this rules out most rows, or at the end; rows not ruled out
are scored exactly. Each block gives k rows a query, and the best k of all blocks are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytide.session import stored

ROWS = 4096
QUERIES = 256
#: Query batches, and bytes of them, that are broadcast together.
TOGETHER, BROADCAST_BYTES = 256, 1 << 26
FEW = 16


class Block:
    """Postings of one block, by descending impact level and component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        size = np.abs(values)
        level = np.where(size > 0, np.floor(2 * np.log2(np.maximum(size, 1))), -1).astype(np.int64)
        # column by column, so that a segment's postings lie together
        order = np.argsort(-level.T.reshape(-1), kind="stable")
        order = order[: int((level >= 0).sum())]
        self.component, self.row = np.divmod(order, max(len(values), 1))
        self.impact = level.T.reshape(-1)[order]
        self.size = size.T.reshape(-1)[order]
        heads = np.flatnonzero((np.diff(self.impact) != 0) | (np.diff(self.component) != 0)) + 1
        self.cuts = np.concatenate(([0], heads, [len(order)])) if len(order) else np.array([0])

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per query its index, and ids, scores and scores as doubles of its k best rows here (fewer if there are fewer).

        With doubles partial scores are rounded: what that can be off by keeps a row possible, and
        possible rows are scored in whole numbers of any size.
        """
        n, m = len(self.ids), len(queries)
        wide = self.values.dtype == np.float64
        lowest = -np.inf if wide else -(1 << 62)
        partial = np.zeros((n, m), dtype=self.values.dtype)
        partial[self.ids[:, None] == own[None, :]] = lowest
        weight = np.abs(queries).sum(axis=1)
        off = weight * float(np.abs(self.values).max(initial=0)) * queries.shape[1] * 2.0**-50 if wide else 0
        maybe = np.ones((n, m), dtype=bool)
        for s, (at, to) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            rows, d = self.row[at:to], self.component[at]
            partial[rows] += self.values[rows, d][:, None] * queries[None, :, d]
            ends = s + 2 == len(self.cuts)
            if n > k and not ends and self.impact[to] < self.impact[at]:
                left = self.size[to:][self.impact[to:] == self.impact[to]].max() * weight
                kth = np.partition(partial, n - k, axis=0)[n - k]
                maybe = partial >= (kth - 2 * left - 2 * off)[None, :]
                if maybe.sum() * FEW <= n * m:
                    break
        else:
            kth = np.partition(partial, n - k, axis=0)[n - k] if n > k else np.full(m, lowest)
            maybe = partial >= (kth - 2 * off)[None, :]
        for q in range(m):
            rows = np.flatnonzero(maybe[:, q] & (self.ids != own[q]))
            if wide:
                query = [int(x) for x in queries[q]]
                exact = [sum(a * b for a, b in zip(map(int, self.values[r]), query, strict=True)) for r in rows.tolist()]
                chosen = sorted(range(len(rows)), key=lambda i: (-exact[i], self.ids[rows[i]]))[:k]
                scores = np.array([min(max(exact[i], -(1 << 63)), (1 << 63) - 1) for i in chosen], dtype=np.int64)
                yield q, self.ids[rows[chosen]], scores, np.array([float(exact[i]) for i in chosen], dtype=np.float64)
            else:
                scores = self.values[rows] @ queries[q]
                first = np.lexsort((self.ids[rows], -scores))[:k]
                yield q, self.ids[rows][first], scores[first], np.zeros(len(first))


def _packed(rows: DataFrame, keys: list[str], scale: int) -> DataFrame:
    """One row per block: its ids, row keys and scaled values as bytes. Blocks are of bounded size.

    Values are whole numbers: 32-bit ones where all of a block fit, else doubles that hold them exactly.
    """

    def pack(key, table):
        with np.errstate(over="ignore"):
            flat = np.floor(table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64) * float(scale))
        if not len(flat) or np.abs(flat).max() < 1 << 31:
            flat = flat.astype(np.int32)
        blobs = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "row")]
        named = dict(zip(keys, [[k.as_py()] for k in key], strict=True))
        return pa.table(
            {c: pa.array(v, pa.int64()) for c, v in named.items()}
            | {"ids": pa.array([blobs[0]], pa.binary()), "rows": pa.array([blobs[1]], pa.binary()), "v": pa.array([flat.tobytes()], pa.binary())}
        )

    schema = ", ".join(f"{c} long" for c in keys) + ", ids binary, rows binary, v binary"
    return rows.select(*keys, "vec_id", "row", "v").groupBy(*keys).applyInArrow(pack, schema)


def _unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(data) == 4 * n * dim else np.float64
    return np.frombuffer(data, dtype=kind).reshape(n, dim)


def _pair(block: bytes, n: int, queries: bytes, m: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and queries as 64-bit integers where no score of theirs can overflow, else as doubles."""
    values, wanted = _unpacked(block, n, dim), _unpacked(queries, m, dim)
    most = dim * int(np.abs(values.astype(np.float64)).max(initial=0)) * int(np.abs(wanted.astype(np.float64)).max(initial=0))
    kind = np.int64 if most < 1 << 60 and values.dtype == wanted.dtype == np.int32 else np.float64
    return values.astype(kind), wanted.astype(kind)


def top_k(vectors: DataFrame, queries_are, k: int = 10, scale: int = 1024) -> DataFrame:
    """The k best rows for each row of vectors (vec_id, embedding) that ``queries_are`` selects.

    Components become floor(scale * x). Returns query_id, rank (from 1), vec_id, score: highest
    inner products first, ties to the smaller vec_id. A query's own rows (those of its vec_id)
    are no candidates; a repeated query row is answered once. Rows take no part if the id, the
    vector or a component is null, or a component, also a scaled one, is not finite. Scores that a
    64-bit number cannot hold are reported as the largest or smallest one, and ranked by their
    size as doubles among themselves. Vectors are compared with those of their own length, of any
    length. Equal candidate rows each count. An empty table gives an empty result.

    The index is stored once and stays where it is: queries come to it, ``TOGETHER`` batches of them
    at a time as a broadcast of bounded size, and each stage reads every block once.
    """
    spark = vectors.sparkSession
    size = lambda x: F.abs(x.cast("double") * F.lit(float(scale)))
    good = F.forall("embedding", lambda x: F.coalesce(size(x) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    kept = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = rows.select("vec_id", F.col("embedding").cast(kept).alias("v"), F.size("embedding").cast("long").alias("dim"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    scaled = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    # beyond 2**53 every double is whole, so such vectors are equal when they are
    large = F.when(F.exists("v", lambda x: size(x) >= F.lit(2.0**53)), F.col("v"))
    asked = rows.filter(queries_are).withColumns({"scaled": scaled, "large": large}).dropDuplicates(["vec_id", "scaled", "large"])
    asked = stored(asked.drop("scaled", "large"), "asked")
    n, m, dims = rows.count(), asked.count(), asked.agg(F.max("dim")).head()[0] or 1
    n_blocks, n_batches = max(1, math.ceil(n / ROWS)), max(1, math.ceil(m / QUERIES))
    index = stored(_packed(rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks))), ["dim", "block"], scale), "index")
    batches = stored(_packed(asked.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(n_batches))), ["dim", "batch"], scale), "queries")
    together = max(1, min(TOGETHER, BROADCAST_BYTES // (QUERIES * 8 * dims)))
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.desc("size"), "vec_id")
    parts: list[DataFrame] = []
    for first in range(0, n_batches, together):
        group = batches.filter((F.col("batch") >= first) & (F.col("batch") < first + together)).toArrow().to_pylist()
        found = index.select("dim", "ids", "v").mapInArrow(_searching(spark, group, k), "q_row long, query_id long, vec_id long, score long, size double")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        # a plan of its own for each of many groups
        parts.append(stored(best, "best") if n_batches > together else best)
    return reduce(DataFrame.union, parts)


def _searching(spark: SparkSession, group: list[dict], k: int):
    """Each block of the index against one group of query batches."""
    held = spark.sparkContext.broadcast(group)

    def search(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (b for batch in blocks for b in batch.to_pylist()):
            ids, built = np.frombuffer(block["ids"], dtype=np.int64), {}
            for asked in held.value:
                if asked["dim"] != block["dim"]:
                    continue
                own, asked_rows = (np.frombuffer(asked[c], dtype=np.int64) for c in ("ids", "rows"))
                values, wanted = _pair(block["v"], len(ids), asked["v"], len(own), block["dim"])
                if values.dtype not in built:
                    built[values.dtype] = Block(ids, values)
                out = [
                    (np.full(len(i), asked_rows[q]), np.full(len(i), own[q]), i, s, z)
                    for q, i, s, z in built[values.dtype].best(wanted, own, k)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["q_row", "query_id", "vec_id", "score", "size"]
                )

    return search
