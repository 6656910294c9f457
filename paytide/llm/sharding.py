"""Sharding by a keyed permutation of global row numbers.

A Feistel network over Z_a x Z_b, the smallest such rectangle that holds all row numbers,
permutes 0..a*b-1. A number that lands outside 0..n-1 is sent through it again (cycle
walking), which makes the whole a permutation of 0..n-1. Row number r goes to place
p = perm(r): shard p mod k, slot p div k. Shards differ by one row at most, slots have no
gaps, and both can be computed from the row number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.functions.position import with_position
from paytide.llm.common import key_number

ROUNDS = 4


def sides(n: int) -> tuple[int, int]:
    """The rectangle: a*b >= n, with fewer than a places to spare."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _mixed(half: str, seed: int, i: int) -> str:
    """The round function: 32 bits of an md5 over the round's key and the other half."""
    text = f"concat('{key_number(seed, i)}:', cast({half} AS string))"
    return f"cast(conv(substring(md5({text}), 1, 8), 16, 10) AS bigint)"


def _rounds(a: int, b: int, seed: int):
    """Per round: which half changes, and its new value from the halves l and r."""
    for i in range(ROUNDS):
        if i % 2 == 0:
            yield "l", f"(({{l}}) + {_mixed('{r}', seed, i)}) % {a}"
        else:
            yield "r", f"(({{r}}) + {_mixed('{l}', seed, i)}) % {b}"


def network_sql(x: str, n: int, seed: int) -> str:
    """One pass of the network over ``x`` as one SQL expression."""
    a, b = sides(n)
    halves = {"l": f"(({x}) div {b})", "r": f"(({x}) % {b})"}
    for half, value in _rounds(a, b, seed):
        halves[half] = f"({value.format(**halves)})"
    return f"({halves['l']} * {b} + {halves['r']})"


def permuted(df: DataFrame, number: str, n: int, seed: int, name: str) -> DataFrame:
    """Add the place of row number ``number`` of ``n`` as column ``name``.

    The first pass runs round by round, in code that Spark compiles. Only what lands outside,
    fewer than sqrt(n)+1 numbers, walks on, and as many steps as there are places to spare
    always bring it back.
    """
    a, b = sides(n)
    out = df.withColumn("_l", F.expr(f"`{number}` div {b}")).withColumn("_r", F.expr(f"`{number}` % {b}"))
    for half, value in _rounds(a, b, seed):
        out = out.withColumn(f"_{half}", F.expr(value.format(l="_l", r="_r")))
    out = out.withColumn("_x", F.expr(f"_l * {b} + _r"))
    if spare := a * b - n:
        step = f"CASE WHEN v >= {n} THEN {network_sql('v', n, seed)} ELSE v END"
        walk = f"aggregate(sequence(1, {spare}), _x, (v, i) -> {step})"
        out = out.withColumn("_x", F.expr(f"CASE WHEN _x >= {n} THEN {walk} ELSE _x END"))
    return out.withColumn(name, F.col("_x")).drop("_l", "_r", "_x")


def shards(rows: DataFrame, order: list[str], n_shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot`` (both from 0) to every row.

    The global row number is the row's rank by ``order``. Rows alike in all of ``order`` are
    told apart by where they are read, so a great many equal keys still spread over tasks;
    they may swap places from run to run, which shows only in columns left out of ``order``.
    Null keys sort first. An empty table gives an empty result. Columns named ``shard`` or
    ``slot`` are replaced.
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    rows = rows.drop("shard", "slot").withColumn("_tie", F.monotonically_increasing_id())
    numbered = with_position(rows, [*order, "_tie"], "_number").drop("_tie")
    n = numbered.count()
    placed = permuted(numbered, "_number", n, seed, "_place") if n else numbered.withColumn("_place", F.lit(0).cast("long"))
    return placed.select(
        *[f"`{c}`" for c in rows.columns if c != "_tie"],
        F.expr(f"cast(_place % {n_shards} AS int)").alias("shard"),
        F.expr(f"_place div {n_shards}").alias("slot"),
    )


def shard_documents(docs: DataFrame, n_shards: int = 16, seed: int = 0) -> DataFrame:
    """Shard and slot of every document, by its id and then its text's digests.

    Returns doc_id, size (UTF-8 bytes and one), text_crc32, law ('rows': the counts of two
    shards differ by one at most), shard, slot and grown_shard (null: only the key law has
    one). Copies of a text are rows like others and spread evenly. A null text has size 1 and
    the crc of the empty text; equal rows are each kept. The text itself never moves.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
    )
    return shards(narrow, ["doc_id", "size", "text_crc32", "_text"], n_shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
