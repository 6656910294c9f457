"""Toxicity by a chain of classifiers.

Categories are predicted one after the other by linear models. A later model sees the features
of the text and the probabilities of all earlier categories; while it is trained, those come
from models that did not see the row (out-of-fold predictions), so that it learns to trust them
as far as they deserve. Features are hashed words and parts of words, present or not; for each
category those that divide the sampled labelled rows most clearly, by a likelihood-ratio test,
are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytide.llm import hashing
from paytide.session import stored

BITS = 18
PART = 4
FOLDS = 3
U = np.uint64


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Per text its index and sorted distinct feature numbers: words, and runs of PART bytes in them."""
    factors = hashing.powers(0x8CB92BA72F3D8DD7, PART + 1)[1:]
    for at, data, offsets in hashing.slices(column):
        words, rows = hashing.words(data, offsets)
        values = hashing.BYTES[data]
        n = len(data) - PART + 1
        parts, part_rows = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
        if n > 0:
            blank = np.concatenate(([0], np.cumsum(hashing.BLANK[data])))
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            whole = np.flatnonzero((blank[PART:] == blank[:-PART]) & (row[PART - 1 :] == row[:n]))
            parts = np.zeros(len(whole), dtype=U)
            for i in range(PART):
                parts += values[whole + i] * factors[i]
            parts, part_rows = hashing.mixed(parts), row[whole]
        keys = np.concatenate((words, parts)) >> U(64 - BITS)
        both = (np.concatenate((rows, part_rows)).astype(U) << U(32)) | keys
        both = np.unique(both)
        found = (both >> U(32)).astype(np.int64)
        cuts = np.searchsorted(found, np.arange(len(offsets)))
        numbers = (both & U(0xFFFFFFFF)).astype(np.int64)
        for i in range(len(offsets) - 1):
            yield at + i, numbers[cuts[i] : cuts[i + 1]]


@dataclass
class Link:
    """One category's model: weights of its features and of the earlier categories' log-odds."""

    name: str
    wanted: np.ndarray  # feature numbers, sorted
    weights: np.ndarray
    chain: np.ndarray
    bias: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _blocks(n: int, size: int = 4096) -> Iterator[slice]:
    return (slice(at, min(at + size, n)) for at in range(0, n, size))


def _matrix(row: np.ndarray, own: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
    """A row of 0/1 for each text at its own features, the extra columns and a constant one."""
    full = np.zeros((len(extra), n + extra.shape[1] + 1), dtype=np.float32)
    full[row, own] = 1
    full[:, n:-1], full[:, -1] = extra, 1
    return full


def _times(full: np.ndarray, use: np.ndarray, w: np.ndarray) -> np.ndarray:
    out = np.zeros(len(use))
    for part in _blocks(len(use)):
        out[part] = full[use[part]].astype(float) @ w
    return out


def _solve(full: np.ndarray, use: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25, ridge: float = 0.3) -> np.ndarray:
    """Ridge logistic regression on the weighted 0/1 rows ``use`` by Newton steps with halving.

    Rows are widened to doubles a block at a time, so that little more than the matrix is held.
    """
    penalty = np.full(full.shape[1], ridge)
    penalty[-1] = 1e-3

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, z) - (weight * y) @ z + 0.5 * penalty @ w**2)

    w, z = np.zeros(full.shape[1]), np.zeros(len(use))
    now = loss(w, z)
    for _ in range(rounds):
        p = _sigmoid(z)
        steep, bend = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        gradient, curvature = penalty * w, np.diag(penalty)
        for part in _blocks(len(use)):
            x = full[use[part]].astype(float)
            gradient += x.T @ steep[part]
            curvature += x.T @ (x * bend[part, None])
        step, size = np.linalg.solve(curvature, gradient), 1.0
        along = _times(full, use, step)
        while (new := loss(w - size * step, z - size * along)) > now and size > 1e-4:
            size /= 2
        if now - new < 1e-6 * abs(now):
            break
        w, z, now = w - size * step, z - size * along, new
    return w


def _table(labelled: DataFrame, names: list[str]) -> dict[str, np.ndarray]:
    """Per category, summed weights of the rows of each feature among its 0 and 1 labels."""
    slots = 2 * len(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((slots, 1 << BITS))
        for batch in batches:
            labels, weight = [batch.column(c).to_pylist() for c in names], batch.column("weight").to_numpy()
            for i, found in features(batch.column("text")):
                for k, values in enumerate(labels):
                    if values[i] in (0, 1):
                        total[2 * k + values[i], found] += weight[i]
        at, feature = np.nonzero(total)
        for cut in range(0, len(at), 1 << 16):
            part = slice(cut, cut + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[part].astype(np.int32)), pa.array(feature[part].astype(np.int32)), pa.array(total[at[part], feature[part]])],
                ["slot", "feature", "c"],
            )

    found = labelled.select("text", *names, "weight").mapInArrow(count, "slot int, feature int, c double")
    rows = found.groupBy("slot", "feature").agg(F.sum("c").alias("c")).toArrow()  # at most 2 * categories * 2**18 rows
    table = np.zeros((slots, 1 << BITS))
    table[rows.column("slot").to_numpy(), rows.column("feature").to_numpy()] = rows.column("c").to_numpy()
    return {name: table[2 * k : 2 * k + 2] for k, name in enumerate(names)}


def _clearest(counts: np.ndarray, rows: np.ndarray, most: int, least: float) -> np.ndarray:
    """Feature numbers by likelihood ratio of presence against the label, strongest kept."""
    seen = counts.sum(axis=0)
    total = rows.sum()
    if not total:
        return np.zeros(0, dtype=np.int64)

    def part(a: np.ndarray, row: float, col: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log(a * total / np.maximum(row * col, 1e-9)), 0.0)

    score = sum(part(counts[k], rows[k], seen) + part(rows[k] - counts[k], rows[k], total - seen) for k in (0, 1))
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(best[2 * score[best] > least])


def drawn(marks: DataFrame, names: list[str], most_rows: int) -> DataFrame:
    """At most ``most_rows`` rows of (doc_id, one 0/1 column per category), lowest hash of the id first.

    Half of them have a positive label if there are enough. A row's ``weight`` is what its kind
    (with a positive label or without) is of all rows, over what it is of the drawn ones: the
    weighted rows have the rates of all, and weigh one each on average. Hashes are counted in
    2**16 ranges; only in the range where a kind's half ends are rows put in order.
    """
    half = most_rows // 2
    positive = F.greatest(F.lit(0), *[F.coalesce(c, F.lit(0)) for c in names])
    keyed = marks.withColumn("_y", positive).withColumn("_h", F.xxhash64("doc_id"))
    keyed = keyed.withColumn("_range", F.shiftright("_h", 48).cast("int"))
    counts = keyed.groupBy("_y", "_range").agg(F.count("*").alias("n")).orderBy("_y", "_range").toArrow()  # at most 2**17 rows
    kind, span, n = (counts.column(c).to_numpy() for c in ("_y", "_range", "n"))
    whole, cut, weight = F.lit(False), F.lit(False), F.lit(1.0)
    left = F.lit(0)
    drawn_rows = sum(min(int(n[kind == y].sum()), half) for y in (0, 1))
    for y in (0, 1):
        own = n[kind == y]
        if not own.sum():
            continue
        before = np.cumsum(own) - own
        last = max(0, int(np.searchsorted(before, half)) - 1)
        this, end = F.col("_y") == y, int(span[kind == y][last])
        whole = whole | (this & (F.col("_range") < end))
        cut = cut | (this & (F.col("_range") == end))
        left = F.when(this, half - int(before[last])).otherwise(left)
        # in steps of 2**-16, so that sums do not depend on their order
        share = own.sum() / n.sum() * drawn_rows / max(1, min(own.sum(), half))
        weight = F.when(this, max(1, round(65536 * share)) / 65536).otherwise(weight)
    order = Window.partitionBy("_y").orderBy("_h", *names)
    ending = keyed.filter(cut).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= left).drop("_r")
    return keyed.filter(whole).union(ending).withColumn("weight", weight).drop("_y", "_h", "_range")


def fit(labelled: DataFrame, names: list[str], most_features: int = 256, least: float = 20.0) -> list[Link]:
    """Train the chain on rows of (text, one 0/1 column per category, weight), a sample of bounded size.

    Rows whose label is null in a category are left out of that category's model.
    """
    labelled = labelled.select("text", *names, "weight")
    counts = _table(labelled, names)
    totals = labelled.agg(*[F.coalesce(F.sum(F.when(F.col(c) == v, F.col("weight"))), F.lit(0.0)).alias(f"{c}{v}") for c in names for v in (0, 1)]).head()
    rows = {c: np.array([totals[2 * k], totals[2 * k + 1]], dtype=float) for k, c in enumerate(names)}
    wanted = {c: _clearest(counts[c], rows[c], most_features, least) for c in names}
    union = np.unique(np.concatenate(list(wanted.values())))
    keyed = labelled.select("*", F.xxhash64("text", *names).alias("_h"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None] * batch.num_rows
            for i, f in features(batch.column("text")):
                found[i] = np.searchsorted(union, f[np.isin(f, union, assume_unique=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_h"), *(batch.column(c).cast(pa.int32()) for c in names), batch.column("weight"), pa.array(found, pa.list_(pa.int32()))], ["h", *names, "weight", "found"]
            )

    schema = "h long, " + ", ".join(f"`{c}` int" for c in names) + ", weight double, found array<int>"
    sample = keyed.select("text", "_h", *names, "weight").mapInArrow(describe, schema).toArrow()
    h, weight = sample.column("h").to_numpy(), sample.column("weight").to_numpy()
    order = np.argsort(h, kind="stable")  # rows of one hash are copies, labels included
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    found = sample.column("found").combine_chunks()
    row = np.repeat(place, found.value_lengths().to_numpy())
    found = found.flatten().to_numpy()
    labels = {c: sample.column(c).fill_null(-1).to_numpy()[order] for c in names}
    del sample
    h, weight = h[order], weight[order]
    fold = (h >> 7) % FOLDS  # copies share a fold
    earlier = np.zeros((len(h), 0))
    chain = []
    for name in names:
        label, n = labels[name], len(wanted[name])
        own = np.full(len(union), -1, dtype=np.int32)
        own[np.searchsorted(union, wanted[name])] = np.arange(n)
        has = own[found] >= 0
        full = _matrix(row[has], own[found[has]], n, earlier)
        known = np.isin(label, (0, 1))
        held = np.zeros(len(h))
        for f in range(FOLDS):
            use, ask = np.flatnonzero(known & (fold != f)), np.flatnonzero(fold == f)
            held[ask] = _times(full, ask, _solve(full, use, label[use], weight[use]))
        use = np.flatnonzero(known)
        w = _solve(full, use, label[use], weight[use])
        chain.append(Link(name, wanted[name], w[:n], w[n:-1], w[-1] if rows[name][1] else -20.0))
        earlier = np.column_stack((earlier, _log_odds(_sigmoid(held))))
        del full
    return chain


def predict(docs: DataFrame, chain: list[Link], threshold: float = 0.5) -> DataFrame:
    """Add p_<category> for each category, and ``toxic``: the last one's probability is at least ``threshold``.

    Null and empty texts have no features and get the models' base rates. Columns of these
    names are replaced.
    """
    added = [f"p_{link.name}" for link in chain]
    docs = docs.drop(*added, "toxic")
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = []
        for link in shared.value:
            w = np.zeros(1 << BITS)
            w[link.wanted] = link.weights
            dense.append(w)
        for batch in batches:
            out = np.zeros((len(dense), batch.num_rows))
            for i, found in features(batch.column("text")):
                odds = np.zeros(0)
                for k, link in enumerate(shared.value):
                    p = _sigmoid(np.float64(dense[k][found].sum() + odds @ link.chain + link.bias))
                    out[k, i] = p
                    odds = np.append(odds, _log_odds(p))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(p) for p in out), pa.array(out[-1] >= threshold)], [*batch.schema.names, *added, "toxic"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(judge, ", ".join([fields, *(f"`{c}` double" for c in added), "toxic boolean"]))


#: The chain: junk first, since what it says helps to read a text's other features.
CATEGORIES = ["low_quality", "toxic"]


def train_documents(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> list[Link]:
    """The chain for documents and labels (doc_id, quality, toxic): low quality, then toxic.

    It is fitted on at most ``most_rows`` labelled rows, so few that their ids are broadcast and
    no other text moves; they weigh what they stand for among all labels, so that decisions do
    not turn with the number of labels. Labels without a document, or with a null id, teach
    nothing and take no place in the sample. A document labelled twice counts once for each.
    """
    marks = labels.filter("doc_id IS NOT NULL").select(
        "doc_id", (1 - F.col("quality")).cast("int").alias("low_quality"), F.col("toxic").cast("int").alias("toxic")
    )
    marks = stored(marks.join(docs.select("doc_id"), "doc_id", "left_semi"), "marks")
    chosen = F.broadcast(drawn(marks, CATEGORIES, most_rows))
    return fit(stored(docs.select("doc_id", "text").join(chosen, "doc_id"), "labelled"), CATEGORIES)


def rate_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_low_quality, p_toxic and toxic for every document; equal rows are each rated."""
    return predict(docs.select("doc_id", "text"), train_documents(docs, labels)).drop("text")
