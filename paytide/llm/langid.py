"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of sample texts. A text is encoded
with every dictionary; the language whose dictionary gives the smallest result is chosen. A
narrow margin is first looked at again with a slower, stronger encoder; what stays narrow is
marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytide.session import stored

LETTER = regex.compile(r"\p{L}")
OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """Lower-cased runs of letters: case, digits and marks say little about the language."""
    return OTHER.sub(" ", text.lower()).strip().encode()


def sample(docs: DataFrame, texts: int, longest: int) -> DataFrame:
    """Up to ``texts`` different texts per language (lang, text), in hash order.

    Texts of at most ``longest`` characters come first; longer ones only fill up. Only digests
    are ranked, in 256 parts of which each gives a sixteenth of the number at most, and copies
    of a text count once.
    """
    keyed = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", F.xxhash64("text").alias("h"), (F.length("text") > longest).alias("long"), "text"
    )
    different = keyed.select("lang", "long", "h").distinct()
    # ranked within parts first: of each part only ``texts`` go on, however many rows a language has
    part = Window.partitionBy("lang", F.pmod("h", F.lit(256))).orderBy("long", "h")
    whole = Window.partitionBy("lang").orderBy("long", "h")
    least = different.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= max(1, texts // 16))
    chosen = least.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= texts)
    # stored, so that its small size is known and the texts need not move to meet it
    picked = keyed.join(stored(chosen.select("lang", "h", "r"), "sample"), ["lang", "h"])
    return picked.groupBy("lang", "r").agg(F.first("text").alias("text"))


def dictionaries(docs: DataFrame, size: int = 16 << 10, texts: int = 200, longest: int = 2000) -> dict[str, bytes]:
    """Per language ``size`` bytes of sample text (if there is less, it is repeated).

    Languages come in order of their number of rows, so that ties go to the more usual one.
    The fit looks at no more than ``texts`` texts per language; that bound is a parameter.
    Every language gets as many bytes, so that none wins by the length of its dictionary.
    """
    counts = docs.filter("lang IS NOT NULL").groupBy("lang").count()
    parts: dict[str, list[bytes]] = {r["lang"]: [] for r in sorted(counts.collect(), key=lambda r: (-r["count"], r["lang"]))}
    for row in sorted(sample(docs, texts, longest).collect(), key=lambda r: (r["lang"], r["r"])):
        have = parts[row["lang"]]
        if sum(map(len, have)) < size:
            have.append(plain(row["text"])[:size])
    out = {}
    for lang, have in parts.items():
        whole = b" ".join(have)
        if whole.strip():
            while len(whole) < size:
                whole = whole + b" " + whole
            out[lang] = whole[:size]
    return out


def _coder(content: bytes, level: int) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=words, write_checksum=False)


def _smallest(coders: list[zstandard.ZstdCompressor], raw: bytes) -> tuple[int, float]:
    """The coder of the smallest result, and how much larger the next one's is, as a share of it."""
    sizes = [len(c.compress(raw)) for c in coders]
    first, *rest = sorted(range(len(sizes)), key=sizes.__getitem__)
    return first, 1 - sizes[first] / sizes[rest[0]] if rest else 1.0


def classify(docs: DataFrame, models: dict[str, bytes], levels: tuple[int, int] = (6, 12), margin: float = 0.02) -> DataFrame:
    """Add lang_pred, score, margin and accepted to rows that have ``text``.

    lang_pred is the language of the smallest encoding (a tie goes to the one named
    first in ``models``), or 'und' if the text is null or has no letter, or there is no language to choose. margin is
    the next smallest size's excess as a share of it; score maps it to 0..1 (0 for 'und');
    accepted is false for 'und' and for margins below ``margin``. Columns of these names are
    replaced.
    """
    added = ["lang_pred", "score", "margin", "accepted"]
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(shared.value)
        quick, strong = ([_coder(c, level) for c in shared.value.values()] for level in levels)
        for batch in batches:
            preds, scores, margins, sure = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                if text is None or not names or not LETTER.search(text):
                    preds.append("und")
                    scores.append(0.0)
                    margins.append(0.0)
                    sure.append(False)
                    continue
                raw = plain(text)
                best, gap = _smallest(quick, raw)
                if gap < margin:
                    best, gap = _smallest(strong, raw)
                preds.append(names[best])
                margins.append(gap)
                scores.append(1 - (1 - gap) ** 10)
                sure.append(gap >= margin)
            out = {c: batch.column(c) for c in batch.schema.names} | {
                "lang_pred": pa.array(preds, pa.string()),
                "score": pa.array(scores, pa.float64()),
                "margin": pa.array(margins, pa.float64()),
                "accepted": pa.array(sure, pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays([x for c, x in out.items() if c != "text"], [c for c in out if c != "text"])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string, score double, margin double, accepted boolean"])
    return docs.mapInArrow(judge, schema)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Predict the language of every (doc_id, text) row; learn where crc32(doc_id) mod 5 is not 0.

    Returns doc_id, held_out, lang_pred, score, margin, accepted. Only text and lang of the
    other rows are learnt from; a null doc_id counts as the empty string and so is held out.
    Equal rows are each answered.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    docs = docs.select("doc_id", held.alias("held_out"), "text", "lang")
    models = dictionaries(docs.filter(~F.col("held_out")))
    return classify(docs.drop("lang"), models)
