"""The pipeline's stages against plain Python, and its registration."""

import re

import __spark_entry__ as contract
import brute
import corpus_pipeline
from paytide.llm import toxicity
from paytide.llm.common import table

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "decontamination", "mixing", "sharding"
    ]


def test_stages_do_what_they_say(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rated = toxicity.rate_documents(docs, table(spark, SF, "labels")).filter("NOT toxic")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rated.collect())

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    once = corpus_pipeline.drop_near_copies(spark, kept, SF).cache()
    assert once.columns == columns
    assert sorted(r.doc_id for r in once.collect()) == [i for i, _, least in brute.groups(rows) if i == least]

    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = corpus_pipeline.drop_benchmark(spark, once, SF).cache()
    want = sorted(r.doc_id for r in once.collect() if not any(i in plain(r.text) for i in items))
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == want

    mixed = corpus_pipeline.mix_sources(spark, clean, SF).cache()
    have = {r.doc_id: 0 for r in clean.collect()}
    for r in mixed.collect():
        have[r.doc_id] += 1
    assert mixed.columns == columns and max(have.values()) <= 3
    size = lambda frame: sum(len(brute.words(r.text)) for r in frame.collect())
    assert abs(size(mixed) - size(clean)) < 0.15 * size(clean)

    placed = corpus_pipeline.shard(spark, mixed, SF).collect()
    counts = [sum(r.shard == s for r in placed) for s in range(16)]
    assert sum(counts) == mixed.count() and max(counts) - min(counts) <= 1
    for frame in (kept, once, clean, mixed):
        frame.unpersist()


def test_stages_take_odd_tables(spark):
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, toxic INT, place INT, _row INT"
    rows = [(1, "a b c d e f", "en", "s", 1, 1, 1, 1)] * 2
    rows += [(None, None, None, None, None, None, None, None), (2, "", "en", None, 0, 0, 0, 0), (3, "other words " * 9000, None, "s", 1, 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for frame, least in ((docs, 2), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns and out.count() >= least
        assert corpus_pipeline.STAGES[4][1](spark, frame, SF).count() == frame.count()
    assert corpus_pipeline.drop_near_copies(spark, docs, SF).filter("doc_id = 1").count() == 1


def test_an_id_of_two_texts_loses_neither(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(5, x), (9, x), (3, y), (5, y), (7, z), (7, z), (7, None), (None, x), (None, x)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS number", "2 AS digest", "3 AS doc")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted([(5, x), (3, y), (7, z), (7, ""), (0, x), (0, x)])
