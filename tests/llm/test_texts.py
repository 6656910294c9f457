"""Hashing, groups by shingles, language, scoring, personal data: against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from paytide.llm import components, hashing, jaccard, langid, lm, pii

DOC = "doc_id LONG, text STRING"
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x1f😀", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_shingles_are_those_of_python(column):
    seen, sizes = {}, []
    for at, data, offsets in hashing.slices(pa.array(column, pa.string()), most=16):
        found, rows = hashing.words(data, offsets)
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        keys = hashing.sequence_keys(found, counts)
        for i, s in enumerate(hashing.shingles(found, counts, keys, 5)):
            own = brute.words(column[at + i])
            assert counts[i] == len(own)
            for w, h in zip(own, found[rows == i], strict=True):
                assert seen.setdefault(w, h) == h
            sizes.append(len(s) == len(brute.shingles(column[at + i])))
    assert all(sizes) and len(sizes) == len(column) and len(set(seen.values())) == len(seen)


def copies(seed, n=14):
    """Families of near copies, exact copies with other case and spacing, short and empty texts."""
    r = random.Random(seed)
    rows = [None, "", "  \n", "one", "One ", "one two three four", "one two three four", "a b c d e"]
    for _ in range(n):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([6, 20, 60, 150]))]
        rows.append(" ".join(base))
        for _ in range(r.randrange(6)):
            near = list(base)
            for _ in range(r.randrange(1 + len(base) // 12)):
                near[r.randrange(len(near))] = f"x{r.randrange(10**6)}"
            rows.append(r.choice([" ", "\n"]).join(near).upper() if r.random() < 0.3 else " ".join(near))
    r.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def grouped(spark, rows):
    got = jaccard.similar_groups(spark.createDataFrame(rows, DOC)).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, seed):
    rows = copies(seed)
    assert grouped(spark, rows) == brute.groups(rows)


def test_groups_of_many_blocks_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "SHORT_LIST", 4)
    r = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        near = list(base)
        for _ in range(r.randrange(4)):
            near[r.randrange(80)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(near)))
    assert grouped(spark, rows) == brute.groups(rows)


def test_groups_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, long), (1, long), (2, long + " end"), (None, long), (None, None), (3, None)]
    got = jaccard.similar_groups(spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS node", "2 AS n")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got if r.doc_id) == [
        (1, 29996, 1), (1, 29996, 1), (2, 29997, 1), (3, 0, 3)
    ]
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert jaccard.similar_groups(spark.createDataFrame([], DOC)).count() == 0


def test_components_by_stars_and_by_one_task(spark):
    r = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 40)]
    links = chain + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(60)] + [(5, 5)]
    frame = spark.createDataFrame(links, "a LONG, b LONG")
    one = sorted(map(tuple, components.components(frame).collect()))
    many = sorted(map(tuple, components.components(frame, in_one_task=0).collect()))
    assert one == many and (40, 0) in one


def test_bound_is_above_the_overlap():
    r = np.random.default_rng(5)
    for n, m, common in [(10, 12, 9), (500, 450, 400), (9000, 8000, 7000), (300, 4000, 100)]:
        both = r.integers(0, 2**63, common, dtype=np.uint64)
        a = np.unique(np.append(both, r.integers(0, 2**63, n - common, dtype=np.uint64)))
        b = np.unique(np.append(both, r.integers(0, 2**63, m - common, dtype=np.uint64)))
        assert jaccard.overlap_bound(jaccard.bitmap(a), jaccard.bitmap(b), len(a), len(b)) >= len(np.intersect1d(a, b))


def lm_rows():
    r = random.Random(6)
    rows = []
    for i in range(160):
        kind = r.choice(["a", "b"])
        rows.append((i, " ".join(f"{kind}{min(r.randrange(12), r.randrange(12))}" for _ in range(r.randrange(40)))))
    return rows + [(900, "the same words " * 20), (901, "the same words " * 20), (902, None), (903, ""), (904, "UNSEEN only")]


def test_scores_are_those_of_a_tree_of_dictionaries(spark):
    rows = lm_rows()
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS row", "0 AS key")
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    tree = brute.SuffixTree([t for i, t in rows if brute.crc(i) % 7 != 2])
    assert any(len(s) > 1 for s in tree.states) and len(got) == len(rows)
    for i, t in rows:
        base, score = tree.score(t)
        known = sum(tree.c[w] > 0 for w in [*brute.words(t), "END"])
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.crc(i) % 7 == 2, len(brute.words(t)) + 1, known, tree.n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    # every state is a distribution: known words and one unseen word have all the mass
    for s in list(tree.states)[:20]:
        assert sum(10 ** tree.logp(s, w) for w in [*tree.c, "never seen"]) == pytest.approx(1)


def test_no_run_is_lost_when_few_words_are_broadcast(spark, monkeypatch):
    rows = lm_rows()
    docs = spark.createDataFrame(rows, DOC)
    whole = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    monkeypatch.setattr(lm, "MOST", 4)
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    assert got.keys() == whole.keys()
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (whole[i].n_tokens, whole[i].n_known, whole[i].train_tokens)
        assert r.base_score == pytest.approx(whole[i].base_score, rel=1e-9) and r.score == pytest.approx(whole[i].score, rel=1e-9)


def test_scores_without_training_rows(spark):
    held = [(i, "a b") for i in range(60) if brute.crc(i) % 7 == 2]
    got = lm.score_documents(spark.createDataFrame(held, DOC)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(3, 0, 0, 0.0, 0.0)}
    assert lm.score_documents(spark.createDataFrame([], DOC)).count() == 0
    assert lm.score_documents(spark.createDataFrame([(None, "a"), (None, "a")], DOC)).count() == 2


def language_rows(n=120):
    r = random.Random(7)
    parts = {"en": ["the", "ing", "th", "er", "and"], "fr": ["eau", "que", "é", "ment", "oi"], "de": ["sch", "ung", "ß", "keit", "ein"]}
    rows = []
    for i in range(n):
        lang = ["en", "en", "fr", "de"][i % 4]
        word = lambda p: "".join(r.choice(p) for _ in range(r.randrange(1, 4)))
        rows.append((i, " ".join(word(parts[lang]) for _ in range(40)), lang))
    return rows


def test_languages_of_held_out_rows(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, DOC + ", lang STRING").selectExpr("*", "'no' AS source")
    got = {r.doc_id: r for r in langid.identify_documents(docs).collect()}
    assert all(got[i].held_out == (brute.crc(i) % 5 == 0) and 0 <= got[i].score <= 1 for i, _, _ in rows)
    held = [(got[i].lang_pred, lang) for i, _, lang in rows if got[i].held_out]
    assert len(held) > 15 and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_texts_without_a_language(spark):
    models = {"en": b"the of and ing " * 1000, "fr": b"eau que de la " * 1000}
    long = "the and of " * 20000
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 .,! ½ ²₃ Ⅳ"), (4, long), (5, "THE OF 1 AND")], DOC).selectExpr("*", "9 AS score")
    got = {r.doc_id: r for r in langid.classify(docs, models).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["und", "und", "und", "en", "en"]
    assert not got[1].accepted and got[1].score == 0 and got[4].accepted
    assert {r.lang_pred for r in langid.classify(docs, {}).collect()} == {"und"}
    nothing = spark.createDataFrame([], DOC + ", lang STRING")
    assert langid.identify_documents(nothing).count() == 0
    unnamed = spark.createDataFrame([(1, "abc", None)], DOC + ", lang STRING")
    assert [r.lang_pred for r in langid.identify_documents(unnamed).collect()] == ["und"]


PIECES = [
    "a", "b.", "@", "1", "22", "333", "4", ".", " ", "-", "+", "(", ")", "é", "😀", "%", "x@y.z", "4111111111111111",
    "4111 1111-1111 1111 ", "10.0.0.1", "+1 (234) 555-0000", "256.1.1.1", "0", "00", "\n", "A@b-c.d.e",
]


def test_personal_data_is_that_of_the_rules(spark):
    r = random.Random(8)
    rows = [(i, "".join(r.choice(PIECES) for _ in range(r.randrange(60)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "x@y.z " * 500), (1003, "9" * 3000), (1004, "a." * 1500 + "@b.c"), (1005, "+1" * 2000)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS row", "1 AS kind")
    got = {r.doc_id: r for r in pii.find_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        counts, digest, spans = brute.personal(t)
        g = got[i]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == counts and g.base_sha256 == digest, (i, t)
        assert g.spans == spans or g.spans.startswith(spans + "," if spans else "id:")


def test_very_long_runs_end_soon(spark):
    rows = [(1, "1 " * 50000), (2, "9" * 100000), (3, "a" * 100000), (4, "x@y.z " * 5000), (4, "x@y.z " * 5000)]
    got = pii.find_documents(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(r.n_email for r in got) == [0, 0, 0, 5000, 5000]
    assert pii.find_documents(spark.createDataFrame([], DOC)).count() == 0


def test_patterns_of_seeds_find_other_identifiers(spark):
    rows = [(i, f"word{i} please write to u{i}@mail.org for more") for i in range(12)]
    rows += [(50, "other words please write to acct-77x now"), (51, "the year was 1999 again"), (52, "the year was u1@mail.org again")]
    rows += [(60 + i, f"the year was {1900 + i} again") for i in range(20)]
    got = {r.doc_id: r.spans for r in pii.find_documents(spark.createDataFrame(rows, DOC)).collect()}
    assert got[50] == "id:28:36" and got[51] == "" and got[52] == "email:13:24"
