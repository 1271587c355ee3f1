"""The pipeline and its stages, and every operator on awkward rows."""

import pyarrow as pa
import pytest
from contrail.llm import bpe, licenses, packing, quality, quality_rules, simhash, token_count, toxicity
from test_operators import SMALL, check_packing, slow_components, slow_fingerprint

import corpus_pipeline

LONG = "word and another thing " * 60_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing names."""
    rows = [
        (1, "", "en", "a"), (2, "   \n\t", "en", "a"), (3, None, None, None), (None, "some text here", "en", "b"),
        (None, None, None, None), (4, LONG, "en", "b"), (5, "one", "xx", "c"), (6, "same text twice", "en", "c"),
        (6, "same text twice", "en", "c"), (7, "été 日本語 \U0001f600 'll  x", "fr", "c"), (8, "same text twice", "en", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ("id", "fp", "fingerprint", "key", "size", "host", "label", "score", "kept", "toxicity", "is_toxic", "p0", "labels",
             "component_id", "row", "__fp", "__row", "n_words", "expected_grade", "tail_probability", "start", "tie", "part")
    return df.selectExpr("*", *(f"'{c}' AS {c}" for c in clash))


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    return quality.train(docs, labels), toxicity.train(docs, labels)


def test_classifiers_on_odd_rows(spark, odd, models):
    q, t = models
    a, b = quality.score(odd, q).collect(), toxicity.score(odd, t).collect()
    assert len(a) == len(b) == odd.count()
    assert all(0 <= r.tail_probability <= 1 for r in a) and all(0 <= r.toxicity <= 1 for r in b)
    by_text = {}
    for r in a:
        by_text.setdefault(r.text or "", set()).add(r.tail_probability)
    assert all(len(v) == 1 for v in by_text.values())  # null reads as empty, repeats score alike
    assert quality.score(odd.limit(0), q).count() == toxicity.score(odd.limit(0), t).count() == 0


def test_classifiers_without_usable_labels(spark, odd):
    none = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert quality.train(odd, none) is None
    assert {(r.expected_grade, r.kept) for r in quality.score(odd, None).collect()} == {(None, True)}
    assert {r.toxicity for r in toxicity.score(odd, toxicity.train(odd, none)).collect()} == {0.0}
    one = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.expected_grade for r in quality.score(odd, quality.train(odd, one)).collect()} == {1.0}


def test_simhash_on_odd_rows(spark, odd):
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in simhash.simhash_components(odd).collect())
    zero = "0" * 16
    assert [x for x in got if x[1] == zero] == [(-1, zero, 1), (1, zero, 1), (2, zero, 1), (3, zero, 1)]
    assert [x[2] for x in got if x[0] in (6, 8)] == [6, 6, 6]
    fp = {r.text or "": r.fingerprint for r in simhash.with_fingerprint(odd).collect()}
    for t, f in fp.items():
        if len(t) < 1000:
            assert f % 2**64 == slow_fingerprint(t)
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6, 7]
    assert simhash.simhash_components(odd.limit(0)).count() == simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def test_text_operators_on_odd_rows(spark, odd):
    n = odd.count()
    ids = bpe.encode_decode(odd, keep_ids=True).collect()
    assert len(ids) == n and sum(r.n_tokens == 0 for r in ids) == 3
    assert sorted(bytes(r.decoded).decode() for r in ids) == sorted(r.text or "" for r in odd.collect())
    lic = licenses.scan(odd).collect()
    assert len(lic) == n and {r.labels for r in lic} == {""} and max(r.n_words for r in lic) == 240_000
    rules = {(r.doc_id, r.n_words): r for r in quality_rules.judge(odd).collect()}
    assert rules[4, 240_000].n_repeat_words == 240_000 and rules[4, 240_000].base_failed and rules[1, 0].base_failed
    assert sum(1 for _ in quality_rules.judge(odd).collect()) == n
    edited = odd.selectExpr("doc_id", "text", "array(named_struct('start', 1, 'stop', null, 'text', source), null) AS edits")
    counts = token_count.count_with_edits(edited).collect()
    assert len(counts) == n and max(r.n_tokens for r in counts) > 240_000
    for f in (bpe.encode_decode, licenses.scan, quality_rules.judge, packing.pack):
        assert f(odd.limit(0)).count() == 0


def test_packing_on_odd_rows(spark, odd):
    distinct = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in distinct.collect()}
    check_packing(packing.pack(distinct).collect(), texts)
    assert packing.pack(odd).filter("doc_id IS NULL").count() == 2 and packing.pack(odd).filter("doc_id = 6").count() >= 2


def test_stages_on_odd_rows_and_on_nothing(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, odd, SMALL), stage(spark, odd.limit(0), SMALL)
        assert none.count() == 0
        if name != "packing":
            assert out.columns == odd.columns and out.schema["text"].dataType == odd.schema["text"].dataType
        assert 0 < out.count() <= (10_000 if name == "packing" else odd.count())


def test_pipeline_matches_brute_force(spark):
    """Each stage again by plain Python over all documents."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    q, t = quality.train(docs, labels), toxicity.train(docs, labels)
    top = q.at_least(q.logits(pa.array([r.text for r in rows])))[:, -1]
    rows = [r for r, p in zip(rows, top) if p >= quality.KEEP_PROBABILITY]
    scores = t.scores(pa.array([r.text for r in rows]))
    rows = [r for r, p in zip(rows, scores) if p < t.thresholds.get(r.lang or "", toxicity.THRESHOLD)]
    assert 0 < len(rows) < docs.count()
    group = slow_components({r.doc_id: slow_fingerprint(r.text) for r in rows})
    texts = {r.doc_id: r.text for r in rows if group[r.doc_id] == r.doc_id}
    assert len(texts) < len(rows)
    out = corpus_pipeline.run(spark, SMALL)
    assert corpus_pipeline.ORACLE_SQL is None
    check_packing(out.collect(), texts)


def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema.names == docs.columns
