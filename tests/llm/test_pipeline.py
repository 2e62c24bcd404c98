"""The pipeline's stages one after another against brute force."""

import random

import pytest
from test_operators import DOCS, base_metrics, plain_components, plain_fingerprint, plain_secrets, rows, words  # noqa: F401

import corpus_pipeline
from costlens.llm import exact_dedup, packing, simhash
from costlens.llm.common import cut

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    after = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        after.append({r.doc_id: r.text for r in docs.collect()})
    one, two, three, four = after
    good = {}
    for i, t in text.items():
        m = base_metrics(t)
        if m[0] >= 20 and 100 * m[4] <= 30 * m[0]:
            good[i] = t
    assert one == good  # too few labels here to certify a cutoff
    bare = {}
    for i, t in sorted(one.items(), key=lambda x: (-len(x[1]), x[0])):
        bare.setdefault("".join(c for c in t if c not in " \t\n\x0b\x0c\r"), i)
    assert set(two) == set(bare.values())
    fps = {i: plain_fingerprint(t) for i, t in two.items()}
    comp = plain_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    assert set(three) == set(comp.values())
    assert set(four) == set(three)
    for i, t in four.items():
        assert (t == three[i]) == (not plain_secrets(three[i])) and not plain_secrets(t)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    sizes = {r.doc_id: r.n_tokens for r in packing.lengths(docs).collect()}
    total = dict.fromkeys(sizes, 0)
    for r in packed:
        total[r.doc_id] += r.n_tokens
    assert total == sizes


def test_run_equals_its_stages(spark):
    whole = {(r.doc_id, r.piece) for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), "test-stage")
    assert {(r.doc_id, r.piece) for r in docs.collect()} == whole


@pytest.mark.parametrize("extra", [[], ["quality_", "digest_", "keep_", "blob_", "words_"]])
def test_stages_take_odd_rows(spark, rows, extra):  # noqa: F811
    docs = spark.createDataFrame(rows, DOCS)
    for e in extra:
        docs = docs.selectExpr("*", f"'mine' AS {e}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF), "test-stage")
        assert docs.columns[5:] == extra
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 0
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = cut(stage(spark, empty, SF), "test-stage")
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_stages_decide_alike_however_rows_are_dealt(spark):
    rnd = random.Random(9)
    data = [(i, words(rnd.choice([4, 30, 60]), rnd), "en", "s", 1) for i in range(80)]
    data += [(100 + i, data[i][1], "en", "s", 1) for i in range(0, 80, 3)]
    rnd.shuffle(data)
    found = []
    for parts in (1, 7):
        docs = spark.createDataFrame(data, DOCS).repartition(parts)
        found.append((sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()), sorted(r.doc_id for r in simhash.keep_one(docs).collect())))
    assert found[0] == found[1]
