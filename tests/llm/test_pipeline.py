"""The pipeline, stage by stage: what goes in, what may come out, and the same result as the parts."""

import pathlib
import re
from collections import defaultdict

import pytest
from test_ngram_join import expected as components_of
from test_repeats import covered, split

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(spark.createDataFrame(stage(spark, out[-1], SF).toPandas(), out[-1].schema) if len(out) < 5 else stage(spark, out[-1], SF))
    return out


def test_columns_and_rows_are_kept(stages):
    docs = stages[0]
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    for before, after, stage in zip(ids, ids[1:], stages[1:5]):
        assert after <= before and after and stage.columns == docs.columns
    for s in stages[1:4]:
        texts = {r.doc_id: r.text for r in s.collect()}
        assert texts.items() <= {r.doc_id: r.text for r in docs.collect()}.items()
    assert ids[5] == ids[4] == ids[3]


def test_clean_documents_stay(spark, stages):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert len(good & kept) >= 0.98 * len(good)
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    assert len(bad - kept) >= 0.8 * len(bad)


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    first = {i for i, _, c in components_of(rows, 5, 80) if i == c}
    assert {r.doc_id for r in stages[3].collect()} == first


def test_passages_are_cut(stages):
    rows = [(r.doc_id, r.text) for r in stages[3].collect()]
    want = {i: [w for p, w in enumerate(split(t)) if p not in places] for (i, t), places in zip(rows, covered(rows))}
    got = {r.doc_id: r for r in stages[4].collect()}
    assert {i: split(r.text) for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_run_is_the_stages(spark, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    got = corpus_pipeline.run(spark, SF)
    assert key(got) == key(stages[5])
    at = defaultdict(int)
    for r in got.collect():
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 1024 and re.fullmatch(r"\d+", str(min(at)))
