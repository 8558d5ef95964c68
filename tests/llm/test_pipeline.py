"""The pipeline's stages, each on what the one before kept."""

import os

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from oracle_compare import compare, duck
from sparkrec.llm import sentencepiece_bpe, toxicity
from sparkrec.llm.queries import piece_model

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "sentencepiece"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    kept = {}
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if k < len(C.STAGES) - 1:
            assert out.columns == first.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs
    everything = {r.doc_id: r.text for r in first.collect()}
    model = toxicity.fit(first, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score_documents(first, model).collect() if not r.predicted}
    assert {r.doc_id for r in kept["toxicity"].collect()} == clean
    lines = {r.doc_id: r.text for r in kept["line_dedup"].collect()}
    assert lines.keys() == clean and all(set(t.split("\n")) <= set((everything[d] or "").split("\n")) for d, t in lines.items())
    alone = {r.doc_id for r in kept["jaccard_join"].collect()}
    assert alone < clean
    mixed = [r.doc_id for r in kept["mixing"].collect()]
    assert set(mixed) == alone and len(mixed) >= len(alone)
    last = sorted(map(tuple, kept["sentencepiece"].collect()))
    assert last == sorted(map(tuple, sentencepiece_bpe.round_trip(kept["mixing"], piece_model()).collect()))
    assert sorted(map(tuple, C.run(spark, SF).collect())) == last


@pytest.mark.parametrize("name", ["op4_line_dedup", "op8_jaccard_join", "op9_block_topk"])
def test_sql(spark, name):
    compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
