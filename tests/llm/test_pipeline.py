import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import cases
from test_dedup import plain_exact, plain_near
from test_tokens import check_packing
from vigil.llm import language
from vigil.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def replay(spark, docs):
    """(doc_id, text) that the cleaning stages keep, by plain comparisons."""
    known = {(r.doc_id, r.held_out): (r.lang_pred, r.score) for r in language.predict_documents(docs).collect()}
    held = {d: v for (d, _), v in known.items()}
    pairs = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    pairs = [p for p in pairs if held[p[0]][0] != "und" and held[p[0]][1] >= 0.05]
    kept = {d for d, _, _, _, k in plain_exact(pairs) if k}
    pairs = [p for p in pairs if p[0] in kept]
    near = {d for d, _, _, k in plain_near(pairs, 80) if k}
    return [p for p in pairs if p[0] in near]


def test_pipeline_against_a_replay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = replay(spark, docs)
    assert 0 < len(kept) < docs.count()
    check_packing(corpus_pipeline.run(spark, SF).collect(), kept, library(), 1024)


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_dedup", "packing"]
    docs = cases.frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert 0 < out.count() < docs.count()
        assert out.exceptAll(docs).count() == 0
        assert stage(spark, cases.empty(spark), SF).count() == 0


def test_every_operator_is_registered():
    registered = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
