"""The pipeline against a plain Python walk through its stages."""

import sys
from collections import Counter

import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline  # noqa: E402
from bazaar.llm import byte_cnn, decontaminate  # noqa: E402
from test_llm_ops import SCHEMA, awkward_rows, brute_components, brute_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    import sentencepiece

    docs = pd.read_parquet(f"{SF}/documents.parquet")
    model = byte_cnn.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = docs[[byte_cnn.probability(model, t) >= 0.3 for t in docs.text]]
    docs = docs.sort_values("doc_id").drop_duplicates("text", keep="last").reset_index(drop=True)
    docs["c"] = brute_components([brute_fingerprint(t) for t in docs.text])
    docs = docs.sort_values("doc_id").drop_duplicates("c").reset_index(drop=True)
    items = [decontaminate.words_of(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]

    def leaked(text):
        words = decontaminate.words_of(text)
        return any(decontaminate.lcs(decontaminate.masks_of(w), len(w), words[k:k + 2 * len(w)]) >= 0.8 * len(w)
                   for w in items if len(set(w) & set(words)) >= 0.7 * len(set(w))
                   for k in range(0, len(words), max(1, len(w) // 2)))
    docs = docs[[not leaked(t) for t in docs.text]]
    lib = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    want = {int(i): lib.encode(t) for i, t in zip(docs.doc_id, docs.text)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == want and len(rows) == len(want)
    assert all(r.round_trip for r in rows)


def test_stages_keep_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).columns == docs.columns, name
        assert stage(spark, empty, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0
    assert len(corpus_pipeline.STAGES) == 5


def test_awkward_rows_go_through_all_stages(spark):
    """Each stage by its own rule on what the stage before has kept."""
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = byte_cnn.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in rows if byte_cnn.probability(model, r[1]) >= 0.3]

    def order(r):
        return (r[0] is not None, r[0] or 0)
    last = {}
    for r in sorted(rows, key=order):
        last[r[1] or ""] = r
    rows = list(last.values())
    comps = brute_components([brute_fingerprint(r[1]) for r in rows])
    first = {}
    for c, r in sorted(zip(comps, rows), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        first.setdefault(c, r)
    want = Counter((r[0], r[1] or "") for r in first.values())
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
    assert Counter((r.doc_id, r.text or "") for r in docs.collect()) == want
    clean = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert clean.columns == docs.columns and Counter((r.doc_id, r.text or "") for r in clean.collect()) == want
    out = corpus_pipeline.STAGES[4][1](spark, clean, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in want.elements())
    assert all(r.round_trip and (r.n_tokens > 0 or not r.ids) for r in out)
