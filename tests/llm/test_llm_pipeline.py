"""The stages of the pipeline, each held against a plain version on its own input."""

import corpus_pipeline as P
import helpers_llm as H
from conftest import SMALL, rows

from tillwise.llm import fertility
from tillwise.staging import stage


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, frames = docs.schema, [docs]
    for name, function in P.STAGES:
        frames.append(stage(function(spark, frames[-1], SMALL), name))
    assert all(f.schema.names == columns.names for f in frames[:-1])
    texts = [{r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]

    kept = {r.doc_id for r in fertility.quality(docs).where("kept").collect()}
    assert texts[1] == {d: t for d, t in texts[0].items() if d in kept}

    classes = H.near_classes(list(texts[1].items()))
    assert texts[2] == {d: t for d, t in texts[1].items() if classes[d] == d}

    before = list(texts[2].items())
    gone, want = H.removed_words(before), {}
    for i, (doc, text) in enumerate(before):
        ws = H.words(text)
        if len(gone[i]) < len(ws):
            want[doc] = " ".join(w for k, w in enumerate(ws) if k not in gone[i]) if gone[i] else text
    assert texts[3] == want

    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    found = H.hits(items, texts[3].values())
    clean = {d: t for (d, t), (_, hit, _) in zip(texts[3].items(), found, strict=True) if not hit}
    cut = {d: texts[4].get(d, "") for (d, _), (_, hit, _) in zip(texts[3].items(), found, strict=True) if hit}
    assert {d: texts[4][d] for d in clean} == clean
    for (doc, text), (_, hit, _) in zip(texts[3].items(), found, strict=True):
        if hit:
            assert H.item_words(cut[doc]) == [w for k, w in enumerate(H.item_words(text)) if k not in hit]

    assert set(rows(frames[5].select("doc_id").distinct())) == {(d,) for d in texts[4]}
    assert frames[4].where("n_chars <> length(text)").count() == 0


def test_run_gives_the_same_pieces_for_each_document(spark):
    found = P.run(spark, SMALL)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0
