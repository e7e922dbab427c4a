import corpus_pipeline
from codecorpus.llm import langid, sentencepieces, toxicity
from codecorpus.llm.common import Staging, table
from tests.llm.test_benchmark_urls import plain_hits
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_equal_brute_force(spark, sf):
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("rejected").collect()}
    left = docs.filter(~docs.doc_id.isin(list(toxic)))
    unknown = {r.doc_id for r in langid.languages(left).filter("rejected").collect()}
    left = {i: t for i, t in rows.items() if i not in toxic | unknown}
    prints = {i: plain_fingerprint(t) for i, t in left.items()}
    roots = plain_components(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(roots[prints[i]], i)
    left = {i: left[i] for i in first.values()}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    hit = {x[0] for x in plain_hits(left.items(), items) if x[-1]}
    left = {i: t for i, t in left.items() if i not in hit}
    pieces = sentencepieces.Pieces()
    found = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert found == {i: pieces.encode(t)[0] for i, t in left.items()}
    assert toxic and hit and len(first) < len(prints)


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, sf):
    docs, staging = odd_docs, Staging(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "encoding" or out.columns == docs.columns
        docs = staging.put(out, name)
    assert docs.filter("exact").count() == docs.count() > 0
    empty = odd_docs.filter("false")
    assert all(stage(spark, empty, sf).count() == 0 for _, stage in corpus_pipeline.STAGES)
