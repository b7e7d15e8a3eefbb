"""The pipeline against plain versions of its stages."""

import sentencepiece

import corpus_pipeline
from tidemart.llm import toxicity
from tidemart.llm.common import read_table
from tidemart.llm.queries import SENTENCEPIECE_MODEL, vocabulary_path
from test_dedup import low, plain_components, plain_fingerprint
from test_text_filters import plain_contamination


def test_pipeline_equals_plain_stages(spark, sf_dir):
    table = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(spark, table, read_table(spark, sf_dir, "labels"))
    grammar, (a, b) = toxicity.Grammar(model["words"], model["beginnings"]), model["fit"]
    docs = {r.doc_id: r for r in table.collect() if a + b * grammar.raw(r.text)[0] < 0}
    assert len(docs) < table.count()
    last = {low(r.text): i for i, r in sorted(docs.items())}
    docs = {i: docs[i] for i in last.values()}
    groups = plain_components([(i, plain_fingerprint(r.text)) for i, r in docs.items()])
    docs = {i: docs[i] for i in {c for _, _, c in groups}}
    items = [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    found = {i: plain_contamination(r.text, items) for i, r in docs.items()}
    docs = {i: r for i, r in docs.items() if not (found[i][1] and 20 * len(found[i][1]) >= found[i][0])}
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(SENTENCEPIECE_MODEL))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.text == docs[r.doc_id].text and r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.same


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir):
    from edge_rows import edge_docs, no_docs

    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edge_docs(spark), sf_dir)
        assert out.columns == edge_docs(spark).columns and 0 < out.count() <= edge_docs(spark).count()
        assert stage(spark, no_docs(spark), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, edge_docs(spark), sf_dir).count() == edge_docs(spark).count()
