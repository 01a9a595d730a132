"""The llm queries with SQL over the smallest driver tables, and the pipeline's stages."""

import collections
import os
import re

import pytest

import corpus_pipeline
import oracle
from juncture.llm import common, exact_dedup, language_id, ngram_join, queries, sentencepiece
from llm.test_llm import brute_components

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF_DIR), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    oracle.assert_same(spark, oracle.connect(), queries.queries()[name], queries.oracle_sql()[name])


def test_stages(spark):
    """Each stage on what the one before it kept: its decisions are those of its operator, and they take effect."""
    docs = common.read_documents(spark, oracle.SF_DIR)
    columns, held = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialise(stage(spark, docs, oracle.SF_DIR), name)
        held.append((docs, out))
        docs = out
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    (raw, known), (_, alone), (_, distinct), (_, mixed), (_, encoded) = held
    assert all(df.columns == columns for df in (known, alone, distinct, mixed))
    models = language_id.train(raw.filter(language_id.fold() != 0), language_id.fold() == 1)
    assert ids(known) == ids(language_id.identify(raw, models).filter("accepted")) and known.count() >= 0.95 * raw.count()
    assert ids(alone) == ids(exact_dedup.exact_duplicates(known).filter("kept"))
    assert ids(distinct) == ids(ngram_join.jaccard_components(alone, 5, 8, 10).filter("doc_id = component_id"))
    copies = mixed.groupBy("doc_id").count().collect()
    assert ids(mixed) <= ids(distinct) and max(r["count"] for r in copies) <= 3
    assert ids(encoded) == ids(mixed) and encoded.filter("not round_trip").count() == 0


def test_stages_against_brute_force(spark):
    """Deduplicating, near-copy, mixing and encoding stages on the driver's smallest table, by plain Python."""
    stages = dict(corpus_pipeline.STAGES)
    docs = common.read_documents(spark, oracle.SF_DIR)
    rows = sorted((r.doc_id, r.text or "", r.source) for r in docs.select("doc_id", "text", "source").collect())
    first = {}
    for k, t, _ in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), k)
    alone = common.materialise(stages["exact_dedup"](spark, docs, oracle.SF_DIR), "alone")
    assert sorted(r.doc_id for r in alone.select("doc_id").collect()) == sorted(first.values())

    kept = [(k, t) for k, t, _ in rows if k in set(first.values())]
    components = brute_components(kept, 5, 8, 10)
    distinct = common.materialise(stages["ngram_jaccard"](spark, alone, oracle.SF_DIR), "distinct")
    assert sorted(r.doc_id for r in distinct.select("doc_id").collect()) == sorted(k for k, (_, c) in components.items() if k == c)

    left = [(k, len(re.findall(rb"[^\x20\x09-\x0D]+", t.encode())), s) for k, t, s in rows if components.get(k, (0, None))[1] == k]
    size, most = collections.Counter(), collections.Counter()
    for _, n, s in left:
        size[s] += n
        most[s] = max(most[s], n)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, capped = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    mixed = common.materialise(stages["mix_sources"](spark, distinct, oracle.SF_DIR), "mixed")
    copies, taken = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect()), collections.Counter()
    for k, n, s in left:
        taken[s] += n * copies[k]
    for s in order:
        assert abs(taken[s] - (3 * size[s] if s in capped else level * weight[s])) <= max(most[s], 3)

    texts = {k: t for k, t, _ in rows}
    vocabulary = sentencepiece.Vocabulary.load()
    encoded = stages["sentencepiece"](spark, mixed, oracle.SF_DIR).collect()
    assert {r.doc_id for r in encoded} == set(copies)
    assert all(sentencepiece.decode(vocabulary, r.ids) == texts[r.doc_id] for r in encoded)
