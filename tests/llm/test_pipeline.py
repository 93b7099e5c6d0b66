"""The pipeline, stage by stage, against plain versions on its own input."""

from collections import Counter

import brute

import corpus_pipeline
from recoengine.llm import mixing, quality
from recoengine.llm.common import save, table


def test_stages_do_their_whole_job(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "MinHash near-dedup", "suffix-array dedup", "mixing sources", "packing"]

    good = save(stages["quality rules"](spark, docs, sf_dir), "t")
    verdict = quality.op10_quality(spark, sf_dir).where("kept")
    assert sorted(r.doc_id for r in good.select("doc_id").collect()) == sorted(r.doc_id for r in verdict.select("doc_id").collect())

    distinct = save(stages["MinHash near-dedup"](spark, good, sf_dir), "t")
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    want = {c for _, _, c in brute.near_documents([i for i, _ in rows], [t for _, t in rows])}
    kept = {r.doc_id: r.text for r in distinct.collect()}
    assert set(kept) == want

    cut = save(stages["suffix-array dedup"](spark, distinct, sf_dir), "t")
    left = {r.doc_id: r.text for r in cut.collect()}
    for (i, t), (n, gone, _, _) in zip(kept.items(), brute.repeated_bytes(list(kept.values()), corpus_pipeline.REPEAT_BYTES)):
        assert (i in left) == (gone < n)
        if i in left:
            assert 0 <= n - gone - len(left[i].encode()) < 8 and (gone or left[i] == t)

    mixed = save(stages["mixing sources"](spark, cut, sf_dir), "t")
    copies = Counter({r.doc_id: r.copies for r in mixing.mix(cut).collect() if r.copies})
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    for out in (good, distinct, cut, mixed):
        assert out.columns == docs.columns

    packed = stages["packing"](spark, mixed, sf_dir).collect()
    lengths = Counter()
    for r in packed:
        lengths[r.sequence_id] += r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in lengths.values())
    whole = Counter()
    for r in packed:
        whole[r.doc_id] += r.length
    assert all(whole[r.doc_id] == r.doc_tokens * copies[r.doc_id] for r in packed)
