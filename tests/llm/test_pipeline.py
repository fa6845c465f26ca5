"""The pipeline against plain versions of its stages, each on what its predecessor kept."""

from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_packing import check_packs
from tramline.llm import mixing, quality
from tramline.llm.common import materialise, table
from tramline.llm.packing import SEQ_LEN


def test_stages(spark, tiny):
    docs = table(spark, tiny, "documents")
    known = {r[0] for r in table(spark, tiny, "labels").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    ids = lambda df: Counter(r[0] for r in df.select("doc_id").collect())
    texts = lambda df: {r[0]: r[1] for r in df.select("doc_id", "text").collect()}

    kept = []
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = materialise(stage(spark, now, tiny))
        assert now.columns == docs.columns
        kept.append(now)
    good, single, apart, mixed = kept

    assert ids(good) == ids(quality.classify(docs, table(spark, tiny, "labels")))

    best = {}
    for id_, t in texts(good).items():
        best[t] = min(best.get(t, (2, 0)), (id_ not in known, id_))
    assert ids(single) == Counter(k[1] for k in best.values())

    assert sorted(ids(apart)) == [i for i, _ in brute.near_groups(list(texts(single).items()))]

    rows = [tuple(r) for r in apart.select("doc_id", "text", "lang", "source").collect()]
    want = brute.mixture(rows, mixing.FRACTION, mixing.EPOCHS, mixing.SEED)
    assert ids(mixed) == Counter(id_ for (id_, _), n in want.items() for _ in range(n))

    final = corpus_pipeline.STAGES[-1][1](spark, mixed, tiny)
    check_packs([tuple(r) for r in final.collect()], [(r[0], r[1]) for r in mixed.select("doc_id", "text").collect()], SEQ_LEN)
    assert ids(corpus_pipeline.run(spark, tiny)) == ids(final)


def test_columns_keep_their_values(spark, awkward, labels, clash, whole, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = docs = clash(awkward)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = materialise(stage(spark, now, str(tmp_path)))
        whole(now, docs)


def test_awkward_and_empty(spark, awkward, empty, labels, clash, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (clash(awkward), empty):
        docs.write.parquet(f"{tmp_path}/{docs is empty}/documents.parquet")
        labels.write.mode("overwrite").parquet(f"{tmp_path}/{docs is empty}/labels.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{docs is empty}").collect()
        assert bool(rows) != (docs is empty)
