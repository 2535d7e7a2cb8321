"""The pipeline's stages against the operators' own results, each on the input it got."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from tests.conftest import DATA
from tillhouse.llm import exact_dedup, mixing, near_dedup, piece_sampling, quality_rules


def test_stages(spark, tmp_path):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    tables = [source]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], DATA).write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
        if i < 4:
            assert tables[-1].columns == source.columns
    docs, judged, unlike, apart, mixed, encoded = tables

    ids = lambda frame: sorted(r[0] for r in frame.select("doc_id").collect())
    assert ids(judged) == ids(quality_rules.judge(docs, labels).filter("quality.kept").select("row.*"))
    assert ids(unlike) == ids(exact_dedup.exact_dedup(judged).filter("kept"))
    assert ids(apart) == ids(near_dedup.classes(unlike).filter("kept"))
    assert 0 < apart.count() <= unlike.count() < judged.count() < docs.count()
    taken = {r.doc_id: r.taken for r in mixing.mix(apart).documents.collect() if r.taken}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == taken
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.MODEL)
    texts = {}
    for r in mixed.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in encoded.filter("sample = 1").collect():
        assert piece_sampling.decode(vocabulary, r.ids) in texts[r.doc_id]


def test_rows_are_judged_one_by_one(spark, documents, prose):
    """Rows with a null id or one that others share go or stay by their own verdict."""
    r = random.Random(18)
    rows = [(None, "copy of x"), (None, "copy of x"), (5, "a text"), (5, "b text"), (1, "b text"), (6, "a text"), (None, "alone")]
    found = corpus_pipeline.exact(spark, documents(rows), DATA).select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [(None, "copy of x"), (5, "a text"), (1, "b text"), (None, "alone")]))

    one, two, *others = (prose(r, 150, 5000) for _ in range(5))
    changed = lambda text: [*text[:70], "new", *text[71:]]
    rows = [(None, one), (None, changed(one)), (7, two), (7, changed(two)), (8, others[0]), (9, others[1]), (9, others[2])]
    found = corpus_pipeline.near(spark, documents([(d, " ".join(t)) for d, t in rows]), DATA).collect()
    assert Counter(x.doc_id for x in found) == {None: 1, 7: 1, 8: 1, 9: 2}
    assert {" ".join(t) for t in others} <= {x.text for x in found}


def test_registered_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near-dedup", "source mixing", "segmentation"]
    assert corpus_pipeline.run(spark, DATA).count() > 0
