from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tillhouse.llm import html_extraction as H
from tillhouse.llm import piece_sampling as P
from tillhouse.llm.words import mix


DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sources(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").orderBy("page_id").select("html").collect()
    return [r["html"] for r in rows]


@pytest.fixture(scope="module")
def labeller(sources):
    return H.train(sources[:120])


def test_labels_of_pages_not_trained_on(sources, labeller):
    pages = [H.blocks(s) for s in sources[120:]]
    good = labeller.scores(H.Features()(pages), [len(p) for p in pages]) > 0
    expected = np.array([H.contained(b) for p in pages for b in p])
    assert (good == expected).mean() > 0.99


def test_labels_of_other_layouts(sources, labeller):
    random = np.random.Generator(np.random.PCG64(123))
    texts = [b.text for s in sources[120:] for b in H.blocks(s)]
    prose, short = [t for t in texts if len(t) > 60], [t for t in texts if len(t) <= 60]
    pages, labels = [], []
    for _ in range(150):
        source, label = H._lay_out(random, prose, short)
        pages.append(H.blocks(source))
        labels.append(label)
        assert len(pages[-1]) == len(label)
    good = labeller.scores(H.Features()(pages), [len(p) for p in pages]) > 0
    assert (good == np.concatenate(labels)).mean() > 0.97


def test_blocks():
    page = "<p>a &amp; b\n <i>c</i>&eacute;<br>d<script>x<p>y</script><p class='k1 k2'>e<li>f<!-- g --><select><option>h</select></li> <a href=x>i</a><p>&#x41;&nbsp;<textarea>t</textarea>"
    assert [b.text for b in H.blocks(page)] == ["a & b cé d", "e", "f", "i", "A\xa0"]
    assert H.blocks(page)[1].path == ("<p", "k1", "k2")
    assert H.blocks(page)[3].link_chars == 1
    assert H.blocks("") == [] and H.blocks("<p>  </p>") == []
    assert [b.text for b in H.blocks("<p>open <b>tags <p>and <!-- no end")] == ["open tags", "and"]
    assert [b.text for b in H.blocks("1 < 2 <p>x</p><script>var a = 1;")] == ["1 < 2", "x"]


def test_extract_edges(spark, labeller):
    article = "<html><body><nav><ul><li><a href=x>home</a></li></ul></nav><article><h1>Title</h1>" + "<p>Some longer words, as in an article.</p>" * 2000 + "</article><footer>&copy; me</footer>"
    rows = [(1, "u", article), (2, None, None), (3, "v", ""), (None, "w", "<nav><a href=1>x</a></nav>"), (1, "u", article)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    found = H.extract(pages, labeller).collect()
    assert len(found) == 5
    by = {x.url: x for x in found}
    assert by["u"].text.startswith("Title\nSome longer words") and by["u"].n_chars == len(by["u"].text)
    assert by["u"].text.count("\n") == 2000
    assert [by[u].text for u in (None, "v", "w")] == ["", "", ""]
    assert H.extract(pages.filter("page_id > 9")).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.load(P.MODEL)


def every_path(vocabulary, text):
    spelled = (" " + text).replace(" ", P.SPACE)
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.usable[i]}
    found = []

    def go(at, path, score):
        if at == len(spelled):
            found.append((tuple(path), score))
        for size in range(1, 17):
            piece = spelled[at : at + size]
            if len(piece) == size and piece in ids:
                go(at + size, [*path, ids[piece]], score + vocabulary.scores[ids[piece]])

    go(0, [], 0.0)
    total = math.log(sum(math.exp(s) for _, s in found))
    return {path: math.exp(s - total) for path, s in found}


def drawn(vocabulary, text, n, k):
    lattices = P.Lattices(vocabulary, 1.0)
    found, _ = P.sample_batch(lattices, [text] * n, mix(np.arange(n, dtype=np.uint64)), k)
    out = [[] for _ in range(n)]
    for rows, value, log_prob, inclusion, path in found:
        ids, of = P._ids(lattices, path)
        for j, r in enumerate(rows.tolist()):
            out[r].append((tuple(ids[of[r] : of[r + 1]].tolist()), value[j], log_prob[j], inclusion[j]))
    return out


def test_samples_follow_the_distribution(vocabulary):
    text, n = "then cat", 6000
    exact = every_path(vocabulary, text)
    rows = drawn(vocabulary, text, n, 3)
    first, two, estimate = Counter(), Counter(), Counter()
    for row in rows:
        assert len({x[0] for x in row}) == 3 and row[0][1] >= row[1][1] >= row[2][1]
        first[row[0][0]] += 1
        two.update(x[0] for x in row[:2])
        for path, _, log_prob, inclusion in row:
            assert log_prob == pytest.approx(math.log(exact[path]), abs=1e-6)
            estimate[path] += math.exp(log_prob) / inclusion
    for path, p in exact.items():
        either = p + sum(q * p / (1 - q) for other, q in exact.items() if other != path)
        assert first[path] / n == pytest.approx(p, abs=0.025)
        assert two[path] / n == pytest.approx(either, abs=0.025)
        assert estimate[path] / n == pytest.approx(p, abs=0.04)


def test_round_trip(spark, documents, vocabulary):
    texts = ["", None, " ", "a", "  two  spaces \n\n lines\t", "é▁x ▁", "日本語 text", "\U0001f600 ok", "x" * 5000, "word " * 20_000, "<s> </s> <0x41>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null key"), (3, "a")]
    found = P.segmentations(documents(rows)).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    by_id = dict(rows)
    for x in found:
        text = by_id[x.doc_id] or ""
        assert P.decode(vocabulary, x.ids) == text
        if "▁" not in text:
            assert model.decode(x.ids) == text
        assert 0 < x.inclusion <= 1 or x.log_prob < -20
    count = Counter(x.doc_id for x in found)
    assert count[0] == count[1] == 1 and count[9] == 3
    assert [x.ids for x in found if x.doc_id == 0] == [[]]
    assert all(x.same_text for x in P.digests(documents(rows)).collect())
    again = P.segmentations(documents(rows[::-1])).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    assert P.segmentations(documents(rows).filter("doc_id > 99")).collect() == []
