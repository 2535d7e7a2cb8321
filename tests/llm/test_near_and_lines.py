from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tillhouse.llm import line_dedup, near_dedup
from tillhouse.llm.components import components


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def changed(r, text, edits, letters="abcé "):
    out = list(text)
    for _ in range(edits):
        kind, at = r.randrange(3), r.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, r.choice(letters))
        elif at < len(out):
            if kind == 1:
                del out[at]
            else:
                out[at] = r.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_edit_distance(tau):
    r = random.Random(3)
    left = ["".join(r.choice("abcé") for _ in range(r.randrange(30))) for _ in range(800)]
    right = [changed(r, x, r.randrange(7), "abcé") for x in left]
    assert line_dedup.within(left, right, tau).tolist() == [distance(a, b) <= tau for a, b in zip(left, right)]


def smallest(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in parent}


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + r.randrange(1, 200)) for _ in range(100)] + [(r.randrange(2000, 2060), r.randrange(2000, 2060)) for _ in range(40)]
    found = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: v for k, v in smallest(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_line_dedup_brute_force(spark, documents):
    r = random.Random(6)
    base = ["".join(r.choice("abcdefgé ") for _ in range(r.randrange(20, 60))) for _ in range(25)]
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, base[0]), (4, "tiny\ntiny\ntinz")]
    for i in range(40):
        lines = [changed(r, r.choice(base), r.randrange(4)) for _ in range(r.randrange(1, 6))]
        rows.append((10 + i, "\n".join(lines)))
    # A large group of different near copies, and a hot line.
    rows += [(200 + i, changed(r, base[3], 1) + "\nthe line that everybody has") for i in range(60)]
    rows.append((300, "y" * 100_000))
    result = {x.doc_id: x for x in line_dedup.dedup_lines(documents(rows)).collect()}
    seen = {}
    for doc, text in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        for i, line in enumerate((text or "").split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", line):
                seen.setdefault(line, []).append((doc, i))
    long = [x for x in seen if len(x) >= line_dedup.MIN_CHARS]
    links = [(a, b) for i, a in enumerate(long) for b in long[:i] if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2]
    assert len(links) > 50
    label = smallest(links)
    first = {}
    for line, places in seen.items():
        k = label.get(line, line)
        first[k] = min(first.get(k, places[0]), places[0])
    for line, places in seen.items():
        n = sum(line in x for x in links)
        for doc, i in places:
            got = next(x for x in result[doc].lines if x.line_no == i)
            assert ((got.class_doc, got.class_line), got.links, got.kept) == (first[label.get(line, line)], n, first[label.get(line, line)] == (doc, i))
    assert len(result) == len(rows)
    assert result[1].n_lines == result[3].n_lines == result[None].n_lines == 0
    assert sum(x.n_removed for x in result.values()) == sum(len(p) for p in seen.values()) - len(first)


def test_line_dedup_links_short_lines(spark, documents):
    r = random.Random(16)
    lines = sorted({"".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n)) for n in (1, 2, 3, 4, 5, 7, 10, 15, 19) for _ in range(8)})
    lines = sorted({*lines, *(changed(r, x, 1 + i % 3, "xyé") for i, x in enumerate(lines))} - {""})
    lines = [x for x in lines if x.strip()]
    close = [(i, j) for j, b in enumerate(lines) for i, a in enumerate(lines[:j]) if distance(a, b) <= 2]
    label = smallest(close)
    found = {x.doc_id: x.lines[0] for x in line_dedup.dedup_lines(documents(list(enumerate(lines)))).collect()}
    assert len(close) > 50
    assert {i: (x.class_doc, x.links) for i, x in found.items()} == {i: (label.get(i, i), sum(i in x for x in close)) for i in range(len(lines))}


def test_line_dedup_takes_its_length(spark, documents):
    rows = [(1, "eight ch\nfour"), (2, "eight cx\nfoul")]
    found = {x.doc_id: [y.kept for y in x.lines] for x in line_dedup.dedup_lines(documents(rows), min_chars=5).collect()}
    assert found == {1: [True, True], 2: [False, True]}


def weighted(rows):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])
        return {x: runs.count(x) for x in set(runs)} if len(runs) < 3000 else {x: 1 for x in runs}

    found = [(d, shingles(t)) for d, t in rows]
    df = {}
    for _, s in found:
        for x in s:
            df[x] = df.get(x, 0) + 1
    code = {x: min(255, round(4 * float(np.log2(n)))) for x, n in df.items()}
    idf = {x: max(np.log1p(len(rows) / 2 ** (c / 4)), np.log1p(len(rows)) / 2) for x, c in code.items()}
    return [(d, {x: n * idf[x] for x, n in s.items()}) for d, s in found]


def similarity(a, b):
    both = sum(min(a.get(x, 0), b.get(x, 0)) for x in {*a, *b})
    return both / sum(max(a.get(x, 0), b.get(x, 0)) for x in {*a, *b})


def test_near_dedup_classes(spark, documents, prose):
    r = random.Random(7)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "three"), (6, "\n")]
    for family in range(6):
        base = prose(r, 150, 5000)
        for copy in range(8):
            text = list(base)
            for _ in range(copy % 5):
                text[r.randrange(150)] = f"new{r.random()}"
            rows.append((10 + family * 10 + copy, " ".join(text)))
    rows += [(200 + i, " ".join(prose(r, 120, 5000))) for i in range(20)] + [(300, rows[10][1]), (300, rows[10][1])]
    rows.append((400, " ".join(prose(r, 20_000, 100_000))))
    ids = [x[0] for x in rows]
    vectors = weighted(rows)
    links = [(a, b) for i, (a, x) in enumerate(vectors) for b, y in vectors[:i] if a != b and x and y and similarity(x, y) >= 0.8]
    label = smallest(links)
    result = near_dedup.classes(documents([*rows, (None, "null id")])).collect()
    assert len(result) == len(rows) + 1
    found = {x.doc_id: x.class_id for x in result}
    assert found.pop(None) is None
    assert found == {d: label.get(d, d) for d in ids}
    assert all(x.kept == (x.doc_id == x.class_id) for x in result if x.doc_id is not None)


def test_near_copies_of_a_mass_copied_text(spark, documents, prose):
    """A few words changed in a text that most documents share, exactly or nearly, make no class of their own."""
    r = random.Random(17)
    base = prose(r, 150, 5000)
    rows = [(i, " ".join(base)) for i in range(200)]
    for i in range(200):
        text = list(base)
        for _ in range(1 + i % 2):
            text[r.randrange(150)] = f"new{r.random()}"
        rows.append((1000 + i, " ".join(text)))
    rows += [(2000 + i, " ".join(prose(r, 150, 5000))) for i in range(200)]
    found = {x.doc_id: x.class_id for x in near_dedup.classes(documents(rows)).collect()}
    assert found == {d: 0 if d < 2000 else d for d, _ in rows}


def test_rows_that_share_an_id_link_their_texts(spark, documents, prose):
    r = random.Random(27)
    one, two, three = (prose(r, 150, 5000) for _ in range(3))
    near = lambda words: " ".join([*words[:70], "changed", *words[71:]])
    rows = [(5, " ".join(one)), (5, " ".join(two)), (6, near(one)), (7, near(two)), (8, " ".join(three)), (9, near(three)), (9, " ".join(one))]
    rows += [(20, ""), (20, "only this"), (21, "only this"), (30, " ".join(prose(r, 60, 5000)))]
    found = {(x.doc_id, x.class_id, x.class_size) for x in near_dedup.classes(documents(rows)).collect()}
    assert found == {*((i, 5, 7) for i in (5, 6, 7, 8, 9)), (20, 20, 3), (21, 20, 3), (30, 30, 1)}


def test_texts_changed_in_places_of_their_own(spark, documents, prose, monkeypatch):
    """Copies of one text that are 0.5 to 0.8 alike: the classes are right, and most pairs are ruled out unseen."""
    r = random.Random(37)
    base, rows = prose(r, 150, 5000), []
    for i in range(500):
        text = list(base)
        for _ in range(2 + i % 7):
            text[r.randrange(150)] = f"new{r.random()}"
        rows.append((i, " ".join(text)))
    vectors = weighted(rows)
    alike = [(a, b, similarity(x, y)) for i, (a, x) in enumerate(vectors) for b, y in vectors[:i]]
    label = smallest([(a, b) for a, b, s in alike if s >= 0.8])
    counted, in_pairs = [], near_dedup._in_pairs
    monkeypatch.setattr(near_dedup, "_in_pairs", lambda *x: counted.append(in_pairs(*x)) or counted[-1])
    found = {x.doc_id: x.class_id for x in near_dedup.classes(documents(rows)).collect()}
    assert found == {d: label.get(d, d) for d, _ in rows}
    assert sum(0.5 <= s < 0.8 for _, _, s in alike) > 30_000
    assert counted[0].count() < 2_000


def test_near_dedup_recall_on_the_given_documents(spark):
    """Links of every document whose id is divisible by 50 with all others, and all links from 0.8 to 0.9."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    vectors = dict(weighted([(x.doc_id, x.text) for x in docs.collect()]))
    holders = {}
    for d, s in vectors.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    pairs = {(a, b) for ids in holders.values() for i, a in enumerate(ids) for b in ids[:i]}
    alike = {(a, b): similarity(vectors[a], vectors[b]) for a, b in pairs}
    found = {x.doc_id: x.class_id for x in near_dedup.classes(docs).collect()}
    together = lambda links: sum(found[a] == found[b] for a, b in links) / max(1, len(links))
    queries = [p for p, s in alike.items() if s >= 0.8 and (p[0] % 50 == 0 or p[1] % 50 == 0)]
    close = [p for p, s in alike.items() if 0.8 <= s < 0.9]
    assert together(queries) >= 0.98 and together(close) >= 0.98, (len(queries), together(queries), len(close), together(close))
    # No class holds what no link joins.
    label = smallest([p for p, s in alike.items() if s >= 0.8])
    assert all(label.get(d, d) == label.get(k, k) for d, k in found.items())


def test_sampling_follows_similarity():
    """Draws of two weighted sets agree with the probability of their weighted Jaccard similarity."""
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 2**63, 400).astype(np.uint64))
    x, y = r.gamma(2, 2, len(keys)), r.gamma(2, 2, len(keys))
    y[:200] = x[:200]
    sampler = near_dedup.Sampler(4000)
    one = sampler.sample(keys, x, np.array([0]))
    two = sampler.sample(keys, y, np.array([0]))
    expected = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((one == two).mean() - expected) < 0.04


def test_empty_tables(spark, documents):
    empty = documents([(1, "x")]).filter("doc_id > 1")
    assert near_dedup.classes(empty).collect() == []
    assert line_dedup.dedup_lines(empty).collect() == []
