from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillhouse.llm import mixing


def filled(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if 2 * sizes[s] < level * weight[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in capped else min(2.0 * sizes[s], level * weight[s]) for s in order}
        capped |= more


@pytest.fixture
def table(spark, documents):
    r = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(r.randrange(0, 200))), r.choice(["a", "a", "a", "b", "c", "", None, "é", "z"])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "only-empty"), (1002, "x " * 50_000, "long"), (None, "five words in this one", "a"), (1003, "one", "tiny")]
    return documents(rows), rows


def test_targets_and_taken(table):
    frame, rows = table
    size = lambda t: len((t or "").split())
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    expected = filled(sizes)
    found = mixing.mix(frame, block_words=64).documents.collect()
    assert len(found) == len(rows)
    taken = {}
    for x in found:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(expected[x.source])
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
    assert all(abs(taken[s] - expected[s]) < 1 for s in sizes)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(frame.repartition(7), block_words=64).documents.collect()))


def test_schedule_is_even(table):
    """Every prefix of the schedule holds about a source's share of slots, and ranks go up with the places."""
    frame, _ = table
    slots = sorted(mixing.mix(frame, block_words=64).slots.collect(), key=lambda x: x.place)
    assert len({x.place for x in slots}) == len(slots)
    total = {}
    for x in slots:
        assert x["rank"] == total.get((x.s_null, x.s), 0)
        total[x.s_null, x.s] = x["rank"] + 1
    seen = {}
    for n, x in enumerate(slots, 1):
        seen[x.s_null, x.s] = seen.get((x.s_null, x.s), 0) + 1
        assert all(abs(k - n * total[s] / len(slots)) < 8 for s, k in seen.items())


def test_mixed_rows(table):
    frame, rows = table
    frame = frame.filter("doc_id IS NOT NULL")
    counts = {x.doc_id: x for x in mixing.mix(frame, 64).documents.collect()}
    out = {}
    for x in mixing.mixed(frame, 64).collect():
        out.setdefault(x.doc_id, []).append(x)
    texts = {r[0]: r[1] for r in rows}
    for doc, x in counts.items():
        mine = out.get(doc, [])
        assert sum(len(y.text.split()) for y in mine) == x.taken
        assert all(texts[doc].split()[: len(y.text.split())] == y.text.split() for y in mine)
        assert all(y.n_chars == len(y.text) for y in mine)


def test_mixed_rows_without_an_id_of_their_own(documents):
    """Null and repeated ids: each row is taken by its own count, and no source is above its target."""
    r = random.Random(9)
    text = lambda name: " ".join(f"{name}-{i}" for i in range(r.randrange(1, 90)))
    rows = [(None, text(f"n{k}"), "ab"[k % 2]) for k in range(30)] + [(7, text(f"r{k}"), "a") for k in range(30)] + [(k, text(f"u{k}"), "b") for k in range(100, 130)]
    frame = documents(rows)
    planned, out = {}, {}
    for x in mixing.mix(frame, 64).documents.collect():
        planned.setdefault(x.source, []).append((x.doc_id, x.taken))
    size = {t.split("-")[0]: len(t.split()) for _, t, _ in rows}
    owner = {t.split("-")[0]: (d, s) for d, t, s in rows}
    for x in mixing.mixed(frame, 64).collect():
        got = x.text.split()
        name = got[0].split("-")[0]
        assert owner[name] == (x.doc_id, x.source) and got == [f"{name}-{i}" for i in range(len(got))]
        out.setdefault(name, []).append(len(got))
    assert all(sum(n) <= 2 * size[name] for name, n in out.items())
    for source, plan in planned.items():
        taken = [(owner[k][0], sum(n)) for k, n in out.items() if owner[k][1] == source]
        assert sorted(map(repr, taken)) == sorted(repr(x) for x in plan if x[1])


def test_no_rows(table):
    frame, _ = table
    assert mixing.mix(frame.filter("doc_id < 0")).documents.collect() == []
    assert mixing.mixed(frame.filter("doc_id < 0")).collect() == []
    empty = mixing.mix(frame.filter(F.col("doc_id") == 1001)).documents.collect()
    assert [(x.target, x.taken) for x in empty] == [(0.0, 0)]
