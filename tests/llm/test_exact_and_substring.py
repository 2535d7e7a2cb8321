from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np

from tillhouse.llm import exact_dedup, substring_dedup
from tillhouse.llm.substring_dedup import FMIndex, fragments

SPACES = " \t\n\x0b\x0c\r"


def norm(text):
    return "".join(c for c in (text or "") if c not in SPACES)


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in rows:
        best = min(groups[norm(text)])
        out.append((doc_id, best[2], len(groups[norm(text)]), hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_edges(spark, documents):
    long = "x" * 300_000
    rows = [(1, "a b"), (2, "ab"), (3, " a\tb "), (4, None), (5, ""), (6, "\n\x0b"), (7, long), (8, long + " "), (None, "zz"), (9, "zz"), (10, "é é"), (11, "éé")]
    rows += [(100 + i, "the same text") for i in range(200)] + [(12, "again"), (12, "again")]
    result = exact_dedup.exact_dedup(documents(rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in result), key=repr) == brute_exact(rows)
    kept = [r for r in result if r.kept]
    assert len(kept) == len({norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_group_over_partitions(spark, documents):
    """A group that holds most rows is cut into several ranges and still counted once."""
    rows = [(i, "hot" + " " * (i % 3)) for i in range(3000)] + [(5000 + i, f"cold {i}") for i in range(300)]
    result = exact_dedup.exact_dedup(documents(rows, extra=False).repartition(6)).collect()
    hot = [r for r in result if r.doc_id < 5000]
    assert {(r.keep_id, r.group_size) for r in hot} == {(2, 3000)}
    assert [r.doc_id for r in hot if r.kept] == [2]


def test_empty_tables(spark, documents):
    empty = documents([(1, "x")]).filter("doc_id > 1")
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert substring_dedup.remove_repeats(empty).collect() == []


def brute_substring(rows, width=13):
    first = {}
    split = [(d, "".join(" " if c in SPACES else c for c in t or "").split(" ")) for d, t in rows]
    split = [(d, [w for w in ws if w]) for d, ws in split]
    for d, ws in split:
        if d is not None:
            for i in range(len(ws) - width + 1):
                k = tuple(ws[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - width + 1):
            if d is not None and first[tuple(ws[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup_brute_force(spark, documents, prose):
    r = random.Random(5)
    passages = [" ".join(prose(r, n)) for n in (13, 14, 30, 60, 12)]
    rows = [(1, None), (2, ""), (3, "short text"), (None, passages[3]), (None, passages[3])]
    for i in range(60):
        parts = [" ".join(prose(r, r.randrange(0, 60)))]
        for _ in range(r.randrange(3)):
            parts += [r.choice(passages), " ".join(prose(r, r.randrange(0, 40)))]
        rows.append((100 + i, "\n".join(parts)))
    rows += [(300, rows[10][1]), (10, rows[20][1]), (301, "same " * 200), (302, "same " * 50), (303, rows[12][1]), (303, rows[12][1])]
    rows.append((400, " ".join(prose(r, 30_000))))
    result = substring_dedup.remove_repeats(documents(rows)).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in result), key=repr) == brute_substring(rows)


def test_fm_index_counts():
    r = np.random.default_rng(1)
    entries = [r.integers(0, 4, int(n)).astype(np.uint64) for n in r.integers(1, 20, 40)]
    index = FMIndex(np.concatenate(entries), np.array([len(e) for e in entries]))
    for _ in range(100):
        pattern = r.integers(0, 4, int(r.integers(1, 5)))
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            if high[0] > low[0]:
                low, high = index.extended(np.array([np.searchsorted(index.alphabet, c) + 1]), low, high)
        m = len(pattern)
        expected = sum((e[i : i + m] == pattern).all() for e in entries for i in range(len(e) - m + 1))
        assert max(0, high[0] - low[0]) == expected


def test_fragments_cover_each_window_once():
    r = np.random.default_rng(2)
    hashes = r.integers(0, 50, 500).astype(np.uint64)
    of = np.array([0, 0, 5, 18, 18, 200, 500])
    start, n, _ = fragments(hashes, of, 13, 8)
    covered = sorted(int(s + j) for s, k in zip(start, n) for j in range(k))
    assert covered == [i for a, b in zip(of[:-1], of[1:]) for i in range(a, b - 12)]
