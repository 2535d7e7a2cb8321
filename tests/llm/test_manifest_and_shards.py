"""The Merkle manifest and sharding against plain Python, with null, equal and clashing rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES
from tillhouse.llm import merkle, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    def build(rows):
        return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "first", "n", "leaf", "tree", "idx"]})

    return build


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = [row[0], row[3], row[2], row[4], row[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, i, digest):
    siblings = ""
    for level in levels[:-1]:
        start, place = i // 16 * 16, i % 16
        left, right = level[start : start + place], level[start + place + 1 : start + 16]
        siblings += "".join(left + right)
        digest, i = sha("".join([*left, digest, *right])), i // 16
    return siblings, digest


def by_hand(rows, altered):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
        trees[s] = (own, levels_of([leaf(r) for r in own]))
    upper = levels_of([trees[s][1][-1][0] for s in sources])
    found = []
    for k, s in enumerate(sources):
        own, levels = trees[s]
        for i, r in enumerate(own):
            claimed = r
            if altered(r) and r[1] is not None:
                claimed = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            below, digest = climb(levels, i, leaf(claimed))
            above, digest = climb(upper, k, digest)
            found.append((r[0], leaf(r), levels[-1][0], upper[-1][0], sha(below + above), digest, digest == upper[-1][0]))
    return sorted(found, key=str)


def altered_id(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def manifest(frame):
    return merkle.manifest(frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def mixed_rows():
    """A hot source of more than 16 superblocks, sources of 1, 16, 17, 256 and 257 rows, a null one and an empty name."""
    draw = random.Random(5)
    rows, next_id = [], 0
    for source, n in [("hot", 4200), ("one", 1), ("a", 16), ("b", 17), ("c", 256), ("ü", 257), (None, 3), ("", 2)]:
        for _ in range(n):
            next_id += draw.randrange(1, 4)
            rows.append((next_id, f"Text {draw.randrange(10**6)} É\n", "en", source, draw.randrange(100)))
    rows += [(None, "No id", "en", "a", 5), (None, None, None, "a", None), (7, None, "de", None, None), (7, "", "de", None, 0), (7, "", "de", None, 0)]
    rows.append((10**12, "Very long " * 50_000, "en", "b", 500_000))
    return rows


def test_manifest(table):
    rows = mixed_rows()
    result = sorted((tuple(r) for r in manifest(table(rows)).collect()), key=str)
    assert result == by_hand(rows, altered_id)
    assert any(not r[-1] for r in result) and any(r[-1] for r in result)


def test_manifest_with_many_sources(table):
    rows = [(i, f"T{i}", "en", f"s{i % 300:03}", i) for i in range(900)]
    assert sorted((tuple(r) for r in manifest(table(rows)).collect()), key=str) == by_hand(rows, altered_id)


def test_manifest_of_one_and_of_no_rows(table):
    rows = [(1, "Only", "en", "s", 4)]
    assert [tuple(r) for r in manifest(table(rows)).collect()] == by_hand(rows, altered_id)
    assert manifest(table([])).count() == 0


def test_any_change_fails_the_proof(table):
    rows = [(i, f"T{i}", "en", "s" if i % 3 else None, i) for i in range(300)]
    docs = table(rows)
    for changed in ({"source": F.lit("other")}, {"n_chars": F.col("n_chars") + 1}, {"lang": F.lit(None)}):
        claimed = docs.select("doc_id", "source", merkle.leaf_hash().alias("leaf"), merkle.leaf_hash(**changed).alias("claimed"))
        assert not any(r.verified for r in merkle.prove(claimed).collect())


def test_shards_are_even_and_hold_the_mixture(table):
    rows = [(r[0], *r[1:]) for r in mixed_rows()]
    found = sharding.assign(table(rows), shards=7).collect()
    assert len(found) == len(rows) and {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    per_shard = [[r for r in found if r.shard == s] for s in range(7)]
    sizes = [len(s) for s in per_shard]
    assert max(sizes) - min(sizes) <= 1
    for shard in per_shard:
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
        for source in {r[3] for r in rows}:
            share = sum(1 for r in rows if r[3] == source) / 7
            assert abs(sum(1 for r in shard if r.source == source) - share) <= 2
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in found) == want


def test_shards_agree_on_reruns_and_do_not_follow_the_input_order(table):
    rows = [(i, f"T{i % 50}", "en", f"s{i % 3}", 2) for i in range(2000)]
    places = [sorted((r.doc_id, r.shard, r.slot) for r in sharding.assign(table(x), shards=5).collect()) for x in (rows, rows[::-1])]
    assert places[0] == places[1]
    first = [i for i, shard, _ in places[0] if shard == 0]
    assert max(first) > 1500 and min(first) < 500
    assert sorted((r.doc_id, r.shard, r.slot) for r in sharding.assign(table(rows), shards=5, seed=14).collect()) != places[0]


def test_equal_rows_split_over_shards(table):
    rows = [(None, "same", "en", "s", 4)] * 1000
    sizes = [r["count"] for r in sharding.assign(table(rows), shards=40).groupBy("shard").count().collect()]
    assert len(sizes) == 40 and set(sizes) == {25}


def test_few_or_no_rows(table):
    found = sharding.assign(table([(1, "a", "en", "s", 1), (2, None, None, None, None)])).collect()
    assert sorted((r.slot, r.size, r.text_crc32) for r in found) == [(0, 16, 0), (0, 17, zlib.crc32(b"a"))]
    assert sharding.assign(table([])).count() == 0


def test_written_shards_hold_whole_rows(spark, table, tmp_path):
    docs = table([(i if i % 10 else None, f"T{i}", "en", "s", i) for i in range(500)])
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [125] * 4
    assert sorted(r.n_chars for r in back.select("row.n_chars").collect()) == list(range(500))
