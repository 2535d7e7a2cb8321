"""Phrase mining against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillhouse.llm import phrases


def occurrences(rows):
    """Counts of every phrase of one to four words, by language."""
    counts = {}
    for row in rows:
        lang, text = row[2] or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1] or "")
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            own[""] += len(words)
            for m in range(1, 5):
                own.update(" ".join(words[i : i + m]) for i in range(len(words) - m + 1))
    return counts


def by_hand(rows, top=2000):
    found = []
    for lang, f in occurrences(rows).items():
        frequent = {p: a for p, a in f.items() if p and a >= 30}
        scored = []
        for phrase, a in frequent.items():
            words = phrase.split(" ")
            if len(words) < 2:
                continue
            if any(f" {phrase} " in f" {q} " and 100 * b >= 80 * a for q, b in frequent.items() if q.count(" ") > phrase.count(" ")):
                continue
            cuts = [(f[" ".join(words[:k])], f[" ".join(words[k:])], k) for k in range(1, len(words))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for x, y, k in cuts)
            scored.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, f[""], -score))
    return sorted(found)


def mined(frame):
    return sorted(tuple(r) for r in phrases.mine(frame).collect())


@pytest.fixture
def table(spark):
    def build(rows, parts=3):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(parts)

    return build


def prose(seed, docs=220, length=60):
    """Zipf-like words with planted phrases, capitals, all separators and other white space."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    planted = ["New york", "new York City", "as soon as", "tick tick tick tick tick", "in spite of that"]
    rows = []
    for i in range(docs):
        text = ""
        for _ in range(draw.randrange(length)):
            word = draw.choice(planted) if draw.random() < 0.2 else vocabulary[int(60 * draw.random() ** 3)]
            text += word + draw.choice([" ", " ", " ", "  ", "\t", "\n", ". ", ",", "\x0b", "\xa0", " ! ", "-"])
        rows.append((i, text, draw.choice(["en", "en", "de", None, "und"]), "s"))
    return rows


def edge_rows():
    return [
        (None, None, "en", "s"),
        (None, "", None, None),
        (5, " \t.,;!?", "en", "s"),
        (5, "same text again and again", "fr", "s"),
        *[(9, "Copied LINE here\nand there", "fr", "s")] * 40,
        (10, "long run " * 30_000, "long", "s"),
    ]


def test_mined_phrases(table):
    rows = prose(1) + edge_rows()
    found = mined(table(rows))
    assert found == by_hand(rows)
    assert {r[0] for r in found} >= {"en", "und", "fr", "long"}


@pytest.mark.parametrize("one_in, sample_count", [(1, 1), (1, 30), (1, 200), (40, 1), (10**9, 1)])
def test_any_sample_gives_the_same_counts(table, one_in, sample_count):
    """Also one that proposes nothing, so that every length is found as a border failure, or everything."""
    rows = prose(2, docs=150)
    found = {(r.lang, r.phrase): r.found for r in phrases.frequent_phrases(table(rows), 30, one_in, sample_count).collect()}
    counts = occurrences(rows)
    assert found == {(lang, p): a for lang, f in counts.items() for p, a in f.items() if a >= 30 or p == ""}


def test_shared_bits_only_add_work(table, monkeypatch):
    """With 2 ** 15 bits the phrases share many, and the counts stay exact."""
    monkeypatch.setattr(phrases, "FILTER_BITS", 15)
    rows = prose(3, docs=150)
    assert mined(table(rows)) == by_hand(rows)


def test_input_order_and_extra_columns_do_not_matter(table):
    from pyspark.sql import functions as F

    rows = prose(4, docs=120)
    plain = mined(table(rows))
    clashing = table(rows[::-1], parts=7).withColumns({c: F.lit("x") for c in ["phrase", "found", "n", "a", "bit", "known", "rank", "words"]})
    assert mined(clashing) == plain


def test_top_and_no_rows(table):
    rows = prose(5)
    found = phrases.frequent_phrases(table(rows))
    few = sorted(tuple(r) for r in phrases.collocations(found, top=2).collect())
    assert few == [r for r in by_hand(rows) if r[1] <= 2]
    assert mined(table([(1, "nothing is frequent", "en", "s")])) == []
    assert mined(table([])) == []


def test_chunks_do_not_split_what_belongs_together(table, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 500)
    rows = prose(6, docs=80) + edge_rows()[:-1]
    assert mined(table(rows)) == by_hand(rows)


def test_words_of_a_chunk():
    chunk = phrases.Chunk(pa.array(["A b.C", None, "", "c\td e", "É É"]), "en")
    at = np.arange(chunk.n)
    assert chunk.phrases(at, 1).to_pylist() == ["a", "b", "c", "c", "d", "e", "É", "É"]
    assert len(set(chunk.piece.tolist())) == 4 and chunk.piece[0] == chunk.piece[1]
    assert chunk.word[2] == chunk.word[3] and chunk.word[6] == chunk.word[7]
    assert chunk.phrases(np.array([3, 6]), 2).to_pylist() == ["c d", "É É"]
    keys = chunk.keys(at, 1)
    assert keys[2] == keys[3] and phrases.Chunk(pa.array(["c"]), "de").keys(at[:1], 1)[0] != keys[2]
    assert {int(k) & 7 for k in chunk.keys(np.array([3, 6]), 2)} == {2}


def test_shared_keys_only_add_work(table, monkeypatch):
    """Keys of 17 bits: rare phrases look frequent by the keys they share, and the last pass drops them."""
    plain = phrases.Chunk.keys
    few = np.uint64(((1 << 14) - 1) << 50)
    monkeypatch.setattr(phrases.Chunk, "keys", lambda self, at, length: (plain(self, at, length) & few) | np.uint64(length))
    rows = prose(7, docs=150)
    assert mined(table(rows)) == by_hand(rows)
