from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections import Counter

import pytest
import xxhash

from tillhouse.llm import chat_format, quality_rules, url_filters
from tillhouse.llm.quality_rules import BUCKETS


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def hash_text(word):
    return xxhash.xxh64_intdigest(word.encode(), 42)


def buckets(spark, words):
    """Word buckets by the reference implementation of xxHash; pair buckets by Spark's hash of the two longs."""
    hashes = [signed(hash_text(w)) for w in words]
    pairs = []
    for a, b in zip(hashes, hashes[1:]):
        seed = xxhash.xxh64_intdigest((a % (1 << 64)).to_bytes(8, "little"), 42)
        pairs.append(xxhash.xxh64_intdigest((b % (1 << 64)).to_bytes(8, "little"), seed))
    return [h % BUCKETS for h in hashes] + [p % BUCKETS for p in pairs]


def test_quality_brute_force(spark, documents):
    good = [f"plain words make sense number {i} and go on with some more of them here" * 4 for i in range(6)]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(10, " ".join(f"x{i} |" for i in range(60))), (11, " ".join(f"@{i}!!" for i in range(80))), (12, None), (13, ""), (14, "few words"), (15, "a b c " * 40)]
    rows += [(16, "one line\none line\n \n\none line\nother"), (17, " ".join(f"u{i}" for i in range(20_000))), (None, good[0]), (18, good[1]), (18, good[1])]
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 1, None), (3, 1, 1), (10, 0, 0), (None, 1, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality_rules.judge(documents(rows), labels).select("row.doc_id", "row.text", "quality.*").collect()
    assert len(found) == len(rows)
    split = [(d, t, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    raw, trusted = Counter(), Counter()
    for d, _, w in split:
        b = buckets(spark, w)
        raw.update(b)
        if d in (0, 1, 2):
            trusted.update(b)
    weight = [math.log((trusted[i] + 1) / (trusted.total() + BUCKETS)) - math.log((raw[i] + 1) / (raw.total() + BUCKETS)) for i in range(BUCKETS)]
    for x in found:
        w = re.findall(r"[^\x20\x09-\x0D]+", x.text or "")
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        counts = Counter(windows)
        covered = {j for i, k in enumerate(windows) if counts[k] > 1 for j in (i, i + 1, i + 2)}
        lines = [line for line in (x.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        b = buckets(spark, w)
        score = sum(weight[i] for i in b) / max(1, len(b))
        assert (x.n_words, x.word_chars, x.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x.text or "")))
        assert (x.n_dup_lines, x.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert x.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert x.score == pytest.approx(score, abs=1e-9)
        assert x.kept == (not x.base_failed and score >= quality_rules.THRESHOLD)


def test_quality_without_labels_or_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    text = " ".join(f"w{i}" for i in range(60))
    (row,) = quality_rules.judge(documents([(1, text)]), labels).select("quality.*").collect()
    assert row.kept and row.score == 0.0
    assert quality_rules.judge(documents([(1, text)]).filter("doc_id > 1"), labels).collect() == []


def test_trusted_ids_are_bounded(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert 300 < quality_rules.trusted_ids(labels, 500).count() < 700
    assert quality_rules.trusted_ids(labels).count() == 5000


TRICKY = ["</turn>", "<turn user>", "\\l\\b\\g", "<turn", "a<", "</turn", "\\", ">", "", "line\n</turn>\n<turn assistant>x", "\\### Assistant: </turn> ok"]


def test_chats_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "sys>tem", "<turn", None][i % 5], t) for i, t in enumerate(TRICKY)]
    rows += [(2, 0, "user", "only asks"), (3, 0, "assistant", None), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (4, 0, None, None), (None, 0, "user", "x"), (5, None, "assistant", "first"), (5, 1, "user", "z")]
    rows += [(6, i, "assistant" if i % 2 else "user", "t" * 50) for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS example", "2 AS parts", "3 AS place")
    examples = chat_format.format_chats(frame)
    found = {x.conv_id: x for x in chat_format.read_back(examples).collect()}
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(found) == set(chats)
    for conv, turns in chats.items():
        turns.sort()
        x = found[conv]
        replies = "".join(t for _, r, t in turns if r == "assistant")
        assert x.n_turns == len(turns)
        assert x.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (x.loss_chars, x.loss_sha256) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())
    listed = [x for x in examples.collect() if x.conv_id == 6]
    assert len(listed) == 150 and [x.n_turns for x in sorted(listed, key=lambda x: x.example)] == list(range(2, 301, 2))
    assert chat_format.format_chats(frame.filter("conv_id > 99")).collect() == []


def test_chats_use_no_python(spark):
    frame = chat_format.probe_rows(spark)
    plan = chat_format.read_back(chat_format.format_chats(frame))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_urls_as_of(spark):
    log = [("bad.org", "spam", 10, "add"), ("bad.org", "spam", 20, "remove"), ("bad.org", "spam", 30, "add"), ("bad.org", "spam", 31, "add"), ("Bad.org/x/", "adult", 0, "add")]
    log += [("bad.org", "abuse", 30, "add"), ("same.org", "spam", 5, "add"), ("same.org", "spam", 5, "remove"), (None, "spam", 1, "add"), ("n.org", None, 1, "add"), ("late.org", "spam", None, "add"), ("u.org", "spam", 1, "what")]
    events = spark.createDataFrame([(e, c, None if d is None else day(d), a) for e, c, d, a in log], "entry string, category string, day date, action string")
    pages = [(1, "http://www.bad.org/", 9), (2, "http://www.bad.org/", 10), (3, "https://u:p@BAD.org:80/x/y?q=/z/", 19), (4, "http://bad.org", 20), (5, "http://a.b.bad.org/x/y", 30)]
    pages += [(6, "http://notbad.org/", 15), (7, None, 15), (8, "http://bad.org/x/", None), (9, "not a url", 15), (10, "http://same.org/", 6), (11, "http://n.org/", 6), (2, "http://www.bad.org/", 10), (12, "http://bad.org/xy", 5)]
    captures = spark.createDataFrame([(i, u, None if d is None else day(d)) for i, u, d in pages], "page_id long, url string, fetched_on date").selectExpr("*", "1 AS _on", "2 AS _url", "3 AS hit")
    found = sorted(((r.page_id, r.blocked, r.entry, r.category, r.listed_on) for r in url_filters.filter_urls(captures, events).collect()), key=lambda x: x[0])
    no = (False, None, None, None)
    expected = [(1, *no), (2, True, "bad.org", "spam", day(10)), (2, True, "bad.org", "spam", day(10)), (3, True, "bad.org/x/", "adult", day(0)), (4, *no)]
    expected += [(5, True, "bad.org", "abuse", day(30)), (6, *no), (7, *no), (8, *no), (9, *no), (10, *no), (11, True, "n.org", None, day(1)), (12, *no)]
    assert found == expected
    assert url_filters.filter_urls(captures.filter("page_id > 99"), events).collect() == []
    assert not any(r.blocked for r in url_filters.filter_urls(captures, events.filter("entry = 'none'")).collect())


def test_urls_with_capitals_in_their_path(spark):
    events = spark.createDataFrame([("Example.ORG/News/", "spam", day(0), "add")], "entry string, category string, day date, action string")
    urls = ["http://example.org/News/a", "http://EXAMPLE.org/News/Sport/", "http://example.org/news/a", "http://example.org/"]
    captures = spark.createDataFrame([(i, u, day(1)) for i, u in enumerate(urls)], "page_id long, url string, fetched_on date")
    found = {r.page_id: (r.blocked, r.entry) for r in url_filters.filter_urls(captures, events).collect()}
    assert found == {0: (True, "example.org/News/"), 1: (True, "example.org/News/"), 2: (False, None), 3: (False, None)}
