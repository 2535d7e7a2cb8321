"""All key checks from one pass, against one check at a time."""

from __future__ import annotations

from tillhouse.plans.quality import ForeignKey, Rule, check_keys, check_unique, orphans, run


def test_one_pass_equals_single_checks(frame, spark):
    tables = {
        "parent": frame("k string, other int", ("a", 1), ("b", 1), ("b", 2), (None, 3), (None, 3), ("hot", 4)),
        "child": frame("p string, q string", ("a", "zz"), ("x", "b"), ("x", None), (None, "hot"), *[("hot", "gone")] * 500),
        "empty": frame("p string", ("a",)).filter("p = 'b'"),
    }
    keys = [ForeignKey("child", "p", "parent", "k"), ForeignKey("child", "q", "parent", "k"), ForeignKey("empty", "p", "parent", "k"), ForeignKey("child", "p", "empty", "p")]
    unique = [("parent", "k"), ("parent", "other"), ("child", "p"), ("empty", "p")]
    findings = check_keys(tables.__getitem__, unique, keys)
    columns = [findings.of_unique(*u).alias(f"u{i}") for i, u in enumerate(unique)]
    columns += [findings.of_key(k, nulls).alias(f"k{i}{nulls}") for i, k in enumerate(keys) for nulls in (False, True)]
    row = findings.found.select(*columns).first()
    for i, (table, column) in enumerate(unique):
        assert row[f"u{i}"] == check_unique(tables[table], Rule(table, "unique", column)).first().failures
    for i, k in enumerate(keys):
        for nulls in (False, True):
            assert row[f"k{i}{nulls}"] == orphans(tables[k.child], k.column, tables[k.parent], k.key, nulls).first().orphan_count


def test_each_table_is_read_once_and_shuffled_once(frame, tmp_path, spark):
    for name in ("p", "c"):
        frame("k string, v string", ("a", "a")).write.parquet(str(tmp_path / name))
    rules = [Rule("p", "unique", "k"), Rule("p", "unique", "v"), Rule("c", "unique", "k"), Rule("c", "relationships", "k", ("p", "k")), Rule("c", "relationships", "v", ("p", "k"))]
    report = run(lambda name: spark.read.parquet(str(tmp_path / name)), rules)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning(domain") == 2  # the values, then one row per domain
    assert [r.failures for r in report.collect()] == [0] * 5
