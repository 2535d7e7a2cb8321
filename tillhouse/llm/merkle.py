"""A Merkle manifest of a dataset, and proofs of its rows, by cogrouped exchange of subtrees.

A leaf is the SHA-256 of a row's fields, each as byte count, colon and value (`-` if null). The leaves of a source ascend
by id; every 16 nodes that follow each other become the hash of their digests, until one remains, the source's subroot;
subroots, by source, are reduced the same way to the root. A proof is the list of siblings from the leaf up to the root.

Leaves are hashed in expressions and ranked over range partitions, so one source may hold any share of the rows. 256
neighbours make a superblock, reduced by one call; its top goes on to the upper tree, which has one row per superblock and
is built and walked down again level by level with joins on (source, run), at most 16 rows to a key. Then the leaves and
the outer nodes that their proofs need meet by superblock in one cogrouped call, which ends the local reduction, joins the
proofs and folds each claimed leaf up to a root. No call sees more than 256 leaves and one path.

Null fields are `-`, null is a source (the first one), null ids come last in their source, rows that share an id are
ordered by leaf; fully equal rows have equal leaves, so their order doesn't matter to any node, and each has its own proof.
A source of one row has its leaf as subroot. No rows give no rows. Only the five columns are read.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.ranks import rank_in_groups
from tillhouse.operators.ranking import global_row_number

FAN = 16
LOCAL_LEVELS = 2
SUPERBLOCK = FAN**LOCAL_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<place:int,run:array<string>>>"


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row of documents; fields given here stand in for the row's own."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, FIELDS)).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _reduced(leaves: list[str], n: int) -> list[list[str]]:
    """The levels of a superblock, leaves first. In a larger source each goes up LOCAL_LEVELS, else to one node."""
    levels = [leaves]
    while len(levels) <= LOCAL_LEVELS if n > SUPERBLOCK else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def _top(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rank")
    top = _reduced(rows["leaf"].tolist(), int(rows["n"].iloc[0]))[-1][0]
    return pd.DataFrame({"tree": [rows["first"].iloc[0]], "idx": [rows["block"].iloc[0]], "leaves": [rows["n"].iloc[0]], "digest": [top]})


def _finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Local reduction, proofs and folding of one superblock, given its path to the root."""
    rows = rows.sort_values("rank")
    levels = _reduced(rows["leaf"].tolist(), int(rows["n"].iloc[0]))
    path = [(step["place"], list(step["run"])) for step in outer["path"].iloc[0]]
    folded: dict[tuple[int, int, str], str] = {}

    def run_of(level: int, i: int) -> tuple[int, list[str]]:
        start = i // FAN * FAN
        return i - start, levels[level][start : start + FAN]

    def up(level: int, i: int, digest: str) -> str:
        """The root that a node's digest leads to. Equal digests at one place are folded once."""
        if level - len(levels) + 1 == len(path):
            return digest
        if (level, i, digest) not in folded:
            place, run = run_of(level, i) if level < len(levels) - 1 else path[level - len(levels) + 1]
            folded[level, i, digest] = up(level + 1, i // FAN, _hash("".join([*run[:place], digest, *run[place + 1 :]])))
        return folded[level, i, digest]

    above = "".join(d for place, run in path for k, d in enumerate(run) if k != place)
    rest: dict[int, str] = {}
    proofs, roots = [], []
    for i, (leaf, claimed) in enumerate(zip(rows["leaf"], rows["claimed"])):
        siblings = ""
        if len(levels) > 1:
            place, run = run_of(0, i)
            siblings = "".join([*run[:place], *run[place + 1 :]])
        if i // FAN not in rest:
            higher = []
            for level in range(1, len(levels) - 1):
                place, run = run_of(level, i // FAN**level)
                higher += [*run[:place], *run[place + 1 :]]
            rest[i // FAN] = "".join(higher) + above
        proofs.append(_hash(siblings + rest[i // FAN]))
        roots.append(up(0, i, claimed))
    root = outer["root"].iloc[0]
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"],
            "leaf": rows["leaf"],
            "subroot": outer["subroot"].iloc[0],
            "root": root,
            "proof_sha256": proofs,
            "folded_root": roots,
            "verified": [r == root for r in roots],
        }
    )


def _raise(nodes: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """From nodes (tree, idx, n, digest) to the runs of each level and the trees' roots, by the level they end at."""
    runs, roots = [], []
    while most > 1:
        roots.append(nodes.filter("n = 1"))
        together = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda node: node["digest"])
        run = (F.floor(F.col("idx") / FAN)).cast("long").alias("run")
        runs.append(nodes.filter("n > 1").groupBy("tree", run, "n").agg(together.alias("nodes")).checkpoint())
        nodes = runs[-1].select(
            "tree", F.col("run").alias("idx"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), F.sha2(F.array_join("nodes", "").cast("binary"), 256).alias("digest")
        )
        most = math.ceil(most / FAN)
    return runs, [*roots, nodes]


def _lower(runs: list[DataFrame], roots: list[DataFrame], outer: DataFrame) -> DataFrame:
    """(tree, idx, path) of the nodes at the bottom. `outer` has each tree's (tree, path) from its root on."""
    at_roots = [r.select("tree", "idx").join(outer, "tree") for r in roots]
    paths = at_roots[-1]
    for run, ended in zip(reversed(runs), reversed(at_roots[:-1])):
        children = run.join(paths.withColumnRenamed("idx", "run"), ["tree", "run"]).select("tree", "run", "nodes", "path", F.posexplode("nodes").alias("place", "digest"))
        step = F.struct(F.col("place").cast("int").alias("place"), F.col("nodes").alias("run"))
        paths = children.select("tree", (F.col("run") * FAN + F.col("place")).alias("idx"), F.concat(F.array(step), F.col("path")).alias("path")).unionByName(ended)
    return paths


def prove(leaves: DataFrame) -> DataFrame:
    """From rows (doc_id, source, leaf, claimed) to their place in the manifest and what `claimed` folds to.

    doc_id, leaf, subroot, root and proof_sha256 are those of the leaves; folded_root starts from `claimed`, the hash
    that a holder of the row presents, and is verified if it is the root.
    """
    rows = leaves.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "leaf", "claimed")
    ranked = rank_in_groups(rows, "source", [F.col("doc_id").asc_nulls_last(), "leaf", "claimed"])
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / SUPERBLOCK).cast("long")).drop("source")
    tops = ranked.select("first", "block", "rank", "n", "leaf").groupBy("first", "block").applyInPandas(_top, "tree long, idx long, leaves long, digest string").checkpoint()
    blocks = F.ceil(F.col("leaves") / SUPERBLOCK).cast("long")
    most, sources = tops.agg(F.max(blocks), F.count_distinct("tree")).first()
    runs, roots = _raise(tops.select("tree", "idx", blocks.alias("n"), "digest"), most or 0)
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = subroots.select("tree", "digest").checkpoint()
    # Sources in order: a source's key is its first row's number.
    upper = global_row_number(subroots, ["tree"], "_row").select(
        F.lit(0).cast("long").alias("tree"),
        (F.col("_row") - 1).alias("idx"),
        F.lit(sources).cast("long").alias("n"),
        "digest",
        F.col("tree").alias("source_tree"),
    )
    upper = upper.checkpoint()
    upper_runs, upper_roots = _raise(upper.drop("source_tree"), sources)
    root = upper_roots[-1].select("digest").first()
    start = upper.sparkSession.range(1).select(F.col("id").alias("tree"), F.expr(f"cast(array() as {_PATH})").alias("path"))
    of_sources = _lower(upper_runs, upper_roots, start)
    outer = upper.join(of_sources, ["tree", "idx"]).select(F.col("source_tree").alias("tree"), "path")
    paths = _lower(runs, roots, outer).join(subroots.withColumnRenamed("digest", "subroot"), "tree").withColumn("root", F.lit(root and root[0]))
    return (
        ranked.groupBy("first", "block")
        .cogroup(paths.select(F.col("tree").alias("first"), F.col("idx").alias("block"), "path", "subroot", "root").groupBy("first", "block"))
        .applyInPandas(_finish, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    )


def tampered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def manifest(docs: DataFrame, altered: Column) -> DataFrame:
    """The manifest of documents. Where `altered` holds, the claimed leaf is that of the tampered text."""
    leaf = leaf_hash()
    claimed = F.when(altered, leaf_hash(text=tampered(F.col("text"))))
    return prove(docs.select("doc_id", "source", leaf.alias("leaf"), F.coalesce(claimed, leaf).alias("claimed")))
