"""Near-equal lines by a segment-partition edit join.

Two lines are linked if at most `TAU` edits (insert, delete or replace a code point) turn one into the other. A line cut
into TAU + 1 segments keeps one of them unchanged under TAU edits, so the longer line holds that segment as a substring,
at a place the lengths limit. Every line is indexed under its segments and probes with its substrings for each length
from its own down to TAU less; only places that a match of the remaining segments allows are probed. Candidates are
verified by a bit-parallel edit distance, banded to 2 TAU + 1 diagonals. Links make classes; of a class the first line
stays, by smallest doc_id, then line number.

Equal lines are one line here, known by 64-bit hashes; links are between different lines, and no link is lost, whatever
the length. Lines of at most `TAU` code points have an empty segment, which every line that is long enough holds: there
all distinct lines of like length are compared, and they do link, two edits making any of them of any other.
Two sketches, of single characters and of neighbouring pairs, drop candidates before they leave their bucket: an edit
changes at most two bits of the first and four of the second, so nothing within TAU edits is dropped.

Keys travel packed, a row for each part of the key range and chunk of documents; pairs are made and sketched in blocks
inside a part. Lines without a word are never linked nor removed. A null text has no lines; rows with a null id take no
part, and are returned with nothing removed. Rows sharing an id share its lines: the first of equal (id, line number)
counts. Columns other than doc_id and text are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.components import components
from tillhouse.llm.words import SpanHashes, chunks, mix, space_table
from tillhouse.session import shared_folder

TAU = 2
#: Lines with fewer code points take part by equality only. No line with a word has fewer than one.
MIN_CHARS = 1
#: Pairs sketched at once, and characters of pairs verified at once.
PAIRS = 1_000_000
VERIFY_CHARS = 1_000_000


class Lines:
    """The lines with a word of a chunk of documents, as code points."""

    def __init__(self, batch: pa.RecordBatch):
        texts = [t or "" for t in batch["text"].to_pylist()]
        joined = "\n".join(texts)
        self.points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        breaks = np.flatnonzero(self.points == 10)
        start = np.concatenate([[0], breaks + 1])
        end = np.append(breaks, len(self.points))
        row = np.searchsorted(begins, start, side="right") - 1
        solid = np.zeros(len(self.points) + 1, np.int64)
        np.cumsum(~space_table()[np.minimum(self.points, 255)], out=solid[1:])
        told = (solid[end] > solid[start]) & batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)[row]
        first_line = np.searchsorted(start, begins)
        number = np.arange(len(start)) - first_line[row]
        self.start, self.end, self.number = start[told], end[told], number[told]
        self.doc = pc.fill_null(batch["doc_id"], 0).to_numpy(zero_copy_only=False)[row[told]]
        self.span = SpanHashes(self.points)
        self.size = self.end - self.start
        self.id = mix(self.span(self.start, self.end) + self.size.astype(np.uint64))

    def sketches(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parities of hashed characters and of hashed neighbouring pairs, 32 bits each."""
        point = self.points.astype(np.uint64)
        single = mix(point)
        pair = mix(point[:-1] * np.uint64(0x9E3779B97F4A7C15) + point[1:])
        out = []
        for hashed, shorter in ((single, 0), (pair, 1)):
            flip = np.uint32(1) << (hashed >> np.uint64(59)).astype(np.uint32)
            parity = np.concatenate([[np.uint32(0)], np.bitwise_xor.accumulate(flip)])
            out.append(parity[self.end[which] - shorter] ^ parity[self.start[which]])
        return out[0], out[1]


def probes(tau: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of every substring a line probes with."""
    out = []
    for d in range(tau + 1):
        for i in range(1, tau + 2):
            low, high = max(-(i - 1), d - (tau + 1 - i)), min(i - 1, d + (tau + 1 - i))
            out += [(d, i - 1, shift) for shift in range(low, high + 1)]
    return out


def _segment(size: np.ndarray, i: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and length of segment i of lines of that size; the last segments take what is left over."""
    base, longer = size // (tau + 1), size % (tau + 1)
    short = tau + 1 - longer
    return i * base + np.maximum(0, i - short), base + (i >= short)


def _keys(lines: Lines, which: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, place in `which` and role (0 index, 1 probe) of all segments and substrings."""
    start, size = lines.start[which], lines.size[which]
    keys, owners, roles = [], [], []

    def add(place, length, of_size, i, role, fits):
        hashed = lines.span((start + place)[fits], (start + place + length)[fits])
        keys.append(mix(hashed + of_size[fits].astype(np.uint64) * np.uint64(64) + np.uint64(i)))
        owners.append(np.flatnonzero(fits))
        roles.append(np.full(int(fits.sum()), role, np.uint8))

    for i in range(tau + 1):
        place, length = _segment(size, i, tau)
        add(place, length, size, i, 0, np.ones(len(which), bool))
    for d, i, shift in probes(tau):
        place, length = _segment(size - d, i, tau)
        add(place + shift, length, size - d, i, 1, (size - d >= 1) & (place + shift >= 0) & (place + shift + length <= size))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(roles)


def _file(parts: int, tau: int, min_chars: int):
    schema = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()), ("roles", pa.binary()), ("one", pa.binary()), ("two", pa.binary())])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                lines = Lines(chunk)
                long = np.flatnonzero(lines.size >= min_chars)
                _, first = np.unique(lines.id[long], return_index=True)
                which = long[first]
                if not len(which):
                    continue
                one, two = lines.sketches(which)
                keys, owner, roles = _keys(lines, which, tau)
                order = np.argsort(keys)
                keys, owner, roles = keys[order], owner[order], roles[order]
                cuts = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
                spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
                columns = [keys, lines.id[which][owner], roles, one[owner], two[owner]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(parts), pa.int32()), *(pa.array([c[s].tobytes() for s in spans], pa.binary()) for c in columns)], schema=schema
                )

    return file


def _expanded(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of groups whose sizes add up to about the limit."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield a, b
        a = b


def _meet(tau: int):
    def meet(table: pa.Table) -> pa.Table:
        keys, ids, roles, one, two = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[name]])
            for name, kind in (("keys", np.uint64), ("ids", np.uint64), ("roles", np.uint8), ("one", np.uint32), ("two", np.uint32))
        )
        # A line that several chunks hold counts once.
        order = np.lexsort((ids, roles, keys))
        keys, ids, roles, one, two = (x[order] for x in (keys, ids, roles, one, two))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (roles[1:] != roles[:-1]) | (ids[1:] != ids[:-1])
        keys, ids, roles, one, two = (x[new] for x in (keys, ids, roles, one, two))
        bucket = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        ends = np.append(bucket[1:], len(keys))
        probing = np.concatenate([[0], np.cumsum(roles, dtype=np.int64)])
        n_probes = probing[ends] - probing[bucket]
        n_index = ends - bucket - n_probes
        use = (n_index > 0) & (n_probes > 0) & ((n_index > 1) | (n_probes > 1))
        # Each probe of a bucket meets each index entry of it: index entries come first.
        probe = _runs(ends[use] - n_probes[use], n_probes[use])
        lead, width = np.repeat(bucket[use], n_probes[use]), np.repeat(n_index[use], n_probes[use])
        found = []
        for a, b in _expanded(width, PAIRS):
            left = np.repeat(probe[a:b], width[a:b])
            right = _runs(lead[a:b], width[a:b])
            near = (np.bitwise_count(one[left] ^ one[right]) <= 2 * tau) & (np.bitwise_count(two[left] ^ two[right]) <= 4 * tau) & (ids[left] != ids[right])
            pair = np.stack([ids[left[near]], ids[right[near]]], axis=1)
            found.append(np.unique(np.sort(pair, axis=1), axis=0))
        pairs = np.unique(np.concatenate([np.zeros((0, 2), np.uint64), *found]), axis=0).view(np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return meet


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def within(left: list[str], right: list[str], tau: int) -> np.ndarray:
    """Whether each pair is at most tau edits apart.

    Myers' bit vectors hold the differences down a column of the edit matrix; here only those of the 2 tau + 1 diagonals
    around the main one, sliding down with the columns (Hyyro's banded form), for all pairs at once.
    """
    n = len(left)
    m = np.array([len(x) for x in left], np.int64)
    k = np.array([len(x) for x in right], np.int64)
    width, bits = int(max(m.max(initial=0), k.max(initial=0))), 2 * tau + 1
    # Row i of `a` has the code points of left[i] behind tau blanks, so that the band never leaves the array.
    a = np.full((n, width + 2 * bits), 0xFFFFFFFF, np.uint32)
    b = np.full((n, width + 1), 0xFFFFFFFE, np.uint32)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, tau : tau + len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        b[i, : len(y)] = np.frombuffer(y.encode("utf-32-le"), np.uint32)
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    full = np.uint32((1 << bits) - 1)
    top = np.uint32(1 << (bits - 1))
    # Above the first row the matrix goes on with falling values, below the diagonal with rising ones.
    up, down = np.full(n, full & ~np.uint32((1 << tau) - 1), np.uint32), np.full(n, (1 << tau) - 1, np.uint32)
    score = np.full(n, tau, np.int64)
    out = np.abs(m - k) <= tau
    result = np.where(k == 0, m, 0)
    for j in range(int(k.max(initial=0))):
        # The band of column j covers rows j - tau .. j + tau; bit 0 is the topmost.
        same = np.zeros(n, np.uint32)
        for t in range(bits):
            same |= (a[j + t] == b[j]).astype(np.uint32) << np.uint32(t)
        d0 = ((((same & up) + up) ^ up) | same | down) & full
        rise = down | (full & ~(d0 | up))
        fall = d0 & up
        # Down the lowest diagonal the value grows unless the diagonal step is free.
        inside = j < k
        score = np.where(inside, score + ((d0 & top) == 0), score)
        slid = d0 >> np.uint32(1)
        up = (fall | (full & ~(slid | rise))) & full
        down = slid & rise
        last = (k - 1 == j) & out
        if last.any():
            # The band's lowest cell is row j + 1 + tau; walk up to row m. The vectors have slid on by a row.
            value = score.copy()
            for t in range(bits - 1):
                step = last & (j + 1 + tau - t > m)
                bit = np.uint32(1 << (bits - 2 - t))
                value = np.where(step, value - ((up & bit) > 0) + ((down & bit) > 0), value)
            result = np.where(last, value, result)
    return out & (result <= tau)


def _verify(tau: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Pairs of like length together, so that padding and the arrays' size stay small.
            size = pc.utf8_length(batch["one"]).to_numpy()
            order = np.argsort(size, kind="stable")
            at = 0
            while at < len(order):
                # The longest of the first n is the last.
                n = max(1, int(np.searchsorted(size[order[at:]] * np.arange(1, len(order) - at + 1), VERIFY_CHARS)))
                part = batch.take(pa.array(order[at : at + n]))
                at += n
                near = within(part["one"].to_pylist(), part["two"].to_pylist(), tau)
                yield part.select(["a", "b"]).filter(pa.array(near))

    return verify


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch, "text"):
            lines = Lines(chunk)
            columns = [lines.id.view(np.int64), lines.doc, lines.number.astype(np.int32), lines.size.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "doc_id", "line_no", "chars"])


def _texts(min_chars: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                lines = Lines(chunk)
                _, first = np.unique(lines.id, return_index=True)
                first = first[lines.size[first] >= min_chars]
                found = [lines.points[s:e].tobytes().decode("utf-32-le") for s, e in zip(lines.start[first].tolist(), lines.end[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(lines.id[first].view(np.int64)), pa.array(found, pa.string())], ["id", "line"])

    return texts


def links(docs: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b): ids of different lines at most tau edits apart, a < b."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filed = docs.mapInArrow(_file(parts, tau, min_chars), "part int, keys binary, ids binary, roles binary, one binary, two binary")
    pairs = filed.groupBy("part").applyInArrow(_meet(tau), "a long, b long").distinct().checkpoint()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    lines = docs.mapInArrow(_texts(min_chars), "id long, line string").join(wanted, "id", "left_semi").groupBy("id").agg(F.first("line").alias("line")).checkpoint()
    one, two = lines.toDF("a", "one"), lines.toDF("b", "two")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(_verify(tau), "a long, b long").checkpoint()


def dedup_lines(docs: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines (with a word), n_links, n_removed, and `lines`.

    `lines` has line_no (from 0, all lines counted), class_doc, class_line (the first line of its class), class_id, links
    (different lines linked to it) and kept.
    """
    shared_folder(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = links(rows, tau, min_chars)
    degree = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    linked = components(found).withColumnRenamed("node", "id").join(degree, "id").toDF("id", "label", "links")
    seen = rows.mapInArrow(_occurrences, "id long, doc_id long, line_no int, chars int").dropDuplicates(["doc_id", "line_no"])
    placed = seen.join(linked, "id", "left").select(
        "doc_id", "line_no", F.coalesce("label", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")
    )
    first = placed.groupBy("class_id").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    line = F.struct(
        "line_no",
        F.col("first.doc_id").alias("class_doc"),
        F.col("first.line_no").alias("class_line"),
        "class_id",
        "links",
        ((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.line_no") == F.col("line_no"))).alias("kept"),
    )
    per_doc = (
        placed.join(first, "class_id")
        .select("doc_id", line.alias("line"))
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("line.links").alias("n_links"),
            F.count(F.when(~F.col("line.kept"), 1)).alias("n_removed"),
            F.sort_array(F.collect_list("line")).alias("lines"),
        )
    )
    zero = F.lit(0).cast("long")
    return rows.select("doc_id").join(per_doc, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_lines", zero).alias("n_lines"),
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("lines", F.array()).alias("lines"),
    )
