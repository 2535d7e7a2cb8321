"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (a shorter text is one shingle). A shingle weighs its count in the text
times ln(1 + N / df), df being the number of documents that hold it, over all documents, in steps of a quarter octave,
but at least ln(1 + N) / `IDF_RATIO`: however many copies a text has, what a copy changed outweighs what it kept by that
factor at most. With a factor of 2, texts of unweighted Jaccard similarity 8/9 or more, repeats
counted, are always similar enough.
Consistent weighted sampling draws one (shingle, level) per hash function, equal for two texts with the probability of
their weighted Jaccard similarity; `BANDS` bands of `ROWS` draws make the buckets in which candidates meet. A pair at the
threshold 0.8 shares no band with a probability of 0.2 %. Candidates are verified by their exact weighted Jaccard
similarity, and links of at least `SIMILARITY` make classes.

Texts with the same words in the same order are one text here, represented by the smallest id: copies never meet. A text
of which less than the threshold's share, by weight, lies in shingles that other documents hold too is similar to none
and is not sampled. In a bucket every text is compared with one pivot, not with every other; texts that the pivot does not link and that are in
another class so far are compared with a second pivot, and what is then still apart, pair by pair across classes, but for
pairs that bounds rule out. Two texts share at most the lighter one's weight and, group by group, the lesser weight that each
has in shingles of other documents: `SKETCH` such sums a text bound a pair's similarity from above. Pairs meet within bins of
the lighter text's weight. So no candidate pair that could join two classes is left out, a bucket of n alike texts costs n
comparisons, and of texts that are each changed in places of their own few pairs are left.

A null text has no words. Texts without words are alike only to themselves and link to nothing: each row without words
is a class of its own. Rows that share an id share a class, and so do all texts that they are near copies of. Rows with a
null id get a null class and are kept. Columns
other than doc_id and text are not read. No rows give no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import key_counts
from tillhouse.llm.components import components
from tillhouse.llm.words import Words, constants, mix, windows
from tillhouse.session import shared_folder

WIDTH = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 4
POOL_BITS = 16
#: The rarest shingle weighs at most so many times as much as the most common one.
IDF_RATIO = 2.0
#: Members of a pivot that are verified together.
GROUP = 256
#: Groups of shingles whose weights bound what two texts can share.
SKETCH = 64
#: Bins of weight within the ratio that two alike texts can have.
BINS = 4
#: Shingles sampled at once.
SPAN = 200_000


def shingles(words: Words, hashes: np.ndarray, i: int, runs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text i's distinct shingle hashes, ascending, and their counts."""
    a, b = words.of[i], words.of[i + 1]
    if b - a >= width:
        return np.unique(runs[a : b - width + 1], return_counts=True)
    own = windows(hashes[a:b], b - a, seed=width + b - a) if b > a else np.zeros(0, np.uint64)
    return own, np.ones(len(own), np.int64)


def all_shingles(column: pa.Array, width: int) -> tuple[Words, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    words = Words(column)
    hashes = words.hashes()
    runs = windows(hashes, width)
    found = [shingles(words, hashes, i, runs, width) for i in range(len(column))]
    return words, hashes, [x[0] for x in found], [x[1] for x in found]


def df_code(df: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(4 * np.log2(df)))


def idf(codes: np.ndarray, n_docs: int) -> np.ndarray:
    return np.maximum(np.log1p(n_docs / 2.0 ** (codes / 4)), np.log1p(n_docs) / IDF_RATIO)


class Sampler:
    """Improved consistent weighted sampling. The draws of a shingle come from a pool of 65,536 triples (r, c, beta),
    picked by a hash of shingle and function, so that no logarithm is taken per shingle; draws that tie by sharing a
    triple are told apart by the shingle."""

    def __init__(self, n: int):
        random = np.random.Generator(np.random.PCG64(20240229))
        size = 1 << POOL_BITS
        r = random.gamma(2.0, 1.0, size)
        ln_c = np.log(random.gamma(2.0, 1.0, size))
        beta = random.random(size)
        self.beta, self.r, self.inverse = (x.astype(np.float32) for x in (beta, r, 1 / r))
        self.lead = (ln_c + r * beta - r).astype(np.float32)
        self.pick = constants(n, 77)
        self.shift = np.uint64(64 - POOL_BITS)

    def sample(self, keys: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of draws for each text; text i has the keys from starts[i] on, and at least one."""
        ln_weight = np.log(weights).astype(np.float32)
        sizes = np.diff(np.append(starts, len(keys)))
        out = np.empty((len(starts), len(self.pick)), np.uint64)
        for k, factor in enumerate(self.pick):
            at = ((keys * factor) >> self.shift).astype(np.intp)
            r = self.r[at]
            level = np.floor(ln_weight * self.inverse[at] + self.beta[at])
            ln_a = self.lead[at] - r * level
            least = np.minimum.reduceat(ln_a, starts)
            hits = np.flatnonzero(ln_a == np.repeat(least, sizes))
            first = hits[np.searchsorted(hits, starts)]
            out[:, k] = mix(keys[first] + level[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + factor)
        return out


def _counted_keys(keys: np.ndarray) -> np.ndarray:
    """Document frequencies are those of 56-bit hashes, which pack a byte shorter."""
    return keys & ~np.uint64(0xFF)


_SIGNED = "doc_id long, s1 long, s2 long, bands array<long>, codes binary, words binary, total double, common array<double>"


def _sign(n_docs: int, width: int, similarity: float, bands: int, rows: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("s1", pa.int64()),
            ("s2", pa.int64()),
            ("bands", pa.list_(pa.int64())),
            ("codes", pa.binary()),
            ("words", pa.binary()),
            ("total", pa.float64()),
            ("common", pa.list_(pa.float64())),
        ]
    )

    def sign(block: pa.Table, told: pa.Table) -> pa.Table:
        if not block.num_rows:
            return schema.empty_table()
        # The smallest id of equal texts comes first and signs for them.
        block = block.sort_by("doc_id")
        words, hashes, keys, counts = all_shingles(block["text"], width)
        # Two hashes of the whole word sequence tell texts apart.
        of = list(zip(words.of[:-1].tolist(), words.of[1:].tolist()))
        names = np.array([[_sequence(hashes[a:b], seed) for a, b in of] for seed in (11, 13)], np.uint64).view(np.int64)
        _, first = np.unique(names, axis=1, return_index=True)
        block_keys = np.unique(_counted_keys(np.concatenate(keys)))
        told_codes = key_counts.codes_in_order(told)
        sampler, combine = Sampler(bands * rows), constants(rows, 5)
        n = len(keys)
        signed, codes, spelled, totals, common = ([None] * n for _ in range(5))
        now, weighed, held = [], [], 0

        def flush() -> None:
            if not now:
                return
            starts = np.cumsum([0, *(len(w) for w in weighed[:-1])])
            draws = sampler.sample(np.concatenate([keys[i] for i in now]), np.concatenate(weighed), starts)
            for i, row in zip(now, mix((draws.reshape(len(now), bands, rows) * combine).sum(axis=2, dtype=np.uint64)).view(np.int64)):
                signed[i] = row

        for i in np.sort(first).tolist():
            if not len(keys[i]):
                continue
            own = told_codes[np.searchsorted(block_keys, _counted_keys(keys[i]))]
            weights = counts[i] * idf(own, n_docs)
            # Two texts share only what two documents hold: with less than that share of its weight in such shingles, a
            # text is similar to no other.
            held_by_others = np.where(own > 0, weights, 0.0)
            if held_by_others.sum() < similarity * weights.sum() - 1e-9:
                continue
            totals[i] = float(weights.sum())
            common[i] = np.bincount((keys[i] % np.uint64(SKETCH)).astype(np.intp), weights=held_by_others, minlength=SKETCH)
            codes[i] = zlib.compress(own.tobytes(), 1)
            a, b = words.offsets[i], words.offsets[i + 1]
            spelled[i] = zlib.compress(words.data[a:b].tobytes(), 1)
            now.append(i)
            weighed.append(weights)
            held += len(weights)
            if held >= SPAN:
                flush()
                now, weighed, held = [], [], 0
        flush()
        columns = [
            block["doc_id"].combine_chunks(),
            pa.array(names[0]),
            pa.array(names[1]),
            pa.array(signed, pa.list_(pa.int64())),
            pa.array(codes, pa.binary()),
            pa.array(spelled, pa.binary()),
            pa.array(totals, pa.float64()),
            pa.array(common, pa.list_(pa.float64())),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    return sign


def _sequence(hashes: np.ndarray, seed: int) -> np.uint64:
    places = np.arange(1, len(hashes) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(np.array([mix(hashes + mix(places + np.uint64(seed))).sum(dtype=np.uint64) + np.uint64(len(hashes))]))[0]


def _compare(n_docs: int, width: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def compare(members: pa.Table, pivot: pa.Table) -> pa.Table:
        if not members.num_rows or not pivot.num_rows:
            return schema.empty_table()

        def vectors(table: pa.Table):
            texts = pa.array([zlib.decompress(x.as_buffer()) for x in table["words"]], pa.large_binary())
            _, _, keys, counts = all_shingles(texts, width)
            codes = (np.frombuffer(zlib.decompress(x.as_buffer()), np.uint8) for x in table["codes"])
            return [(k, c * idf(code, n_docs)) for k, c, code in zip(keys, counts, codes)]

        (keys, weights), found = vectors(pivot.slice(0, 1))[0], []
        for other, other_weights in vectors(members):
            at = np.minimum(np.searchsorted(keys, other), len(keys) - 1)
            shared = np.minimum(weights[at], other_weights)[keys[at] == other].sum()
            found.append(float(shared / (weights.sum() + other_weights.sum() - shared)))
        columns = [members["a"].combine_chunks(), members["b"].combine_chunks(), pa.array(found)]
        return pa.Table.from_arrays(columns, schema=schema)

    return compare


def classes(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class), class_size, kept."""
    shared_folder(docs.sparkSession)
    identified = docs.filter("doc_id IS NOT NULL")
    n_docs = max(1, identified.count())
    blocks = key_counts.in_blocks(identified)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, _, keys, _ = all_shingles(table["text"], width)
        per_text = [np.unique(_counted_keys(k)) for k in keys]
        return np.unique(np.concatenate(per_text), return_counts=True)

    told = key_counts.counted(blocks, keys_of, df_code)
    signed = (
        blocks.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(_sign(n_docs, width, similarity, bands, rows), _SIGNED)
        .checkpoint()
    )
    # A text's node is its smallest id; of texts that have the same one, all but one take a hash of theirs.
    first = signed.groupBy("s1", "s2").agg(F.min("doc_id").alias("least"))
    owners = first.groupBy("least").agg(F.min(F.struct("s1", "s2")).alias("owner"))
    owns = (F.col("owner.s1") == F.col("s1")) & (F.col("owner.s2") == F.col("s2"))
    first = first.join(owners, "least").select("s1", "s2", "least", F.when(owns, F.col("least")).otherwise(F.xxhash64("s1", "s2")).alias("rep"))
    first = first.checkpoint()
    # The empty text is like no other, itself included.
    empty = _sequence(np.zeros(0, np.uint64), 11)
    member_of = signed.select("doc_id", "s1", "s2").join(first, ["s1", "s2"])
    member_of = member_of.withColumn("rep", F.when(F.col("s1") == int(empty.view(np.int64)), F.col("doc_id")).otherwise(F.col("rep")))
    member_of = member_of.select("doc_id", "rep").distinct().checkpoint()
    # Rows that share an id link the texts they have.
    several = member_of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).filter("a != most")
    same_id = member_of.join(several, "doc_id").filter("rep != a").select("a", F.col("rep").alias("b"))
    reps = signed.filter("bands IS NOT NULL").join(first.withColumnRenamed("least", "doc_id"), ["s1", "s2", "doc_id"]).drop("doc_id")
    entries = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = entries.groupBy("band", "key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Texts that meet nobody are done; what follows is about the others.
    met = entries.join(shared, ["band", "key"]).checkpoint()
    vectors = reps.select("rep", "words", "codes")
    bounds = reps.select("rep", "total", "common")
    compare, slack = _compare(n_docs, width), 1 - similarity + 1e-9
    pairs = met.filter("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    measured = _measured(pairs.checkpoint(), vectors, compare).checkpoint()
    # Every text's distance to the pivots of its buckets.
    far = measured.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), (1 - F.col("similarity")).alias("far"))
    met = met.join(far, ["pivot", "rep"], "left").withColumn("far", F.coalesce("far", F.lit(0.0))).checkpoint()
    links = measured.filter(1 - F.col("similarity") <= slack).select("a", "b").union(same_id).checkpoint()
    for last in (False, True):
        # Lists of ids are written before they are used several times, which keeps the plans small.
        known = _contested(met, components(links)).checkpoint()
        pairs = (_in_pairs(known, bounds, similarity) if last else _second(known, slack)).join(measured.select("a", "b"), ["a", "b"], "left_anti")
        more = _measured(pairs.checkpoint(), vectors, compare).checkpoint()
        measured = measured.union(more)
        links = links.union(more.filter(1 - F.col("similarity") <= slack).select("a", "b"))
    labels = components(links)
    # A row's text stands for itself; all texts of an id have one label.
    by_doc = member_of.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("label"))
    one = by_doc.groupBy("doc_id").agg(F.min("label").alias("label"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    found = ids.join(one, "doc_id", "left")
    sizes = found.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(sizes, "label", "left").select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


def _contested(met: DataFrame, labels: DataFrame) -> DataFrame:
    """What lies in buckets that hold several classes so far, with its class and its pivot's."""
    known = met.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    spread = known.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    pivots = labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    mixed = known.join(spread, ["band", "key"]).join(pivots, "pivot", "left")
    return mixed.withColumn("pivot_label", F.coalesce("pivot_label", "pivot"))


def _second(known: DataFrame, slack: float) -> DataFrame:
    """Pairs (a < b) of a second pivot, one that the first does not reach, with the texts of other classes.

    1 - weighted Jaccard similarity is a metric: texts whose distances to their pivot differ by more than the greatest
    distance of a link are not similar, and need no comparison.
    """
    lead = known.filter("label != pivot_label").groupBy("band", "key").agg(F.min(F.struct("rep", "label", "far")).alias("lead"))
    pairs = known.join(lead, ["band", "key"]).filter((F.col("label") != F.col("lead.label")) & (F.abs(F.col("far") - F.col("lead.far")) <= slack))
    return pairs.select(F.least("rep", "lead.rep").alias("a"), F.greatest("rep", "lead.rep").alias("b")).distinct()


def _in_pairs(known: DataFrame, bounds: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a < b) that share a bucket but no class, and that no bound rules out.

    Texts of weights v <= w are similar if they share `share` * (v + w) or more. They share at most what each holds in
    shingles of other documents, so a text that can be the lighter one has 2 * share of its weight there, and a heavier
    one meets it in the bins of weights that are left to it.
    """
    share, eps = similarity / (1 + similarity), 1e-6
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda held, y: held + y)
    texts = known.select("band", "key", "rep", "label", "far").join(bounds, "rep").withColumn("held", total(F.col("common")))
    bin_of = lambda weight: F.floor(F.log(weight) * (BINS / -math.log(similarity))).cast("int")
    lighter = texts.filter(F.col("held") >= 2 * share * F.col("total") * (1 - eps)).withColumn("bin", bin_of(F.col("total")))
    low, high = similarity * F.col("total") * (1 - eps), F.least(F.col("total"), F.col("held") / share - F.col("total")) * (1 + eps)
    heavier = texts.filter(low <= high).withColumn("bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    names = ["rep", "label", "far", "total", "held", "common"]
    left = lighter.select("band", "key", "bin", *(F.col(x).alias(f"{x}_a") for x in names))
    right = heavier.select("band", "key", "bin", *(F.col(x).alias(f"{x}_b") for x in names))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    same = (left["band"] == right["band"]) & (left["key"] == right["key"]) & (left["bin"] == right["bin"])
    needed = share * (F.col("total_a") + F.col("total_b")) * (1 - eps)
    by_weight = (F.col("total_a") < F.col("total_b")) | ((F.col("total_a") == F.col("total_b")) & (F.col("rep_a") < F.col("rep_b")))
    near = (F.abs(F.col("far_a") - F.col("far_b")) <= 1 - similarity + eps) & (F.least("held_a", "held_b") >= needed)
    shared = total(F.zip_with("common_a", "common_b", lambda x, y: F.least(x, y))) >= needed
    pairs = left.join(right, same & by_weight & (F.col("label_a") != F.col("label_b")) & near & shared)
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def _measured(pairs: DataFrame, vectors: DataFrame, compare) -> DataFrame:
    """The pairs (a, b) with their similarity. The members of a are compared in groups, each with a's vector."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("groups"))).select("a", "part", "b")
    members = dealt.join(vectors.withColumnRenamed("rep", "b"), "b")
    pivots = dealt.select("a", "part").distinct().join(vectors.withColumnRenamed("rep", "a"), "a").select("a", "part", "words", "codes")
    pivots = pivots.toDF("a", "part", "words", "codes")  # columns of its own, both sides being the same tables
    return members.groupBy("a", "part").cogroup(pivots.groupBy("a", "part")).applyInArrow(compare, "a long, b long, similarity double")
