"""Collocations by Toivonen's sampling method: exact phrase counts from few passes over the corpus.

A sample of the documents proposes phrases: those of up to three words that it holds twice or more. A full pass counts
every word and every phrase whose two parts that are one word shorter are proposed: the proposed phrases and the negative
border around them. Border failures, phrases that turn out frequent though they were not proposed, may have frequent
extensions that were not counted. So long as there are any, all phrases found frequent become the next proposal, and a
further pass counts what that admits and no pass before it did. Without failures the found set is closed: each frequent
phrase has frequent parts, so it was admitted. Phrases of four words end after three further passes at most.

These passes count 64-bit keys, since nearly all phrases of the border are rare and are not needed as text. Phrases that
share a key can only look more frequent than they are. So the closed set holds all frequent phrases, and one last pass
counts its phrases themselves, as text, which leaves the frequent ones with their exact counts.

Proposals are told to the tasks as a bitmap of fixed size (`FILTER_BITS`, 16 MiB), set from the keys. Where two phrases
share a bit, more is counted than needed and nothing is lost. In a task the words of a chunk are numbered and phrases are
counted as pairs of numbers, then sent with their count; Spark adds them up, within the task first, so a very frequent
phrase is a few rows. Scores are taken from the found set by joins.

Everything is per language; a null language is `und`. Null and empty texts have no words. Repeated rows count as often as
they occur, null ids too. Equal scores are ordered by count, then by the phrase's bytes, so results agree whatever the
input's order; the sample decides only how many passes are needed. A language without frequent phrases has no rows, and
no rows give no rows. Only doc_id, lang and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.words import SpanHashes, chunks, constants, mix, raw
from tillhouse.session import shared_folder

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
#: A phrase that another one holds in this share of its occurrences, in percent, is part of that one.
WITHIN = 80
SCALE = 2_000_000
#: One document in so many is sampled, and a phrase that occurs so often there is proposed.
SAMPLE_ONE_IN = 8
SAMPLE_COUNT = 2
FILTER_BITS = 27
CHUNK_BYTES = 1_000_000
_SENT_BYTES = 1_000_000
_STEP = 50_000
_BUCKET = 1 << 15

#: The characters between pieces and, besides these, between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ENDS_PIECE = np.isin(np.arange(256), np.frombuffer(PIECE_ENDS, np.uint8))
_IN_WORD = ~np.isin(np.arange(256), np.frombuffer(PIECE_ENDS + WORD_ENDS, np.uint8))
_KEYED = pa.schema([("key", pa.int64()), ("found", pa.int64())])
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("found", pa.int64())])
#: A key's lowest bits hold the number of words, its highest ones the bit of a filter.
_LENGTH_BITS = 3


def _text_hashes(texts: pa.Array) -> np.ndarray:
    data, offsets = raw(texts)
    return SpanHashes(data)(offsets[:-1], offsets[1:])


class Chunk:
    """The words of some texts of one language: numbers, pieces, and a text in which one space follows each word."""

    def __init__(self, texts: pa.Array, lang: str):
        data, offsets = raw(texts)
        data = _LOWER[data]
        solid = _IN_WORD[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        start = np.flatnonzero(solid & (~before | edge[:-1]))
        size = np.flatnonzero(solid & (~after | edge[1:])) + 1 - start
        self.n = len(start)
        ends = np.cumsum(_ENDS_PIECE[data], dtype=np.int32)
        self.piece = ends[start] + np.searchsorted(offsets, start, side="right")
        packed = data[solid]
        word_ends = np.cumsum(size)
        buffers = [None, pa.py_buffer(np.concatenate([[0], word_ends]).astype(np.int64)), pa.py_buffer(packed)]
        words = pa.Array.from_buffers(pa.large_binary(), self.n, buffers).dictionary_encode()
        self.word = words.indices.to_numpy().astype(np.int64)
        self.vocabulary = max(1, len(words.dictionary))
        self.end = word_ends + np.arange(self.n)
        self.start = self.end - size
        self.text = np.full(len(packed) + self.n, 0x20, np.uint8)
        for a in range(0, self.n, _STEP):
            b = min(a + _STEP, self.n)
            first, last = word_ends[a] - size[a], word_ends[b - 1]
            self.text[np.arange(first, last) + np.repeat(np.arange(a, b), size[a:b])] = packed[first:last]
        self._lang = _text_hashes(pa.array([lang.encode()], pa.large_binary()))[0]
        self._word_hash = _text_hashes(words.dictionary)

    def keys(self, at: np.ndarray, length: int) -> np.ndarray:
        """The keys of the phrases that begin at each word."""
        hashes = np.full(len(at), self._lang)
        for k, odd in enumerate(constants(length, 17)):
            hashes += self._word_hash[self.word[at + k]] * odd
        return ((mix(hashes) >> np.uint64(_LENGTH_BITS)) << np.uint64(_LENGTH_BITS)) | np.uint64(length)

    def portions(self, at: np.ndarray, length: int) -> Iterator[slice]:
        """Ranges of phrases that are sent together: a bounded number of bytes, or one phrase."""
        upto = np.cumsum(self.end[at + length - 1] - self.start[at])
        begin = 0
        while begin < len(at):
            done = upto[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, done + _SENT_BYTES, side="right")))
            yield slice(begin, stop)
            begin = stop

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        size = self.end[at + length - 1] - self.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        taken = self.text[np.arange(offsets[-1]) + np.repeat(self.start[at] - offsets[:-1], size)]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken)]
        return pa.Array.from_buffers(pa.large_string(), len(at), buffers).cast(pa.string())


def _holds(proposed: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if proposed is None:
        return np.ones(len(keys), bool)
    bit = (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (proposed[bit >> 3] >> (bit & 7)) & 1 == 1


def _grams(chunk: Chunk, proposals: list[np.ndarray | None], longest: int, held_only: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: where each phrase first occurs that the last proposal admits and no earlier one does, its count
    and its key. A proposal admits all words, and phrases of which it admits and holds both parts. With held_only, only
    phrases that it holds itself."""
    admitted = [np.ones(chunk.n, bool) for _ in proposals]
    number = np.zeros(chunk.n, np.int64)
    for length in range(1, longest + 1):
        at = np.flatnonzero(np.logical_or.reduce(admitted))
        if not len(at):
            return
        pair = number[at] * chunk.vocabulary + chunk.word[at + length - 1]
        _, first, same, counts = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        number[at] = same
        where = at[first]
        keys = chunk.keys(where, length)
        held = [_holds(p, keys) for p in proposals]
        new = admitted[-1][where]
        for earlier in admitted[:-1]:
            new &= ~earlier[where]
        if held_only:
            new &= held[-1]
        yield length, where[new], counts[new], keys[new]
        for i, is_held in enumerate(held):
            extends = np.zeros(chunk.n, bool)
            extends[at] = is_held[same] & admitted[i][at]
            admitted[i] = np.zeros(chunk.n, bool)
            admitted[i][:-1] = extends[:-1] & extends[1:] & (chunk.piece[:-1] == chunk.piece[1:])


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Chunk]]:
    for batch in batches:
        for lang in pc.unique(batch["lang"]).to_pylist():
            for part in chunks(batch.filter(pc.equal(batch["lang"], lang)), "text", CHUNK_BYTES):
                if (chunk := Chunk(part["text"], lang)).n:
                    yield lang, chunk


def _key_counter(proposals: list, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys and counts of what the last proposal admits and none before; without proposals, of all phrases."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [p.value for p in proposals] or [None]
        for _, chunk in _by_language(batches):
            for _, _, counts, keys in _grams(chunk, held, longest):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], schema=_KEYED)

    return count


def _phrase_counter(closed) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Phrases of the closed set and their counts. The empty phrase stands for the number of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = closed.value
        for lang, chunk in _by_language(batches):
            yield pa.RecordBatch.from_pydict({"lang": [lang], "phrase": [""], "found": [chunk.n]}, schema=_COUNTED)
            for length, where, counts, _ in _grams(chunk, [held], MAX_WORDS, held_only=True):
                for some in chunk.portions(where, length):
                    columns = [pa.repeat(pa.scalar(lang, pa.string()), some.stop - some.start), chunk.phrases(where[some], length), pa.array(counts[some], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema=_COUNTED)

    return count


def _unknown(proposal) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~_holds(proposal.value, batch["key"].to_numpy().view(np.uint64))))

    return keep


def _proposal(keys: DataFrame):
    """The bitmap of the given keys, broadcast: 2 ** FILTER_BITS bits, however many phrases there are."""
    spark = keys.sparkSession
    bits = keys.select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("bit"))
    place = F.col("bit").bitwiseAND(F.lit(_BUCKET - 1))
    buckets = bits.groupBy(F.shiftright("bit", 15).alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bitmap"))
    filled = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = _BUCKET // 8
    for row in buckets.toLocalIterator():
        filled[row.bucket * width : (row.bucket + 1) * width] = np.frombuffer(row.bitmap, np.uint8)
    return spark.sparkContext.broadcast(filled)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, one_in: int = SAMPLE_ONE_IN, sample_count: int = SAMPLE_COUNT) -> DataFrame:
    """(lang, phrase, n_words, found): every phrase of up to four words with its exact count, if that is min_count or
    more. The row of no words has the number of words of the language."""
    shared_folder(docs.sparkSession)
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce("text", F.lit(""))
    texts = docs.select(lang.alias("lang"), text.alias("text"))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0).select(lang.alias("lang"), text.alias("text"))

    def keys(rows: DataFrame, proposals: list, longest: int, at_least: int) -> DataFrame:
        counts = rows.mapInArrow(_key_counter(proposals, longest), "key long, found long")
        return counts.groupBy("key").agg(F.sum("found").alias("found")).filter(F.col("found") >= at_least).select("key")

    proposals = [_proposal(keys(sample, [], MAX_WORDS - 1, sample_count))]
    extensible = F.col("key").bitwiseAND(F.lit((1 << _LENGTH_BITS) - 1)) < MAX_WORDS
    found: DataFrame | None = None
    while True:
        new = keys(texts, proposals, MAX_WORDS, min_count).checkpoint()
        found = new if found is None else found.unionByName(new)
        failures = new.filter(extensible).mapInArrow(_unknown(proposals[-1]), "key long")
        if failures.isEmpty():
            break
        proposals.append(_proposal(found.filter(extensible)))
    counts = texts.mapInArrow(_phrase_counter(_proposal(found)), "lang string, phrase string, found long")
    summed = counts.groupBy("lang", "phrase").agg(F.sum("found").alias("found"))
    n_words = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1)
    frequent = summed.filter((F.col("found") >= min_count) | (F.col("phrase") == ""))
    return frequent.select("lang", "phrase", n_words.alias("n_words"), "found").checkpoint()


def _part(words: Column, start: int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(found: DataFrame, top: int = TOP, within: int = WITHIN) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score. `found` is what frequent_phrases gives.

    A phrase's cut is the lowest-scoring one, the first of equal ones. Phrases that lie in a longer frequent one in
    `within` percent of their occurrences or more are left out.
    """
    long = found.filter("n_words >= 2").select("lang", "phrase", "n_words", F.col("found").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = range(1, MAX_WORDS)
    sides = [
        F.when(F.col("n_words") > k, F.struct(F.lit(2 * k + side).alias("part"), text.alias("text")))
        for k in cuts
        for side, text in ((0, _part(F.col("words"), 1, k)), (1, _part(F.col("words"), k + 1, F.col("n_words") - k)))
    ]
    parts = long.select("lang", "phrase", "a", F.explode(F.array_compact(F.array(*sides))).alias("of"))
    counted = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("found").alias("_found"))
    known = parts.join(counted, (F.col("lang") == F.col("_lang")) & (F.col("of.text") == F.col("_part")))
    count_of = [F.max(F.when(F.col("of.part") == 2 * k + side, F.col("_found"))).alias(f"_{'lr'[side]}{k}") for k in cuts for side in (0, 1)]
    halves = known.groupBy("lang", "phrase", "a").agg(*count_of)
    # Decimals: the products may pass 64 bits.
    scored = [
        F.when(
            F.col(f"_l{k}").isNotNull(),
            F.struct(F.expr(f"cast({SCALE} * cast(a as decimal(19,0)) div (cast(_l{k} as decimal(19,0)) + _r{k}) as long)").alias("score"), F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r")),
        )
        for k in cuts
    ]
    best = halves.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*scored))).alias("cut"))
    inner = [
        F.when(F.col("n_words") > size, F.when(F.col("n_words") >= start + size - 1, _part(F.col("words"), start, size)))
        for size in range(2, MAX_WORDS)
        for start in range(1, MAX_WORDS - size + 2)
    ]
    held = (
        long.filter("n_words >= 3")
        .select("lang", "a", F.explode(F.array_distinct(F.array_compact(F.array(*inner)))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("_longer"))
    )
    inside = F.col("_longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * within
    kept = best.join(held, ["lang", "phrase"], "left").filter(~F.coalesce(inside, F.lit(False)))
    totals = found.filter("n_words = 0").select("lang", F.col("found").alias("n"))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The limit on ranks is applied before the shuffle too.
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame) -> DataFrame:
    """Frequent phrases and, of these, the collocations."""
    return collocations(frequent_phrases(docs))
