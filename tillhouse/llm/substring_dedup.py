"""Repeated passages, found with compressed FM-indexes.

A window is 13 consecutive words. A word goes if a window that covers it also starts in a document with a smaller id;
windows are judged on the input. The documents are streamed against FM-indexes, one per shard, whose backward search
gives how far the words before each position match elsewhere; matches of at least a window are reported with the
smallest document they occur in.

Shards are cut by content, not by document, so that a document meets only the shards that can hold its passages. Every
window is filed under the smallest hash among its six 8-word runs; windows next to each other under the same run make
one fragment of 13 to 18 words. Equal windows are under equal runs, thus in the same shard. Runs that occur in a single
document are settled by counting (`key_counts`), and only the other fragments are sent, once per block of documents with
the block's smallest id. In a shard equal fragments are one entry. So a passage that a third of all documents share is
one fragment per block. Words are 64-bit hashes of their bytes.

A null text has no words. Rows with a null id keep all words and remove none; rows that share an id don't remove each
other's words. Texts under 13 words stay whole. Columns other than doc_id and text are not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import key_counts
from tillhouse.llm.words import Words, mix, windows

WIDTH = 13
RUN = 8
#: Windows searched at once.
BATCH = 200_000
_NO_DOC = np.int64(2**63 - 1)


class BitVector:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded.reshape(-1, 8)[:, ::-1], axis=1).ravel().view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)


class FMIndex:
    """FM-index of words with a wavelet tree (in matrix form) over the Burrows-Wheeler transform.

    `entries` are the lengths of the entries that lie one after another in `tokens`; no match runs across them.
    """

    def __init__(self, tokens: np.ndarray, entries: np.ndarray):
        ends = np.cumsum(entries)
        n, n_entries = len(tokens) + len(entries), len(entries)
        self.alphabet, symbols = np.unique(tokens, return_inverse=True)
        separators = ends + np.arange(n_entries)
        is_word = np.ones(n, bool)
        is_word[separators] = False
        text = np.zeros(n, np.int64)
        text[is_word] = symbols + 1
        #: Where entry i begins in the text with separators.
        self.starts = np.concatenate([[0], separators[:-1] + 1]) if n_entries else np.zeros(0, np.int64)
        rank = text + n_entries
        rank[separators] = np.arange(n_entries)
        self.suffixes = self._sorted_suffixes(rank)
        bwt = text[self.suffixes - 1]
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.levels = []
        for shift in range(max(1, int(len(self.alphabet)).bit_length()) - 1, -1, -1):
            bits = (bwt >> shift) & 1
            self.levels.append((shift, BitVector(bits)))
            bwt = np.concatenate([bwt[bits == 0], bwt[bits == 1]])
        # Where each symbol's run begins below the last level, taken off once for all.
        every = np.arange(len(self.alphabet) + 1)
        self.lead = first - self._down(every, np.zeros(len(every), np.int64))
        self.size = n

    @staticmethod
    def _sorted_suffixes(rank: np.ndarray) -> np.ndarray:
        """By prefix doubling. Separators differ from each other, so a few rounds tell all suffixes apart."""
        n, k = len(rank), 1
        _, rank = np.unique(rank, return_inverse=True)
        while True:
            key = rank.astype(np.int64) * (n + 1)
            key[: n - k] += rank[k:] + 1
            order = np.argsort(key)
            if n < 2:
                return order
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            if new[order[-1]] == n - 1:
                return order
            rank, k = new, 2 * k

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> shift) & 1, bits.zeros + ones, i - ones)
        return i

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that begin with the symbol and go on as the rows low..high do."""
        m, lead = len(symbol), self.lead[symbol]
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return lead + both[:m], lead + both[m:]


def fragments(hashes: np.ndarray, of: np.ndarray, width: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and filing key of every fragment. `of` bounds the texts."""
    per_window = width - run + 1
    runs = windows(hashes, run, seed=3)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, where = runs[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, per_window):
        smaller = runs[i : i + n] < least
        least[smaller] = runs[i : i + n][smaller]
        where[smaller] = i
    text = np.searchsorted(of, np.arange(n), side="right") - 1
    whole = np.arange(n) + width <= of[text + 1]
    place = np.arange(n) + where
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new & whole)
    # Windows at a text's end that run into the next text come last in their group.
    group = np.cumsum(new) - 1
    sizes = np.bincount(group[whole], minlength=group[-1] + 1)[group[starts]]
    # Smallest hashes crowd at the low end; mixed anew, they spread over the shards.
    return starts, sizes, mix(least[starts])


class _Block:
    """The fragments of a block of documents."""

    def __init__(self, table: pa.Table, width: int, run: int):
        self.words = Words(table["text"])
        self.hashes = self.words.hashes()
        self.ids = table["doc_id"].combine_chunks()
        self.start, self.n, self.key = fragments(self.hashes, self.words.of, width, run)
        self.text = np.searchsorted(self.words.of, self.start, side="right") - 1
        known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc = self.ids.fill_null(0).to_numpy(zero_copy_only=False)
        keep = known[self.text]
        self.start, self.n, self.key, self.text = (x[keep] for x in (self.start, self.n, self.key, self.text))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and the number of documents that hold each."""
        order = np.lexsort((self.text, self.key))
        key, text = self.key[order], self.text[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        return np.unique(key[first], return_counts=True)

    def shared(self, codes: np.ndarray, width: int) -> _Shared:
        """The distinct fragments whose key several documents hold."""
        keys, _ = self.keys()
        kept = np.flatnonzero(codes[np.searchsorted(keys, self.key)] > 0) if len(keys) else np.zeros(0, np.int64)
        start, n, key = self.start[kept], self.n[kept], self.key[kept]
        length = n + width - 1
        content = np.zeros(len(kept), np.uint64)
        for i in range(int(length.max(initial=0))):
            inside = i < length
            content[inside] = mix(content[inside] + self.hashes[start[inside] + i] + np.uint64(i + 1))
        order = np.lexsort((content, key))
        new = np.ones(len(kept), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])
        entry = np.empty(len(kept), np.int64)
        entry[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(self.doc[self.text[kept]][order], np.flatnonzero(new)) if len(kept) else np.zeros(0, np.int64)
        return _Shared(kept, entry, order[new], least)


class _Shared:
    def __init__(self, kept: np.ndarray, entry: np.ndarray, example: np.ndarray, least: np.ndarray):
        #: Fragment numbers; the entry of each; for each entry one of them (a place in `kept`) and the smallest document.
        self.kept, self.entry, self.example, self.least = kept, entry, example, least


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places start[i] .. start[i] + length[i] - 1, one run after another."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _search(table: pa.Table, width: int) -> pa.Table:
    """A shard's fragments: for every window of every entry the smallest document that holds it."""
    sizes = [np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64) for x in table["sizes"]]
    length = np.concatenate(sizes) + width - 1
    tokens = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["tokens"]])
    docs = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["docs"]])
    # Equal fragments of several blocks are one entry of the index.
    content = np.zeros(len(length), np.uint64)
    start = np.cumsum(length) - length
    for i in range(int(length.max(initial=0))):
        inside = i < length
        content[inside] = mix(content[inside] + tokens[start[inside] + i] + np.uint64(i + 1))
    _, example, entry = np.unique(content, return_index=True, return_inverse=True)
    least = np.full(len(example), _NO_DOC)
    np.minimum.at(least, entry, docs)
    lengths = length[example]
    index = FMIndex(tokens[_spans(start[example], lengths)], lengths)
    owner = np.repeat(least, lengths + 1)[index.suffixes]
    owner = np.append(owner, _NO_DOC)
    # The symbols of the indexed text, to stream its windows from right to left.
    symbols = np.zeros(index.size, np.int64)
    symbols[_spans(index.starts, lengths)] = np.searchsorted(index.alphabet, tokens[_spans(start[example], lengths)]) + 1
    n_windows = lengths - width + 1
    window = _spans(index.starts, n_windows)
    found = np.repeat(least, n_windows)
    for a in range(0, len(window), BATCH):
        at = np.arange(a, min(a + BATCH, len(window)))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), index.size)
        for step in range(width):
            low, high = index.extended(symbols[window[at] + width - 1 - step], low, high)
            # A match that only the fragment itself has can't grow into another's.
            several = high - low > 1
            at, low, high = at[several], low[several], high[several]
        if len(at):
            found[at] = np.minimum(found[at], np.minimum.reduceat(owner, np.stack([low, high], axis=1).ravel())[::2])
    first = np.cumsum(n_windows) - n_windows
    told = found[_spans(first[entry], n_windows[entry])]
    per_row = np.cumsum([0, *(int(x.sum()) for x in sizes)])
    answers = [told[a:b].tobytes() for a, b in zip(per_row[:-1], per_row[1:])]
    return pa.Table.from_arrays([table["block"].combine_chunks(), table["part"].combine_chunks(), pa.array(answers, pa.binary())], names=["block", "part", "codes"])


def remove_repeats(docs: DataFrame, width: int = WIDTH, run: int = RUN) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the kept words, joined by one space), kept_sha256."""
    blocks = key_counts.in_blocks(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Read twice, below and at the end: one exchange that both read, so that it is made once.
    told = key_counts.counted(blocks, lambda t: _Block(t, width, run).keys(), lambda n: n > 1).repartition(parts, "block")

    def owners(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))

    def send(table: pa.Table, counts: pa.Table) -> pa.Table:
        names, kinds = ["block", "part", "sizes", "tokens", "docs"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        rows: list[list] = [[] for _ in names]
        if table.num_rows:
            block = _Block(table, width, run)
            shared = block.shared(key_counts.codes_in_order(counts), width)
            at = shared.kept[shared.example]
            cuts = owners(block.key[at])
            for part in range(parts):
                own = at[cuts[part] : cuts[part + 1]]
                if len(own):
                    tokens = block.hashes[_spans(block.start[own], block.n[own] + width - 1)]
                    least = shared.least[cuts[part] : cuts[part + 1]]
                    row = (table["block"][0].as_py(), part, block.n[own].astype(np.uint8).tobytes(), tokens.tobytes(), least.tobytes())
                    for column, value in zip(rows, row):
                        column.append(value)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        if not table.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        block = _Block(table, width, run)
        kinds_of = answers["kind"].to_numpy()
        shared = block.shared(key_counts.codes_in_order(answers.filter(pa.array(kinds_of == 0))), width)
        sent = sorted(zip(*(answers.filter(pa.array(kinds_of == 1))[c].to_pylist() for c in ("part", "codes"))))
        least = np.frombuffer(b"".join(x for _, x in sent), np.int64)
        n_of_entry = block.n[shared.kept[shared.example]]
        first = np.cumsum(n_of_entry) - n_of_entry
        n = block.n[shared.kept]
        smaller = least[_spans(first[shared.entry], n)] < np.repeat(block.doc[block.text[shared.kept]], n)
        windows_gone = _spans(block.start[shared.kept], n)[smaller]
        change = np.zeros(len(block.hashes) + width + 1, np.int64)
        np.add.at(change, windows_gone, 1)
        np.add.at(change, windows_gone + width, -1)
        gone = np.cumsum(change)[: len(block.hashes)] > 0
        words, rows = block.words, []
        data = words.data.tobytes()
        for i in range(table.num_rows):
            a, b = words.of[i], words.of[i + 1]
            cut = gone[a:b]
            if cut.any():
                kept = b" ".join([data[s:e] for s, e in zip(words.start[a:b][~cut].tolist(), words.end[a:b][~cut].tolist())])
            else:
                kept = b" ".join(data[words.offsets[i] : words.offsets[i + 1]].split())
            rows.append((int(b - a), int(cut.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
        columns = [block.ids, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds[1:]))]
        return pa.Table.from_arrays(columns, names=names)

    by_block = blocks.groupBy("block")
    sent = by_block.cogroup(told.groupBy("block")).applyInArrow(send, "block int, part int, sizes binary, tokens binary, docs binary")
    found = sent.groupBy("part").applyInArrow(lambda t: _search(t, width), "block int, part int, codes binary")
    answers = told.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)))
    schema = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(finish, schema)
