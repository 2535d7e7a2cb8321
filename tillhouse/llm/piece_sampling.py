"""SentencePiece encoding and decoding, with distinct sampled segmentations of every text.

A text's lattice has an edge for every piece of the model that matches at a place, and a path is a segmentation. Its
probability is proportional to exp(sum of edge scores / temperature). The model is a BPE one, whose scores are ranks of
merges and not log-probabilities; a piece of rank r scores -ln(r + 1), its share under Zipf's law. A character that is no
piece is an edge of its UTF-8 bytes, each scored below every piece. The text begins with the dummy space and keeps every
white space, as the model's normaliser says, so decoding gives the text back. A literal U+2581, the sign for a space, is
written in bytes, which keeps even that apart.

Gumbel top-k without replacement: every path has a perturbed score, its log-probability plus a Gumbel draw, and the k
greatest are the sample. They are found by A-star search over the lattice without listing paths. A hypothesis is a path's
beginning; its priority is the greatest perturbed score of all paths that go on from it, which is exact, since that
maximum is itself a Gumbel draw located at the hypothesis's log-probability (from the forward sums). Taking a hypothesis
down to a whole path leaves a group of siblings at every node, whose maximum is drawn truncated at the path's score and
waits on the agenda. The next greatest group gives the next path. The greatest waiting after k paths is the threshold
kappa: a path's inclusion score is 1 - exp(-exp(log_prob - kappa)), the probability that it enters a sample with that
threshold, so that sums weighted by its inverse are unbiased.

No piece runs across a line break or a space that follows a word, so the lattice is a chain of word lattices, and a word's lattice is
built once and kept (at most `KEPT_WORDS`, then anew). Draws are hashes of the row key, the sample and the place, not a
generator's state: a row gives the same samples in any batch. A long word is only a longer lattice.

A null text counts as empty; an empty text has one segmentation, of no pieces, with inclusion 1. A text with fewer than
k segmentations gives them all, with inclusion 1. Rows with a null key share one key; equal keys draw alike, so repeated
rows give equal samples. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.words import SpanHashes, chunks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
TEMPERATURE = 1.0
KEPT_WORDS = 120_000
BATCH_BYTES = 500_000
#: Log-probabilities are added in 2^-40.
UNITS = 2.0**40
SPACE = "▁"
_WORD = re.compile(r" *[^ \n]+| +|\n")


@dataclass
class Vocabulary:
    """Pieces by id, their scores, which are single bytes, and the id of each byte."""

    pieces: list[str]
    scores: np.ndarray
    is_byte: np.ndarray
    byte_ids: np.ndarray
    usable: np.ndarray

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.GetPieceSize()
        pieces = [model.IdToPiece(i) for i in range(n)]
        is_byte = np.array([model.IsByte(i) for i in range(n)])
        usable = np.array([not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i)) for i in range(n)])
        rank = np.minimum(np.array([-model.GetScore(i) for i in range(n)]), n)
        byte_ids = np.array([model.PieceToId(f"<0x{b:02X}>") for b in range(256)])
        scores = -np.log(np.maximum(rank, 0) + 1.0)
        scores[is_byte] = -np.log(n + 1.0) - 1.0
        within = next((p for i, p in enumerate(pieces) if usable[i] and (SPACE in p.lstrip(SPACE) or "\n" in p)), None)
        if within:
            raise ValueError(f"the piece {within!r} runs across words")
        return Vocabulary(pieces, scores, is_byte, byte_ids, usable)


class Decoder:
    """Texts of segmentations. Pieces are looked up as bytes; the first space is the dummy one."""

    def __init__(self, vocabulary: Vocabulary):
        spelled = [
            bytes([int(p[3:5], 16)]) if byte else p.replace(SPACE, " ").encode() for p, byte in zip(vocabulary.pieces, vocabulary.is_byte)
        ]
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(spelled), np.uint8)

    def __call__(self, ids: np.ndarray, of: np.ndarray) -> list[bytes]:
        """The UTF-8 of each run of[i]:of[i + 1] of ids."""
        sizes = self.sizes[ids]
        data = self.table[_runs(self.starts[ids], sizes)].tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])[of].tolist()
        return [data[a + 1 : b] for a, b in zip(upto[:-1], upto[1:])]


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    return Decoder(vocabulary)(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode()


class Numbers(dict):
    """Numbers for words in the order in which they are first asked for."""

    def __init__(self):
        self.listed: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.listed)
        self.listed.append(word)
        return n


class Lattices:
    """The lattices of words met so far. An edge belongs to the node it ends at; a node's likely edges come first."""

    def __init__(self, vocabulary: Vocabulary, temperature: float):
        self.vocabulary, self.temperature = vocabulary, temperature
        ids = np.flatnonzero(vocabulary.usable)
        lengths = np.array([len(vocabulary.pieces[i]) for i in ids])
        begins = np.cumsum(lengths) - lengths
        span = SpanHashes(np.frombuffer("".join(vocabulary.pieces[i] for i in ids).encode("utf-32-le"), np.uint32))
        #: For each length the hashes of the beginnings of pieces, and the piece that is the beginning itself, or -1.
        self.tables = []
        for size in range(1, int(lengths.max()) + 1):
            long = lengths >= size
            found, place = np.unique(span(begins[long], begins[long] + size), return_inverse=True)
            whole = np.full(len(found), -1)
            whole[place[lengths[long] == size]] = ids[lengths == size]
            self.tables.append((found, whole))
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        #: Of each word the first and the last node; of each node its first edge; of each edge the start and end node,
        #: the piece (or -1 - code point, for a character in bytes), the log-share and the cumulative share at its node.
        whole = dict.fromkeys(("root", "last", "first", "start", "end", "piece"), np.int32)
        self._room = {name: np.zeros(1024, kind) for name, kind in (whole | {"upto": np.float32, "share": np.float64}).items()}
        for name, room in self._room.items():
            setattr(self, name, room[:0])
        self.nodes = 0

    def _extend(self, **more: np.ndarray) -> None:
        """Adds to the arrays; their room grows by half, so that adding costs what is added."""
        for name, values in more.items():
            size = len(getattr(self, name))
            if size + len(values) > len(self._room[name]):
                room = np.zeros((size + len(values)) * 3 // 2, self._room[name].dtype)
                room[:size] = getattr(self, name)
                self._room[name] = room
            self._room[name][size : size + len(values)] = values
            setattr(self, name, self._room[name][: size + len(values)])

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > KEPT_WORDS:
            self.clear()
        known = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if len(self.number) > known:
            self._add(self.number.listed[known:])
        return out

    def _add(self, words: list[str]) -> None:
        """Lattices of new words, all at once: edges by length, then forward sums place by place."""
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        spaced = np.where(points == 32, np.uint32(ord(SPACE)), np.where(points == ord(SPACE), np.uint32(0xFFFFFFFF), points))
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        left = ends[word] - np.arange(len(points))
        span = SpanHashes(spaced)
        begin, length, piece, score = [], [], [], []
        single = np.zeros(len(points), bool)
        at = np.arange(len(points))
        for size, (hashes, whole) in enumerate(self.tables, 1):
            # Only places where some piece goes on.
            at = at[left[at] >= size]
            found = span(at, at + size)
            place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            on = hashes[place] == found
            at, ids = at[on], whole[place[on]]
            is_piece = ids >= 0
            begin.append(at[is_piece])
            piece.append(ids[is_piece])
            length.append(np.full(len(piece[-1]), size))
            score.append(self.vocabulary.scores[piece[-1]])
            if size == 1:
                single[begin[-1]] = True
        other = np.flatnonzero(~single)
        n_bytes = 1 + (points[other] > 0x7F) + (points[other] > 0x7FF) + (points[other] > 0xFFFF).astype(np.int64)
        begin.append(other)
        length.append(np.ones(len(other), np.int64))
        # A character in bytes is known by its code point, below zero.
        piece.append(-1 - points[other].astype(np.int64))
        score.append(n_bytes * self.vocabulary.scores[self.vocabulary.byte_ids[0]])
        begin, length, piece = np.concatenate(begin), np.concatenate(length).astype(np.int64), np.concatenate(piece)
        score = np.concatenate(score) / self.temperature
        # A word of n characters has n + 1 nodes.
        node = begin + word[begin]
        end = node + length
        order = np.argsort(end, kind="stable")
        node, end, piece, score = node[order], end[order], piece[order], score[order]
        n_nodes = len(points) + len(words)
        first = np.searchsorted(end, np.arange(n_nodes + 1))
        total = np.zeros(n_nodes)
        roots = ends - sizes + np.arange(len(words))
        by_size = np.argsort(-sizes, kind="stable")
        value = np.empty(len(score))
        for place in range(1, int(sizes.max(initial=0)) + 1):
            here = roots[by_size[: np.searchsorted(-sizes[by_size], -place, side="right")]] + place
            a, n = first[here], first[here + 1] - first[here]
            edges = _runs(a, n)
            value[edges] = total[node[edges]] + score[edges]
            starts = np.cumsum(n) - n
            peak = np.maximum.reduceat(value[edges], starts)
            total[here] = peak + np.log(np.add.reduceat(np.exp(value[edges] - np.repeat(peak, n)), starts))
        share = value - total[end]
        # A node's likeliest edge first; cumulative shares within each node, the last one 1.
        heads = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        peaks = np.flatnonzero(share == np.repeat(np.maximum.reduceat(share, heads), np.diff(np.append(heads, len(end)))))
        peaks = peaks[np.searchsorted(peaks, heads)]
        for x in (node, piece, share):
            x[heads], x[peaks] = x[peaks], x[heads]
        upto, sizes_in, so_far = np.empty(len(share)), np.diff(np.append(heads, len(end))), np.zeros(len(heads))
        for i in range(int(sizes_in.max(initial=0))):
            more = np.flatnonzero(sizes_in > i)
            so_far[more] += np.exp(share[heads[more] + i])
            upto[heads[more] + i] = so_far[more]
        upto[heads + sizes_in - 1] = 1.0
        self._extend(
            first=first[:-1] + len(self.start),
            start=node + self.nodes,
            end=end + self.nodes,
            piece=piece,
            upto=upto,
            share=np.minimum(share, 0.0),
            root=roots + self.nodes,
            last=roots + sizes + self.nodes,
        )
        self.nodes += n_nodes

    def edge(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An incoming edge of each node, drawn by its share."""
        edge = self.first[node]
        on = np.flatnonzero(u > self.upto[edge])
        while len(on):
            edge[on] += 1
            on = on[u[on] > self.upto[edge[on]]]
        return edge


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _uniform(key: np.ndarray, kind: int, sample: int, place: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    """Draws in (0, 1) from the row key, the purpose, the sample and the place."""
    seed = np.uint64(((kind << 32) + sample) * 0x9E3779B97F4A7C15 % (1 << 64))
    h = mix(key + seed + mix(place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(step) * np.uint64(0xA0761D6478BD642F)))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


@dataclass
class Paths:
    """Paths of a batch: edges of all rows, words in order, and in a word from its end to its beginning."""

    of: np.ndarray  # the range of each row's edges
    edge: np.ndarray
    word: np.ndarray  # the word occurrence of each edge
    step: np.ndarray  # its number within the word, from the word's end


def _walk(lattices: Lattices, words: np.ndarray, node: np.ndarray, step: np.ndarray, key: np.ndarray, place: np.ndarray, sample: int):
    """Edges from each node back to its word's beginning, drawn by share: (index into words, step, edge)."""
    index, found = np.arange(len(words)), []
    root = lattices.root[words]
    going = node > root
    index, node, step = index[going], node[going], step[going]
    while len(index):
        edge = lattices.edge(node, _uniform(key[index], 1, sample, place[index], step))
        found.append((index, step, edge))
        node, step = lattices.start[edge], step + 1
        going = node > root[index]
        index, node, step = index[going], node[going], step[going]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    index, step, edge = (np.concatenate(x) for x in zip(*found))
    return index, step, edge


def _truncated(location: np.ndarray, limit: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws at a location, given that they are at most the limit."""
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(np.isneginf(location), -np.inf, location - np.log(np.exp(np.minimum(location - limit, 700.0)) - np.log(u)))


def _log_rest(taken: np.ndarray) -> np.ndarray:
    """log(1 - share taken); nothing is left where the share is 1 to rounding."""
    rest = 1.0 - taken
    return np.where(rest > 1e-12, np.log(np.maximum(rest, 1e-300)), -np.inf)


def sample_batch(lattices: Lattices, texts: list[str], keys: np.ndarray, k: int):
    """(row, sample, log_prob, inclusion, edges in text order) of each path, greatest perturbed score first."""
    per_row = [_WORD.findall(" " + t) if t else [] for t in texts]
    n_words = np.array([len(w) for w in per_row], np.int64)
    words = lattices.numbers([w for row in per_row for w in row])
    row_of_word = np.repeat(np.arange(len(texts)), n_words)
    first_word = np.cumsum(n_words) - n_words
    place = np.arange(len(words)) - first_word[row_of_word]
    n = len(texts)
    score = -np.log(-np.log(_uniform(keys, 0, 0, np.zeros(n, np.int64), 0)))
    # Waiting groups of siblings: row, priority, path they left, its edge there, share taken at that node already, location.
    agenda = {name: np.zeros(0, kind) for name, kind in (("row", np.int64), ("value", float), ("path", np.int64), ("at", np.int64), ("taken", float), ("lead", float), ("banned", object))}
    paths: list[Paths] = []
    results = []
    rows = np.arange(n)
    new = None
    for sample in range(k + 1):
        if sample == 0:
            index, step, edge = _walk(lattices, words, lattices.last[words], np.zeros(len(words), np.int64), keys[row_of_word], place, 0)
            order = np.lexsort((step, index))
            path = Paths(np.searchsorted(row_of_word[index[order]], np.arange(n + 1)), edge[order], index[order], step[order])
            fork = np.zeros(n, np.int64)
            value, taken_before, lead_before, banned_before = score, np.zeros(n), np.zeros(n), np.full(n, None, object)
        else:
            # The greatest waiting group of each row.
            order = np.lexsort((-agenda["value"], agenda["row"]))
            top = order[np.flatnonzero(np.append(True, np.diff(agenda["row"][order]) > 0))] if len(order) else order
            top = top[~np.isneginf(agenda["value"][top])]
            kappa = np.full(n, -np.inf)
            kappa[agenda["row"][top]] = agenda["value"][top]
            if sample == k:
                break
            rows = agenda["row"][top]
            if not len(rows):
                break
            popped = {name: v[top] for name, v in agenda.items()}
            agenda = {name: np.delete(v, top) for name, v in agenda.items()}
            path, fork, taken_before, lead_before, banned_before, value = _branch(lattices, paths, popped, words, row_of_word, keys, place, sample, n)
        paths.append(path)
        own = np.repeat(np.arange(n), np.diff(path.of))
        share = lattices.share[path.edge]
        # Sums in whole units, so that they don't depend on the rows before in the batch.
        upto = np.concatenate([[0], np.cumsum(np.round(share * UNITS).astype(np.int64))])
        ahead = (upto[:-1] - np.repeat(upto[path.of[:-1]], np.diff(path.of))) / UNITS
        log_prob = (upto[path.of[1:]] - upto[path.of[:-1]]) / UNITS
        results.append((rows, value[rows], log_prob[rows], path))
        # Siblings at every node after the fork, and what is left of the group at the fork.
        at = np.arange(len(path.edge)) - path.of[own]
        after = at > fork[own] if sample else np.ones(len(at), bool)
        location = ahead[after] + _log_rest(np.exp(share[after]))
        drawn = _truncated(location, value[own[after]], _uniform(keys[own[after]], 2, sample, at[after], 0))
        keep = _greatest(own[after], drawn, k)
        add = {
            "row": own[after][keep], "value": drawn[keep], "path": np.full(len(keep), sample), "at": at[after][keep],
            "taken": np.exp(share[after][keep]), "lead": ahead[after][keep], "banned": np.full(len(keep), None, object),
        }
        agenda = {name: np.concatenate([agenda[name], add[name]]) for name in agenda}
        if sample:
            mine = path.of[rows] + fork[rows]
            taken = taken_before[rows] + np.exp(share[mine])
            location = lead_before[rows] + _log_rest(taken)
            drawn = _truncated(location, value[rows], _uniform(keys[rows], 3, sample, fork[rows], 0))
            banned = np.empty(len(rows), object)
            for i, r in enumerate(rows.tolist()):
                banned[i] = banned_before[r] + [int(path.edge[mine[i]])]
            add = {"row": rows, "value": drawn, "path": np.full(len(rows), sample), "at": fork[rows], "taken": taken, "lead": lead_before[rows], "banned": banned}
            agenda = {name: np.concatenate([agenda[name], add[name]]) for name in agenda}
    out = []
    for sample, (rows, value, log_prob, path) in enumerate(results):
        limit = kappa[rows]
        with np.errstate(over="ignore"):
            inclusion = np.where(np.isneginf(limit), 1.0, -np.expm1(-np.exp(log_prob - limit)))
        out.append((rows, value, log_prob, inclusion, path))
    return out, words


def _greatest(row: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k greatest values. Rows come in order."""
    if not len(row):
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, np.diff(row) > 0))
    sizes = np.diff(np.append(starts, len(row)))
    left, found = value.copy(), []
    for _ in range(k):
        peak = np.maximum.reduceat(left, starts)
        hits = np.flatnonzero(left == np.repeat(peak, sizes))
        hits = hits[np.searchsorted(hits, starts)]
        hits = hits[~np.isneginf(left[hits])]
        found.append(hits)
        left[hits] = -np.inf
    return np.concatenate(found)


def _branch(lattices, paths, popped, words, row_of_word, keys, place, sample, n):
    """Takes the popped groups down to paths: as the path they left up to the fork, another edge there, then new draws."""
    rows = popped["row"]
    fork = np.zeros(n, np.int64)
    taken, lead, value, banned_of = np.zeros(n), np.zeros(n), np.zeros(n), np.full(n, None, object)
    fork[rows], taken[rows], lead[rows], value[rows] = popped["at"], popped["taken"], popped["lead"], popped["value"]
    pieces = []
    for old, path in enumerate(paths):
        mine = popped["path"] == old
        if not mine.any():
            continue
        r, at = rows[mine], popped["at"][mine]
        edge_at = path.of[r] + at
        kept = _runs(path.of[r], at)
        pieces.append((path.word[kept], path.step[kept], path.edge[kept]))
        left_edge = path.edge[edge_at]
        banned = popped["banned"][mine]
        for i in range(len(r)):
            if banned[i] is None:
                banned[i] = [int(left_edge[i])]
            banned_of[r[i]] = banned[i]
        word, step = path.word[edge_at], path.step[edge_at]
        # Another edge into the same node: the shares of the taken ones are stepped over.
        node = lattices.end[left_edge]
        chosen = np.empty(len(r), np.int64)
        u = _uniform(keys[r], 4, sample, at, 0)
        for i, (a, b, x, no) in enumerate(zip(lattices.first[node].tolist(), _next_first(lattices, node).tolist(), u.tolist(), banned)):
            free = [e for e in range(a, b) if e not in no]
            shares = np.exp(lattices.share[free])
            chosen[i] = free[min(int(np.searchsorted(np.cumsum(shares), x * shares.sum())), len(free) - 1)]
        pieces.append((word, step, chosen))
        index, steps, edges = _walk(lattices, words[word], lattices.start[chosen], step + 1, keys[r], place[word], sample)
        pieces.append((word[index], steps, edges))
        # The words after the fork's.
        ends = np.searchsorted(row_of_word, r, side="right")
        rest = _runs(word + 1, ends - word - 1)
        index, steps, edges = _walk(lattices, words[rest], lattices.last[words[rest]], np.zeros(len(rest), np.int64), keys[row_of_word[rest]], place[rest], sample)
        pieces.append((rest[index], steps, edges))
    word, step, edge = (np.concatenate(x) for x in zip(*pieces))
    order = np.lexsort((step, word))
    word, step, edge = word[order], step[order], edge[order]
    of = np.searchsorted(row_of_word[word], np.arange(n + 1))
    return Paths(of, edge, word, step), fork, taken, lead, banned_of, value


def _next_first(lattices: Lattices, node: np.ndarray) -> np.ndarray:
    last = node + 1 == len(lattices.first)
    return np.where(last, len(lattices.start), lattices.first[np.where(last, 0, node + 1)])


def _ids(lattices: Lattices, path: Paths) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids in text order, and the range of each row's."""
    # Within a word the path runs backwards.
    size = len(path.edge)
    if not size:
        return np.zeros(0, np.int32), np.zeros(len(path.of), np.int64)
    starts = np.flatnonzero(path.step == 0)
    lengths = np.diff(np.append(starts, size))
    turned = np.repeat(2 * starts + lengths - 1, lengths) - np.arange(size)
    pieces = lattices.piece[path.edge[turned]]
    coded = np.flatnonzero(pieces < 0)
    if not len(coded):
        return pieces.astype(np.int32), path.of
    # Characters written in bytes.
    byte_ids = lattices.vocabulary.byte_ids
    written = [byte_ids[list(chr(-1 - int(p)).encode())] for p in pieces[coded]]
    widths = np.ones(size, np.int64)
    widths[coded] = [len(w) for w in written]
    at = np.cumsum(widths) - widths
    out = np.empty(int(widths.sum()), np.int32)
    plain = pieces >= 0
    out[at[plain]] = pieces[plain]
    for place, w in zip(at[coded].tolist(), written):
        out[place : place + len(w)] = w
    return out, np.append(at, len(out))[path.of]


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("inclusion", pa.float64())]
)


def segmenter(vocabulary: Callable[[], Vocabulary], k: int, temperature: float):
    """Batches of (doc_id, text) to batches of (doc_id, sample, ids, log_prob, inclusion), and their texts."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
        lattices = Lattices(vocabulary(), temperature)
        for batch in batches:
            for chunk in chunks(batch, "text", BATCH_BYTES):
                texts = [t or "" for t in chunk["text"].to_pylist()]
                ids = chunk["doc_id"]
                keys = mix(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(0x51ED270B))
                found, _ = sample_batch(lattices, texts, keys, k)
                for sample, (rows, _, log_prob, inclusion, path) in enumerate(found):
                    pieces, of = _ids(lattices, path)
                    sizes = (of[rows + 1] - of[rows]).astype(np.int64)
                    listed = pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(pieces[_runs(of[rows], sizes)])
                    )
                    taken = pa.array(rows)
                    out = pa.RecordBatch.from_arrays(
                        [ids.take(taken), pa.array(np.full(len(rows), sample + 1, np.int32)), listed, pa.array(log_prob), pa.array(inclusion)], schema=_SCHEMA
                    )
                    yield out, [texts[r] for r in rows.tolist()]

    return segment


def segmentations(docs: DataFrame, model: str = MODEL, k: int = SAMPLES, temperature: float = TEMPERATURE) -> DataFrame:
    """Up to k rows per document: doc_id, sample (from 1), ids, log_prob, inclusion. `model` is the model file's path."""
    # The vocabulary's size is that of the model file.
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    segment = segmenter(lambda: vocabulary.value, k, temperature)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (out for out, _ in segment(batches))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, sample int, ids array<int>, log_prob double, inclusion double")


def digests(docs: DataFrame, model: str = MODEL, k: int = SAMPLES, temperature: float = TEMPERATURE) -> DataFrame:
    """The segmentations, each decoded: doc_id, sample, n_pieces, log_prob, inclusion, ids_sha256 (of the ids as
    little-endian 32-bit integers), same_text (whether decoding gives the text back)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    segment = segmenter(lambda: vocabulary.value, k, temperature)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary.value)
        for out, texts in segment(batches):
            flat, of = out["ids"].values.to_numpy(), out["ids"].offsets.to_numpy()
            same = [decoded == t.encode() for decoded, t in zip(decoder(flat, of), texts)]
            sha = [hashlib.sha256(flat[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(of[:-1].tolist(), of[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [out["doc_id"], out["sample"], pa.array(np.diff(of).astype(np.int64)), out["log_prob"], out["inclusion"], pa.array(sha, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "sample", "n_pieces", "log_prob", "inclusion", "ids_sha256", "same_text"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, sample int, n_pieces long, log_prob double, inclusion double, ids_sha256 string, same_text boolean"
    return rows.mapInArrow(run, schema)
