"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, its leaf texts between block-level tags. A bidirectional LSTM (numpy) reads the page's blocks
in order and says of each, from everything before and after it, whether it belongs to the article. A block is given to
it as the hashed tags, classes, ids and roles on its path, its hashed words, and a few figures (length, links,
punctuation, digits, place). Texts of scripts, styles, controls and the head are no blocks.

The labeller is trained on the driver from at most `TRAIN_PAGES` pages, the same for the same table: the pages as they
are, labelled by their containers, and the texts of their blocks set anew into `LAYOUTS` random layouts each, in which
the kind of every block is known, and in which adverts, notices and comments hold the same prose as articles. The sample
and the model have a fixed size; every page is labelled, from its whole source.

Character references are decoded, white space inside a block becomes one space, blocks are joined by a line break in
page order. A null or empty page gives an empty text. Broken markup is read as far as it goes: unclosed tags stay open,
an unclosed comment or script runs to the end. Repeated pages keep a row each. Columns other than page_id, url and html
are not read. No rows give no rows; the labeller then learns from made-up words, and labels nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.words import Words, chunks

TRAIN_PAGES = 300
TRAIN_CHARS = 50_000
LAYOUTS = 4
PATH_SIZE, WORD_SIZE, FIGURES, WIDTH, HIDDEN = 512, 256, 8, 32, 24
EPOCHS, BATCH, RATE = 8, 32, 0.01
#: Bytes of page source labelled together.
CHUNK = 1_000_000

#: Fixed values of HTML: elements whose text is never shown or is a control, those without an end, those inside a line.
HIDDEN_TAGS = frozenset("script style noscript template head title svg math iframe object select option textarea button canvas audio video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input br".split()
)
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
_MARK = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    link_chars: int


def blocks(source: str) -> list[Block]:
    """The leaf texts of a page with the marks on their path (tags, and classes, ids and roles in words)."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = hidden = at = link_chars = 0
    path: tuple[str, ...] | None = None

    def finish() -> None:
        nonlocal parts, path, link_chars
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
            if text:
                out.append(Block(text, path or (), link_chars))
        parts, path, link_chars = [], None, 0

    def add(text: str) -> None:
        nonlocal path, link_chars
        if hidden or not text:
            return
        if path is None and not text.isspace():
            path = tuple(mark for tag, marks in stack for mark in (f"<{tag}", *marks))
        parts.append(text)
        if links:
            link_chars += len(text)

    def close(i: int) -> None:
        nonlocal links, hidden
        for tag, _ in stack[i:]:
            links -= tag == "a"
            hidden -= tag in HIDDEN_TAGS
        del stack[i:]

    while True:
        found = _TOKEN.search(source, at)
        if not found:
            add(source[at:])
            break
        add(source[at : found.start()])
        at = found.end()
        ending, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE_TAGS:
            finish()
        if ending:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in VOID_TAGS or rest.endswith("/"):
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag in _CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _CLOSES[tag]:
                    close(i)
                    break
                if stack[i][0] not in INLINE_TAGS:
                    break
        marks = tuple(w for m in _MARK.finditer(rest) for w in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower()) if w) if rest else ()
        stack.append((tag, marks))
        links += tag == "a"
        hidden += tag in HIDDEN_TAGS
    finish()
    return out


def _bucket(text: str, size: int) -> int:
    h = 2166136261
    for b in text.encode():
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) % size


class Features:
    """Arrays of a list of pages' blocks. Paths repeat from page to page, so their vectors are kept."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            found = np.zeros(PATH_SIZE, np.float32)
            tags = [m for m in path if m[0] == "<"]
            # Marks count wherever they are; the last tags again as a pair, since neighbours in the path say more together.
            for mark in {*path, "/".join(tags[-2:]), "last:" + (tags[-1] if tags else "")}:
                found[_bucket(mark, PATH_SIZE)] = 1.0
            self.paths[path] = found
        return found

    def __call__(self, pages: list[list[Block]]) -> np.ndarray:
        flat = [b for page in pages for b in page]
        x = np.zeros((len(flat), PATH_SIZE + WORD_SIZE + FIGURES), np.float32)
        if not flat:
            return x
        for i, b in enumerate(flat):
            x[i, :PATH_SIZE] = self.path(b.path)
        words = Words(pa.array([b.text for b in flat], pa.large_string()))
        n_words = np.diff(words.of)
        owner = np.repeat(np.arange(len(flat)), n_words)
        bag = np.bincount(owner * WORD_SIZE + (words.hashes() % np.uint64(WORD_SIZE)).astype(np.int64), minlength=len(flat) * WORD_SIZE)
        x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = bag.reshape(len(flat), WORD_SIZE) / np.maximum(n_words, 1)[:, None]
        data, size = words.data, np.diff(words.offsets)
        upto = lambda table: np.concatenate([[0], np.cumsum(np.isin(data, table))])
        share = lambda table: np.diff(upto(table)[words.offsets]) / np.maximum(size, 1)
        chars = np.array([len(b.text) for b in flat])
        place = np.concatenate([np.arange(len(p)) / max(1, len(p) - 1) for p in pages])
        lengths = np.repeat([len(p) for p in pages], [len(p) for p in pages])
        figures = [
            np.log1p(chars) / 8,
            np.minimum(1.0, np.array([b.link_chars for b in flat]) / np.maximum(chars, 1)),
            share(np.frombuffer(b".,;:!?", np.uint8)) * 10,
            share(np.frombuffer(b"0123456789", np.uint8)),
            place,
            np.log1p(lengths) / 8,
            np.minimum(n_words, 20) / 20,
            np.ones(len(flat)),
        ]
        x[:, PATH_SIZE + WORD_SIZE :] = np.stack(figures, axis=1)
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """tanh layer, LSTM in both directions, logistic output."""

    def __init__(self, seed: int = 7):
        random = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {"w": normal(PATH_SIZE + WORD_SIZE + FIGURES, WIDTH), "b": np.zeros(WIDTH, np.float32)}
        for d in "fr":
            self.p[d + "x"], self.p[d + "h"] = normal(WIDTH, 4 * HIDDEN), normal(HIDDEN, 4 * HIDDEN)
            self.p[d + "b"] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
        self.p |= {"o": normal(2 * HIDDEN, 1), "c": np.zeros(1, np.float32)}

    def _run(self, z: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, batch, HIDDEN); padded places pass the state on."""
        steps = range(len(z)) if d == "f" else range(len(z) - 1, -1, -1)
        h = c = np.zeros((z.shape[1], HIDDEN), np.float32)
        out = np.empty((len(z), z.shape[1], HIDDEN), np.float32)
        gates_x = z @ self.p[d + "x"] + self.p[d + "b"]
        for t in steps:
            g = gates_x[t] + h @ self.p[d + "h"]
            i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = m * (f * c + i * u) + (1 - m) * c
            tanh_c = np.tanh(new_c)
            new_h = m * (o * tanh_c) + (1 - m) * h
            if keep is not None:
                keep.append((t, h, c, i, f, o, u, tanh_c, m))
            h, c = new_h, new_c
            out[t] = h
        return out

    def _states(self, z, mask, keep=None):
        return np.concatenate([self._run(z, mask, d, keep and keep[d]) for d in "fr"], axis=2)

    def scores(self, x: np.ndarray, lengths: list[int]) -> np.ndarray:
        """Log-odds of every block of pages of those lengths, pages of like length together."""
        z = np.tanh(x @ self.p["w"] + self.p["b"])
        out = np.zeros(len(x), np.float32)
        starts = np.cumsum([0, *lengths])
        order = np.argsort(lengths, kind="stable")
        order = order[np.searchsorted(np.array(lengths)[order], 0, side="right") :]
        while len(order):
            # Padding at most doubles a group.
            n = int(np.searchsorted(np.array(lengths)[order], 2 * lengths[order[0]] + 8, side="right"))
            group, order = order[: min(n, 256)], order[min(n, 256) :]
            zs, mask, at = _padded(z, starts, lengths, group)
            logits = (self._states(zs, mask) @ self.p["o"] + self.p["c"])[:, :, 0]
            out[at[mask > 0]] = logits[mask > 0]
        return out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 11) -> Labeller:
        """Adam on the mean log loss, back through time."""
        random = np.random.Generator(np.random.PCG64(seed))
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(pages))
            for a in range(0, len(order), BATCH):
                chosen = [pages[i] for i in order[a : a + BATCH]]
                grads = self._gradients(chosen)
                step += 1
                rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
        x, y = np.concatenate([p[0] for p in pages]), np.concatenate([p[1] for p in pages])
        lengths = [len(p[0]) for p in pages]
        starts = np.cumsum([0, *lengths])
        z_flat = np.tanh(x @ self.p["w"] + self.p["b"])
        z, mask, at = _padded(z_flat, starts, lengths, np.arange(len(pages)))
        kept = {"f": [], "r": []}
        states = np.concatenate([self._run(z, mask, d, kept[d]) for d in "fr"], axis=2)
        logits = (states @ self.p["o"] + self.p["c"])[:, :, 0]
        wrong = (_sigmoid(logits) - y[at]) * mask / mask.sum()
        grads = {"o": np.einsum("tbh,tb->h", states, wrong)[:, None], "c": np.array([wrong.sum()])}
        to_states = wrong[:, :, None] * self.p["o"][:, 0]
        to_z = np.zeros_like(z)
        for n, d in enumerate("fr"):
            wx, wh = self.p[d + "x"], self.p[d + "h"]
            gx, gh, gb = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            dh = dc = np.zeros((z.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, u, tanh_c, m in reversed(kept[d]):
                dh = dh + to_states[t][:, n * HIDDEN : (n + 1) * HIDDEN]
                on = dh * m
                dcell = (dc + on * o * (1 - tanh_c**2)) * m
                dg = np.concatenate([dcell * u * i * (1 - i), dcell * c * f * (1 - f), on * tanh_c * o * (1 - o), dcell * i * (1 - u**2)], axis=1)
                gx, gh, gb = gx + z[t].T @ dg, gh + h.T @ dg, gb + dg.sum(axis=0)
                to_z[t] += dg @ wx.T
                dh = dg @ wh.T + dh * (1 - m)
                dc = dcell * f + dc * (1 - m)
            grads |= {d + "x": gx, d + "h": gh, d + "b": gb}
        flat = np.zeros_like(z_flat)
        flat[at[mask > 0]] = to_z[mask > 0]
        flat *= 1 - z_flat**2
        return grads | {"w": x.T @ flat, "b": flat.sum(axis=0)}


def _padded(z: np.ndarray, starts: np.ndarray, lengths: list[int], group: np.ndarray):
    """(time, page) arrays of a group of pages: inputs, mask, and the flat place of each."""
    sizes = np.array(lengths)[group]
    time = np.arange(int(sizes.max()))[:, None]
    mask = (time < sizes).astype(np.float32)
    at = np.where(mask > 0, starts[group] + time, 0)
    return z[at] * mask[:, :, None], mask, at


#: Markers of containers that don't belong to an article.
BOILERPLATE = frozenset(
    "<nav <header <footer <aside <form <button <label <fieldset ad ads advert advertisement adverts banner sponsored sponsor promo menu nav navigation navbar breadcrumb "
    "breadcrumbs sidebar cookie consent notice alert popup modal newsletter subscribe comment comments discussion reply replies related share social footer header "
    "masthead legal copyright widget pagination search login signup".split()
)
_ARTICLE = frozenset("<article <main article main content post entry story".split())
_WORDS = "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no".split()


def contained(block: Block) -> bool:
    """Whether a block's containers make it part of an article: the labels of the sampled pages."""
    marks = set(block.path)
    inner = marks - {"<header"} if "<article" in marks else marks
    return bool(marks & _ARTICLE) and not inner & BOILERPLATE


def _lay_out(random: np.random.Generator, prose: list[str], short: list[str]) -> tuple[str, list[bool]]:
    """A page in a random layout, and for each of its blocks whether it belongs to the article."""
    pick = lambda options: options[int(random.integers(len(options)))]
    chance = lambda p: random.random() < p
    out: list[str] = []
    labels: list[bool] = []
    esc = html.escape

    def line(tag: str, text: str, good: bool) -> None:
        out.append(f"<{tag}>{esc(text)}" + (f"</{tag.split()[0]}>" if tag != "p" or chance(0.9) else ""))
        labels.append(good)

    def item_list() -> None:
        out.append("<ul>")
        for _ in range(int(random.integers(2, 8))):
            out.append(f'<li><a href="/x">{esc(pick(short))}</a></li>')
            labels.append(False)
        out.append("</ul>")

    def box(opening: str, body) -> None:
        out.append(f"<{opening}>")
        body()
        out.append(f"</{opening.split()[0]}>")

    def paragraphs(n: int, good: bool) -> None:
        for _ in range(n):
            line("p" if chance(0.8) else "div", pick(prose), good)

    def marked(name: str) -> str:
        return pick([f'div class="{name}"', f'div id="{name}"', f'section class="{name}"', f'div class="box {name}"'])

    def comments() -> None:
        line(pick(["h2", "h3"]), pick(short), False)
        for _ in range(int(random.integers(1, 5))):
            box(pick(['div class="comment"', 'li class="comment"', 'article class="comment"', 'div class="reply"']), lambda: paragraphs(int(random.integers(1, 3)), False))

    def form() -> None:
        out.append(f"<label>{esc(pick(short))}</label><input name=q>")
        labels.append(False)
        if chance(0.5):
            line("p", pick(prose), False)
        out.append("<button>Go</button>")

    def aside() -> None:
        kind = int(random.integers(6))
        if kind == 0:
            # An advert's or notice's text may stand in the box itself.
            out.append(f"<{(o := marked(pick(['ad', 'ads', 'advert', 'sponsored', 'promo', 'banner', 'advertisement'])))}>{esc(pick(prose))}</{o.split()[0]}>")
            labels.append(False)
        elif kind == 1:
            box(marked(pick(["cookie-notice", "notice", "alert", "cookie-consent", "consent", "popup"])), lambda: paragraphs(1, False))
        elif kind == 2:
            box(pick(['form class="newsletter"', "form", 'form id="search"', 'div class="subscribe"']), form)
        elif kind == 3:
            box(marked(pick(["related", "share", "social", "breadcrumbs", "pagination"])), item_list)
        elif kind == 4:
            box(pick(["aside", 'aside class="sidebar"', 'div class="sidebar"', 'div id="sidebar"']), lambda: (paragraphs(int(random.integers(1, 3)), False), item_list()))
        else:
            out.append(f"<{(o := marked(pick(['ad', 'advert', 'promo', 'notice'])))}>{esc(pick(prose))}</{o.split()[0]}>")
            labels.append(False)

    def article() -> None:
        if chance(0.8):
            line(pick(["h1", "h1", "h2"]), pick(short), True)
        for _ in range(int(random.integers(1, 9))):
            kind = random.random()
            if kind < 0.75:
                line("p", pick(prose), True)
            elif kind < 0.8:
                line(pick(["h2", "h3"]), pick(short), True)
            elif kind < 0.85:
                line("blockquote", pick(prose), True)
            elif kind < 0.9:
                box("ul", lambda: [line("li", pick(prose if chance(0.5) else short), True) for _ in range(int(random.integers(2, 5)))])
            else:
                aside()

    out.append("<html><body>")
    if chance(0.7):
        box(pick(["header", 'div class="header"', 'div id="masthead"']), lambda: line(pick(["h1", "p", "div"]), pick(short), False))
    if chance(0.8):
        box(pick(["nav", 'nav class="menu"', 'ul class="menu"', 'div class="navbar"']), item_list)
    for _ in range(int(random.integers(3))):
        aside()
    body = pick(["article", "article", "main", 'div class="content"', 'div id="content"', 'section class="post"', 'div class="entry"', 'div class="story"', 'article class="post"', 'div class="article"', "div"])
    wrap = pick([None, None, "main", 'div class="wrapper"', 'div id="main"', 'div class="container"'])
    if wrap:
        out.append(f"<{wrap}>")
    box(body, article)
    for _ in range(int(random.integers(3))):
        aside()
    if chance(0.4):
        box(marked(pick(["comments", "comment-list", "discussion"])), comments)
    if wrap:
        out.append(f"</{wrap.split()[0]}>")
    if chance(0.8):
        box(pick(["footer", "footer", 'div class="footer"', 'div id="footer"']), lambda: line(pick(["p", "div", "small"]), "© " + pick(prose if chance(0.5) else short), False))
    out.append("</body></html>")
    return "".join(out), labels


def training_pages(sources: list[str], layouts: int = LAYOUTS, seed: int = 5) -> list[tuple[list[Block], np.ndarray]]:
    """Labelled pages: the sources, and their texts in random layouts."""
    random = np.random.Generator(np.random.PCG64(seed))
    own = [blocks(s) for s in sources]
    pages = [(page, np.array([contained(b) for b in page], np.float32)) for page in own if page]
    texts = [b.text for page in own for b in page]
    made = [" ".join(random.choice(_WORDS, int(n))) for n in random.integers(3, 40, 50)]
    prose = [t for t in texts if len(t) > 60] or made
    short = [t for t in texts if len(t) <= 60] or [" ".join(t.split()[:4]) for t in made]
    for _ in range(layouts * max(len(sources), 50)):
        source, labels = _lay_out(random, prose, short)
        page = blocks(source)
        if len(page) == len(labels) and page:
            pages.append((page, np.array(labels, np.float32)))
    return pages


def train(sources: list[str]) -> Labeller:
    features = Features()
    return Labeller().fit([(features([page]), labels) for page, labels in training_pages(sources)])


def sample(pages: DataFrame, n: int = TRAIN_PAGES) -> list[str]:
    """Sources of at most n pages, those with the smallest hashed ids among pages of ordinary size."""
    fit = pages.filter(F.length("html").between(1, TRAIN_CHARS)).select("html", F.xxhash64("page_id", "url").alias("_at"))
    return [r["html"] for r in fit.orderBy("_at", "html").limit(n).collect()]


def extractor(labeller: Labeller):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for chunk in chunks(batch, "html", CHUNK):
                pages = [blocks(s or "") for s in chunk["html"].to_pylist()]
                lengths = [len(p) for p in pages]
                good = labeller.scores(features(pages), lengths) > 0
                at, texts = 0, []
                for page, n in zip(pages, lengths):
                    texts.append("\n".join(b.text for b, g in zip(page, good[at : at + n].tolist()) if g))
                    at += n
                columns = [chunk["page_id"], chunk["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    labeller = labeller or train(sample(rows))
    return rows.mapInArrow(extractor(labeller), "page_id long, url string, text string, n_chars long")
