"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read once into its leaf blocks: runs of text between block-level tags, with their
ancestors. Each block has features of its ancestors (tags, and words of class, id and role) and
of its text (length, link share, closing punctuation, place on the page). The chain has two
labels, main text and other; it is trained by maximum likelihood (forward-backward gradients in
numpy) and decoded by Viterbi.

Labelled pages are (a) pages composed from the labelled snippets below, and (b) at most
`max_pages` pages of the table that mark their main text themselves (article, main or
role=main): inside that element, but outside any menu, footer, aside, form or marked advert,
comment or notice in it, a block is main text (the element's own header holds its title and is
main text too). So that the model does not lean on the marks alone, every page is used a second
time with the features of its ancestors hidden; a page that has none of the sectioning tags and
none of the marks of the snippets is read by these features.

The pages of (b) are those of the smallest hashes of id and html among pages of at most
`max_page_bytes`, up to `max_blocks` blocks together, so every run draws the same. Chains are
trained in windows of `WINDOW` blocks, so neither time nor memory follows the longest page.

Defined cases: null or empty html, and pages without main text, give ''. Whole pages are read;
nothing is dropped or capped within the main text. Unclosed and misnested tags are repaired
like browsers do in the common cases (paragraphs, list items, table cells; stray end tags are
ignored). An element that is left out but not ended before its parent or the page is read as if
its tag were not there. Repeated rows are read each; extra columns are ignored.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, table_bytes, worker_state

BITS = 14
#: Blocks of a chain that are trained together.
WINDOW = 128
# A comment, a tag with closed quotes, a tag whose quotes do not close, a declaration or a stray end tag.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|</(?![a-zA-Z])[^>]*+>", re.S)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "textarea", "title", "head", "select",
        "annotation", "annotation-xml"}
#: Elements whose content is raw text up to their end tag: nothing inside is a tag.
_TEXT = {"script", "style", "iframe", "textarea", "title"}
#: Of these, the ones whose content is no text for readers even if they do not end.
_CODE = {"script", "style"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
           "br", "img", "wbr", "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot",
           "mstyle", "mpadded", "mphantom", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover",
           "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd"}
#: Start tags that end an open element of the second set (up to the nearest of the third).
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
_SCOPE = {"table", "td", "th", "button", "article", "section", "div", "body", "main", "aside", "nav", "footer", "header", "li", "form"}


class Block:
    __slots__ = ("text", "path", "marks", "linked")

    def __init__(self, text, path, marks, linked):
        self.text, self.path, self.marks, self.linked = text, path, marks, linked


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks of text in page order, white space collapsed, references decoded."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links = at = linked = 0
    # the element that is left out: its name, how often it is open, what is open in it, where its content begins
    skip, hidden, within, begin = None, 0, {}, 0
    read_on: dict[str, int] = {}  # up to where the tags of an element that did not end are ignored

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, tuple(t for t, _ in stack), tuple(m for _, ms in stack for m in ms), linked))
            pieces.clear()
        linked = 0

    def take(raw: str):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text)

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            if skip is None:
                break
            read_on[skip], skip, at = len(page), None, begin
            flush()
            continue
        if skip is None:
            take(page[at:m.start()])
        at = m.end()
        slash, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if name is None:
            continue
        name, closing = name.lower(), bool(slash)
        if skip == "head" and name == "body":  # the head's end tag may be missing
            skip = None
        closed = attributes.rstrip().endswith("/")
        if not closing and name in _TEXT and not (skip == "svg" and closed):
            # the scan goes on behind its end tag, also inside an element that is left out
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            at = end.end() if end else len(page) if name in _CODE else at
            if name == "iframe" and skip is None:
                flush()
            continue
        if skip is not None:
            if name == skip and (closing or not closed):
                hidden += -1 if closing else 1
                if not hidden:
                    skip = None
            elif not closing:
                if not closed and name not in _VOID:
                    within[name] = within.get(name, 0) + 1
            elif within.get(name):
                within[name] -= 1
            elif any(t == name for t, _ in stack):  # its parent ends
                read_on[skip], skip, at = m.start(), None, begin
                flush()
            continue
        if not closing and name in _RAW:
            if m.start() < read_on.get(name, 0):
                flush()
            elif not closed:
                skip, hidden, within, begin = name, 1, {}, at
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in _INLINE:
            flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            links = sum(t == "a" for t, _ in stack)
            continue
        if name in _VOID:
            continue
        if name not in _INLINE:  # an open paragraph ends here
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in _SCOPE:
                    break
        if name in _CLOSES:
            ends, scope = _CLOSES[name]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in ends:
                    del stack[i:]
                    if name != "tr":
                        break
        marks = ()
        if "=" in attributes:
            marks = tuple(w for a in _ATTR.finditer(attributes) for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower()))
        stack.append((name, marks))
        links = sum(t == "a" for t, _ in stack)
    take(page[at:])
    flush()
    return out


def _size(n: int) -> int:
    return min(n.bit_length(), 9)


_slots: dict[str, int] = {}


def _slot(name: str) -> int:
    got = _slots.get(name)
    if got is None:
        if len(_slots) > 200_000:
            _slots.clear()
        got = _slots[name] = zlib.crc32(name.encode()) >> 32 - BITS
    return got


def features(blocks: list[Block], hide: bool = False) -> list[list[int]]:
    """Feature numbers of each block; hide: without its ancestors' names."""
    out = []
    n = len(blocks)
    longest = max((len(b.text) for b in blocks), default=1)
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = 4 * b.linked // max(len(b.text), 1)
        f = ["bias", f"words{_size(words)}", f"links{min(share, 4)}", f"words{_size(words)}links{min(share, 4)}",
             f"place{min(9, 10 * i // n)}", f"left{min(n - 1 - i, 4)}", f"share{4 * len(b.text) // longest}"]
        last = b.text[-1]
        f.append("end." if last in ".!?…\"'»”" else "end:" if last in ":;," else "end")
        f.append(f"stops{min(3, b.text.count('. ') + (last == '.'))}")
        if "©" in b.text or "copyright" in b.text[:200].lower():
            f.append("copyright")
        if not hide:
            f += [f"in:{t}" for t in set(b.path)]
            f += [f"mark:{m}" for m in set(b.marks)]
            f.append(f"leaf:{b.path[-1] if b.path else ''}")
        elif b.path:
            f.append(f"leaf:{b.path[-1]}" if b.path[-1] in ("p", "li", "a", "h1", "h2", "h3", "td", "blockquote", "pre") else "leaf:")
        out.append([_slot(x) for x in f])
    return out


class Chain:
    """Two-label linear-chain CRF; label 1 is main text."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, first: np.ndarray):
        self.emit, self.move, self.first = emit, move, first

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[f].sum(axis=0) for f in feats])

    def decode(self, feats: list[list[int]]) -> list[int]:
        """Viterbi; a tie goes to the smaller label."""
        if not feats:
            return []
        s = self.scores(feats)
        move = self.move
        a0, a1 = s[0, 0] + self.first[0], s[0, 1] + self.first[1]
        back = []
        for e0, e1 in s[1:].tolist():
            f0, f1 = a0 + move[0, 0] >= a1 + move[1, 0], a0 + move[0, 1] >= a1 + move[1, 1]
            back.append((0 if f0 else 1, 0 if f1 else 1))
            a0, a1 = (e0 + (a0 + move[0, 0] if f0 else a1 + move[1, 0]), e1 + (a0 + move[0, 1] if f1 else a1 + move[1, 1]))
        label = [0 if a0 >= a1 else 1]
        for b in reversed(back):
            label.append(b[label[-1]])
        return label[::-1]


class Likelihood:
    """Mean negative log-likelihood of labelled chains, with a quadratic penalty, and its gradient. Chains
    are cut into windows, which advance together, one position at a time."""

    def __init__(self, pages: list[tuple[list[list[int]], list[int]]], l2: float):
        cut = [(fs[a:a + WINDOW], ys[a:a + WINDOW]) for fs, ys in pages for a in range(0, len(ys), WINDOW)]
        self.l2, self.n, self.size = l2, len(cut), max((len(y) for _, y in cut), default=0)
        n, size = self.n, self.size
        lens = np.array([len(y) for _, y in cut], np.int64)
        y = np.zeros((n, size), int)
        for i, (_, ys) in enumerate(cut):
            y[i, :len(ys)] = ys
        flat = [(i * size + t, f) for i, (fs, _) in enumerate(cut) for t, f in enumerate(fs)]
        self.owner = np.repeat(np.array([p for p, _ in flat], np.int64), [len(f) for _, f in flat])
        self.slot = np.fromiter((x for _, f in flat for x in f), np.int64, len(self.owner))
        self.live = np.arange(size)[None, :] < lens[:, None]
        self.total = int(self.live.sum())
        self.gold = np.eye(2)[y] * self.live[..., None]
        self.both = self.live[:, 1:]
        self.pair = np.zeros((2, 2))
        np.add.at(self.pair, (y[:, :-1][self.both], y[:, 1:][self.both]), 1)

    def __call__(self, emit: np.ndarray, move: np.ndarray, first: np.ndarray) -> tuple[float, list[np.ndarray]]:
        n, size, live, owner, slot = self.n, self.size, self.live, self.owner, self.slot

        def lse(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)
        s = np.stack([np.bincount(owner, emit[slot, k], n * size) for k in (0, 1)], axis=1).reshape(n, size, 2)
        a, b = np.zeros((n, size, 2)), np.zeros((n, size, 2))
        a[:, 0] = s[:, 0] + first
        for t in range(1, size):
            a[:, t] = np.where(live[:, t, None], s[:, t] + lse(a[:, t - 1, :, None] + move[None], 1), a[:, t - 1])
        for t in range(size - 2, -1, -1):
            nxt = lse(move[None] + (s[:, t + 1] + b[:, t + 1])[:, None, :], 2)
            b[:, t] = np.where(live[:, t + 1, None], nxt, 0)
        z = lse(a[:, -1], 1)
        one = np.exp(a + b - z[:, None, None]) * live[..., None]
        two = np.exp(a[:, :-1, :, None] + move + (s[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None])
        two = (two * self.both[..., None, None]).sum(axis=(0, 1))
        d = (one - self.gold).reshape(-1, 2)
        total, l2 = self.total, self.l2
        value = (z.sum() - (s * self.gold).sum() - (self.pair * move).sum() - (self.gold[:, 0] * first).sum()) / total
        value += l2 / 2 * sum(float((x * x).sum()) for x in (emit, move, first))
        return float(value), [
            np.stack([np.bincount(slot, d[owner, k], len(emit)) for k in (0, 1)], axis=1) / total + l2 * emit,
            (two - self.pair) / total + l2 * move, (one[:, 0] - self.gold[:, 0]).sum(axis=0) / total + l2 * first]


def train_chain(pages: list[tuple[list[list[int]], list[int]]], steps: int = 120, rate: float = 0.15, l2: float = 1e-3) -> Chain:
    """Maximum likelihood by gradient steps."""
    theta = [np.zeros((1 << BITS, 2)), np.zeros((2, 2)), np.zeros(2)]
    fit = Likelihood(pages, l2)
    if not fit.n:
        return Chain(*theta)
    m = [np.zeros_like(x) for x in theta]
    v = [np.zeros_like(x) for x in theta]
    for step in range(1, steps + 1):
        _, g = fit(*theta)
        for i, x in enumerate(theta):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
            x -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Chain(*theta)


# --- labelled pages -------------------------------------------------------------------

#: Snippets that are not main text; {w} words, {s} a sentence.
OTHER = (
    '<nav><ul><li><a href="/a">{w}</a></li><li><a href="/b">{w}</a></li><li><a href="/c">{w}</a></li></ul></nav>',
    '<div class="menu"><a href="/a">{w}</a> <a href="/b">{w}</a> <a href="/c">{w}</a></div>',
    '<header><div class="logo">{w}</div><p>{w}</p></header>', '<div id="header"><h2>{w}</h2><p>{s}</p></div>',
    '<aside><h3>{w}</h3><ul><li><a href="/x">{w}</a></li><li><a href="/y">{w}</a></li></ul></aside>',
    '<div class="sidebar"><h3>{w}</h3><p>{s}</p></div>', '<aside class="related"><p>{s}</p></aside>',
    '<div class="ad">{s}</div>', '<div class="advert banner"><p>{s}</p></div>', '<div class="sponsored promo">{s} {s}</div>',
    '<div class="cookie notice"><p>{s}</p><button>{w}</button></div>', '<div role="alert" class="notice">{s}</div>',
    '<form action="/q"><label>{w}</label><input name="q"><p>{s}</p><button>{w}</button></form>',
    '<div class="newsletter subscribe"><p>{s}</p></div>', '<div class="share social"><a href="#">{w}</a><a href="#">{w}</a></div>',
    '<div class="breadcrumbs"><a href="/">{w}</a> / <a href="/n">{w}</a></div>',
)
AFTER = (
    '<footer>&copy; {w} {s}</footer>', '<footer><p>{s}</p><p>&copy; {w}</p></footer>', '<div id="footer"><p>&copy; {w} {s}</p></div>',
    '<div class="comments"><h3>{w}</h3><div class="comment"><p>{s} {s}</p></div><div class="comment"><p>{s}</p></div></div>',
    '<section id="comments"><article class="comment"><p>{s} {s}</p></article></section>',
)
MAIN = (
    "<article><h1>{w}</h1>{body}</article>", "<main><h1>{w}</h1>{body}</main>", '<div class="content"><h1>{w}</h1>{body}</div>',
    '<div id="main"><article><h2>{w}</h2>{body}</article></div>', '<div class="post entry"><h1>{w}</h1>{body}</div>',
    "<article><header><h1>{w}</h1></header>{body}</article>", '<section role="main">{body}</section>', "<div><h1>{w}</h1>{body}</div>",
)
BODY = ("<p>{s} {s} {s}</p>", "<p>{s}</p>", "<p>{s} {s} {s} {s} {s}</p>", "<ul><li>{s}</li><li>{s}</li></ul>", "<h2>{w}</h2>",
        "<blockquote>{s} {s}</blockquote>", "<pre>{w} {w}</pre>", "<table><tr><td>{w}</td><td>{w}</td></tr></table>")
_MAIN_MARK = ("article", "main")
_NOT_MAIN = {"nav", "footer", "aside", "form"}
_NOT_MARKS = {"ad", "ads", "advert", "comment", "comments", "notice", "cookie", "sidebar", "menu", "related", "share", "promo", "sponsored"}


_SECTIONS = {"article", "main", "nav", "aside", "header", "footer", "form", "section"}
_KNOWN_MARKS = _NOT_MARKS | {w for x in (*OTHER, *AFTER, *MAIN) for a in _ATTR.finditer(x) for w in _WORD.findall((a[2] or "").lower())}


def unmarked(blocks: list[Block]) -> bool:
    """Whether nothing names the parts of a page."""
    return not any(_SECTIONS.intersection(b.path) or _KNOWN_MARKS.intersection(b.marks) for b in blocks)


def _fill(rng: random.Random, snippet: str) -> str:
    def word():
        return "".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(2, 8)))

    def sentence():
        return " ".join(word() for _ in range(rng.randint(5, 22))).capitalize() + "."
    while "{w}" in snippet:
        snippet = snippet.replace("{w}", " ".join(word() for _ in range(rng.randint(1, 4))), 1)
    while "{s}" in snippet:
        snippet = snippet.replace("{s}", sentence(), 1)
    return snippet


def composed_pages(n: int = 240, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages made of the snippets; main text is known by composition."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        blocks, labels = [], []

        def add(snippet: str, label: int):
            found = leaf_blocks("<body>" + _fill(rng, snippet) + "</body>")
            blocks.extend(found)
            labels.extend([label] * len(found))
        for x in rng.sample(OTHER, rng.randint(0, 4)):
            add(x, 0)
        add(rng.choice(MAIN).replace("{body}", "".join(rng.choice(BODY) for _ in range(rng.randint(0, 9)))), 1)
        for x in rng.sample(OTHER, rng.randint(0, 2)) + rng.sample(AFTER, rng.randint(0, 2)):
            add(x, 0)
        out.append((blocks, labels))
    return out


def _own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its main text; None if it does not."""
    out = [int(any(t in _MAIN_MARK for t in b.path) and not _NOT_MAIN.intersection(b.path) and not _NOT_MARKS.intersection(b.marks))
           for b in blocks]
    return out if any(out) else None


def train(pages: DataFrame, *, max_pages: int = 300, max_page_bytes: int = 1 << 18, max_blocks: int = 12_000,
          id_col: str = "page_id", html_col: str = "html") -> Chain:
    """Fit on the composed pages and on the sample of the table that the module describes: at most
    max_pages pages of at most max_page_bytes, of max_blocks blocks together (a page beyond is left out)."""
    rows = (pick(pages, id=id_col, html=html_col).where(F.octet_length("html") <= max_page_bytes)
            .withColumn("h", F.xxhash64("id", "html")))
    last = rows.select("h").orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    labelled, room = composed_pages(), max_blocks
    if last is not None:
        drawn = rows.where(F.col("h") <= last).select("h", "html").dropDuplicates(["h"]).toArrow().sort_by("h")
        for page in drawn.column("html").to_pylist():
            blocks = leaf_blocks(page)
            labels = _own_labels(blocks)
            if labels and len(blocks) <= room:
                room -= len(blocks)
                labelled.append((blocks, labels))
    return train_chain([(features(b, hide), y) for b, y in labelled for hide in (False, True)])


def extract(pages: DataFrame, chain: Chain, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (blocks labelled main, joined by line breaks), n_blocks, of every row."""
    raw = pickle.dumps((chain.emit, chain.move, chain.first))
    shared, key = table_bytes(pages.sparkSession, raw), zlib.crc32(raw)

    def run(batches):
        kept = worker_state("htmlcrf")
        if kept.get("key") != key:
            kept.update(key=key, chain=Chain(*pickle.loads(shared.value)))
        own = kept["chain"]
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                texts, counts = [], []
                for page in batch.column("html").slice(a, 256):
                    blocks = leaf_blocks(page.as_py())
                    kept = [b.text for b, y in zip(blocks, own.decode(features(blocks, unmarked(blocks)))) if y]
                    texts.append("\n".join(kept))
                    counts.append(len(blocks))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, 256).cast(pa.int64()), batch.column("url").slice(a, 256).cast(pa.string()),
                     pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["page_id", "url", "text", "n_blocks"])

    return pick(pages, id=id_col, url=url_col, html=html_col).mapInArrow(
        run, "page_id long, url string, text string, n_blocks long")
