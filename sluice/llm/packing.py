"""Best-fit packing of token pieces into sequences under several capacities at once.

An item of n tokens demands the vector (n tokens, 1 document, n * n attention cost), and a sequence
has a capacity in each of the three. Vector best-fit takes items by falling length and gives each
to the open sequence that fits under every capacity and scores best:

- score="norm": the smallest weighted norm of what is left after the item;
- score="dot": the largest weighted dot product of the demand with what is left, over the norm
  of what is left (so that an emptier sequence does not win by its size alone).

A sequence is opened only if no open one fits. The weights default to each capacity's scarcity: all
demand over the capacity. Under "norm" a sequence that took an item scores better than its equals
next time, so equal sequences are filled one after the other; the algorithm is therefore run over
classes of equal sequences and lengths with their counts, which gives the sequential result.

Plan: an item's demand follows from its length, so the driver sees the histogram of lengths only
(capacity + 1 rows at most). It answers with segments: items first <= rank < until of a length go,
`each` to a sequence, to consecutive sequences at an offset. A class is made only by a step that
opens sequences or ends a length, and a sequence of n tokens holds under sqrt(2 n) different
lengths, so there are at most 3 * (capacity + 1) * sqrt(2 * capacity) segments of 48 bytes (53 MB
for 4096; 1 MB measured for 278,000 pieces), which are broadcast. The rank of an item among those
of its length is its rank inside the task that wrote it plus the counts of the tasks before; no
length is collected into one task. The counts have up to (capacity + 1) rows a task and grow with
the input, so they are joined by shuffle unless Spark has measured that they are small.

Tokens: the known vocabulary's splitting pattern looks at no more than a run without white space, and some
places in such a run are boundaries whatever stands around them. Whole texts are cut there as byte
arrays, a block of texts at a time. The different parts of a block that are words of Latin-1 letters,
digits or ASCII marks are merged together (`Merges`), the other ones go through the library each, and
the ids of all parts are gathered by numpy, so the cost of a word does not hang on a cache that holds
it. Texts with special tokens go through the library's order of steps one by one, as do all texts
under another tokenizer.

Defined cases: null text is empty, so its piece is the end id alone. A null length counts as 0, and
such an item takes a document's place only. An item beyond a capacity by itself fails the job.
Repeated rows are packed each; extra columns of items go through whatever their names; those of
documents are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, done, pick, q, stage, table_bytes, utf8, worker_state

#: Bytes of pre-tokens and their ids that a worker keeps, in all its caches (two generations of half of
#: it each). An executor has a worker for each core, beside its heap. Over 60 million characters, text by
#: text, the tokenizer was asked 517,000 times with 160 MB, 538,000 with 96 MB, 723,000 with 48, 1,695,000 with 12.
CACHE_BYTES = 96 << 20
#: Code points of a text that are split at a time; cuts are made at white space.
SLICE_CHARS = 1 << 20
#: Bytes of whole texts that are cut into parts together; a longer text is taken by slices.
#: Over 173 MB of texts in blocks of 1 MB 7.8 million parts are looked up, 5.1 million in blocks of 4 MB.
TEXT_BYTES = 4 << 20
#: Bytes of the longest words whose ids are made together, and how many words at a time.
WORD_BYTES, WORD_ROWS = 64, 16384
#: Bytes of ids in an output batch, unless one document has more.
BATCH_BYTES = 4 << 20

# Fixed values of the public lower-casing word vocabulary: its splitting pattern, and the same over
# lower-cased texts of the characters below, whose classes and cases do not depend on Unicode versions.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_FAST = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ƿ]+|[0-9²³¹¼-¾]|[^\\s0-9a-zªµºß-öø-ƿ²³¹¼-¾]+")
_ODD = re.compile("[^\x00-\x1b\x20-\xffĀ-įĲ-ſ–—‘’“”…€]")
_SPACE = re.compile(r"[ \t\n]")
# where a slice of bytes may end: at white space, or at some of the boundaries of `_boundaries`
_SLICE_END = re.compile(rb"[ \t\n]|[0-9](?=[!-~])|[A-Za-z](?=[!-@\[-`{-~])")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 characters
    stand for themselves, the others take code points from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


_OTHER, _SPACES, _LETTER, _DIGIT, _MARK, _QUOTE = range(6)


def _boundaries() -> tuple[np.ndarray, np.ndarray]:
    """Kind of each byte, and whether a part begins between two kinds (8 * the first + the second).

    White space is left out. Elsewhere a part begins only where the pattern ends a match whatever stands
    around: an apostrophe may go on into the letters behind it, and beside bytes that are neither visible
    ASCII characters nor Latin-1 letters (see `_kinds`) nothing is certain."""
    kind = np.full(256, _OTHER, np.uint8)
    for c in range(128):
        if chr(c) in " \t\n\v\f\r":
            kind[c] = _SPACES
        elif 32 < c < 127:
            kind[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _QUOTE if c == 39 else _MARK
    begins = np.zeros(64, bool)
    begins[[8 * _SPACES + b for b in (_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE)]] = True
    for a, after in ((_LETTER, (_DIGIT, _MARK, _QUOTE)), (_DIGIT, (_LETTER, _DIGIT, _MARK, _QUOTE)),
                     (_MARK, (_LETTER, _DIGIT)), (_QUOTE, (_DIGIT,))):
        begins[[8 * a + b for b in after]] = True
    return kind, begins


_KIND, _BEGINS = _boundaries()
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _kinds(text: np.ndarray) -> np.ndarray:
    """Kind of each byte of whole UTF-8 texts. C3 leads U+00C0 to U+00FF: letters but for U+00D7 and U+00F7."""
    kind = _KIND[text]
    lead = np.flatnonzero(text == 0xC3)
    second = text[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


class Merges:
    """Byte-level BPE of many words at once: in each round every unfinished word merges its pair of lowest
    rank (ties: the leftmost), as the library does with one word. Raises KeyError if a byte has no token."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, model: dict, letters: list[str]):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        ranks = {vocab[a] << 32 | vocab[b]: i for i, (a, b) in enumerate(pairs)}
        # open addressing: a pair is at its slot or behind it, before the first empty one
        bits = max(4, (4 * len(ranks)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.NONE, np.int32)
        key, rank = np.array([*ranks], np.int64), np.array([*ranks.values()], np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[free]
            here = self.keys[slot] == key
            self.ranks[slot[here]] = rank[here]
            key, rank, slot = key[~here], rank[~here], (slot[~here] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE if it is not merged (-1 stands for no id)."""
        key = a.astype(np.int64) << 32 | b
        slot = self._slot(key)
        found, out = self.keys[slot], self.ranks[slot]
        wrong = np.flatnonzero(found != key)
        out[wrong] = self.NONE
        wrong = wrong[found[wrong] != -1]
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            found = self.keys[slot[wrong]]
            here = found == key[wrong]
            out[wrong[here]] = self.ranks[slot[wrong[here]]]
            wrong = wrong[~here & (found != -1)]
        return out

    def __call__(self, words: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Ids of the words in the rows of a byte matrix (two columns at least), -1 behind them."""
        n, width = words.shape
        col, row = np.arange(width, dtype=np.int8), np.arange(n)
        ids = self.inner[words]
        ids[row, length - 1] = self.last[words[row, length - 1]]
        ids[col >= length[:, None]] = -1
        rank = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        out = ids.copy()
        while True:
            at = rank.argmin(1)
            best = rank[np.arange(len(at)), at]
            go = best < self.NONE
            if not go.all():
                out[row[~go]] = ids[~go]
                row, ids, rank, at, best = row[go], ids[go], rank[go], at[go], best[go]
            if not len(row):
                return out
            i = np.arange(len(row))
            ids[i, at] = self.made[best]
            behind = col[:-1] > at.astype(np.int8)[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = self.NONE
            rank[i, at] = self.rank(ids[i, at], ids[i, at + 1])
            i = np.flatnonzero(at)
            rank[i, at[i] - 1] = self.rank(ids[i, at[i] - 1], ids[i, at[i]])


class _Group(list):
    """Caches that share one limit, and the bytes charged to them in this generation."""
    size = 0


class _Cache(dict):
    """Piece -> ids as little-endian bytes; what was not met for a generation is forgotten.

    The caches of a group share one limit and begin a generation together."""

    def __init__(self, make, group: _Group):
        super().__init__()
        self.make, self.old, self.group = make, {}, group
        group.append(self)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
            if len(piece) > 64:
                return ids
        group = self.group
        if group.size > CACHE_BYTES // 2:
            for c in group:
                c.old = {}
                c.old = dict(c)
                c.clear()
            group.size = 0
        group.size += 70 + sys.getsizeof(piece) + sys.getsizeof(ids)
        self[piece] = ids
        return ids


class TokenIds:
    """Ids of whole texts as the tokenizers library gives them (no special tokens added, those inside a
    text found as by default), by looking up each pre-token once."""

    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer
        spec = json.loads(tokenizer)
        added = spec.get("added_tokens", ())
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        if spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
            raise ValueError("a tokenizer without post-processing, truncation and padding is needed")
        library = Tokenizer.from_str(tokenizer.decode("utf-8"))
        self.library = library  # owns the model
        self.model, self.normalizer, self.splitter = library.model, library.normalizer, library.pre_tokenizer
        self.special = {t["content"]: self._bytes([t["id"]]) for t in added}
        self.find = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        self.find_bytes = re.compile(self.find.pattern.encode()) if added else None
        self.letters = _byte_letters()
        caches = _Group()
        self.pieces, self.words = _Cache(self._piece, caches), _Cache(self._word, caches)
        self.parts = _Cache(self._part, caches)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())
        forms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", ())]
        self.fast = (forms == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
                     and steps[0]["pattern"] == {"Regex": WORD_PATTERN} and steps[0]["invert"]
                     and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])
        model, self.merges = spec["model"], None
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if self.fast and model["type"] == "BPE" and plain and model.get("end_of_word_suffix"):
            self.merges = Merges(model, self.letters)

    @staticmethod
    def _bytes(ids) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._bytes([t.id for t in self.model.tokenize(piece)])

    def _word(self, word: str) -> bytes:
        if not word.isascii() or not word.isprintable():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return self._piece(word)

    def _plain(self, text: str) -> bytes:
        if self.fast and not _ODD.search(text):
            return b"".join(map(self.words.__getitem__, _FAST.findall(text.lower())))
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if self.splitter is None:
            return self._piece(text) if text else b""
        return b"".join([self.pieces[p] for p, _ in self.splitter.pre_tokenize_str(text)])

    def _part(self, part: str) -> bytes:
        if _ODD.search(part):
            return self._plain(part)
        low = part.lower()
        if low != part:
            return self.parts[low]
        return self._word(part) if part.isalpha() else b"".join(map(self.words.__getitem__, _FAST.findall(part)))

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a string column (null: empty), as a call for each gives them."""
        if self.merges is None:
            for text in column:
                yield self(text.as_py() or "")
            return
        data, offsets = utf8(column)
        for a, b in blocks(offsets, TEXT_BYTES):
            text, at, alone = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], {}
            if self.find_bytes is not None and self.find_bytes.search(text):
                alone = {i: text[x:y].tobytes().decode() for i, (x, y) in enumerate(zip(at.tolist(), at[1:].tolist()))
                         if self.find_bytes.search(text, x, y)}
                text = text.copy()
                for i in alone:
                    text[at[i]:at[i + 1]] = 32
            if b == a + 1 and not alone:
                yield b"".join([x for piece in self._byte_slices(text) for x in self._block(piece, np.array([0, len(piece)]))])
                continue
            for i, ids in enumerate(self._block(text, at)):
                yield self(alone[i]) if i in alone else ids

    @staticmethod
    def _byte_slices(text: np.ndarray) -> Iterator[np.ndarray]:
        a = 0
        while a < len(text):
            cut = _SLICE_END.search(text, a + TEXT_BYTES)
            b = cut.end() if cut else len(text)
            yield text[a:b]
            a = b

    def _block(self, text: np.ndarray, at: np.ndarray) -> Iterator[bytes]:
        """Ids of the texts between the byte positions `at`."""
        kind = _kinds(text)
        pair = kind.copy()
        pair[1:] |= kind[:-1] << 3
        first = at[:-1][at[:-1] < at[1:]]
        pair[first] = kind[first] | _SPACES << 3
        begins, keep = _BEGINS[pair], kind != _SPACES
        kept = text[keep]
        bounds = np.append(np.flatnonzero(begins[keep]), len(kept)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(kept)).dictionary_encode()
        ids, start, size = self._part_ids(parts.dictionary)
        which = parts.indices.to_numpy()
        n = size[which]
        end = np.append(0, np.cumsum(n))
        every = ids[np.repeat(start[which] - end[:-1], n) + np.arange(end[-1])]
        cuts = end[np.searchsorted(np.flatnonzero(begins), at)].tolist()
        for lo, hi in zip(cuts, cuts[1:]):
            yield every[lo:hi].tobytes()

    def _part_ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different parts, and where those of each begin and how many they are."""
        data, offsets = utf8(parts)
        length = np.diff(offsets)
        start, size = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        # words in the pattern's sense, whose bytes lower-case one by one: letters, a digit, or other visible characters
        kinds = np.bitwise_or.reduceat(np.uint8(1) << _kinds(data), offsets[:-1]) if len(parts) else np.zeros(0, np.uint8)
        word = (kinds == 1 << _LETTER) | (kinds == 1 << _DIGIT) | (kinds & ~np.uint8(1 << _MARK | 1 << _QUOTE) == 0)
        low = _LOWER[data]
        accent = np.flatnonzero(data == 0xC3) + 1
        low[accent[data[accent] < 0x9F]] += 32
        low = np.append(low, np.zeros(WORD_BYTES, np.uint8))
        found, at, least = [], 0, 1
        for width in (4, 6, 8, 10, 12, 16, 24, 32, WORD_BYTES):
            fit = np.flatnonzero(word & (length >= least) & (length <= width))
            for k in range(0, len(fit), WORD_ROWS):
                these = fit[k:k + WORD_ROWS]
                ids = self.merges(low[offsets[these][:, None] + np.arange(width)], length[these])
                size[these], start[these] = (ids >= 0).sum(1), at + np.arange(len(these)) * width
                found.append(ids.ravel())
                at += ids.size
            least = width + 1
        rest = np.flatnonzero(~word | (length > WORD_BYTES))
        own = [self.parts[p] for p in parts.take(pa.array(rest)).to_pylist()]
        size[rest] = [len(x) // 4 for x in own]
        start[rest] = at + np.cumsum(size[rest]) - size[rest]
        return np.concatenate([*found, np.frombuffer(b"".join(own), "<u4").astype(np.int32)]).astype("<u4"), start, size

    def __call__(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.find is None or not self.find.search(text):
            return b"".join(map(self._plain, self._slices(text)))
        out, at = [], 0
        for m in self.find.finditer(text):
            out += [*map(self._plain, self._slices(text[at:m.start()])), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, *map(self._plain, self._slices(text[at:]))])

    def _slices(self, text: str):
        if not self.fast or len(text) <= SLICE_CHARS:  # only this pattern is known to keep no white space
            yield text
            return
        a = 0
        while a < len(text):
            cut = _SPACE.search(text, a + SLICE_CHARS)
            b = cut.end() if cut else len(text)
            yield text[a:b]
            a = b


def _token_ids(tokenizer: bytes) -> TokenIds:
    key, kept = (len(tokenizer), zlib.crc32(tokenizer)), worker_state("packing")
    if kept.get("key") != key:
        kept.update(key=key, ids=TokenIds(tokenizer))
    return kept["ids"]


def token_pieces(docs: DataFrame, tokenizer: bytes, *, capacity: int = 4096, end_id: int | None = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit integers) of every document, with
    end_id behind its own ids. Only documents of more than `capacity` ids are cut.

    tokenizer: content of a tokenizers .json file, read on the driver."""
    shared = table_bytes(docs.sparkSession, tokenizer)
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    step = 4 * capacity

    def run(batches):
        ids = _token_ids(shared.value)
        end = b"" if end_id is None else ids._bytes([end_id])
        cols, size = [[] for _ in range(5)], 0

        def out():
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "piece", "start", "length", "ids"])
            for c in cols:
                c.clear()
            return got
        for batch in batches:
            for doc, own in zip(batch.column("id").to_pylist(), ids.texts(batch.column("text"))):
                all_ids = own + end
                for n, a in enumerate(range(0, max(len(all_ids), 1), step)):
                    part = all_ids[a:a + step]
                    size += len(part) + 40
                    for c, v in zip(cols, (doc, n, a // 4, len(part) // 4, part)):
                        c.append(v)
                    if size > BATCH_BYTES:
                        yield out()
                        size = 0
        if cols[0]:
            yield out()
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents (pieces), and attention cost (the sum of squared lengths).
    The defaults of the last two follow from the first and never bind."""
    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        tokens, documents, attention = astuple(self)
        return np.array([tokens, tokens if documents is None else documents,
                         tokens * tokens if attention is None else attention], np.int64)


def best_fit(lengths: dict[int, int], capacity: Capacity = Capacity(), *, score: str = "norm",
             weights: tuple[float, float, float] | None = None) -> tuple[np.ndarray, int]:
    """Segments (length, first, until, each, sequence, offset) and the number of sequences, for `lengths`
    items of each length."""
    if score not in ("norm", "dot"):
        raise ValueError("score is 'norm' or 'dot'")
    cap = capacity.vector()

    def demand(n: int) -> np.ndarray:
        return np.array([n, 1, n * n], np.int64)
    for n in lengths:
        if (demand(n) > cap).any():
            raise ValueError(f"an item of length {n} is beyond a capacity: {capacity}")
    w = np.array(weights, float) if weights else sum((demand(n) * float(c) for n, c in lengths.items()), np.zeros(3)) / cap
    room = max(64, 4 * len(lengths) + 8)
    left, count, first_seq = np.zeros((room, 3), np.int64), np.zeros(room, np.int64), np.zeros(room, np.int64)
    used, sequences, segments = 0, 0, []

    def add(residual, n, seq):
        nonlocal used
        left[used], count[used], first_seq[used] = residual, n, seq
        used += 1
    for n in sorted(lengths, reverse=True):
        x, todo, rank = demand(n), lengths[n], 0
        while todo:
            fits = np.flatnonzero((left[:used] >= x).all(1) & (count[:used] > 0))
            if len(fits):
                r = left[fits] / cap
                if score == "norm":
                    at = fits[np.argmin(((r - x / cap) ** 2) @ w)]
                else:
                    at = fits[np.argmax((r * (x / cap)) @ w / np.sqrt((r * r) @ w + 1e-300))]
            else:
                at = used
                each = int(np.min(cap[x > 0] // x[x > 0]))
                if used + 3 > len(count):
                    left, count, first_seq = (np.concatenate([a, np.zeros_like(a)]) for a in (left, count, first_seq))
                add(cap, -(-todo // each), sequences)
                sequences += int(count[at])
            if used + 3 > len(count):
                left, count, first_seq = (np.concatenate([a, np.zeros_like(a)]) for a in (left, count, first_seq))
            residual, seq = left[at].copy(), int(first_seq[at])
            each = int(np.min(residual[x > 0] // x[x > 0]))
            offset = int(cap[0] - residual[0])
            full = min(int(count[at]), todo // each)
            rest = todo - full * each if full < count[at] else 0
            if full:
                segments.append((n, rank, rank + full * each, each, seq, offset))
            if rest:
                segments.append((n, rank + full * each, rank + full * each + rest, rest, seq + full, offset))
                add(residual - rest * x, 1, seq + full)
            if full:
                add(residual - each * x, full, seq)
            taken = full + bool(rest)
            count[at] -= taken
            first_seq[at] += taken
            rank += full * each + rest
            todo -= full * each + rest
        # classes that are used up, or too full for anything that comes, need no look again
        live = np.flatnonzero(count[:used] > 0)
        for a in (left, count, first_seq):
            a[:len(live)] = a[live]
        used = len(live)
    return np.array(segments, np.int64).reshape(-1, 6), sequences


_SEGMENT = T.StructType([T.StructField(f"__sl_{c}", T.LongType()) for c in ("len", "first", "until", "each", "seq", "off")])


def pack(items: DataFrame, *, length_col: str = "length", capacity: Capacity = Capacity(), score: str = "norm",
         weights: tuple[float, float, float] | None = None, seq_col: str = "sequence_id",
         offset_col: str = "offset") -> DataFrame:
    """The items with their sequence and the place of their first token in it (gapless from 0).

    Columns of items that have the names of the two new ones are replaced."""
    spark, names = items.sparkSession, [c for c in items.columns if c.lower() not in (seq_col.lower(), offset_col.lower())]
    tagged = stage(items.select(*[q(c) for c in names], F.coalesce(q(length_col).cast("long"), F.lit(0)).alias("__sl_len"),
                                F.spark_partition_id().alias("__sl_pid"), F.monotonically_increasing_id().alias("__sl_at")), "pack-items")
    # counted twice from two columns, not written: Spark would broadcast a written table by the size of its compressed
    # files (10 MB in memory for 278,000 items), and it would have as many files as there are shuffle partitions
    counts = tagged.groupBy("__sl_len", "__sl_pid").agg(F.count(F.lit(1)).alias("__sl_n"))
    # no more than tokens + 1 lengths are valid, and the longest come first
    histogram = (counts.groupBy("__sl_len").agg(F.sum("__sl_n").alias("n")).orderBy(F.col("__sl_len").desc())
                 .limit(capacity.tokens + 2).collect())
    segments, _ = best_fit({r["__sl_len"]: r["n"] for r in histogram}, capacity, score=score, weights=weights)
    done(spark)
    table = pa.Table.from_arrays([pa.array(c) for c in segments.T], names=_SEGMENT.fieldNames())
    plan = F.broadcast(spark.createDataFrame(table, _SEGMENT))

    before = Window.partitionBy("__sl_len").orderBy("__sl_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("__sl_len", "__sl_pid", F.coalesce(F.sum("__sl_n").over(before), F.lit(0)).alias("__sl_base"))
    nth = F.row_number().over(Window.partitionBy("__sl_len", "__sl_pid").orderBy("__sl_at")) - 1
    ranked = (tagged.withColumn("__sl_nth", nth).join(base, ["__sl_len", "__sl_pid"])
              .withColumn("__sl_rank", F.col("__sl_base") + F.col("__sl_nth")))
    p = {c: plan[f"__sl_{c}"] for c in ("first", "until", "each", "seq", "off")}
    x = ranked["__sl_rank"] - p["first"]
    placed = ranked.join(plan, (ranked["__sl_len"] == plan["__sl_len"]) & (ranked["__sl_rank"] >= p["first"])
                         & (ranked["__sl_rank"] < p["until"]))
    return placed.select(*[ranked[f"`{c.replace('`', '``')}`"] for c in names],
                         (p["seq"] + F.floor(x / p["each"])).cast("long").alias(seq_col),
                         (p["off"] + (x % p["each"]) * ranked["__sl_len"]).cast("long").alias(offset_col))


def sequences(packed: DataFrame, *, ids_col: str = "ids") -> DataFrame:
    """sequence_id, length, documents (doc_id, piece, offset, length in order), ids: the packed sequences
    themselves. A group holds at most a sequence's capacity of tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", q(ids_col).alias("ids"))))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, i: a + i["length"]).alias("length"),
        F.transform("p", lambda i: F.struct(i["doc_id"].alias("doc_id"), i["piece"].alias("piece"), i["offset"].alias("offset"),
                                            i["length"].alias("length"))).alias("documents"),
        F.aggregate("p", F.lit(b""), lambda a, i: F.concat(a, i["ids"])).alias("ids"))
