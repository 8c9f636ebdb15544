"""Byte-level BPE: encoding by a lazily determinised finite-state transducer, streaming decoding.

Encoding. A state of the transducer is the string of bytes read since the last token boundary
that is certain. Reading a byte gives the next state and the tokens that have become certain.
A boundary is certain once every way the text can go on passes through it: the only positions
at which a later token can still start are those whose bytes up to here begin some vocabulary
entry, so the lookahead is bounded by the longest entry. (If a boundary is in the final
encoding, both sides encode independently of each other; that also makes the pending bytes
alone a complete state.) Merges are compiled into transitions when a state first meets a byte.

Decoding. `Utf8Machine` walks UTF-8 by an automaton of nine states and holds back an
unfinished character between pieces; `stream_decode` yields text as soon as it is complete.

Text is first split by the public pattern; a piece that is itself a vocabulary entry is that
entry, as in the tiktoken library. Null text is empty and gives no ids. Repeated rows are
encoded each; extra columns are ignored. Memory in a task is bounded by `CACHE_PIECES`
and `CACHE_STEPS`, plus a few documents.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, table_bytes, worker_state

#: The pattern that public byte-level vocabularies split text by (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same over texts of the characters below, where the standard library's classes agree.
_FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
_ODD = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏЀ-ԯ‐-‧€]")
#: Pieces (of the younger of two generations) and transitions that a worker keeps; beyond it the
#: pieces that were not met again are forgotten, and transitions are compiled anew.
CACHE_PIECES, CACHE_STEPS = 150_000, 600_000


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Vocabulary of a .tiktoken file: one base64 entry and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Splitter:
    """Pieces of a text under PATTERN; together they are the whole text."""

    def __init__(self):
        import regex
        self.full = regex.compile(PATTERN)

    def __call__(self, text: str) -> list[str]:
        return (self.full if _ODD.search(text) else _FAST).findall(text)


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t))}
        self.clear()

    def clear(self) -> None:
        # pending bytes of each state, and for each live position its boundaries (None: start state)
        self.pending: list[bytes] = [b""]
        self.live: list[tuple[tuple[int, tuple[int, ...]], ...]] = [((0, (0,)),)]
        self.number = {b"": 0}
        self.step: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _boundaries(self, piece: bytes) -> tuple[int, ...]:
        """Token boundaries of a short string, merging the lowest rank first."""
        cuts, ranks = list(range(len(piece) + 1)), self.ranks
        while len(cuts) > 2:
            best, at = None, 0
            for i in range(len(cuts) - 2):
                r = ranks.get(piece[cuts[i]:cuts[i + 2]])
                if r is not None and (best is None or r < best):
                    best, at = r, i + 1
            if best is None:
                break
            del cuts[at]
        return tuple(cuts)

    def _determinise(self, key: int) -> tuple[int, tuple[int, ...]]:
        state, byte = key >> 8, key & 255
        word = self.pending[state] + bytes([byte])
        n = len(word)
        live = [x for x in self.live[state] if word[x[0]:] in self.prefixes]
        own = self._boundaries(word)
        live.append((n, own))
        common = set(own).intersection(*[c for _, c in live])
        cut = max(common)
        if cut == n:  # a boundary here only if nothing can still reach across it
            cut = n if len(live) == 1 else max(common - {n})
        path = [c for c in own if c <= cut]
        out = tuple(self.ranks[word[a:b]] for a, b in zip(path, path[1:]))
        rest = word[cut:]
        to = self.number.get(rest)
        if to is None:
            to = self.number[rest] = len(self.pending)
            self.pending.append(rest)
            self.live.append(tuple((i - cut, tuple(c - cut for c in chain if c >= cut)) for i, chain in live if i >= cut))
        self.step[key] = (to, out)
        return to, out

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.step) > CACHE_STEPS:
            self.clear()
        state, out, step = 0, [], self.step
        for byte in piece:
            key = state << 8 | byte
            got = step.get(key)
            if got is None:
                got = self._determinise(key)
            state = got[0]
            if got[1]:
                out.extend(got[1])
        if state:
            rest = self.pending[state]
            cuts = self.live[state][-1][1]  # the position after all pending bytes is the last
            out.extend(self.ranks[rest[a:b]] for a, b in zip(cuts, cuts[1:]))
        return out


class Encoder:
    """ids of whole texts, with a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.machine, self.split = Transducer(ranks), Splitter()
        self.cache, self.older = {}, {}

    def packed(self, text: str) -> bytes:
        """ids as little-endian unsigned 32-bit integers."""
        cache, out = self.cache, []
        for piece in self.split(text):
            ids = cache.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    found = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
                    ids = pack(f"<{len(found)}I", *found)
                if len(cache) >= CACHE_PIECES:
                    self.older, self.cache = cache, {}
                    cache = self.cache
                cache[piece] = ids
            out.append(ids)
        return b"".join(out)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u4")


class Utf8Machine:
    """Deterministic automaton of UTF-8: 0 between characters, 1-3 bytes to come, 4-7 after
    E0, ED, F0, F4 (whose second byte is restricted), 8 after an error."""

    def __init__(self):
        t = np.full((9, 256), 8, np.uint8)
        t[0, :0x80] = 0
        t[0, 0xC2:0xE0], t[0, 0xE1:0xF0], t[0, 0xF1:0xF4] = 1, 2, 3
        t[0, 0xE0], t[0, 0xED], t[0, 0xF0], t[0, 0xF4] = 4, 5, 6, 7
        t[1, 0x80:0xC0], t[2, 0x80:0xC0], t[3, 0x80:0xC0] = 0, 1, 2
        t[4, 0xA0:0xC0], t[5, 0x80:0xA0] = 1, 1
        t[6, 0x90:0xC0], t[7, 0x80:0x90] = 2, 2
        self.next = t

    def run(self, state: int, data: bytes) -> int:
        for b in data:
            state = int(self.next[state, b])
        return state

    def over(self, tokens: list[bytes]) -> list[bytes]:
        """Of each token, the state it leads to from each state."""
        start = bytes(range(9))
        rows = self.next.T.tobytes()
        step = [rows[9 * b:9 * b + 9] + bytes(247) for b in range(256)]
        out = []
        for t in tokens:
            now = start
            for b in t:
                now = now.translate(step[b])
            out.append(now)
        return out


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.token: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, r in ranks.items():
            self.token[r] = t
        self.machine = Utf8Machine()
        self.moves = self.machine.over(self.token)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def stream(self, pieces: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of the ids in pieces; an unfinished character waits for the next piece. Bytes that
        are not UTF-8 become replacement characters."""
        held, state = b"", 0
        for ids in pieces:
            ids = list(ids)
            for i in ids:
                state = self.moves[i][state]
            data = held + self.decode(ids)
            if state == 8:
                state = 0
                for n in range(min(3, len(data)), 0, -1):  # does an unfinished character end here?
                    if 0 < (s := self.machine.run(0, data[-n:])) < 8:
                        state = s
                        break
            cut = len(data)
            if state:
                cut -= 1
                while data[cut] & 0xC0 == 0x80:
                    cut -= 1
            held = data[cut:]
            if cut:
                yield data[:cut].decode("utf-8", "replace")
        if held:
            yield held.decode("utf-8", "replace")


def _coders(vocabulary: bytes) -> tuple[Encoder, Decoder]:
    """A worker process keeps its compiled transitions from task to task."""
    kept, key = worker_state("bpe"), (len(vocabulary), zlib.crc32(vocabulary))
    if key not in kept:
        kept.clear()
        ranks = load_ranks(vocabulary)
        kept[key] = Encoder(ranks), Decoder(ranks)
    return kept[key]


def byte_bpe(docs: DataFrame, vocabulary: bytes, *, id_col: str = "doc_id", text_col: str = "text",
             piece_ids: int = 65536) -> DataFrame:
    """Per row: doc_id, ids (packed little-endian uint32), n_tokens, decoded (text of the streaming
    decoder). `vocabulary` is the content of a .tiktoken file, read on the driver and broadcast."""
    shared = table_bytes(docs.sparkSession, vocabulary)

    def run(batches):
        encoder, decoder = _coders(shared.value)
        for batch in batches:
            texts = batch.column("text")
            for lo in range(0, batch.num_rows, 256):
                packed = [encoder.packed(t.as_py() or "") for t in texts.slice(lo, 256)]
                ids = [np.frombuffer(p, "<u4") for p in packed]
                text = ["".join(decoder.stream(x[i:i + piece_ids].tolist() for i in range(0, len(x), piece_ids)))
                        for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, 256).cast(pa.int64()), pa.array(packed, pa.binary()),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array(text, pa.string())],
                    names=["doc_id", "ids", "n_tokens", "decoded"])

    return pick(docs, id=id_col, text=text_col).mapInArrow(
        run, "doc_id long, ids binary, n_tokens long, decoded string")
