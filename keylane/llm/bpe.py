"""Byte-level BPE as a tree reduction.

Encodings of neighbouring parts of a text form a monoid: two are joined by
encoding a window around their boundary again, and the window grows until the
tokens outside cannot change. A text is cut in halves down to leaves, leaves
are encoded alone, and halves are joined up the tree; decoding concatenates up
the same tree. There are two levels, with a proof each:

- Between the pieces of the splitting pattern: no alternative of the pattern
  matches a blank character after one that is not blank, and none looks past
  such a place. So a place after a non-blank and before a blank character
  always separates pieces, whatever is on either side.
- Between the tokens of a piece: a row of tokens is the encoding of its bytes
  if and only if each two neighbours are the encoding of their own bytes. So a
  window is wide enough once its first and last tokens agree with the tokens
  beside it.

By the first rule the text between two single blanks is a leaf of its own, which
is remembered; the leaves that a group of texts has and no earlier one had are
encoded together, a merge of every piece at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import documents, small_batches, text_or_empty

#: Bytes of a piece that are merged without halving, code points of a text that are split at once, tokens decoded at once.
LEAF_BYTES, LEAF_CHARS, LEAF_TOKENS = 64, 1 << 16, 1 << 16
#: Pieces of at most LEAF_BYTES remembered by a task.
_REMEMBERED = 1 << 18
#: Code points of the texts whose unknown pieces are merged together.
AT_ONCE = 1 << 20
_NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with a base64 token and a rank in each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def packed(tokens: list[int]) -> bytes:
    """Tokens as little-endian unsigned 32-bit integers."""
    return np.array(tokens, "<u4").tobytes()


class Pieces(dict):
    """Pieces of text and their packed tokens: a cache that encodes what it lacks."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF_BYTES) -> None:
        super().__init__()
        self.ranks, self.leaf = ranks, leaf
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __missing__(self, piece: str) -> bytes:
        found = packed(self.encode(piece.encode()))
        if len(piece) <= LEAF_BYTES:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[piece] = found
        return found

    def encode(self, body: bytes) -> list[int]:
        whole = self.ranks.get(body)
        if whole is not None:
            return [whole]
        if len(body) <= self.leaf:
            return self.merge(body)
        half = len(body) // 2
        return self.join(self.encode(body[:half]), self.encode(body[half:]))

    def merge(self, body: bytes) -> list[int]:
        """Merge the pair with the lowest rank, the first of equals, until no pair is a token."""
        if len(body) > LEAF_BYTES:
            return self.merge_long(body)
        parts = [body[i: i + 1] for i in range(len(body))]
        rank_of, none = self.ranks.get, 1 << 60
        ranks = [rank_of(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) < none:
            at = ranks.index(lowest)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def merge_long(self, body: bytes) -> list[int]:
        """As merge, with a heap of pairs over a linked list of parts."""
        ranks, n = self.ranks, len(body)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once the part is gone
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(body[i: i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, to = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != to:
                continue  # one of the pair has changed since
            end[i], end[middle] = to, 0
            if to < n:
                before[to] = i
                if (rank := ranks.get(body[i: end[to]])) is not None:
                    heappush(heap, (rank, i, end[to]))
            if i and (rank := ranks.get(body[before[i]: to])) is not None:
                heappush(heap, (rank, before[i], to))
        out, i = [], 0
        while i < n:
            out.append(ranks[body[i: end[i]]])
            i = end[i]
        return out

    def remember(self, pieces: set[str]) -> None:
        """Encode unknown pieces of at most LEAF_BYTES together; the caller sees to it that they are not too many."""
        if len(self) + len(pieces) > _REMEMBERED:
            self.clear()
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            body = piece.encode()
            if (rank := self.ranks.get(body)) is not None:
                self[piece] = rank.to_bytes(4, "little")
            elif len(body) <= LEAF_BYTES:
                by_width.setdefault(max(8, 1 << (len(body) - 1).bit_length()), []).append((piece, body))
        for width, found in by_width.items():
            self.update(zip((piece for piece, _ in found), self.merge_many([body for _, body in found], width), strict=True))

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The token of each byte, and which two tokens together are a token: sorted keys and their ranks."""
        if self.pairs is None:
            rank_of, keys, ranks = self.ranks.get, [], []
            for token, rank in self.ranks.items():
                for i in range(1, len(token)):
                    if (a := rank_of(token[:i])) is not None and (b := rank_of(token[i:])) is not None:
                        keys.append(a << 32 | b)
                        ranks.append(rank)
            held = np.array(keys, np.int64)
            order = np.argsort(held)
            singles = np.array([rank_of(bytes([i]), -1) for i in range(256)], np.int64)
            # a key above all others, so that every search ends at one
            self.pairs = singles, np.append(held[order], _NONE), np.append(np.array(ranks, np.int64)[order], _NONE)
        return self.pairs

    def merge_many(self, bodies: list[bytes], width: int) -> list[bytes]:
        """As merge, for many bodies of at most ``width`` bytes at once, packed: each step merges one pair of every body left."""
        singles, keys, ranks_of = self._pairs()
        count = np.fromiter(map(len, bodies), np.int64, len(bodies))
        raw = np.frombuffer(b"".join(body.ljust(width, b"\0") for body in bodies), np.uint8).reshape(-1, width)
        tokens = singles[raw]
        columns = np.arange(width)

        def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            key = a << 32 | b
            at = np.searchsorted(keys, key)
            return np.where(keys[at] == key, ranks_of[at], _NONE)

        # the rank of each token and the next one
        pairs = np.full(tokens.shape, _NONE)
        pairs[:, :-1] = np.where(columns[1:] < count[:, None], rank(tokens[:, :-1], tokens[:, 1:]), _NONE)
        left = np.flatnonzero(pairs.min(axis=1) < _NONE)
        while len(left):
            now, beside = tokens[left], pairs[left]
            row, at = np.arange(len(left)), beside.argmin(axis=1)
            now[row, at] = beside[row, at]
            now = np.take_along_axis(now, np.minimum(columns + (columns > at[:, None]), width - 1), 1)
            beside = np.take_along_axis(beside, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            beside[:, -1] = _NONE
            size = count[left] - 1
            after = np.minimum(at + 1, width - 1)
            beside[row, at] = np.where(at + 1 < size, rank(now[row, at], now[row, after]), _NONE)
            inner = np.flatnonzero(at > 0)
            place = at[inner]
            beside[inner, place - 1] = rank(now[inner, place - 1], now[inner, place])
            tokens[left], pairs[left], count[left] = now, beside, size
            left = left[beside.min(axis=1) < _NONE]
        body, stride = tokens.astype("<u4").tobytes(), 4 * width
        return [body[i * stride: i * stride + 4 * n] for i, n in enumerate(count.tolist())]

    def agree(self, a: int, b: int) -> bool:
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both parts together, by merging a growing window of tokens around the boundary."""
        wide = 1
        while True:
            begin, end = max(0, len(left) - wide), min(len(right), wide)
            window = self.merge(b"".join(self.tokens[t] for t in left[begin:] + right[:end]))
            if (begin == 0 or self.agree(left[begin - 1], window[0])) and (
                    end == len(right) or self.agree(window[-1], right[end])):
                return left[:begin] + window + right[end:]
            wide *= 2


class Units(dict):
    """Packed tokens of what stands between two blanks, the first of them included: a cache like Pieces."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        found = self.encode(" " + unit)
        if len(unit) <= LEAF_BYTES:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[unit] = found
        return found


class Codec:
    """Encodes texts and decodes tokens for one vocabulary and splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES) -> None:
        # blank space is the Unicode property, not also the separators that Python counts
        pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(pattern).findall
        self.blank = regex.compile(r"\p{White_Space}").match
        self.pieces = Pieces(ranks, leaf_bytes)
        self.units = Units(self._by_pieces)
        self.unclear = regex.compile(r"^ |\p{White_Space} ").search
        self.leaf_chars = leaf_chars

    def _separate(self, before: str, after: str) -> bool:
        return not self.blank(before[-1]) and bool(self.blank(after[0]))

    def parts(self, text: str) -> list[str]:
        """The matches of the pattern, of halves joined up the tree."""
        if len(text) <= self.leaf_chars:
            return self.split(text)
        half = len(text) // 2
        return self._join(self.parts(text[:half]), self.parts(text[half:]))

    def _join(self, left: list[str], right: list[str]) -> list[str]:
        wide = 1
        while True:
            begin, end = max(0, len(left) - wide), min(len(right), wide)
            if (begin == 0 or self._separate(left[begin - 1], left[begin])) and (
                    end == len(right) or self._separate(right[end - 1], right[end])):
                return left[:begin] + self.split("".join(left[begin:] + right[:end])) + right[end:]
            wide *= 2

    def _by_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.parts(text)))

    def encode_packed(self, text: str) -> bytes:
        """Where every blank comes after a non-blank character, it separates pieces, and units between them are encoded alone."""
        return self._by_pieces(text) if self.unclear(text) else self._by_units(text.split(" "))

    def _by_units(self, units: list[str]) -> bytes:
        return self._by_pieces(units[0]) + b"".join(map(self.units.__getitem__, units[1:]))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text as by :meth:`encode_packed`; what the caches lack for texts that follow each other is encoded together."""
        out, begin, size = [], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= AT_ONCE or end == len(texts):
                cut = [None if self.unclear(t) else t.split(" ") for t in texts[begin:end]]
                # longer texts fill the caches as they go
                self._prepare([c for c, t in zip(cut, texts[begin:end]) if c and len(t) <= self.leaf_chars])
                out += [self._by_pieces(t) if c is None else self._by_units(c) for c, t in zip(cut, texts[begin:end])]
                begin, size = end, 0
        return out

    def _prepare(self, texts: list[list[str]]) -> None:
        met = set()
        for units in texts:
            met.update(units[1:])
        parts = {unit: self.split(" " + unit) for unit in met if unit not in self.units and len(unit) <= LEAF_BYTES}
        self.pieces.remember({piece for held in parts.values() for piece in held if piece not in self.pieces})
        if len(self.units) + len(parts) > _REMEMBERED:
            self.units.clear()
        for unit, held in parts.items():
            self.units[unit] = self.pieces[held[0]] if len(held) == 1 else b"".join(map(self.pieces.__getitem__, held))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_packed(text), "<u4")

    def decode(self, tokens: list[int]) -> bytes:
        if len(tokens) <= LEAF_TOKENS:
            return b"".join(map(self.pieces.tokens.__getitem__, tokens))
        half = len(tokens) // 2
        return self.decode(tokens[:half]) + self.decode(tokens[half:])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Replace ``text`` by ``ids``, its tokens as little-endian unsigned 32-bit integers. Null is the empty text.

    The vocabulary, of a fixed size, is sent to the executors once.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(sent.value, pattern)
        for batch in batches:
            for part in _small(batch):
                ids = pa.array(codec.encode_all(part.column(len(others)).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(others)], ids], [*others, "ids"])

    chosen = docs.select(*[F.col(f"`{c}`") for c in others], text_or_empty().alias("text"))
    return chosen.mapInArrow(run, _schema(chosen, others, "ids binary"))


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``bytes``, what the tokens in ``ids`` stand for."""
    sent = tokens.sparkSession.sparkContext.broadcast(ranks)
    names = tokens.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(sent.value, r"\s+")
        for batch in batches:
            for part in _small(batch):
                found = [codec.decode(np.frombuffer(x, "<u4").tolist()) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*names, "bytes"])

    return tokens.mapInArrow(run, _schema(tokens, names, "bytes binary"))


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _schema(df: DataFrame, names: list[str], more: str) -> str:
    return ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names], more])


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of the encoded and decoded documents."""
    decoded = decode(encode(docs.select("doc_id", "text"), ranks, pattern), ranks)
    return decoded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> tuple[dict[bytes, int], str]:
    """Ranks and splitting pattern of an installed public vocabulary."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), *public_ranks())
