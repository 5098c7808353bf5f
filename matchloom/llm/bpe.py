"""Byte-level BPE by monoid tree reduction.

The tokens of a byte string form a monoid under "concatenate and re-encode the seam": a long piece is
cut in halves, each half is encoded recursively, and two neighbours are joined by re-encoding a window
of tokens around the seam. The window grows until the tokens just outside it are stable. Stability is a
local fact of rank-ordered BPE: a token sequence is *the* encoding of its bytes if and only if each pair
of neighbouring tokens, encoded on its own, gives that pair again; so a join is finished when the pairs
at both ends of the window pass that test. Decoding concatenates up the tree.

The split pattern is applied first; each of its matches is encoded separately. Text is cut at single
spaces between two non-spaces, where a match always begins, and the encoding of each such stretch is
remembered, since words recur.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_rows, with_mapped
from .secrets import _arrow_type

LEAF = 32
#: Stretches, and pairs of tokens, that a worker remembers; of stretches as many again that were used before these.
MEMO = 400_000
#: Children of a node of the tree that decodes.
FAN = 16


class Tokenizer:
    """Encoder and decoder for a rank table (bytes to rank) and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.bytes_of_text = {str(r).encode(): b for b, r in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.first, self.rest = _Memo(self, ""), _Memo(self, " ")

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost first, by a heap over a linked list."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        n = len(data)
        end = list(range(1, n + 1))  # end of the part that starts here; 0 if none starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        """Whether the two tokens stay as they are when encoded together."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two neighbours' bytes together."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self.merge(b"".join(self.bytes_of[t] for t in (*left[-a:], *right[:b])))
            before, after = len(left) - a, len(right) - b
            ok_left = before == 0 or self.stable(left[before - 1], window[0])
            ok_right = after == 0 or self.stable(window[-1], right[b])
            if ok_left and ok_right:
                return left[:before] + window + right[b:]
            if not ok_left:
                a = min(len(left), 2 * a)
            if not ok_right:
                b = min(len(right), 2 * b)

    def encode_piece(self, data: bytes) -> list[int]:
        """One match of the pattern, by halves."""
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    def encode_stretch(self, text: str) -> list[int]:
        return [t for m in self.pattern.findall(text) for t in self.encode_piece(m.encode("utf-8"))]

    def stretches(self, text: str | None) -> list[str]:
        """The ids of each stretch, in decimal, joined by one space; no stretch for null."""
        if not text:
            return []
        first, *rest = text.split(" ")
        try:  # a stretch that white space begins or ends, or that is empty, is never remembered
            return [self.first[first], *map(self.rest.__getitem__, rest)]
        except _NoStretch:
            first, *rest = CUT.split(text)
            return [self.first.of(first), *map(self.rest.of, rest)]

    def encode_text(self, text: str | None) -> str:
        """The ids in decimal, joined by one space; null is empty."""
        return " ".join(self.stretches(text))

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for x in self.encode_text(text).split()]

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation up the tree."""
        return self._up([self.bytes_of[i] for i in ids])

    def decode_text(self, ids: str) -> bytes:
        """``decode`` for the decimal form."""
        return self._up([*map(self.bytes_of_text.__getitem__, ids.encode().split())])

    @staticmethod
    def _up(parts: list[bytes]) -> bytes:
        """Neighbours are joined, ``FAN`` at each node, until one stretch is left."""
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + FAN]) for i in range(0, len(parts), FAN)]
        return parts[0] if parts else b""


class _NoStretch(Exception):
    """A part of a text at single spaces is no stretch: no match of the pattern need begin or end there."""


class _Kept(dict):
    """What was made of short texts. When full, all of it becomes the older half; what is used there again is kept."""

    def __init__(self, owner: Tokenizer, longest: int):
        super().__init__()
        self.owner, self.longest, self.older = owner, longest, {}

    def made(self, text: str) -> str:
        raise NotImplementedError

    def __missing__(self, text: str) -> str:
        if (found := self.older.get(text)) is None:
            found = self.made(text)
        if len(text) <= self.longest:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class _Memo(_Kept):
    """Stretch to decimal ids; ``before`` is put before the stretch."""

    def __init__(self, owner: Tokenizer, before: str):
        super().__init__(owner, 64)
        self.before = before

    def of(self, stretch: str) -> str:
        """The ids of a stretch, of any kind."""
        try:
            return self[stretch]
        except _NoStretch:
            return " ".join(map(str, self.owner.encode_stretch(self.before + stretch)))

    def made(self, text: str) -> str:
        if not text or text[0].isspace() or text[-1].isspace():
            raise _NoStretch
        return " ".join(map(str, self.owner.encode_stretch(self.before + text)))


#: One space between two characters that no definition of white space holds.
CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")


@lru_cache(maxsize=4)
def tokenizer(rank_file: str, pattern: str) -> Tokenizer:
    """One tokenizer for each process and rank file. The file is part of an installed package, present on each node."""
    with open(rank_file, "rb") as f:
        return Tokenizer({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per input row: id, number of tokens, digest of the ids, digest of the bytes decoded from the ids.

    Null counts as empty (no token; digests of nothing). Repeated rows are each answered; other columns are not read.
    """
    file, pat = (rank_file, pattern) if rank_file else default_vocabulary()
    pat = pattern or pat

    def rows(ids: list, texts: list) -> list:
        t = tokenizer(file, pat)
        encoded = [t.encode_text(x) for x in texts]
        return [
            ids,
            [x.count(" ") + 1 if x else 0 for x in encoded],
            [hashlib.sha256(x.encode()).hexdigest() for x in encoded],
            [hashlib.sha256(t.decode_text(x)).hexdigest() for x in encoded],
        ]

    fields = [pa.field("doc_id", _arrow_type(docs, id_col)), pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return map_rows(docs.select(id_col, text_col), rows, fields, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "token_ids", rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with an array column of token ids (null text: empty array)."""
    file, pat = (rank_file, pattern) if rank_file else default_vocabulary()
    pat = pattern or pat

    def ids(texts: list) -> list:
        t = tokenizer(file, pat)
        return [np.array(t.encode_text(x).split(), np.int32) for x in texts]

    # workers outlive their tasks, and other stages need the memory
    return with_mapped(docs, text_col, ids, out_col, pa.list_(pa.int32()), "array<int>", tokenizer.cache_clear)


def decode(docs: DataFrame, ids_col: str = "token_ids", out_col: str = "decoded", rank_file: str | None = None) -> DataFrame:
    """``docs`` with the bytes that an array of token ids stands for (null array: null)."""
    file, pat = (rank_file, None) if rank_file else default_vocabulary()

    def raw(rows: list) -> list:
        t = tokenizer(file, pat or default_vocabulary()[1])
        return [None if x is None else t.decode(x) for x in rows]

    return with_mapped(docs, ids_col, raw, out_col, pa.binary(), "binary")
