"""Byte-level BPE by monoid tree reduction.

The tokens of a byte string form a monoid: ``join(tokens(a), tokens(b))`` is
``tokens(a + b)``. A string is halved down to short leaves, leaves are merged
outright, and neighbours are joined by re-encoding a window of bytes around the
border. The window grows until the tokens outside are proven stable.

Why that is a proof: merging always takes the lowest rank, leftmost first. If the
merges of a whole string ever crossed a border between two final tokens, take the
first such merge. Until then both tokens developed as they do alone, so the pair
encoded by itself would cross as well. Hence a token sequence is the encoding of its
bytes exactly if every neighbouring pair encodes to itself; inside the window and
outside it pairs are stable already, and only the two pairs at the window's edges
need a look.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
from array import array

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import append_columns

LEAF_BYTES = 8
NONE = 1 << 62  # above every rank
DECODE_LEAF = 4096
CACHE_PIECES = 600_000
MAX_RANK_FILE = 64 << 20


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class TreeBpe:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.stable: dict[tuple[int, int], bool] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.pieces: dict[str, bytes] = {}

    # -- encoding ---------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """Merge a leaf or a window outright, lowest rank first, leftmost first."""
        get, ranks = self.ranks.get, self.ranks
        starts = list(range(len(data) + 1))
        pairs = [get(data[i : i + 2], NONE) for i in range(len(data) - 1)]  # rank of part i with the next
        while pairs and (best := min(pairs)) < NONE:
            i = pairs.index(best)
            del starts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(data[starts[i] : starts[i + 2]], NONE)
            if i:
                pairs[i - 1] = get(data[starts[i - 1] : starts[i + 1]], NONE)
        return [ranks[data[a:b]] for a, b in zip(starts, starts[1:])]

    def leaf(self, data: bytes) -> list[int]:
        """``merge``, remembering; callers do not change the list."""
        known = self.leaves.get(data)
        if known is None:
            if len(self.leaves) >= CACHE_PIECES:
                self.leaves.clear()
            known = self.leaves[data] = self.merge(data)
        return known

    def pair_is_stable(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) >= CACHE_PIECES:
                self.stable.clear()
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.stable[key] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the two byte strings together."""
        if not left or not right:
            return left + right
        n_left = n_right = 0  # tokens taken into the window on each side
        middle: list[int] = []
        while True:
            ok_left = n_left == len(left) or self.pair_is_stable(
                left[-1 - n_left], middle[0] if middle else right[n_right]
            )
            ok_right = n_right == len(right) or not middle or self.pair_is_stable(middle[-1], right[n_right])
            if ok_left and ok_right:
                return left[: len(left) - n_left] + middle + right[n_right:]
            if not middle:
                n_left = n_right = 1
            else:
                if not ok_left:
                    n_left = min(len(left), 2 * n_left)
                if not ok_right:
                    n_right = min(len(right), 2 * n_right)
            window = left[len(left) - n_left :] + right[:n_right]
            middle = self.window(b"".join([self.bytes_of[t] for t in window]))

    def window(self, data: bytes) -> list[int]:
        """Tokens of a window: small ones outright, large ones by a heap, so that long runs stay cheap."""
        return self.leaf(data) if len(data) <= 4 * LEAF_BYTES else self.merge_long(data)

    def merge_long(self, data: bytes) -> list[int]:
        """As ``merge`` in n log n steps: a heap of pairs over a linked list of parts."""
        n = len(data)
        end = list(range(1, n + 1))  # end of the part that starts at i; 0 once it is merged away
        before = list(range(-1, n - 1))
        get = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue  # one of the two has changed since
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.leaf(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit integers."""
        data = piece.encode("utf-8")
        rank = self.ranks.get(data)  # a piece that is a token stays one
        ids = array("I", [rank] if rank is not None else self.tree(data))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. Pieces are encoded apart, so joining them is concatenation."""
        known, out = self.pieces, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= 64:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    # -- decoding ---------------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids: halves are decoded and concatenated up the tree."""
        numbers = array("I")
        numbers.frombytes(ids)
        return self._decode(numbers, 0, len(numbers))

    def _decode(self, numbers: array, lo: int, hi: int) -> bytes:
        if hi - lo <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, numbers[lo:hi]))
        mid = (lo + hi) // 2
        return self._decode(numbers, lo, mid) + self._decode(numbers, mid, hi)


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    text_col: str = "text",
    digests: bool = False,
    with_ids: bool = True,
) -> DataFrame:
    """Every row with ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit) in place of its text.

    With ``digests`` the ids are decoded again, and ``ids_sha256`` and
    ``decoded_sha256`` are added. Without ``with_ids`` the ids stay in the task that
    made them.

    A null or empty text has no tokens and decodes to no bytes. Repeated rows are
    encoded alike. An empty table gives an empty table. Other columns pass through;
    those named like results are replaced. Nothing is shuffled: a task holds one
    batch of rows and three caches of at most 600,000 entries. The rank file, of 64 MB
    at most, is read on the driver and broadcast.
    """
    if os.path.getsize(rank_file) > MAX_RANK_FILE:
        raise ValueError(f"{rank_file} is over {MAX_RANK_FILE} bytes, the bound for broadcasting it")
    with open(rank_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        coder = TreeBpe(parse_ranks(shared.value), pattern)

        def compute(texts: list) -> list[list]:
            ids = [coder.encode(t or "") for t in texts]
            out: list[list] = [[len(x) // 4 for x in ids]]
            if with_ids:
                out.append(ids)
            if digests:
                out.append([hashlib.sha256(x).hexdigest() for x in ids])
                out.append([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids])
            return out

        return compute

    fields: list[tuple[str, T.DataType]] = [("n_tokens", T.LongType())]
    if with_ids:
        fields.append(("ids", T.BinaryType()))
    if digests:
        fields += [("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return append_columns(docs, text_col, fields, start, [c for c in docs.columns if c != text_col])


def decode_documents(encoded: DataFrame, rank_file: str, ids_col: str = "ids") -> DataFrame:
    """Every row with ``decoded`` (binary), the bytes of its ids. Null ids decode to no bytes."""
    if os.path.getsize(rank_file) > MAX_RANK_FILE:
        raise ValueError(f"{rank_file} is over {MAX_RANK_FILE} bytes, the bound for broadcasting it")
    with open(rank_file, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def start():
        coder = TreeBpe(parse_ranks(shared.value), ".")
        return lambda values: [[coder.decode(x or b"") for x in values]]

    return append_columns(encoded, ids_col, [("decoded", T.BinaryType())], start)


def default_rank_file() -> str:
    """The 50k-token rank file for many languages, where public tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN
