"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token's pieces form a linked list.  Every adjacent pair whose joined
bytes have a rank lies in the bucket of this rank (a heap of positions, so
equal ranks merge from the left).  A three-level bitmap with 64 branches
tells which buckets hold something; find-first-set on the three levels
gives the smallest rank in constant time, however long the pre-token is.
Entries are not removed when a merge makes them stale: an entry is skipped
if the pair at its position does not have the bucket's rank any more.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from laketide.llm.common import in_pieces, mixed
from laketide.llm.shingles import _power_tables

# Distinct pre-tokens remembered per Python worker; dropped when full.
CACHE_SIZE = 400_000

# The split pattern of the byte-level vocabularies, which
# ``Codec.bounds`` follows, and the letters of its contractions.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SHORT = [ord(c) for c in "stmd"]
_LONG = [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]

# Unicode White_Space, what ``\s`` means to the tokenizer.
_WHITE_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Merger:
    """Merges the bytes of one pre-token by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values()) + 1
        self.ranks = ranks
        # the queue's bitmaps: bit r of ``low`` says that bucket r holds
        # something, bit w of ``mid`` that word w of ``low`` is not 0.  A
        # merge empties the queue, so they are all 0 between calls.
        self.low = [0] * ((n >> 6) + 1)
        self.mid = [0] * ((n >> 12) + 1)
        self.two = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]

    def merge(self, token: bytes) -> list[int]:
        """Ids of ``token``."""
        ranks = self.ranks
        whole = ranks.get(token)
        if whole is not None:
            return [whole]
        low, mid, two, rank_of = self.low, self.mid, self.two, ranks.get
        n = len(token)
        end = list(range(1, n + 1))      # end of the piece that starts here; 0: taken in
        before = list(range(-1, n - 1))  # start of the piece to the left
        pair = [two[a << 8 | b] for a, b in zip(token, token[1:])]
        pair.append(-1)                  # rank of the piece here joined with the next
        buckets: dict[int, list[int]] = {}
        top = 0
        for i, r in enumerate(pair):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)         # ascending, so still a heap
                else:
                    buckets[r] = [i]
                    w = r >> 6
                    if not low[w]:
                        mid[w >> 6] |= 1 << (w & 63)
                        top |= 1 << (w >> 6)
                    low[w] |= 1 << (r & 63)
        while top:
            # find-first-set on three levels
            m = (top & -top).bit_length() - 1
            bits = mid[m]
            w = m << 6 | (bits & -bits).bit_length() - 1
            bits = low[w]
            r = w << 6 | (bits & -bits).bit_length() - 1
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[r]
                bits &= bits - 1
                low[w] = bits
                if not bits:
                    mid[m] &= mid[m] - 1
                    if not mid[m]:
                        top &= top - 1
            j = end[i]
            if pair[i] != r or not j:
                continue                 # stale
            stop = end[j]
            end[i], end[j], pair[j] = stop, 0, -1
            if stop < n:
                before[stop] = i
                right = rank_of(token[i:end[stop]], -1)
            else:
                right = -1
            pair[i] = right
            h = before[i]
            left = -1
            if h >= 0:
                left = rank_of(token[h:stop], -1)
                if left == pair[h]:
                    left = -1            # queued already
                else:
                    pair[h] = left
            for r, p in ((right, i), (left, h)):
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], p)
                    else:
                        buckets[r] = [p]
                        w = r >> 6
                        if not low[w]:
                            mid[w >> 6] |= 1 << (w & 63)
                            top |= 1 << (w >> 6)
                        low[w] |= 1 << (r & 63)
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i:end[i]]])
            i = end[i]
        return out


# classes of code points, for the pattern's alternatives
_OTHER, _LETTER, _NUMBER, _BLANK = 0, 1, 2, 3


class Codec:
    """Encodes many texts at once.  The pre-tokens' bounds are found on code
    point classes (runs of letters, numbers, white space and other signs, as
    the pattern's alternatives define them); equal pre-tokens of a piece are
    merged once."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        if pattern != PATTERN:
            raise ValueError("bounds are written for PATTERN")
        with open(rank_file, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.merge = Merger(self.ranks).merge
        size = max(self.ranks.values()) + 1
        pieces = [b""] * size
        for piece, i in self.ranks.items():
            pieces[i] = piece
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_ends = np.cumsum([len(p) for p in pieces])
        self.piece_sizes = np.array([len(p) for p in pieces])
        self.known: dict[str, bytes] = {}
        self.classes = np.zeros(0x110000, np.uint8)
        points = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
        for kind, name in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (f"[{_WHITE_SPACE}]", _BLANK)):
            for m in regex.finditer(f"{kind}+", points):
                lo, hi = ord(m[0][0]), ord(m[0][-1])
                self.classes[lo:hi + 1] = name

    def bounds(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens, and the length at the end."""
        n = len(points)
        kind = self.classes[points]
        edge = np.zeros(n + 1, bool)             # a text starts here
        edge[offsets] = True
        start = edge.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # white space before something else: its last sign goes with what
        # follows if it is a space, and is a pre-token of its own if not
        last = np.flatnonzero((kind[:-1] == _BLANK) & (kind[1:] != _BLANK) & ~edge[1:n])
        start[last] = True
        space = last[points[last] == 32]
        start[space + 1] = False
        # contractions: a lone ' that opens a pre-token and letters behind it
        quote = np.flatnonzero(start[:n] & (points == 39))
        quote = quote[quote + 1 < n]
        quote = quote[start[quote + 1] & ~edge[quote + 1]]
        if len(quote):
            a = points[quote + 1]
            two = quote + 2 < n
            b = np.where(two, points[np.minimum(quote + 2, n - 1)], 0)
            b[two & edge[np.minimum(quote + 2, n)]] = 0
            one = np.isin(a, _SHORT)
            pairs = np.isin(a * 256 + np.minimum(b, 255), _LONG)
            for q, size in ((quote[one], 2), (quote[pairs], 3)):
                start[q + 1] = False
                start[q + size] = True
        start[n] = True
        return np.flatnonzero(start)

    def _ids(self, token: str) -> bytes:
        packed = self.known.get(token)
        if packed is None:
            packed = array("I", self.merge(token.encode())).tobytes()
            if len(token) <= 64:
                if len(self.known) >= CACHE_SIZE:
                    self.known.clear()
                self.known[token] = packed
        return packed

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids, starting with 0)."""
        whole = "".join(texts)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not whole:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        cuts = self.bounds(points, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        powers, inverse = _power_tables(len(points))
        total = np.cumsum((points + np.uint64(1)) * powers, dtype=np.uint64)
        upto = total[ends - 1]
        upto[1:] -= total[starts[1:] - 1]
        hashes = mixed(upto * inverse[starts] + (ends - starts).astype(np.uint64))
        del total
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        packed = [self._ids(whole[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        counts = np.array([len(p) for p in packed]) // 4
        pool = np.frombuffer(b"".join(packed), np.uint32)
        pool_at = np.cumsum(counts) - counts
        per_token = counts[which]
        upto = np.cumsum(per_token)
        ids = pool[np.repeat(pool_at[which] - (upto - per_token), per_token) + np.arange(upto[-1])]
        tokens_before = np.searchsorted(starts, offsets)
        out = np.concatenate([[0], upto])[tokens_before]
        # two pre-tokens with one hash would decode to another text
        for i, t in enumerate(texts):
            part = ids[out[i]:out[i + 1]]
            if self.decode(part) != t.encode():
                return self._one_by_one(texts)
        return ids, out

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for t in texts:
            p = np.frombuffer(t.encode("utf-32-le"), np.uint32)
            cuts = self.bounds(p, np.array([0, len(p)])).tolist() if len(p) else [0]
            parts.append(b"".join(self._ids(t[a:b]) for a, b in zip(cuts, cuts[1:])))
        return (np.frombuffer(b"".join(parts), np.uint32),
                np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int64))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        sizes = self.piece_sizes[ids]
        upto = np.cumsum(sizes)
        at = np.repeat(self.piece_ends[ids] - upto, sizes) + np.arange(upto[-1])
        return self.piece_bytes[at].tobytes()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(rank_file: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (rank_file, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(rank_file, pattern)
    return _codecs[key]


def _like(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every text.

    A null text is empty and has no ids; a null doc_id and repeated rows
    pass through; other columns are not read; an empty table gives no rows.
    ``rank_file`` must be readable under this path on every executor.
    """
    def run(batches):
        c = codec(rank_file, pattern)
        for b in in_pieces(batches):
            ids, at = c.encode_all([t or "" for t in b.column("text").to_pylist()])
            ids = [ids[x:y].astype("<u4").tobytes() for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_like(docs)}, ids binary")


def decode(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, bytes of every row of ids (null: empty)."""
    def run(batches):
        c = codec(rank_file, pattern)
        for b in in_pieces(batches, "ids"):
            out = [c.decode(np.frombuffer(i or b"", "<u4")) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bytes"])
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {_like(tokens)}, bytes binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, as
    :func:`encode` gives them, with ``keep_ids``) of every text: encoded,
    then decoded from the ids, in one pass.  Null, empty, repeated and extra
    input as in :func:`encode`."""
    def run(batches):
        c = codec(rank_file, pattern)
        sha = hashlib.sha256
        for b in in_pieces(batches):
            n, ids_sha, text_sha, packed = [], [], [], []
            all_ids, at = c.encode_all([t or "" for t in b.column("text").to_pylist()])
            for x, y in zip(at[:-1], at[1:]):
                ids = all_ids[x:y].astype("<u4").tobytes()
                n.append(y - x)
                ids_sha.append(sha(ids).hexdigest())
                text_sha.append(sha(c.decode(all_ids[x:y])).hexdigest())
                packed.append(ids)
            arrays = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {_like(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
             + (", ids binary" if keep_ids else ""))
