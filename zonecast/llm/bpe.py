"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by the pattern; each piece is merged on its own. The queue holds one bucket per merge
rank with the positions where that merge applies. A two-level bitmap tells which buckets hold
anything, so the lowest rank is found by find-first-set; positions whose merge has gone meanwhile are
skipped when they come up. A piece of n bytes takes O(n log n) steps, also if it is very long.

Pieces and whole space-delimited words that come up again are taken from caches of bounded size.

Defined cases: a null text is encoded as the empty text (no ids, empty bytes). A null id stays null.
Rows are encoded one by one, so repeated rows repeat. An empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import id_type, small_batches

# The code points that the pattern's \s means (the White_Space property).
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS_CACHED, PIECES_CACHED, LONGEST_CACHED = 300_000, 200_000, 1000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_pairs = np.full(1 << 16, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
        spelt = pattern.replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
        self.cut = regex.compile(spelt, regex.V1).findall  # V1: sets may be nested
        # A space before anything but white space starts a piece; texts with other spaces are cut whole.
        self.odd_space = regex.compile(f" (?:[{SPACES}]|$)").search
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece. All pieces share one queue: they don't meet, so each is merged as if alone."""
        rank_of = self.ranks.get
        data = b"".join(pieces)
        n = len(data)
        raw = np.frombuffer(data, np.uint8).astype(np.int32)
        starts = np.cumsum([0, *map(len, pieces)])
        edge = bytearray(n + 1)  # 1 where a piece starts, and at the end
        np.frombuffer(edge, np.uint8)[starts] = 1
        end = list(range(1, n + 1))  # the linked list: the part that starts here ends there
        before = list(range(-1, n - 1))
        # Rank of merging the part at a position with the next one; -1: no such merge, or the end of a piece.
        ranked = np.append(self.byte_pairs[raw[:-1] << 8 | raw[1:]], np.int32(-1))[:n]
        ranked[starts[1:] - 1] = -1
        wanted = ranked.tolist()
        order = np.flatnonzero(ranked >= 0)
        order = order[np.argsort(ranked[order], kind="stable")]
        first, counts = np.unique(ranked[order], return_counts=True)
        buckets: dict[int, list[int]] = {}
        groups: dict[int, int] = {}  # 64 ranks a group: which of them have a bucket
        top = 0  # which groups have any
        for rank, bucket in zip(first.tolist(), np.split(order, np.cumsum(counts)[:-1]), strict=False):
            buckets[rank] = bucket.tolist()
            groups[rank >> 6] = groups.get(rank >> 6, 0) | 1 << (rank & 63)
            top |= 1 << (rank >> 6)
        pushed: list[tuple[int, int]] = []
        while True:
            for rank, i in pushed:
                bucket = buckets.get(rank)
                if bucket is None:
                    buckets[rank] = [i]
                    groups[rank >> 6] = groups.get(rank >> 6, 0) | 1 << (rank & 63)
                    top |= 1 << (rank >> 6)
                else:
                    bucket.append(i)
            if not top:
                break
            pushed = []
            group = (top & -top).bit_length() - 1
            bits = groups[group]
            now = group << 6 | ((bits & -bits).bit_length() - 1)
            groups[group] = bits & (bits - 1)
            if not groups[group]:
                top ^= 1 << group
            bucket = buckets.pop(now)
            bucket.sort()
            for k, i in enumerate(bucket):
                if wanted[i] != now:  # stale
                    continue
                gone = end[i]
                stop = end[i] = end[gone]
                wanted[gone] = -1
                soonest = now + 1
                if edge[stop]:
                    wanted[i] = -1
                else:
                    before[stop] = i
                    wanted[i] = rank = rank_of(data[i : end[stop]], -1)
                    if rank >= 0:
                        pushed.append((rank, i))
                        soonest = rank
                if not edge[i]:
                    left = before[i]
                    rank = rank_of(data[left:stop], -1)
                    if rank != wanted[left]:
                        wanted[left] = rank
                        if rank >= 0:
                            pushed.append((rank, left))
                            if rank < soonest:
                                soonest = rank
                if soonest <= now:  # it comes before the rest of this bucket
                    pushed += [(now, j) for j in bucket[k + 1 :]]
                    break
        out, i, ranks = [], 0, self.ranks
        for stop in starts[1:].tolist():
            ids = []
            while i < stop:
                ids.append(ranks[data[i : (i := end[i])]])
            out.append(ids)
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Adds the ids of unknown pieces to the cache."""
        new = [p for p in pieces if p not in self.pieces]
        if new:
            for piece, ids in zip(new, self.merge([p.encode("utf-8", "surrogatepass") for p in new]), strict=True):
                self.pieces[piece] = array("I", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        words: list[list[str]] = []
        runs: list[list[str]] = []  # pieces of what isn't a plain word after a space
        for text in texts:
            if not text or self.odd_space(text):
                words.append([])
                runs.append(self.cut(text or ""))
            else:
                first, *rest = text.split(" ")
                words.append(rest)
                runs.append(self.cut(first))
        unknown = {w: self.cut(" " + w) for w in set().union(*words).difference(self.words)}
        self._learn(set().union(*unknown.values(), *runs))
        known = self.pieces.__getitem__
        self.words |= {w: b"".join(map(known, pieces)) for w, pieces in unknown.items()}
        word = self.words.__getitem__
        out = [b"".join(map(known, r)) + b"".join(map(word, w)) for r, w in zip(runs, words, strict=True)]
        # A full cache keeps what it has: the frequent words came first.
        _shrink(self.words, WORDS_CACHED)
        _shrink(self.pieces, PIECES_CACHED)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _shrink(cache: dict[str, bytes], size: int) -> None:
    """Drops the newest entries beyond ``size``, and very long ones among the newest."""
    while len(cache) > size or (cache and len(next(reversed(cache))) > LONGEST_CACHED):
        cache.popitem()


_READY: dict[tuple[int, str], Bpe] = {}


def _codec(content: bytes, pattern: str) -> Bpe:
    """One codec a worker process: building the tables and filling the caches is done once."""
    key = (hash(content), pattern)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Bpe(parse_ranks(content), pattern)
    return _READY[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (bytes) of each row.

    The rank file (bounded: a vocabulary) is read on the driver and broadcast.
    """
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            # Small output batches: the texts of a batch and all their ids needn't be held at once.
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = codec.encode(part.column("text").to_pylist())
                decoded = [codec.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )

    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {id_type(docs)}, ids binary, decoded binary"
    )


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded bytes."""
    return encoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
