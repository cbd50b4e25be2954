"""Questions that shards of text put to parts of a hash space, in packed form.

Documents are dealt to shards, and each shard asks about its own hashes. Hashes are dealt to
parts by their first bits, so that a part sees all shards that have a hash, and answers each
shard with those of its hashes that are wanted. Neither side ever holds more than one shard or
part: the number of both grows with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a hash that are sent besides those that name its part. Hashes that agree in all of these are one
#: question; whoever asks checks the answers against its text.
SENT_BITS = 32
ASK = "shard long, part long, keys binary, counts binary"
ANSWER = "shard long, part long, keys binary"


def mixed(values: np.ndarray) -> np.ndarray:
    """Each number's bits spread over all 64 bits, one to one."""
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def part_bits(mass: float, target: float) -> int:
    """How many first bits name a part, so that a part gets about ``target`` of ``mass``."""
    return max(3, min(SENT_BITS, int(np.ceil(np.log2(max(1.0, mass / target))))))


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as four planes of bytes: a plane of zeros costs next to nothing once compressed."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(raw) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.int64), prepend=0))


def unpack_sorted(raw) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.int64)


def shortened(keys: np.ndarray, bits: int) -> np.ndarray:
    """The part of 64-bit hashes that is sent; the order stays."""
    return keys >> np.uint64(64 - SENT_BITS - bits)


def asks(shard: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """One row per part that is asked about the sorted, distinct, shortened ``keys``."""
    part = (keys >> np.uint64(SENT_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(part))
    low = (keys & np.uint64((1 << SENT_BITS) - 1)).astype(np.int64)
    counts = np.minimum(counts, (1 << 32) - 1)
    return pa.table({
        "shard": pa.array(np.full(len(starts), shard, np.int64)), "part": pa.array(part[starts]),
        "keys": pa.array([pack_sorted(low[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
        "counts": pa.array([pack(counts[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())})


def answers(asked: pa.Table, wanted: np.ndarray) -> pa.Table:
    """To each shard those of its keys that are among the sorted ``wanted``."""
    found = []
    for raw in asked.column("keys"):
        keys = unpack_sorted(raw.as_buffer())
        at = np.searchsorted(wanted, keys)
        found.append(pack_sorted(keys[wanted[np.minimum(at, len(wanted) - 1)] == keys]
                                 if len(wanted) else keys[:0]))
    return pa.table({"shard": asked.column("shard"), "part": asked.column("part"),
                     "keys": pa.array(found, pa.binary())})


def answered(rows: pa.Table) -> np.ndarray:
    """The sorted, shortened keys that a shard's answers hold."""
    order = np.argsort(rows.column("part").to_numpy(), kind="stable").tolist()
    parts, keys = rows.column("part").to_pylist(), rows.column("keys").to_pylist()
    return np.concatenate([np.zeros(0, np.uint64), *(
        unpack_sorted(keys[i]).astype(np.uint64) + np.uint64(parts[i] << SENT_BITS) for i in order)])


class Members:
    """A set of shortened keys that large arrays are looked up in."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self._slot(keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Where in ``keys`` the set's members are."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.seen[self._slot(keys)])
        found = keys[at]
        where = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return at[self.keys[where] == found]


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
