"""A Bloom filter of ids that is built by the executors and sent to them.

It only spares work: rows that it lets pass wrongly are dropped by the join
behind it. So its size may be bounded, whatever the number of ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow
from .hashing import mix

_PIECE = 1 << 14
_SCHEMA = "piece int, data binary"


def united_bits(rows: DataFrame, places: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """The bytes of a filter of ``bits`` in which the places given for each batch are set."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in places(batch):
                np.bitwise_or.at(part, at >> 3, (1 << (at & 7)).astype(np.uint8))
        pieces = part.reshape(-1, _PIECE)
        used = np.flatnonzero(pieces.any(1)).tolist()
        yield {"piece": used, "data": [pieces[k].tobytes() for k in used]}

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("piece").to_pylist(), batch.column("data")):
                held[k] = held.get(k, np.uint8(0)) | np.frombuffer(data.as_py(), np.uint8)
        yield {"piece": list(held), "data": [v.tobytes() for v in held.values()]}

    whole = np.zeros((bits // 8 // _PIECE, _PIECE), np.uint8)
    parts = map_arrow(rows, partial, _SCHEMA)
    for r in map_arrow(parts.repartition(min(64, len(whole)), "piece"), united, _SCHEMA).collect():
        whole[r["piece"]] = np.frombuffer(r["data"], np.uint8)
    return whole.ravel()


@dataclass
class Bloom:
    sent: Broadcast

    @classmethod
    def of(cls, rows: DataFrame, column: str, most_bits: int = 29) -> Bloom:
        """Of a column of longs: 8 bits for each value, 64 MiB at most."""
        bits = 1 << max(17, min(most_bits, math.ceil(math.log2(8 * max(1, rows.count())))))
        places = lambda batch: cls._places(batch.column(column).to_numpy(zero_copy_only=False), bits)
        return cls(rows.sparkSession.sparkContext.broadcast(united_bits(rows.select(F.col(column).cast("long")), places, bits)))

    @staticmethod
    def _places(ids: np.ndarray, size: int) -> Iterator[np.ndarray]:
        for k in range(3):
            yield (mix(ids.astype(np.int64).view(np.uint64), 50 + k) & np.uint64(size - 1)).astype(np.int64)

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        bits, found = self.sent.value, np.ones(len(ids), bool)
        for at in self._places(ids, 8 * len(bits)):
            found &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found
