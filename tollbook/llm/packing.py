"""Packing of documents into windows of equal length by Karmarkar-Karp multiway differencing.

A document is its ids with an end id. Full windows are cut off its front; the rest is cut into pieces of PIECE ids and then
halves of that, down to LEAST, as pieces of many sizes balance better than equal ones. The pieces of a block of documents
are spread over windows so that the windows are nearly equal.
If the fullest window is over capacity, the block gets one window more.

Null texts count as empty: one piece that is the end id alone. Rows that repeat are packed each time, rows with a null doc_id too.
Texts of any length are cut as they need. A block ends at BLOCK ids or PIECES pieces, which bounds the partial partitions held, also
for very many empty texts. Blocks follow the rows of a task, so nothing is shuffled and a task that runs again makes the same
windows. An empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tollbook.llm.common import chunks, id_and_text
from tollbook.llm.tokenization import byte_encoder

CAPACITY = 2048
PIECE = 256
LEAST = 64
#: Ids of a block, about BLOCK / CAPACITY windows.
BLOCK = 1 << 19
PIECES = 1 << 14

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


def cut(n: int, piece: int = PIECE, least: int = LEAST) -> list[int]:
    """Sizes of the pieces of n ids."""
    out, size = [], piece
    while n:
        while size > n and size > least:
            size //= 2
        if size <= least or n < 2 * least:
            size = n if n <= piece else piece
        out.append(size)
        n -= size
    return out


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece: partial partitions are merged, those of the largest difference first, the fullest
    window of one with the emptiest of the other."""
    n = len(sizes)
    if not n:
        return np.zeros(0, int)
    first = np.zeros(windows, np.int64)
    sums = []
    for size in sizes:
        own = first.copy()
        own[-1] = size
        sums.append(own)  # ascending
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(joined, kind="stable")
        sums[a] = sums[b] = None
        merges.append((a, b, order))
        sums.append(joined[order])
        heapq.heappush(heap, (-int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    place: dict[int, np.ndarray] = {len(sums) - 1: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):  # from the whole back to its parts
        a, b, order = merges[k]
        of = np.empty(windows, int)
        of[order] = place.pop(n + k)
        place[a], place[b] = of, of[::-1]
    return np.array([place[i][-1] for i in range(n)])


def balance(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, with as few windows as differencing needs to stay within capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        place = differencing(sizes, windows)
        if not len(sizes) or np.bincount(place, sizes, windows).max() <= capacity:
            return place
        windows += 1


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, piece: int = PIECE,
         block: int = BLOCK) -> DataFrame:
    """A row per piece: its document and place there, its window (sequence_id) and place there, and its ids."""
    if not 0 < piece <= capacity:
        raise ValueError("a piece must fit into a window")

    def run(batches):
        encoder, end = byte_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        state = {"next": TaskContext.get().partitionId() << 40}
        rest: list[tuple] = []
        held = 0

        def rows(pieces, windows, offsets):
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([p[0] for p in pieces], pa.int64()),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([len(p[2]) // 4 for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p[2]) for p in pieces], pa.int64()),
                "doc_tokens": pa.array([p[3] for p in pieces], pa.int64()),
                "sequence_id": pa.array(windows, pa.int64()), "offset": pa.array(offsets, pa.int64()),
                "ids": pa.array([p[2] for p in pieces], pa.binary())})

        def spread():
            place = balance(np.array([len(p[2]) // 4 for p in rest]), capacity)
            used, number = np.unique(place, return_inverse=True)
            filled = np.zeros(len(used), np.int64)
            offsets = []
            for p, w in zip(rest, number):
                offsets.append(int(filled[w]))
                filled[w] += len(p[2]) // 4
            yield from rows(rest, state["next"] + number, offsets)
            state["next"] += len(used)

        for ids, texts in chunks(batches):
            full = []
            for doc_id, own in zip(ids, encoder.encode(texts)):
                own += end
                n = len(own) // 4
                at = 0
                while n - at >= capacity:
                    full.append((doc_id, at, own[4 * at : 4 * (at + capacity)], n))
                    at += capacity
                if at < n:
                    held += n - at
                    for size in cut(n - at, piece):
                        rest.append((doc_id, at, own[4 * at : 4 * (at + size)], n))
                        at += size
                if held >= block or len(rest) >= PIECES:
                    yield from spread()
                    rest.clear()
                    held = 0
            if full:
                yield from rows(full, state["next"] + np.arange(len(full)), [0] * len(full))
                state["next"] += len(full)
        if rest:
            yield from spread()

    return id_and_text(docs).mapInArrow(run, SCHEMA)
