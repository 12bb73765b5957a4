"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

A document's ids (with an end id) are cut into full windows, which need no packing, and a rest,
which is cut into parts of at most `max_part` tokens and halves of the remainder. Parts are gathered into groups of about
`group_windows` windows. In a group, every part starts as a partial partition of its own; the two
partitions with the widest spread between their windows are merged, the fullest windows of one
onto the emptiest of the other, until one partition is left, whose windows are nearly equal. The
window count starts at the least that can hold the group and rises while any window is over
capacity.

Packing runs inside each input partition, batch by batch: no shuffle, memory for one group, and a
lost task repeats itself alike (window numbers come from the partition number). A partition's
last group is the only one that may leave a window partly empty.

Defined results: a null or empty text is the end id alone; null ids, repeated rows and equal
lengths are packed like any row, in input order; an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cellscope.llm.common import giving_back, stretches, texts
from cellscope.llm.tokens import PART, TextIds, text_ids, tokenizer_path

CAPACITY = 2048
MAX_PART = 512
MIN_PART = 32
GROUP_WINDOWS = 128
END_ID = 1


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """The sums of k windows and the numbers of the parts in each."""
    n = len(sizes)
    left, right = list(range(n)), [-1] * n       # leaves are parts; a joined window has two children
    whole = np.zeros(k, np.int64), np.full(k, -1, np.int64)
    parts = [(np.array([s]), np.array([i])) for i, s in enumerate(sizes)]    # sums, descending; windows

    def spread(sums: np.ndarray) -> int:
        return int(sums[0] - (sums[-1] if len(sums) == k else 0))

    heap = [(-int(s) if k > 1 else 0, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sa, wa), (sb, wb) = parts[a], parts[b]
        if len(sa) + len(sb) <= k:               # still empty windows enough: none need be joined
            sums, windows = np.concatenate([sa, sb]), np.concatenate([wa, wb])
        else:
            sums, windows = whole[0].copy(), whole[1].copy()
            sums[:len(sa)], windows[:len(wa)] = sa, wa
            at = np.arange(k - 1, k - 1 - len(sb), -1)
            for i in at[windows[at] >= 0]:
                left.append(int(windows[i]))
                right.append(int(wb[k - 1 - i]))
            both = windows[at] >= 0
            joined = np.arange(len(left) - int(both.sum()), len(left))
            new = wb.copy()
            new[both] = joined
            windows[at] = new
            sums[at] += sb
        order = np.argsort(-sums, kind="stable")
        parts[a] = sums[order], windows[order]
        parts[b] = None
        heapq.heappush(heap, (-spread(parts[a][0]), a))
    sums, windows = parts[heap[0][1]]
    out = []
    for w in windows.tolist():
        found, todo = [], [w] if w >= 0 else []
        while todo:
            x = todo.pop()
            if right[x] < 0:
                found.append(left[x])
            else:
                todo += (right[x], left[x])
        out.append(sorted(found))
    return sums, out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows, as lists of part numbers, none above capacity."""
    sizes = np.asarray(sizes, np.int64)
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        sums, windows = differencing(sizes, k)
        if int(sums.max()) <= capacity:
            return [w for w in windows if w]
        k += 1


def cuts(n: int, capacity: int, max_part: int, min_part: int = MIN_PART) -> tuple[list[int], list[tuple[int, int]]]:
    """Starts of the full windows of n tokens, and (start, length) of the rest's parts: `max_part`
    as often as it goes, then halves down to `min_part`. The small parts let differencing even
    out the large ones."""
    full = n // capacity
    rest, at, parts = n - full * capacity, full * capacity, []
    while rest:
        size = max_part if rest > max_part else -(-rest // 2) if rest > 2 * min_part else rest
        parts.append((at, size))
        at, rest = at + size, rest - size
    return [i * capacity for i in range(full)], parts


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, capacity: int = CAPACITY,
         max_part: int = MAX_PART, group_windows: int = GROUP_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and the ids themselves (array of int) if asked for."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = tokenizer_path(tokenizer)
    # a group is closed a little below full windows, so that nearly equal windows fit at once
    enough = group_windows * (capacity - max(1, capacity // 400))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = [None] + [pa.int64()] * 6

    def encoded(found: list[str], ids_of: TextIds) -> Iterator[memoryview]:
        """The ids of each text, with the end id, as bytes."""
        for a, b in stretches([len(x) for x in found], PART):
            flat, n = ids_of.encode_all(found[a:b])
            upto = np.cumsum(n)
            ids = memoryview(np.insert(flat, upto, end_id).tobytes())
            ends = (4 * (upto + np.arange(1, len(n) + 1))).tolist()
            for start, end in zip([0, *ends], ends):
                yield ids[start:end]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(path)
        sequence = TaskContext.get().partitionId() << 32
        held, total = [], 0       # parts that wait for their group: [doc_id, start, length, crc, n, ids]
        out: list[tuple] = []

        def place(windows: list[list[tuple]]) -> None:
            nonlocal sequence
            for window in windows:
                at = 0
                for doc, start, length, crc, n, ids in window:
                    out.append((doc, start, length, crc, n, sequence, at, ids))
                    at += length
                sequence += 1

        def table(id_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*out))
            arrays = [pa.array(c, t or id_type) for c, t in zip(cols, kinds)]
            if with_ids:
                flat = np.frombuffer(b"".join(cols[7]), "<i4")
                ends = np.concatenate(([0], np.cumsum(cols[2]))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded(texts(batch), ids_of)):
                n = len(ids) // 4
                full, parts = cuts(n, capacity, max_part)

                def piece(start: int, length: int) -> tuple:
                    own = ids[4 * start:4 * (start + length)]
                    return doc, start, length, zlib.crc32(own), n, bytes(own) if with_ids else None

                place([[piece(s, capacity)] for s in full])
                for start, length in parts:
                    held.append(piece(start, length))
                    total += length
                if total >= enough:
                    place([[held[i] for i in w] for w in pack_group([h[2] for h in held], capacity)])
                    held, total = [], 0
                if len(out) >= 4096:
                    yield table(id_type)
        if held:
            place([[held[i] for i in w] for w in pack_group([h[2] for h in held], capacity)])
        if out:
            yield table(id_type)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(giving_back(run, lambda: text_ids(path).release()), schema + (", ids array<int>" if with_ids else ""))
