"""Hierarchical packing: tiers of context sizes, gaps of long windows filled from short ones.

A document's full windows are sequences as they are. What remains of it is routed to the
smallest tier that holds it. Tiers are packed from the longest to the shortest: a window
starts with the longest remaining piece of its tier, and its gap is filled with the
longest piece of a shorter tier that fits, again and again. If nothing fits, a short
piece is cut to measure and its rest goes back to its tier. Windows of a size form step
groups with the same number of ids each and, by size of attention work, nearly the
same cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from contractlens.llm.common import id_and_text, slices
from contractlens.llm.library_ids import WORDS, text_encoder

TIERS = (2048, 1024, 512, 256)
#: Remainders that are packed together; what a task holds in memory.
POOL = 4096
#: Ids in a step group: that many windows of any one size.
STEP_IDS = 1 << 16


class Pool:
    """Pieces by length, with a bitmap of the lengths that are there."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.bits = 0

    def add(self, piece: tuple[int, int, int]) -> None:
        """A piece: (document, start, length)."""
        length = piece[2]
        self.by_length.setdefault(length, []).append(piece)
        self.bits |= 1 << length

    def _take(self, length: int) -> tuple[int, int, int]:
        kept = self.by_length[length]
        piece = kept.pop()
        if not kept:
            del self.by_length[length]
            self.bits &= ~(1 << length)
        return piece

    def longest(self, most: int) -> tuple[int, int, int] | None:
        """The longest piece of at most `most` ids."""
        bits = self.bits & ((1 << (most + 1)) - 1)
        return self._take(bits.bit_length() - 1) if bits else None

    def shortest(self) -> tuple[int, int, int] | None:
        return self._take((self.bits & -self.bits).bit_length() - 1) if self.bits else None


def pack_pool(pool: Pool, tiers: tuple[int, ...]) -> tuple[list[tuple[int, list]], list]:
    """Full windows (size, pieces) and the pieces that fill no window."""
    windows = []
    for tier in tiers:
        while (first := pool.longest(tier)) is not None:
            if first[2] <= tier // 2 and tier != tiers[-1]:
                pool.add(first)  # of a shorter tier
                break
            window, gap = [first], tier - first[2]
            while gap:
                piece = pool.longest(gap)
                if piece is None:
                    piece = pool.shortest()
                    if piece is None:
                        break
                    doc, start, length = piece
                    pool.add((doc, start + gap, length - gap))
                    piece = (doc, start, gap)
                window.append(piece)
                gap -= piece[2]
            if gap:
                return windows, window
            windows.append((tier, window))
    return windows, []


def closing_windows(pieces: list, most: int) -> list[tuple[int, list]]:
    """Windows of powers of two that hold the last pieces exactly: the binary digits of
    their sum, longest first."""
    total, out = sum(p[2] for p in pieces), []
    queue = list(pieces)
    while total:
        size = min(most, 1 << (total.bit_length() - 1))
        window, gap = [], size
        while gap:
            doc, start, length = queue[0]
            taken = min(gap, length)
            window.append((doc, start, taken))
            gap -= taken
            if taken == length:
                queue.pop(0)
            else:
                queue[0] = (doc, start + taken, length - taken)
        out.append((size, window))
        total -= size
    return out


def step_groups(windows: list[tuple[int, list]], step_ids: int) -> list[int]:
    """A group for each window, by size: windows sorted by cost are dealt to and fro."""
    groups, first = [0] * len(windows), 0
    for size in sorted({s for s, _ in windows}, reverse=True):
        own = [i for i, (s, _) in enumerate(windows) if s == size]
        own.sort(key=lambda i: -sum(p[2] * p[2] for p in windows[i][1]))
        count = -(-len(own) * size // step_ids)
        for at, i in enumerate(own):
            lap, place = divmod(at, count)
            groups[i] = first + (place if lap % 2 == 0 else count - 1 - place)
        first += count
    return groups


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, tiers: tuple[int, ...] = TIERS, pool: int = POOL,
    step_ids: int = STEP_IDS, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset,
    context (the size of its sequence), step_group and ids (little-endian unsigned
    32-bit integers).

    `words` bounds what a worker keeps in mind. Every id lies in one piece. Every sequence has a power of two of ids, so nothing is
    padded; sequences shorter than the shortest tier only close a task.

    Defined cases: a null text counts as empty, and such documents have their end id
    only; repeated rows are packed each; the id is passed on as it is; further
    columns are left out; an empty table gives no rows.

    No shuffle: a task packs what it reads, `pool` remainders at a time, and carries the
    pieces of an unfinished window on. Sequence ids start with the task's number. A
    task that runs again reads the same rows in the same order.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    most = tiers[0]
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers, reverse=True):
        raise ValueError("tiers are powers of two, the longest first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(vocabulary, content.value, words)
        base = TaskContext.get().partitionId() << 40
        end, sequence, group, kind = np.array([end_id], "<u4"), 0, 0, pa.int64()
        held: dict[int, tuple] = {}  # documents by number: id, ids
        number, waiting, whole = 0, Pool(), []

        def rows(windows: list[tuple[int, list]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            groups = step_groups(windows, step_ids)
            out = []
            for (size, pieces), step in zip(windows, groups, strict=True):
                offset = 0
                for doc, start, length in pieces:
                    name, ids = held[doc]
                    own = ids[start : start + length].tobytes()
                    out.append((name, start, length, len(ids), base + sequence, offset, size, base + group + step, own))
                    offset += length
                sequence += 1
            group += max(groups, default=-1) + 1
            for at in range(0, len(out), 4096):
                columns = list(zip(*out[at : at + 4096], strict=True))
                kinds = [kind, *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "context", "step_group", "ids"],
                )

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, whole, held
            windows, left = pack_pool(waiting, tiers)
            yield from rows(whole + windows)
            waiting, whole = Pool(), []
            held = {p[0]: held[p[0]] for p in left}
            for piece in left:
                waiting.add(piece)

        pending = 0
        for batch in slices(batches):
            kind = batch.schema.field("doc_id").type
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.append(encode(text), end)
                held[number] = (name, ids)
                cut = len(ids) - len(ids) % most
                whole += [(most, [(number, s, most)]) for s in range(0, cut, most)]
                if cut < len(ids):
                    waiting.add((number, cut, len(ids) - cut))
                number += 1
                pending += 1 + len(ids) // most
                if pending >= pool:
                    yield from flush()
                    pending = 0
        windows, left = pack_pool(waiting, tiers)
        yield from rows(whole + windows + closing_windows(left, most))

    plain = id_and_text(docs, id_col, text_col)
    kind = dict(plain.dtypes)["doc_id"]
    return plain.mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, "
        "context int, step_group long, ids binary",
    )
