"""Packing documents into token sequences by an order-preserving dynamic program.

Documents of a partition keep their order. Their tokens form one stream, cut into
windows of at most ``window`` tokens. Cuts lie at ends of documents (free) or of
sentences (a small penalty); only where neither comes within ``step`` tokens may
a cut fall inside a sentence (a larger penalty). The program minimises padding
plus penalties; as a window's padding is ``window - (end - start)``, the best
start for an end is the least ``cost + position`` within reach, which a monotone
queue gives in constant time.

The stream is worked off in stretches of some hundred windows: at the end of one, the
cheapest cut within the last two windows is kept and the program goes on from it. An
optimal run has a cut there that costs no less, and one more window leads from ours to
its next, so a stretch loses at most one window's cost against the optimum of the whole
stream. Each partition ends with one partly filled window, and no document is moved
between partitions, so there is no shuffle.

Defined results: a null or empty text is its end id alone; null and repeated ids
are documents like others; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import text_slices
from waymark.llm.tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


class Cuts:
    """Cuts of least padding plus penalties along a stream of marks, places where it may be cut.

    Marks rise from 0 and no gap between them is above ``window``. The first mark held is a cut.
    """

    def __init__(self, window: int):
        self.window = window
        self._begin(0)

    def _begin(self, at: int) -> None:
        self.at, self.fee, self.cost, self.before = [at], [0.0], [0.0], [0]
        self.queue: deque[tuple[float, int, int]] = deque([(float(at), at, 0)])

    def add(self, marks: list[int], fees: list[float]) -> None:
        window, queue, j = self.window, self.queue, len(self.at) - 1
        cost, before = self.cost.append, self.before.append
        self.at += marks
        self.fee += fees
        for here, fee in zip(marks, fees, strict=True):
            j += 1
            reach = here - window
            while queue[0][1] < reach:
                queue.popleft()
            least, _, k = queue[0]
            # a window's padding is window - (end - start), so starts compare by cost + position
            key = least + window + fee
            while queue and queue[-1][0] >= key:
                queue.pop()
            queue.append((key, here, j))
            cost(key - here)
            before(k)

    def settled(self, ended: bool = False) -> list[int]:
        """Cuts from the last one known up to the end of the stream, or to the cheapest one within two windows of what is there."""
        j = last = len(self.at) - 1
        if not ended:
            near = self.at[-1] - 2 * self.window
            while last and self.at[last] > near:
                last -= 1
            j = min(range(len(self.at) - 1, last, -1), key=self.cost.__getitem__)
        cuts = [j]
        while cuts[-1]:
            cuts.append(self.before[cuts[-1]])
        found = [self.at[c] for c in reversed(cuts)]
        marks, fees = self.at[j + 1 :], self.fee[j + 1 :]
        self._begin(self.at[j])
        self.add(marks, fees)
        return found


class Packer:
    """Packs a stream of documents; ``add`` and ``close`` return finished pieces."""

    def __init__(self, window: int, sentence_end: np.ndarray, first_sequence: int, stretch: int = 256, sentence_fee: float = 2, inner_fee: float = 8, step: int = 32):
        self.window, self.sentence_end, self.sequence = window, sentence_end, first_sequence
        self.stretch, self.sentence_fee, self.inner_fee, self.step = stretch * window, sentence_fee, inner_fee, min(step, window)
        self.cuts = Cuts(window)
        #: documents that aren't out yet: doc_id, place of the first id in the stream, ids
        self.held: deque[tuple[object, int, np.ndarray]] = deque()
        self.end, self.next = 0, self.stretch

    def marks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document where it may be cut, and their fees: its end, ends of sentences, and others where these are far."""
        fee = np.full(len(ids) + 1, np.inf)
        fee[1:][self.sentence_end[ids]] = self.sentence_fee
        fee[0] = fee[-1] = 0
        marks = np.flatnonzero(fee < np.inf)
        for k in np.flatnonzero(np.diff(marks) > self.step):
            fee[marks[k] + self.step : marks[k + 1] : self.step] = self.inner_fee
        marks = np.flatnonzero(fee < np.inf)[1:]
        return marks, fee[marks]

    def add(self, doc_id: object, ids: np.ndarray) -> list[tuple]:
        marks, fees = self.marks(ids)
        self.cuts.add((marks + self.end).tolist(), fees.tolist())
        self.held.append((doc_id, self.end, ids))
        self.end += len(ids)
        if self.end < self.next:
            return []
        self.next = self.end + self.stretch
        return self._pieces(self.cuts.settled())

    def close(self) -> list[tuple]:
        return self._pieces(self.cuts.settled(ended=True))

    def _pieces(self, cuts: list[int]) -> list[tuple]:
        pieces = []
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            offset = 0
            while a < z:
                doc_id, first, ids = self.held[0]
                part = ids[a - first : z - first]
                pieces.append((doc_id, a - first, len(part), part.tobytes(), len(ids), self.sequence, offset))
                offset += len(part)
                a += len(part)
                if a == first + len(ids):
                    self.held.popleft()
            self.sequence += 1
        return pieces


def pack(docs: DataFrame, window: int = 4096, end_id: int = 2, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all documents (doc_id, text) in sequences of at most ``window`` tokens.

    A document's tokens are its text's, then ``end_id``. Columns: doc_id, start (its
    document's ids before the piece), length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset (where the piece starts in its sequence).
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path)
        packer = Packer(window, code.sentence_end, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], dtype="<u4")

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*pieces, strict=True), kinds, strict=True)], names=NAMES)

        for batch in text_slices(batches, 1):
            texts = ("" if t is None else t for t in batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), code.encode(texts), strict=True):
                if pieces := packer.add(doc_id, np.concatenate([ids, end])):
                    yield rows(pieces)
        if pieces := packer.close():
            yield rows(pieces)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, SCHEMA)
