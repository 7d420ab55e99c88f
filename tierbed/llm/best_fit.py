"""Best-fit-decreasing packing of whole documents.

Documents longer than a sequence are cut into full pieces and a last one; every other document
stays whole. Best-fit decreasing looks at nothing but lengths, so it runs on the histogram of
piece lengths: from the longest down, pieces go to the open sequence with the tightest remaining
capacity that holds them, which a segment tree over the capacities finds in logarithmic time, or
else to a new one. Pieces of one length and sequences of one capacity are interchangeable, so each
step places a whole range of pieces (by rank among those of their length) into a whole range of
sequences; the result is that of placing them one by one.

The histogram has at most ``sequence_length`` entries and the plan a number of ranges that depends
on ``sequence_length`` alone, whatever the corpus: both are safe on the driver and in tasks.
Texts are never shuffled. Pieces get their rank from counts by task and length, so a length that
most documents share is no hot key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.storage import saved
from tierbed.llm.text import blocks, encoded
from tierbed.llm.tokenizer import shared_tokenizer


class OpenCapacities:
    """Segment tree over capacities ``0..most``: which of them some open sequence has left."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.held = [False] * (2 * self.leaves)

    def put(self, capacity: int, held: bool) -> None:
        node = self.leaves + capacity
        self.held[node] = held
        while node > 1:
            node //= 2
            self.held[node] = self.held[2 * node] or self.held[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The least held capacity that is ``length`` or more."""
        node = self.leaves + length
        while not self.held[node]:
            while node & 1:  # a right child: what follows is under an ancestor
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.held[2 * node] else 2 * node + 1
        return node - self.leaves


class Plan(NamedTuple):
    """Where pieces go, one entry a range of ranks of one length, sorted by length and rank.

    The piece of rank ``first_rank + q`` is number ``q % each`` of those added to sequence
    ``sequence + q // each``, which was filled up to ``filled`` before.
    """

    length: np.ndarray
    first_rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    filled: np.ndarray
    n_sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        starts = np.searchsorted(self.length, length, "left")
        stops = np.searchsorted(self.length, length, "right") - 1
        while (starts < stops).any():  # the last range that begins at the rank or before
            middle = (starts + stops + 1) // 2
            before = self.first_rank[middle] <= rank
            starts = np.where(before, middle, starts)
            stops = np.where(before, stops, middle - 1)
        q = rank - self.first_rank[starts]
        each = self.each[starts]
        return self.sequence[starts] + q // each, self.filled[starts] + q % each * length


def best_fit(counts: dict[int, int], most: int) -> Plan:
    """Best-fit decreasing of ``counts`` pieces by length into sequences of ``most``."""
    tree = OpenCapacities(most)
    waiting: dict[int, list[tuple[int, int]]] = {}
    ranges: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            waiting.setdefault(capacity, []).append((first, n))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = most
                first, n = sequences, -(-left // (most // length))
                sequences += n
            else:
                first, n = waiting[room].pop()
                if not waiting[room]:
                    tree.put(room, False)
            # The tightest sequence stays the tightest until it holds no more of this length.
            each = room // length
            full = min(n, left // each)
            ranges.append((length, rank, first, each, most - room))
            put(room - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < n:
                put(room - left * length, first + full, 1)
                put(room, first + full + 1, n - full - 1)
                left = 0
    columns = np.array(sorted(ranges), np.int64).reshape(-1, 5).T
    return Plan(*columns, n_sequences=sequences)


def _pieces(most: int, end_id: int, path: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part = shared_tokenizer(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(most + 1, np.int64)
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for a, b in blocks(texts):
                rows, at = [], []
                for i, doc in enumerate(tokenizer.texts(encoded(texts[a:b])), a):
                    doc += end
                    for piece, start in enumerate(range(0, len(doc), 4 * most)):
                        ids_ = doc[start : start + 4 * most]
                        length = len(ids_) // 4
                        rows.append((piece, start // 4, length, zlib.crc32(ids_), int(seen[length]), ids_))
                        seen[length] += 1
                        at.append(i)
                piece, start, length, crc, nth, raw = zip(*rows, strict=True)
                columns = {
                    "doc_id": ids.take(pa.array(at, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array([part] * len(rows), pa.int32()),
                    "nth": pa.array(nth, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(
                        [np.frombuffer(x, "<u4").astype(np.int32) for x in raw], pa.list_(pa.int32())
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _placed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            sequence, offset = plan.place(
                batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            )
            columns["sequence_id"] = pa.array(sequence, pa.int64())
            columns["offset"] = pa.array(offset, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack_best_fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_length: int = 4096,
    end_id: int = 1,
    tokenizer_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its text's ids and one ``end_id``. Pieces of ``sequence_length`` ids are cut from
    longer documents only, each a sequence of its own. Sequences are numbered from 0; the pieces
    of one lie there without gaps from 0 on. ``with_ids`` adds the ids themselves.

    Null and empty texts have the end id alone. Every row is a document of its own, also when ids
    repeat or are null. Pieces of equal length go to sequences in the order of the input's tasks,
    so which of them shares a sequence with which others depends on the input's files; the number
    of sequences does not. Other columns are ignored; an empty table gives no rows.
    ``tokenizer_path`` is a file all executors can read; by default the installed public vocabulary.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    ids = ", ids array<int>" if with_ids else ""
    pieces = saved(
        rows.mapInArrow(
            _pieces(sequence_length, end_id, tokenizer_path, with_ids),
            f"{fields}, part int, nth bigint{ids}",
        ),
        "best-fit-pieces",
    )

    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = saved(
        by_task.select(
            "length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
        ),
        "best-fit-ranks",
    )
    # One row a length: at most ``sequence_length`` of them.
    counts = {r.length: r.n for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit(counts, sequence_length)

    # The ranks grow with the number of tasks, so they are never broadcast.
    ranked = pieces.join(firsts.drop("n").hint("merge"), ["length", "part"]).withColumn(
        "rank", F.col("first") + F.col("nth")
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return ranked.select(*kept, "rank").mapInArrow(
        _placed(plan), f"{fields}{ids}, sequence_id bigint, offset bigint"
    )
