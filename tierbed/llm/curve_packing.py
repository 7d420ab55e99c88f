"""Packing along a space-filling curve.

Every document becomes a point: each word hash gives one pseudo-random coefficient per
dimension, and the coefficients of its words are summed, which projects the hashed word
vector to a few dimensions. Documents are range-sorted by the Hilbert key of their point, so
each range partition holds one stretch of the curve, and each partition packs its documents
one after another into sequences.

Cost: the key is computed twice (Spark samples it for the ranges), texts are shuffled once
and tokenised once. A task holds one Arrow batch and the pieces of one open sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out
from tierbed.llm.text import blocks, encoded, word_hashes
from tierbed.llm.tokenizer import shared_tokenizer

TYPICAL_WORDS = 64


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points (rows) with ``bits`` bits a dimension."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i, axis in enumerate(axes):
            high = (axis >> level) & 1 == 1
            swap = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(flip)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


def document_points(hashes: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Quantised projections to four dimensions; a document without words is the centre."""
    sizes = np.diff(bounds)
    parts = hashes.view(np.uint16).reshape(-1, 4)
    sums = np.zeros((len(sizes), 4))
    full = sizes > 0
    if full.any():
        sums[full] = np.add.reduceat(parts, bounds[:-1][full], axis=0, dtype=np.int64)
    mean = sums / np.maximum(sizes, 1)[:, None] / 65535 - 0.5
    # Standard deviations of a mean over at most TYPICAL_WORDS words: longer texts do not pile
    # up in the corners.
    spread = mean * np.sqrt(12 * np.minimum(sizes, TYPICAL_WORDS))[:, None] * full[:, None]
    unit = 1 / (1 + np.exp(-1.7 * spread))
    return np.minimum((unit * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def _keys(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            keys = [np.zeros(0, np.int64)]
            for a, b in blocks(texts):
                points = document_points(*word_hashes(encoded(texts[a:b], lower=True)), bits)
                keys.append(hilbert_key(points, bits))
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["curve"] = pa.array(np.concatenate(keys))
            yield pa.RecordBatch.from_pydict(columns)

    return run


class _Packer:
    """Cuts a stream of documents into full sequences; the rest into powers of two."""

    def __init__(self, length: int, first: int) -> None:
        self.length, self.sequence, self.filled = length, first, 0
        self.open: list[tuple] = []

    def add(self, row: int, ids: bytes) -> list[tuple]:
        done, start, total = [], 0, len(ids) // 4
        while start < total:
            n = min(self.length - self.filled, total - start)
            part = ids[4 * start : 4 * (start + n)]
            self.open.append((row, start, part, total))
            start, self.filled = start + n, self.filled + n
            if self.filled == self.length:
                done += self._close(self.length)
        return done

    def _close(self, size: int) -> list[tuple]:
        """The first ``size`` ids of the open pieces as one sequence."""
        out, at = [], 0
        while at < size:
            row, start, part, total = self.open.pop(0)
            n = min(len(part) // 4, size - at)
            out.append((row, start, part[: 4 * n], total, self.sequence, at))
            if 4 * n < len(part):
                self.open.insert(0, (row, start + n, part[4 * n :], total))
            at += n
        self.sequence, self.filled = self.sequence + 1, self.filled - size
        return out

    def rest(self) -> list[tuple]:
        out = []
        while self.filled:
            out += self._close(1 << (self.filled.bit_length() - 1))
        return out


def _pack(length: int, end_id: int, path: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared_tokenizer(path)
        packer = _Packer(length, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], "<u4").tobytes()
        held: list = []

        def rows(pieces: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            columns = {
                "doc_id": pa.array([p[0] for p in pieces], id_type),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([len(p[2]) // 4 for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p[2]) for p in pieces], pa.int64()),
                "doc_tokens": pa.array([p[3] for p in pieces], pa.int64()),
                "sequence_id": pa.array([p[4] for p in pieces], pa.int64()),
                "offset": pa.array([p[5] for p in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(
                    [np.frombuffer(p[2], "<u4").astype(np.int32) for p in pieces],
                    pa.list_(pa.int32()),
                )
            return pa.RecordBatch.from_pydict(columns)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            texts, names = batch.column("text"), batch.column("doc_id").to_pylist()
            for a, b in blocks(texts):
                held = []
                for name, ids in zip(
                    names[a:b], tokenizer.texts(encoded(texts[a:b])), strict=True
                ):
                    held += packer.add(name, ids + end)
                if held:
                    yield rows(held, id_type)
        if last := packer.rest():
            yield rows(last, id_type)

    return run


def pack_along_curve(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_length: int = 2048,
    end_id: int = 1,
    tokenizer_path: str | None = None,
    bits: int = 10,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every document's ids and one ``end_id`` lie in the pieces, each id in exactly one. All
    sequences hold ``sequence_length`` ids, but for the last few of a partition, whose lengths
    are powers of two; so nothing is padded. ``with_ids`` adds the ids themselves.

    Null and empty texts have the end id alone. Every row is a document of its own, also when
    ids repeat or are null. Ties on the curve go by id, then by text. Other columns are
    ignored; an empty table gives no rows. ``tokenizer_path`` is a file all executors can
    read; by default the installed public vocabulary.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, curve bigint"
    keyed = rows.mapInArrow(_keys(bits), schema)
    order = ["curve", "doc_id", F.xxhash64("text")]
    sorted_ = keyed.repartitionByRange(fan_out(docs.sparkSession), *order).sortWithinPartitions(*order)
    out = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, "
        "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    out += ", ids array<int>" if with_ids else ""
    return sorted_.select("doc_id", "text").mapInArrow(
        _pack(sequence_length, end_id, tokenizer_path, with_ids), out
    )
