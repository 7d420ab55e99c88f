"""Line deduplication through a sharded minimal perfect hash.

1. Every document gives the 128-bit hashes of its distinct line keys; per hash, the documents
   are counted and the smallest id is kept.
2. The hashes that repeat are dealt to shards. Each shard becomes one row: a minimal perfect
   hash and, in its order, a fingerprint, a count and an owner array.
3. Documents probe the arrays: hashes go to the task that holds their shard, read as a sorted
   stream after the shard's row. A shard is met in several tasks, so a line that a third of all
   documents hold is not the work of one.
4. The hashes a document loses come back to it, and its text is written anew.

A task holds one shard's arrays and one Arrow batch. Shards have about ``SHARD_KEYS`` keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out, free_name, saved
from tierbed.llm.text import mix

SHARD_KEYS = 500_000
MIN_CODE_POINTS = 10
SPACE = b" \t\n\x0b\x0c\r"


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1.

    Keys that are alone at their place in a level's bit array stay there, the others go on to
    the next level; a key's number is the rank of its bit.
    """

    def __init__(self, levels: list[int], bits: np.ndarray) -> None:
        self.levels, self.bits = levels, bits
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        levels, flags, left = [], [], np.asarray(keys, np.uint64)
        while len(left):
            size = (2 * len(left) + 63) // 64 * 64
            at = cls._place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            flags.append(alone)
            levels.append(size)
            left = left[~alone[at]]
        joined = np.concatenate(flags) if flags else np.zeros(0, bool)
        return cls(levels, np.packbits(joined, bitorder="little").view("<u8"))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys; any number or -1 for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        left, offset = np.arange(len(keys)), 0
        for level, size in enumerate(self.levels):
            at = self._place(keys[left], level, size) + offset
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.ranks[at >> 6] + np.bitwise_count(below))[hit]
            left, offset = left[~hit], offset + size
        return out


def line_keys(text: bytes) -> tuple[list[bytes], list[bytes | None]]:
    """Lines of a text, and their keys; None for keys below ten code points."""
    lines = text.split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(SPACE).lower()
        n = len(key)
        long_enough = n >= 4 * MIN_CODE_POINTS or n >= MIN_CODE_POINTS and len(key.decode()) >= MIN_CODE_POINTS
        keys.append(key if long_enough else None)
    return lines, keys


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes for each key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _distinct_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes] = []
        owners = []
        for i, text in enumerate(_texts(batch)):
            own = set(line_keys(text)[1])
            own.discard(None)
            keys += own
            owners.append(np.full(len(own), i))
        if not keys:
            continue
        pair = _hashes(keys)
        at = pa.array(np.concatenate(owners))
        yield pa.RecordBatch.from_pydict(
            {
                "h0": pa.array(pair[:, 0].view(np.int64)),
                "h1": pa.array(pair[:, 1].view(np.int64)),
                "id": batch.column("id").take(at),
                "row": batch.column("row").take(at),
            }
        )


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.drop_duplicates("h0")  # equal first halves: a chance of 2**-64 for two lines
    first = part["h0"].to_numpy().view(np.uint64)
    perfect = MinimalPerfectHash.build(first)
    order = np.argsort(perfect.find(first))
    arrays = {
        "levels": np.array(perfect.levels, "<i8"),
        "bits": perfect.bits,
        "fingerprints": part["h1"].to_numpy()[order],
        "counts": np.minimum(part["held"].to_numpy()[order], 2**32 - 1).astype("<u4"),
        "owners": part["owner"].to_numpy()[order],
    }
    row = {"shard": part["shard"].iloc[0]} | {k: v.tobytes() for k, v in arrays.items()}
    return pd.DataFrame([row])


class _Shard:
    def __init__(self, row: dict) -> None:
        levels = np.frombuffer(row["levels"], "<i8").tolist()
        self.perfect = MinimalPerfectHash(levels, np.frombuffer(row["bits"], "<u8"))
        self.fingerprints = np.frombuffer(row["fingerprints"], "<i8")
        self.counts = np.frombuffer(row["counts"], "<u4")
        self.owners = np.frombuffer(row["owners"], "<i8")

    def loses(self, h0: np.ndarray, h1: np.ndarray, ids: pa.Array) -> np.ndarray:
        """Whether the document of each probe is to lose the line."""
        at = self.perfect.find(h0.view(np.uint64))
        known = (at >= 0) & (self.fingerprints[at] == h1) & (self.counts[at] > 1)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        return known & (null | (self.owners[at] != ids.fill_null(0).to_numpy(zero_copy_only=False)))


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, held = None, None
    for batch in batches:
        index = batch.column("levels").is_valid().to_numpy(zero_copy_only=False)
        place = batch.column("place").to_numpy()
        cuts = np.flatnonzero(index | (np.diff(place, prepend=place[:1]) != 0))
        for a, b in zip([0, *cuts], [*cuts, len(place)], strict=True):
            if a == b:
                continue
            if index[a]:
                shard, held = _Shard(batch.slice(a, 1).to_pylist()[0]), place[a]
                a += 1
            part = batch.slice(a, b - a)
            if a == b or held != place[a]:
                continue
            h0, h1 = (part.column(n).to_numpy() for n in ("h0", "h1"))
            hit = pa.array(shard.loses(h0, h1, part.column("id")))
            yield part.select(["row", "h0"]).filter(hit)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, sizes, dropped = [], [], []
        lost = batch.column("lost").to_pylist()
        for text, gone in zip(_texts(batch), lost, strict=True):
            lines, keys = line_keys(text)
            sizes.append(len(lines))
            if gone:
                out = {h & (2**64 - 1) for h in gone}
                lines = [
                    line
                    for line, key in zip(lines, keys, strict=True)
                    if key is None or int.from_bytes(xxhash.xxh3_128_digest(key)[:8], "big") not in out
                ]
            dropped.append(sizes[-1] - len(lines))
            texts.append(b"\n".join(lines))
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "lost")}
        columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
        columns["n_lines"] = pa.array(sizes, pa.int64())
        columns["n_dropped"] = pa.array(dropped, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def line_index(lines: DataFrame) -> tuple[DataFrame, int]:
    """Shard rows over the repeated hashes of ``lines(h0, h1, id)``, and the number of shards."""
    repeated = saved(
        lines.groupBy("h0", "h1")
        .agg(
            F.count("*").alias("held"),
            F.min("id").alias("owner"),
            F.max("id").alias("last"),
            F.max(F.col("id").isNull()).alias("nulls"),
        )
        .filter(F.col("owner").isNotNull() & (F.col("nulls") | (F.col("owner") != F.col("last"))))
        .select("h0", "h1", "held", "owner"),
        "line-repeated",
    )
    shards = repeated.count() // SHARD_KEYS + 1
    dealt = repeated.withColumn("shard", F.pmod("h0", F.lit(shards)))
    schema = "shard long, levels binary, bits binary, fingerprints binary, counts binary, owners binary"
    return saved(dealt.groupBy("shard").applyInPandas(_build, schema), "line-index"), shards


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """``id, row, text, n_lines, n_dropped`` and the carried columns as ``c0``, ``c1``, ..."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"),
        *[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(carried)],
    )
    lines = rows.select("id", "text", "row").mapInArrow(
        _distinct_lines, "h0 bigint, h1 bigint, id bigint, row bigint"
    )
    index, shards = line_index(lines)
    tasks = fan_out(docs.sparkSession)
    salts = max(4, -(-tasks // shards))
    salt = F.pmod("row", F.lit(salts))
    probes = lines.withColumn("place", F.pmod("h0", F.lit(shards)) * salts + salt)
    places = F.explode(F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.col("shard") * salts + s))
    met = (
        index.withColumn("place", places)
        .drop("shard")
        .unionByName(probes, allowMissingColumns=True)
        .repartition(tasks, "place")
        .sortWithinPartitions("place", F.col("levels").isNull())
    )
    lost = (
        met.mapInArrow(_probe, "row bigint, h0 bigint")
        .groupBy(F.col("row").alias("lost_row"))
        .agg(F.collect_set("h0").alias("lost"))
    )
    joined = rows.join(lost, F.col("row") == F.col("lost_row"), "left").drop("lost_row")
    schema = joined.drop("text", "lost").schema.add("text", "string")
    return joined.mapInArrow(_rewrite, schema.add("n_lines", "long").add("n_dropped", "long"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, row, text, n_lines, n_dropped``, with repeated lines dropped.

    Lines are split at ``\\n``; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at either
    end and with A-Z in lower case. A key of at least ten code points that two or more documents
    hold loses all its lines but those in the document with the smallest id. ``n_lines`` counts
    before dropping; ``row`` is a hash of id and text, equal for rows alike.

    Ids are integers. Rows with the same id are one document; null ids are one document whose
    id is above all others. Null and empty texts are one empty line. Other columns are ignored;
    an empty table gives no rows.
    """
    return _deduplicated(docs, id_col, text_col, [])


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines dropped from the texts, and ``n_chars``, where there is such a
    column, counted anew for changed texts. Null texts stay null."""
    carried = [name for name in docs.columns if name != text_col]
    flagged = docs.withColumn(empty := free_name(docs, "no_text"), F.col(text_col).isNull())
    out = _deduplicated(flagged, id_col, text_col, [*carried, empty])
    at = {name: F.col(f"c{i}") for i, name in enumerate(carried)}
    changed = F.col("n_dropped") > 0
    at[text_col] = F.when(~F.col(f"c{len(carried)}"), F.col("text"))
    if "n_chars" in carried:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        at["n_chars"] = F.when(changed, counted).otherwise(at["n_chars"])
    return out.select(*[at[name].alias(name) for name in docs.columns])
