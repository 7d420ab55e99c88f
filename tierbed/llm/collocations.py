"""Phrase collocations by prefix-free parsing.

Each text becomes a sequence of words and breaks (piece ends), led by as many breaks as a phrase
has words less one. A window of that many tokens whose hash is a multiple of ``every`` is a
trigger: a chunk ends with it and the next one begins with it, so chunks overlap by one window and
depend on nothing but their own content. Shared passages therefore give the same chunks wherever
they stand, and the distinct chunks with their frequencies, the dictionary, stand for all texts.

A phrase is counted in the chunk where it ends, if it ends behind the first window: an overlap is
counted once, in the earlier chunk. Counts are weighted by the chunk's frequency, and made in two
passes over the dictionary. The first adds up hashes of word pairs and notes in a bit array which
may be frequent (collisions only let more of them pass). The second gives out the exact text of
all words, of pairs that pass and of longer phrases whose pairs all pass, each with a count made by
exact word numbers, and Spark adds these up. The bit array has one bit a word of the corpus, at
most ``2**MOST_BITS``; beyond that more infrequent pairs pass, and results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out, saved
from tierbed.llm.text import blocks, combine, encoded, mix, word_hashes

BREAK = b"."
# What ends a piece, and what else parts words.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_PIECE_ENDS + b"\t", BREAK * len(_PIECE_ENDS) + b" ")
LEAST_BITS, MOST_BITS = 16, 27
# Bytes of chunks counted at once, and pairs that a task holds before it gives them out.
COUNTED_BYTES, HELD_PAIRS = 1 << 22, 1 << 21
# Pairs of one shard of the first pass, by the words of the dictionary.
SHARD_WORDS = 1 << 22


def _tokens(text: bytes) -> bytes:
    """Words and breaks, each after a blank; runs of breaks are shortened."""
    spread = text.lower().translate(_TABLE).replace(BREAK, b" . ")
    return b" ".join([b"", *spread.split()]).replace(b" . .", b" .")


def _chunks(width: int, every: int):
    """Chunks of texts; ``words`` is their number of tokens behind the overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = b" ".join([BREAK] * width)
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            for a, b in blocks(texts):
                docs = [lead + _tokens(x) for x in encoded(texts[a:b])]
                hashes, bounds = word_hashes(docs)
                flat = np.frombuffer(b" ".join(docs) + b" ", np.uint8)
                ends = np.flatnonzero(flat == 0x20)
                starts = np.concatenate(([0], ends[:-1] + 1))
                window = hashes.copy()
                for i in range(1, width):
                    window[i:] = combine(window[i:], hashes[:-i])
                trigger = mix(window) % np.uint64(every) == 0
                for i in range(width):
                    trigger[bounds[:-1] + i] = False
                trigger[bounds[1:] - 1] = True
                last = np.flatnonzero(trigger)
                owner = np.searchsorted(bounds, last, "right") - 1
                first = np.empty_like(last)
                first[0] = 0
                first[1:] = np.where(owner[1:] == owner[:-1], last[:-1] + 1 - width, bounds[owner[1:]])
                new = last - first + 1 - width
                raw, keep = flat.tobytes(), new > 0
                cut = zip(starts[first[keep]].tolist(), ends[last[keep]].tolist(), strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": langs[a:b].take(pa.array(owner[keep])),
                        "chunk": pa.array([raw[i:j] for i, j in cut], pa.binary()).cast(pa.string()),
                        "words": pa.array(new[keep], pa.int64()),
                    }
                )

    return run


class _Block:
    """Dictionary chunks of one language as word numbers of this block."""

    def __init__(self, chunks: list[bytes], weights: np.ndarray, width: int) -> None:
        words = b" ".join(chunks).split(b" ")
        numbers: dict[bytes, int] = {BREAK: 0}
        number = numbers.setdefault
        self.at = np.array([number(w, len(numbers)) for w in words], np.int64)
        self.words = list(numbers)
        sizes = np.array([c.count(b" ") + 1 for c in chunks])
        self.weight = np.repeat(weights, sizes)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.width = width

    def phrases(self, n: int, also: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases of ``n`` words (a row each, in word numbers) and their weighted counts.

        Those that end where ``also`` is false are left out.
        """
        here = (self.place >= self.width) & (self.at != 0)
        for i in range(1, n):
            here[i:] &= self.at[:-i] != 0
        if also is not None:
            here &= also
        ends = np.flatnonzero(here)
        if not len(ends):
            return np.zeros((0, n), np.int64), np.zeros(0, np.int64)
        key, base = self.at[ends - n + 1], len(self.words)
        for i in range(n - 2, -1, -1):
            if base ** (n - i) >= 1 << 63:  # number the phrases so far
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self.words) + self.at[ends - i]
        order = np.argsort(key)
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        counts = np.add.reduceat(self.weight[ends[order]], first)
        seen = ends[order[first]]
        return self.at[seen[:, None] + np.arange(1 - n, 1)], counts

    def hashes(self, lang: str) -> np.ndarray:
        """A hash of each word in this language."""
        out, _ = word_hashes([b" ".join(self.words)])
        own, _ = word_hashes([b"\0" + lang.encode().translate(None, b" \t\n\x0b\x0c\r")])
        return combine(out, own[:1])


def _languages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Chunks by language, gathered to blocks."""
    held: dict[str, list] = {}
    total = 0

    def rest():
        for lang, parts in held.items():
            yield lang, [c for cs, _ in parts for c in cs], np.concatenate([w for _, w in parts])

    for batch in batches:
        chunks = encoded(batch.column("chunk"))
        freq = batch.column("freq").to_numpy()
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        for a, b in blocks(batch.column("chunk"), COUNTED_BYTES):
            for code in np.unique(codes[a:b]).tolist():
                at = a + np.flatnonzero(codes[a:b] == code)
                held.setdefault(langs.dictionary[code].as_py(), []).append(
                    ([chunks[i] for i in at], freq[at])
                )
            total += sum(len(c) for c in chunks[a:b])
            if total >= COUNTED_BYTES:
                yield from rest()
                held, total = {}, 0
    yield from rest()


def _pairs(width: int, shard_bits: int, least: int):
    """Pair hashes by their first bits: sorted, with counts up to ``least``."""

    def fold(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.minimum(np.add.reduceat(counts, first), least)

    def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = np.arange(1, 1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits)
        ends = [*np.searchsorted(keys, cuts).tolist(), len(keys)] if shard_bits else [len(keys)]
        rows = [(i, a, b) for i, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([i for i, _, _ in rows], pa.int64()),
                "keys": pa.array([keys[a:b].astype("<u8").tobytes() for _, a, b in rows], pa.binary()),
                "counts": pa.array([counts[a:b].astype("<u4").tobytes() for _, a, b in rows], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for lang, chunks, weights in _languages(batches):
            block = _Block(chunks, weights, width)
            pairs, counts = block.phrases(2)
            if not len(pairs):
                continue
            h = block.hashes(lang)
            parts.append((combine(h[pairs[:, 0]], h[pairs[:, 1]]), np.minimum(counts, least)))
            size += len(pairs)
            if size > HELD_PAIRS:
                keys, counts = fold(parts)
                parts, size = [(keys, counts)], len(keys)
                if size > HELD_PAIRS // 2:
                    yield out(keys, counts)
                    parts, size = [], 0
        if parts:
            yield out(*fold(parts))

    return run


def _shard_bits(shard_bits: int, bits: int, least: int):
    """The bits of a shard's pairs whose counts reach ``least``; shards are stretches of the array."""
    size = 1 << (bits - shard_bits)

    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        keys, at = np.unique(keys, return_inverse=True)
        frequent = keys[np.bincount(at, counts) >= least]
        held = np.zeros(size, bool)
        held[((frequent >> np.uint64(64 - bits)) & np.uint64(size - 1)).astype(np.int64)] = True
        return pa.table(
            {"shard": table.column("shard")[:1], "bits": pa.array([np.packbits(held).tobytes()], pa.binary())}
        )

    return run


def _texts(width: int, most: int, bits: int, shared):
    """Words, pairs that pass and longer phrases whose pairs all pass, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = np.frombuffer(shared.value, np.uint8)
        for lang, chunks, weights in _languages(batches):
            block = _Block(chunks, weights, width)
            h = block.hashes(lang)[block.at]
            at = np.zeros(len(h), np.int64)
            at[1:] = (combine(h[:-1], h[1:]) >> np.uint64(64 - bits)).astype(np.int64)
            passes = (array[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            also = None
            for n in range(1, most + 1):
                if n == 2:
                    also = passes
                elif n > 2:
                    also = also & np.concatenate((np.zeros(n - 2, bool), passes[: 2 - n]))
                phrases, counts = block.phrases(n, also)
                texts = [b" ".join(x) for x in zip(*([block.words[i] for i in c] for c in phrases.T.tolist()))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(texts), pa.string()),
                        "size": pa.array([n] * len(texts), pa.int32()),
                        "phrase": pa.array(texts, pa.binary()).cast(pa.string()),
                        "f": pa.array(counts, pa.int64()),
                    }
                )

    return run


def chunk_dictionary(docs: DataFrame, width: int = 2, every: int = 16) -> DataFrame:
    """Distinct chunks of ``docs(lang, text)``: ``lang, chunk, freq, words``.

    ``chunk`` has its words and breaks (``.``) with blanks between, the first ``width`` of which are
    the overlap with the chunk before (breaks where there is none); ``words`` counts the others. A
    text without words has no chunk but may have one of breaks. ``lang`` must not be null.
    """
    lang = docs.select("lang", F.col("text").cast("string").alias("text"))
    found = lang.mapInArrow(_chunks(width, every), "lang string, chunk string, words bigint")
    return found.groupBy("lang", "chunk").agg(F.count("*").alias("freq"), F.first("words").alias("words"))


def phrase_counts(docs: DataFrame, most: int = 3, least: int = 10, every: int = 16) -> DataFrame:
    """``lang, size, phrase, f``: exact counts of all words, and of all phrases of up to ``most``
    words that occur ``least`` times or more; some rarer ones are among them."""
    spark = docs.sparkSession
    width = max(1, most - 1)
    parse = saved(chunk_dictionary(docs, width, every), "phrase-chunks")
    sizes = parse.agg(F.sum("words").alias("own"), F.sum(F.col("words") * F.col("freq")).alias("all")).first()
    bits = min(MOST_BITS, max(LEAST_BITS, int(sizes["all"] or 0).bit_length()))
    shards = max(fan_out(spark), (sizes["own"] or 0) // SHARD_WORDS)
    shard_bits = min(bits - 3, int(shards - 1).bit_length())
    # Each shard gives one stretch of a bit array of at most 2**MOST_BITS bits.
    found = (
        parse.select("lang", "chunk", "freq")
        .mapInArrow(_pairs(width, shard_bits, least), "shard bigint, keys binary, counts binary")
        .groupBy("shard")
        .applyInArrow(_shard_bits(shard_bits, bits, least), "shard bigint, bits binary")
    )
    array = np.zeros((1 << shard_bits, 1 << (bits - shard_bits - 3)), np.uint8)
    for row in found.collect():
        array[row.shard] = np.frombuffer(row.bits, np.uint8)
    context: SparkContext = spark.sparkContext
    shared = context.broadcast(array.tobytes())
    texts = parse.select("lang", "chunk", "freq").mapInArrow(
        _texts(width, most, bits, shared), "lang string, size int, phrase string, f bigint"
    )
    return texts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _words(phrase: str, first: str, n: str) -> str:
    return f"array_join(slice(split({phrase}, ' ', -1), {first}, {n}), ' ')"


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    most: int = 3,
    least: int = 10,
    covered_percent: int = 50,
    top: int = 2000,
    every: int = 16,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased in A-Z, split at ``[.,;:!?\\x0A-\\x0D]`` and then into words between blanks
    and tabs. A phrase has 2 to ``most`` words of one piece and occurs ``a`` >= ``least`` times;
    it is dropped if a longer one that contains it occurs ``covered_percent`` of ``a`` times or more.
    ``l`` and ``r`` are the counts of its two parts at the cut with the least ``score``,
    floor(1000000 * a * a / (l * r)), the first such cut; ``n`` counts the language's words.
    Ranks go by score, then ``a``, descending, then by the phrase's bytes. Decimals of 38 digits
    keep the arithmetic exact for counts up to 10**15.

    A null language is ``und``, as is a language of that name. Null, empty and blank texts have no
    words. Repeated rows count as often as they occur; ids are not looked at, nor are other
    columns. An empty table gives no rows.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    counts = saved(
        phrase_counts(docs.select(lang, F.col(text_col).alias("text")), most, least, every), "phrase-counts"
    )
    words = counts.filter("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.filter(F.col("f") >= least)
    candidates = frequent.filter("size > 1").withColumnRenamed("f", "a")

    longer = candidates.filter("size > 2").select(
        "lang", F.col("a").alias("longer"), "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"), "phrase"
    )
    inner = longer.select(
        "lang", "longer", "m", "phrase", F.explode(F.expr("sequence(1, size - m + 1)")).alias("k")
    ).select("lang", "longer", F.expr(_words("phrase", "k", "m")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a"))
    )

    cuts = kept.select(
        "lang", "phrase", "a", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.expr(_words("phrase", "1", "k")).alias("left"),
        F.expr(_words("phrase", "k + 1", "size - k")).alias("right"),
    )
    left = frequent.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    exact = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("a", "l", "r")]
    score = F.expr("(decimal(1000000) * a * a) div (l * r)")
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .select("lang", "phrase", "k", *exact)
        .select("lang", "phrase", F.col("a").cast("bigint").alias("a"), F.struct(
            score.alias("score"), "k", F.col("l").cast("bigint").alias("l"), F.col("r").cast("bigint").alias("r")
        ).alias("cut"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # The best of each of many parts of a language first, so that none is sorted in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(fan_out(docs.sparkSession)))
    in_part = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("part", part).withColumn("rank", F.row_number().over(in_part))
    ranked = best.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
