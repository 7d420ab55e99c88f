"""SimHash fingerprints and a Hamming search through permuted block tables.

Terms are pairs of neighbouring words; each votes on 64 bits with the bits of its hash, weighted
by its length. Votes are counted 32 bits apart in one number: masking the hash, shifted by k,
with ``0x100000001`` leaves bits k and k + 32, so 32 sums hold 64 counters.

All steps are DataFrame functions. Terms become rows only between a scan and a partial
aggregation in the same task.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 64
PAIR_MASK = (1 << 32) | 1
BUCKET_DOCS = 1000
MAX_BUCKETS = 10_000
SALTS = 8


def terms(text: str) -> Column:
    """Hashes and weights of the word pairs of a text; a single word is a term of its own."""
    words = f"filter(split(coalesce({text}, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    return F.expr(
        f"transform(array({words}), w -> if(size(w) = 1,"
        " array(named_struct('h', xxhash64(w[0]), 'weight', cast(length(w[0]) as bigint))),"
        " zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, size(w)), (a, b) ->"
        " named_struct('h', xxhash64(a, b), 'weight', cast(length(a) + length(b) as bigint)))))[0]"
    )


def voted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint of each group of ``rows(*keys, h, weight)``.

    A bit is set if terms with more than half of the weight set it; without terms it is not.
    Rows without a term (null hash) keep their group.
    """
    counters = [
        F.sum(
            F.shiftrightunsigned("h", k).bitwiseAND(F.lit(PAIR_MASK)) * F.col("weight")
        ).alias(f"c{k}")
        for k in range(32)
    ]
    sums = rows.groupBy(*keys).agg(*counters, F.sum("weight").alias("total"))
    half = F.expr("total div 2")
    bits = []
    for k in range(32):
        low = F.col(f"c{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"c{k}", 32)
        bits.append(F.when(low > half, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
        top = (1 << (k + 32)) - (1 << 64 if k == 31 else 0)
        bits.append(F.when(high > half, F.lit(top)).otherwise(F.lit(0)).cast("bigint"))
    return sums.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / BITS


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _starts(ids: DataFrame) -> list[int]:
    """The ids at which buckets of neighbouring ids begin; the smallest is the first.

    At most ``MAX_BUCKETS`` ids reach the driver. Beyond that many times ``BUCKET_DOCS`` rows
    buckets grow.
    """
    least, n = ids.agg(F.min("id"), F.count("id")).first()
    if least is None:
        return []
    buckets = min(MAX_BUCKETS, n // BUCKET_DOCS + 1)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = ids.agg(F.percentile_approx("id", shares, 10 * buckets)).first()[0] if shares else []
    return sorted({least, *cuts})


def _with_next(rows: DataFrame) -> DataFrame:
    """Adds ``bucket, guard, rn, next``: places in the order of ids, and the next document's text.

    A bucket also holds, as guards, the rows with the next bucket's first id; they come last in
    it. Null ids are dealt out by text.
    """
    starts = _starts(rows.select("id")) or [0]
    n = len(starts)
    found = F.expr(
        "aggregate(sequence(1, 15), named_struct('lo', 0, 'hi', __n), (s, step) -> if(s.hi - s.lo < 2, s,"
        " if(get(__starts, (s.lo + s.hi) div 2) <= id,"
        " named_struct('lo', cast((s.lo + s.hi) div 2 as int), 'hi', s.hi),"
        " named_struct('lo', s.lo, 'hi', cast((s.lo + s.hi) div 2 as int)))), s -> s.lo)"
    )
    spread = (-1 - F.pmod(F.xxhash64("text"), F.lit(1024))).cast("int")
    located = (
        rows.withColumn("__starts", F.array(*[F.lit(x).cast("bigint") for x in starts]))
        .withColumn("__n", F.lit(n))
        .withColumn("at", F.when(F.col("id").isNull(), spread).otherwise(found))
        .withColumn("is_start", F.coalesce(F.get("__starts", F.col("at")) == F.col("id"), F.lit(False)))
        .drop("__starts", "__n")
    )
    own = F.struct(F.col("at").alias("bucket"), F.lit(0).alias("guard"))
    before = F.struct(F.pmod(F.col("at") - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("guard"))
    placed = located.select(
        "id", "text", F.inline(F.when(F.col("is_start"), F.array(own, before)).otherwise(F.array(own)))
    )
    order = Window.partitionBy("bucket").orderBy("guard", "id", "text")
    return placed.withColumns({"rn": F.row_number().over(order), "next": F.lead("text").over(order)})


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edited_share: int = 4
) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp``.

    The edited text has its last ``n_chars div edited_share`` code points replaced by the first
    as many of the next document by ascending id, or all of a shorter one; the last document is
    followed by the first. Fingerprints are numbers of 64 bits; equal texts have equal ones, and
    texts without words 0.

    Documents of neighbouring ids share a bucket, where each finds the next; a bucket's first
    document is also sent to the bucket before it, so texts are shuffled once and all later
    steps stay in place. Rows with equal ids are ordered by text. Null ids have no place in the
    order: their edited text only loses its end, and ``next_fp`` is null. Null texts are empty;
    other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    cut = f"(length(text) div {edited_share})"
    following = F.expr(f"if(id is null, '', left(coalesce(next, ''), cast({cut} as int)))")
    edited = F.concat(F.expr(f"left(text, cast(length(text) - {cut} as int))"), following)
    both = _with_next(rows).select(
        "bucket", "rn", "guard", "id", F.length("text").cast("bigint").alias("n_chars"), "text",
        edited.alias("edited"),
    )
    versions = both.select(
        "bucket", "rn", "guard", "id", "n_chars", F.sha2("edited", 256).alias("sha"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")),
            )
        ),
    )
    place = ["bucket", "rn", "guard", "id", "n_chars", "sha"]
    votes = versions.select(*place, "kind", F.expr("1"), F.inline_outer(terms("t"))).drop("1")
    prints = voted(votes, [*place, "kind"])
    paired = prints.groupBy(*place).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"),
    )
    following_fp = F.lead("fp").over(Window.partitionBy("bucket").orderBy("rn"))
    return (
        paired.withColumn("next_fp", F.when(F.col("id").isNotNull(), following_fp))
        .filter("guard = 0")
        .select(
            F.col("id").alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"),
            "fp", "edited_fp", "next_fp",
        )
    )


def _blocks(count: int) -> list[int]:
    """Masks of ``count`` blocks of neighbouring bits."""
    edges = [i * BITS // count for i in range(count + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def neighbours(fps: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``fp, near``: for each distinct ``queries.fp``, how many rows of ``fps`` lie within ``radius``.

    Two fingerprints within the radius agree on at least ``blocks - radius`` blocks of bits. There
    is one table for each choice of so many blocks, keyed by their bits; all tables together
    find every fingerprint within the radius, and a pair counts in the first that it shares.
    Equal fingerprints are one entry with a count. Entries are salted and queries sent to
    every salt, so a key that many entries share is met in many tasks.
    """
    masks = _blocks(blocks)
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(frame: DataFrame, name: str) -> DataFrame:
        keys = F.array(
            *[
                F.struct(
                    F.lit(i).alias(f"{name}_table"),
                    F.col(name).bitwiseAND(_signed(sum(masks[b] for b in t))).alias(f"{name}_key"),
                )
                for i, t in enumerate(tables)
            ]
        )
        return frame.select("*", F.inline(keys))

    entries = fps.groupBy(F.col("fp").alias("entry")).agg(F.count("*").alias("times"))
    entries = keyed(entries.withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(SALTS)).cast("int")), "entry")
    asked = queries.select(F.col("fp").alias("query")).distinct()
    asked = keyed(asked, "query").withColumn("query_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    differing = F.col("query").bitwiseXOR(F.col("entry"))
    first = F.lit(False)
    for i, table in enumerate(tables):
        passed = [b for b in range(table[-1]) if b not in table]
        missed = reduce(lambda a, b: a & b, [differing.bitwiseAND(_signed(masks[b])) != 0 for b in passed], F.lit(True))
        first = first | ((F.col("entry_table") == i) & missed)
    # Queries grow eightyfold after the last measured shuffle, so their size there must not make
    # Spark broadcast them.
    met = entries.join(
        asked.hint("merge"),
        (F.col("entry_table") == F.col("query_table"))
        & (F.col("entry_key") == F.col("query_key"))
        & (F.col("salt") == F.col("query_salt"))
        & (F.bit_count(differing) <= radius)
        & first,
    )
    return met.groupBy(F.col("query").alias("fp")).agg(F.sum("times").alias("near"))
