"""N-gram Jaccard self-join by chosen paths.

Documents become sets of five-word shingles. Equal sets are one node. Each set is embedded by
min-hashing: 128 tokens, one per hash function, of which two sets share a share equal to their
similarity. A run splits all sets on two tokens chosen at random for each path, and splits each
part again until it is small; parts then are compared by brute force. At similarity 0.8 a run
loses a pair with probability ``lost_per_run``; runs are repeated until the target recall.

A part that does not fall apart (near copies share almost every token) is cut into blocks, and
every pair of blocks is compared by a task of its own; so are parts at the last depth. Nothing
is dropped.

Parts give edges between sets that their tokens show to be near. Components of these edges are
then compared exactly, by shingles, in blocks of bounded size; pairs are counted there, and
never become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.graph import components
from tierbed.llm.storage import fan_out, free_name, saved
from tierbed.llm.text import blocks, combine, encoded, mix, word_hashes

SHINGLE_WORDS = 5
TOKENS = 128
BRANCHES = 2
SMALL_PART = 128
MAX_DEPTH = 12
# A part that keeps this share of the part it came from is not going to fall apart.
DENSE = 0.5
PART_BLOCK = 1024
BLOCK_SHINGLES = 100_000

_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(0, 1 << 31, TOKENS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, TOKENS, dtype=np.uint32)


def lost_per_run(similarity: float) -> float:
    """Chance that a pair no longer shares a part at any depth: the least fixed point of the
    branching process in which each of two splits keeps the pair with ``similarity``."""
    q = 0.0
    for _ in range(500):
        q = (1 - similarity + similarity * q) ** BRANCHES
    return q


def runs_for(similarity: float, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost_per_run(similarity))))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words, bounds = word_hashes(texts)
    chained = words
    for k in range(1, SHINGLE_WORDS):
        chained = combine(chained[: len(words) - k], words[k:])
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= SHINGLE_WORDS:
            sets.append(np.unique(chained[a : b - SHINGLE_WORDS + 1]))
        elif b > a:
            short = words[a : a + 1]
            for k in range(a + 1, b):
                short = combine(short, words[k : k + 1])
            sets.append(short)
        else:
            sets.append(words[:0])
    return sets


def tokens_of(shingles: np.ndarray) -> np.ndarray:
    """The min-hash tokens of a set."""
    low = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    short = (mix(shingles) >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 2048):
        hashed = short[i : i + 2048, None] * _MULTIPLY + _ADD
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        np.minimum(low, hashed.min(axis=0), out=low)
    return low


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        nodes, sizes, tokens = [], [], []
        for a, b in blocks(texts):
            for shingles in shingle_sets(encoded(texts[a:b])):
                nodes.append(xxhash.xxh3_64_intdigest(shingles.tobytes()))
                sizes.append(len(shingles))
                tokens.append(tokens_of(shingles).tobytes() if len(shingles) else b"")
        yield pa.RecordBatch.from_pydict(
            {
                "id": batch.column("id"),
                "row": batch.column("row"),
                "node": pa.array(np.array(nodes, np.uint64).view(np.int64)),
                "n": pa.array(sizes, pa.int64()),
                "tokens": pa.array(tokens, pa.binary()),
            }
        )


def _children(paths: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each set, the path that each of its ``BRANCHES`` chosen tokens leads to."""
    out = []
    for branch in range(BRANCHES):
        chosen = mix(paths + np.uint64((branch + 1) * 0x9E3779B97F4A7C15 % 2**64))
        at = (chosen >> np.uint64(40)).astype(np.int64) % TOKENS
        out.append(combine(chosen, tokens[np.arange(len(at)), at].astype(np.uint64)))
    return np.stack(out)


def _split(runs: int):
    """Entries one level down. Without a ``path`` column a set starts at the root of every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            raw = b"".join(batch.column("tokens").to_pylist())
            tokens = np.frombuffer(raw, np.uint32).reshape(-1, TOKENS)
            above = np.full(len(node), 1 << 62)
            if "path" in batch.schema.names:
                roots = [batch.column("path").to_numpy().view(np.uint64)]
                above = batch.column("size").to_numpy()
            else:
                roots = [np.full(len(node), mix(np.array([r + 1], np.uint64))[0]) for r in range(runs)]
            for paths in roots:
                for child in _children(paths, tokens):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": pa.array(child.view(np.int64)),
                            "node": pa.array(node),
                            "above": pa.array(above),
                        }
                    )

    return run


def near_forest(tokens: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the sets that share ``least`` tokens or more."""
    edges, left = [], np.arange(len(tokens))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = (tokens[left] == tokens[at]).sum(axis=1) >= least
            edges += [(at, x) for x in left[near]]
            frontier += list(left[near])
            left = left[~near]
    return edges


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted stream, also across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _near_in_parts(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for part in _groups(batches, ["path", "i", "j"]):
            nodes, first = np.unique(part.column("node").to_numpy(), return_index=True)
            raw = part.column("tokens").to_pylist()
            tokens = np.frombuffer(b"".join(raw[i] for i in first), np.uint32).reshape(-1, TOKENS)
            for x, y in near_forest(tokens, least):
                a.append(nodes[x])
                b.append(nodes[y])
            if len(a) > 50_000:
                yield out()
                a, b = [], []
        yield out()

    return run


def _block_pairs(members: DataFrame, group: str) -> DataFrame:
    """Deals the ``blocks`` blocks of each group out as pairs ``i <= j``; adds ``block``."""
    block = F.pmod(F.xxhash64("node", group), F.col("blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    paired = members.withColumn("block", block).withColumn("partner", partner)
    return paired.withColumns(
        {"i": F.least("block", "partner"), "j": F.greatest("block", "partner")}
    ).drop("partner", "blocks")


def _candidate_edges(nodes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Edges ``a, b`` between nodes that met in a part and whose tokens show them to be near."""
    spark = nodes.sparkSession
    slack = 4 * math.sqrt(similarity * (1 - similarity) / TOKENS)
    least = math.floor((similarity - slack) * TOKENS)
    tokens = nodes.select(F.col("node").alias("of"), "tokens")
    split = _split(runs_for(similarity, recall))
    entries = nodes.filter("n > 0").select("node", "tokens").mapInArrow(split, "path bigint, node bigint, above bigint")
    compared = []
    for depth in range(1, MAX_DEPTH + 1):
        entries = saved(entries.distinct(), "path-entries")
        parts = (
            entries.groupBy("path")
            .agg(
                F.count("*").alias("size"),
                F.bit_xor(F.xxhash64("node")).alias("who"),
                F.min("above").alias("above"),
            )
            .filter("size > 1")
        )
        # Parts with the same members need one comparison and one further split.
        parts = saved(
            parts.groupBy("size", "who").agg(
                F.min("path").alias("part"), F.min("above").alias("above")
            ),
            "path-parts",
        )
        dense = F.col("size") >= F.col("above") * DENSE
        whole = (F.col("size") <= SMALL_PART) | dense if depth < MAX_DEPTH else F.lit(True)
        blocks_ = F.ceil(F.col("size") / PART_BLOCK).alias("blocks")
        done = entries.join(parts.filter(whole).select("part", blocks_), F.col("path") == F.col("part"))
        compared.append(_block_pairs(done.drop("part", "above"), "path"))
        large = parts.filter(~whole)
        if depth == MAX_DEPTH or not large.limit(1).count():
            break
        going = entries.join(large.select("part", "size"), F.col("path") == F.col("part"))
        entries = (
            going.join(tokens, F.col("node") == F.col("of"))
            .select("path", "node", "size", "tokens")
            .mapInArrow(split, "path bigint, node bigint, above bigint")
        )
    everything = compared[0]
    for more in compared[1:]:
        everything = everything.union(more)
    dealt = (
        everything.join(tokens, F.col("node") == F.col("of"))
        .select("path", "i", "j", "node", "tokens")
        .repartition(fan_out(spark), "path", "i", "j")
        .sortWithinPartitions("path", "i", "j")
    )
    return dealt.mapInArrow(_near_in_parts(least), "a bigint, b bigint").distinct()


def overlaps(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    owner, at = owner[shared], at[shared]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    number = np.cumsum(np.diff(at, prepend=at[:1]) != 0) if len(at) else at
    total = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        a, b = np.searchsorted(number, [low, low + columns])
        table = np.zeros((len(sets), columns), np.float32)
        table[owner[a:b], number[a:b] - low] = 1
        total += table @ table.T
    return total.astype(np.int64)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.full(len(linked), -1)
    for start in range(len(linked)):
        if root[start] < 0:
            root[start], stack = start, [start]
            while stack:
                for x in np.flatnonzero(linked[stack.pop()] & (root < 0)):
                    root[x] = start
                    stack.append(x)
    return root


def _exact(percent: int):
    """Links between the members of each block pair: per node their number and one edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, ["comp", "i", "j"]):
            nodes, first = np.unique(part.column("node").to_numpy(), return_index=True)
            first = pa.array(first)
            block = part.column("block").take(first).to_numpy()
            copies = part.column("copies").take(first).to_numpy()
            texts = part.column("text").take(first).combine_chunks()
            sets = [s for a, b in blocks(texts) for s in shingle_sets(encoded(texts[a:b]))]
            sizes = np.array([len(s) for s in sets])
            both = overlaps(sets)
            linked = both * 100 >= percent * (sizes[:, None] + sizes[None, :] - both)
            if part.column("i")[0].as_py() != part.column("j")[0].as_py():
                linked &= block[:, None] != block[None, :]
            np.fill_diagonal(linked, False)
            some = np.flatnonzero(linked.any(axis=1))
            if len(some):
                root = nodes[_roots(linked)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "a": pa.array(nodes[some]),
                        "b": pa.array(root[some]),
                        "links": pa.array((linked * copies[None, :]).sum(axis=1)[some]),
                    }
                )

    return run


def _embedded(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``row, text`` of every document, and its stored node with size and tokens."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row bigint, node bigint, n bigint, tokens binary"
    return rows.select("row", "text"), saved(rows.mapInArrow(_embed, schema), "path-sets")


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    recall: float = 0.9999,
) -> DataFrame:
    """One row per input row: ``doc_id, class_id, n_links, row``.

    Documents are linked if their sets of five-word shingles have a Jaccard similarity of
    ``percent`` or more. ``class_id`` is the smallest id of the documents that links connect
    with this one, ``n_links`` the number of other documents linked with it, copies included.
    ``row`` is a hash of id and text, equal for rows alike.

    Words are split at ``[\\x20\\x09-\\x0D]`` and compared as they are. Null, empty and blank texts
    have no words; they are linked with each other only. Each row is a document, also where ids
    are null or repeat; a class without ids has a null ``class_id``. Other columns are ignored;
    an empty table gives no rows.
    """
    similarity = percent / 100
    rows, sets = _embedded(docs, id_col, text_col)
    named = sets.groupBy("node").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.min("row").alias("rep")
    )
    named = saved(named, "path-named")
    reps = named.select(F.col("node").alias("of"), "rep", "copies")
    nodes = sets.join(reps, (F.col("node") == F.col("of")) & (F.col("row") == F.col("rep"))).select(
        "node", "n", "tokens", "rep", "copies"
    )
    nodes = saved(nodes, "path-nodes")
    candidates = components(_candidate_edges(nodes, similarity, recall))
    members = (
        candidates.join(nodes.drop("tokens"), "node")
        .dropDuplicates(["node"])
        .withColumnRenamed("label", "comp")
    )
    sizes = members.groupBy(F.col("comp").alias("c")).agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks")
    )
    dealt = _block_pairs(members.join(sizes, F.col("comp") == F.col("c")).drop("c", "n"), "comp")
    texts = rows.join(members.select(F.col("rep").alias("wanted")).distinct(), F.col("row") == F.col("wanted"))
    compared = (
        texts.drop("wanted")
        .join(dealt, F.col("row") == F.col("rep"))
        .select("comp", "i", "j", "block", "node", "copies", "text")
        .repartition(fan_out(docs.sparkSession), "comp", "i", "j")
        .sortWithinPartitions("comp", "i", "j")
    )
    linked = saved(compared.mapInArrow(_exact(percent), "a bigint, b bigint, links bigint"), "path-links")
    links = linked.groupBy(F.col("a").alias("l")).agg(F.sum("links").alias("links"))
    classes = components(linked).select(F.col("node").alias("m"), "label")
    joined = (
        named.join(classes, F.col("node") == F.col("m"), "left")
        .join(links, F.col("node") == F.col("l"), "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    least = joined.groupBy(F.col("label").alias("k")).agg(F.min("first_id").alias("class_id"))
    results = joined.join(least, F.col("label") == F.col("k")).select(
        F.col("node").alias("r"),
        "label",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
    )
    return sets.join(results, F.col("node") == F.col("r")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "row", F.col("label").alias("class")
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each class, its columns as they are, whatever their names.

    Texts without five words, null and empty ones among them, are alike if their words are; a very
    long text is compared whole. An empty table gives no rows.

    Null ids come last; among rows with the same id the least hash of id and text decides, and
    of rows alike in both one stays.
    """
    own, theirs, nth = (free_name(docs, x) for x in ("own_row", "kept_row", "nth_row"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row").alias("row")))
    kept = (
        ngram_join(docs, id_col, text_col, **options)
        .groupBy("class")
        .agg(first.alias("first"))
        .select(F.col("first.row").alias(theirs))
        .distinct()
    )
    one = Window.partitionBy(own).orderBy(own)
    return (
        docs.withColumn(own, F.xxhash64(F.col(id_col), F.col(text_col)))
        .join(kept, F.col(own) == F.col(theirs))
        .withColumn(nth, F.row_number().over(one))
        .filter(F.col(nth) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
