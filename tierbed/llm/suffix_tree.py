"""Language-model scores from a probabilistic suffix tree over words.

The root's next-token distribution covers the whole vocabulary, with one count added to each
token and to the unknown one. Deeper states are contexts of one to ``DEPTH`` words. A context and
a next token are considered if they occur together ``LEAST`` times, at any corpus size; a context
is retained if its next-token distribution diverges enough from that of the context one word
shorter. A state's distribution is smoothed with the shorter state's. A token is scored by the
longest suffix of the words before it that is a state.

Learning reads the corpus once per level and counts exactly. Chains are hashes, dealt to places
by equal ranges of a hash: of the chain for counts, of its suffix for the shorter state's
probability, of its context for the test for divergence and the smoothing. What goes to one place
is packed as arrays in a binary row, and a place is worked on at a time, so the tree grows with the
corpus and is never in one place. A text's score is a sum of one weight for each of its chains
(``_states``), so it is looked up like a bag of words: weights of the chains that make up at least
``P_MIN`` of all tokens, at most ``1 / P_MIN`` a level, are sent to all tasks; the others stay in
their places, and documents send the hashes of their chains there and get sums back. Bit arrays of
bounded size (``Bits``) tell most chains that are not in the tree apart; one that they let through
is only looked up in vain.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out, freed, saved
from tierbed.llm.text import HashIndex, Tally, blocks, combine, encoded, with_end, word_hashes

DEPTH = 3
P_MIN = 5e-7
LEAST = 2
DIVERGENCE = 10.0
END = 0x5EED0E0D
PLACE_TOKENS = 1 << 20
FOLD = 1 << 20
ROUNDS = 2
MOST_BITS = 28
LN_10 = math.log(10)
# Kinds of packed rows, in the order in which a place reads them.
INDEX, LEVEL, CHAIN, BITS, ASKED, DOC, FOUND = range(7)
PACKED = pa.schema([("place", pa.int32()), ("kind", pa.int32()), *[(k, pa.binary()) for k in "abcd"]])
_PACKED = "place int, kind int, a binary, b binary, c binary, d binary"
_saved = partial(saved, tidy=True)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return with_end(*word_hashes(encoded(texts, lower=True)), END)


@dataclass
class Level:
    """Frequent chains of ``depth + 1`` tokens.

    A chain's last token is what follows, the others are its context. ``log_p`` has the last
    token's probability after the longest state among the contexts it ends; ``back_off`` is for
    the chain as a context: the share left to tokens not stored with it, or 0 if it is no state.
    """

    index: HashIndex
    counts: np.ndarray
    log_p: np.ndarray
    back_off: np.ndarray


class Bits:
    """A set of 64-bit hashes by their first bits: may hold others too, never misses one."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.shift = np.uint64(64 - (64 * len(words)).bit_length() + 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _some_bits(keys: np.ndarray, size: int) -> pa.RecordBatch:
    """The words of ``Bits`` that sorted ``keys`` lie in, as one row: the first one's number and they."""
    at = (keys >> np.uint64(64 - size)).astype(np.int64)
    first = int(at[0]) >> 6 if len(at) else 0
    flags = np.zeros(((int(at[-1]) >> 6) + 1 - first) * 64 if len(at) else 0, bool)
    flags[at - first * 64] = True
    return _row(0, BITS, np.array([first]), np.packbits(flags, bitorder="little"))


def _bits(rows: DataFrame, size: int) -> Bits:
    words = np.zeros(1 << (size - 6), np.uint64)
    for row in rows.filter(F.col("kind") == BITS).select("a", "b").collect():
        first, part = int(np.frombuffer(row["a"], np.int64)[0]), np.frombuffer(row["b"], "<u8")
        words[first : first + len(part)] |= part
    return Bits(words)


def _bits_size(most: int) -> int:
    """Sixteen bits for each of ``most`` chains, but at most ``MOST_BITS``, as a power of two."""
    return min(MOST_BITS, max(16, (16 * most).bit_length()))


def _row(place: int, kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    data = [*[[c.tobytes()] for c in columns], [None], [None], [None], [None]][:4]
    arrays = [pa.array(x, t) for x, t in zip([[place], [kind], *data], PACKED.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=PACKED)


def _firsts(places: int) -> np.ndarray:
    """The least hash of each place: all hashes in equal ranges."""
    return np.array([-(-(i << 32) // places) << 32 for i in range(places)], np.uint64)


def _packed(kind: int, places: int, by: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """64-bit ``columns`` in the order of the hashes ``by``, one row for each place that has some."""
    order = np.argsort(by)
    cuts = np.append(np.searchsorted(by[order], _firsts(places)), len(by))
    some = np.flatnonzero(np.diff(cuts))
    data = []
    for column in columns:
        raw = column[order]
        data.append(pa.array([raw[cuts[p] : cuts[p + 1]].tobytes() for p in some], pa.binary()))
    data += [pa.nulls(len(some), pa.binary())] * (4 - len(columns))
    head = [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), kind, np.int32))]
    return pa.RecordBatch.from_arrays([*head, *data], schema=PACKED)


def _columns(rows: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(r[k] or b"" for r in rows), np.uint64) for k in "abcd"]


def _by_place(work: Callable[..., Iterator[pa.RecordBatch]]):
    """Runs ``work`` on the arrays of each place: its ``LEVEL`` rows' and its ``CHAIN`` rows'."""

    def of(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        return work(*[_columns([r for r in rows if r["kind"] == k]) for k in (LEVEL, CHAIN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["place"] != rows[0]["place"]:
                    yield from of(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from of(rows)

    return run


def _dealt(rows: DataFrame, work) -> DataFrame:
    placed = rows.repartition(fan_out(rows.sparkSession), "place").sortWithinPartitions("place", "kind")
    return placed.mapInArrow(work, _PACKED)


def _chains(tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level: the chain that ends at each token, and whether one of that length does."""
    starts = np.zeros(len(tokens) + 1, bool)
    starts[bounds[:-1]] = True
    chain, whole = tokens, np.ones(len(tokens), bool)
    while True:
        yield chain, whole
        longer, both = np.zeros_like(chain), whole & ~starts[:-1]
        longer[1:] = combine(chain[:-1], chain[1:])
        both[1:] &= whole[:-1]
        chain, whole = longer, both


def _count(depth: int, shared=None, places: int = 0):
    """Counts the chains of ``depth + 1`` tokens: rows ``key, n`` of words, else packed ones. ``shared``
    has the ``Bits`` of the chains one token shorter: a chain is repeated only if both it is made of are."""

    def rows(keys: np.ndarray, counts: np.ndarray, *pair: np.ndarray) -> pa.RecordBatch:
        if pair:
            return _packed(CHAIN, places, keys, *pair, counts.astype(np.int64))
        return pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "n": pa.array(counts.astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared else None
        tally = Tally(FOLD)
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                tokens, bounds = _tokens(texts[a:b])
                if not depth:
                    parts = tally.add(tokens)
                else:
                    *_, (below, _), (chain, whole) = islice(_chains(tokens, bounds), depth + 1)
                    if known is not None:
                        repeated = known.has(below)
                        whole &= repeated
                        whole[1:] &= repeated[:-1]
                    where = np.flatnonzero(whole)
                    parts = tally.add(chain[where], below[where - 1], below[where])
                for part in parts:
                    yield rows(*part)
        last = tally.rest()
        if len(last[0]):
            yield rows(*last)

    return run


def _pack_words(places: int, log_total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = (batch.column(k).to_numpy() for k in ("key", "n"))
            key = key.view(np.uint64)
            yield _packed(LEVEL, places, key, key, n, np.log10(n + 1.0) - log_total, np.zeros(len(key)))

    return run


def _repeated(places: int, size: int):
    """A place's chains that are met ``LEAST`` times, dealt by suffix, and its part of their ``Bits``."""

    def work(_: list[np.ndarray], chains: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        context, suffix, n, _ = chains
        key = combine(context, suffix)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.add.reduceat(n.view(np.int64)[order], first)
        some = n >= LEAST
        at = order[first[some]]
        yield _packed(CHAIN, places, suffix[at], suffix[at], context[at], n[some])
        yield _some_bits(key[first[some]], size)

    return _by_place(work)


def _with_shorter(places: int):
    """Adds ``log_short``, the last token's probability after the shorter context, to the chains of a
    place; they are dealt by context."""

    def work(level: list[np.ndarray], chains: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        suffix, context, n, _ = chains
        key, log_p, *_ = level
        order = np.argsort(key)
        at = order[np.searchsorted(key, suffix, sorter=order)]
        yield _packed(CHAIN, places, context, context, suffix, n, log_p[at])

    return _by_place(work)


def _states(places: int, divergence: float, words: bool):
    """Tests a place's contexts and smooths the chains after them.

    A level's chain has a count; ``log_p``, its last token's probability after the longest state among
    the contexts that it ends; and ``gain``: after a state, by how much ``log_p`` exceeds the shorter
    state's and what that state leaves to tokens not stored with it, else 0. A token's log probability
    is then the sum of the gains of all chains that end at it and, over all states that end before it,
    of what they leave: a chain's weight is its gain and, if it is a state, what it leaves.

    Gives weights of the level below, all of ``words`` and else those that are not 0, and the new level.
    """

    def work(level: list[np.ndarray], chains: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        context, suffix, n, log_short = chains
        count, log_short = n.view(np.int64).astype(float), log_short.view(float)
        order = np.argsort(level[0])
        key, total, gain = (c[order] for c in level[:3])
        of = np.searchsorted(key, context)
        all_of = total.view(np.int64).astype(float)
        stored = np.bincount(of, weights=count, minlength=len(key))
        reserve = 1.0 + np.bincount(of, minlength=len(key))
        share = (all_of - stored + reserve) / (all_of + reserve)
        log_state = np.log10(count / (all_of + reserve)[of] + share[of] * 10**log_short)
        better = np.bincount(of, weights=count * (log_state - log_short), minlength=len(key)) * LN_10
        state = (better + (all_of - stored) * np.log(share) >= divergence) & (stored > 0)
        left = np.where(state, np.log10(share), 0.0)
        weight = gain.view(float) + left
        some = slice(None) if words else weight != 0
        yield _packed(INDEX, places, key[some], key[some], total[some], weight[some])
        hit, chain = state[of], combine(context, suffix)
        log_p = np.where(hit, log_state, log_short)
        yield _packed(LEVEL, places, chain, chain, n, log_p, np.where(hit, log_state - log_short - left[of], 0.0))

    return _by_place(work)


def _next_level(levels: list[Level], context: np.ndarray, suffix: np.ndarray, counts: np.ndarray,
                divergence: float) -> Level:
    """The level of the given chains; says which contexts of the level below are states.

    ``_states`` does the same for a place; this is what tests hold it against."""
    below = levels[-1]
    chain = combine(context, suffix)
    of, shorter = below.index.find(context), below.index.find(suffix)
    log_short = below.log_p[shorter]
    total = below.counts.astype(float)
    stored = np.bincount(of, weights=counts, minlength=len(total)).astype(float)
    reserve = 1.0 + np.bincount(of, minlength=len(total))
    share = (total - stored + reserve) / (total + reserve)
    p = counts / (total[of] + reserve[of]) + share[of] * 10**log_short
    better = counts * (np.log(p) - np.log(10) * log_short)
    gain = np.bincount(of, weights=better, minlength=len(total)) + (total - stored) * np.log(share)
    state = (gain >= divergence) & (stored > 0)
    below.back_off = np.where(state, np.log10(share), 0.0)
    log_p = np.where(state[of], np.log10(p), log_short)
    return Level(HashIndex(chain), counts, log_p, np.zeros(len(chain)))


@dataclass
class Hot:
    """Frequent words and chains with their weights, and which chains have some at all."""

    words: HashIndex
    counts: np.ndarray
    word_weights: np.ndarray
    chains: HashIndex
    weights: np.ndarray
    weighty: Bits


def _bounded(weights: DataFrame, least: int, words: bool = False) -> tuple[np.ndarray, ...]:
    """Frequent chains on the driver, all of ``words`` and else those of weight: at most ``1 / P_MIN`` a level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, weight, _ = _columns(batch.to_pylist())
            some = (n >= least) & (words | (weight.view(float) != 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(key[some].view(np.int64)),
                    "n": pa.array(n[some].view(np.int64)),
                    "weight": pa.array(weight[some].view(float)),
                }
            )

    frame = weights.mapInArrow(run, "key bigint, n bigint, weight double").toPandas()
    return frame["key"].to_numpy(np.int64).view(np.uint64), frame["n"].to_numpy(np.int64), frame["weight"].to_numpy(float)


def _rare(least: int, size: int, places: int):
    """A place's chains of several words that are not frequent, as chains counted 0, and the ``Bits`` of all."""

    def work(chains: list[np.ndarray], _: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, n, weight, _ = chains
        some = weight.view(float) != 0
        yield _some_bits(np.sort(key[some]), size)
        some &= n < least
        key, weight = key[some], weight[some]
        yield _packed(INDEX, places, key, key, np.zeros(len(key), np.int64), weight)

    return _by_place(work)


def _score(shared, depth: int):
    """Per document: what frequent words and chains give, and the hashes of the others."""

    def of(values: np.ndarray, number: np.ndarray) -> np.ndarray:
        return np.where(number >= 0, values[number], 0.0) if len(values) else np.zeros(len(number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        uid = TaskContext.get().partitionId() << 36
        log_counts = np.log10(hot.counts + 1.0)
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                tokens, bounds = _tokens(texts[a:b])
                number = hot.words.find(tokens)
                frequent = number >= 0
                base, weight = of(log_counts, number), of(hot.word_weights, number)
                rare = np.flatnonzero(~frequent)
                at, raw = [rare], [tokens[rare]]
                for chain, whole in islice(_chains(tokens, bounds), 1, depth + 1):
                    where = np.flatnonzero(whole)
                    where = where[hot.weighty.has(chain[where])]
                    number = hot.chains.find(chain[where])
                    weight[where] += of(hot.weights, number)
                    where = where[number < 0]
                    at.append(where)
                    raw.append(chain[where])
                at, raw = np.concatenate(at), np.concatenate(raw)
                order = np.argsort(at, kind="stable")
                cuts, raw = np.searchsorted(at[order], bounds), raw[order]
                uids = uid + np.arange(b - a)
                uid += b - a
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "held_out": batch.column("held_out").slice(a, b - a),
                        "uid": pa.array(uids),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "known": pa.array(np.add.reduceat(frequent, bounds[:-1], dtype=np.int64)),
                        "base": pa.array(np.add.reduceat(base, bounds[:-1])),
                        "weight": pa.array(np.add.reduceat(weight, bounds[:-1])),
                        "rare": pa.array(
                            [raw[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)],
                            pa.binary(),
                        ),
                    }
                )

    return run


def _deal(shards: int, salts: int):
    """Rare words and chains of many documents as one row per place: ``words``, and whose they are as
    ``uids``. A shard, a range of hashes, has ``salts`` places, dealt out by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare = batch.column("rare").to_pylist()
            words = np.frombuffer(b"".join(rare), np.uint64)
            uids = np.repeat(batch.column("uid").to_numpy(), [len(x) // 8 for x in rare])
            shard = (words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
            place = shard.astype(np.int64) * salts + uids % salts
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(shards * salts + 1))
            some = np.flatnonzero(np.diff(cuts))
            parts = [order[cuts[s] : cuts[s + 1]] for s in some]
            yield pa.RecordBatch.from_pydict(
                {
                    "place": pa.array(some),
                    "uids": pa.array([uids[p].tobytes() for p in parts], pa.binary()),
                    "words": pa.array([words[p].tobytes() for p in parts], pa.binary()),
                }
            )

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``FOLD // 2`` tokens, so that places get few rows."""
    held: list[pa.RecordBatch] = []
    tokens = 0
    for batch in batches:
        held.append(batch)
        tokens += int(batch.column("n_tokens").to_numpy().sum())
        if tokens >= FOLD // 2:
            yield pa.concat_batches(held)
            held, tokens = [], 0
    if held:
        yield pa.concat_batches(held)


def _padded(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    """A batch of ``n`` rows with these ``columns`` and nulls in the others."""

    def of(field: pa.Field) -> pa.Array:
        column = columns.get(field.name)
        if column is None:
            return pa.nulls(n, field.type)
        return column if isinstance(column, pa.Array) else pa.array(column, field.type)

    return pa.RecordBatch.from_arrays([of(f) for f in schema], schema=schema)


def _ask(score, places: int):
    """Documents' rows, and their rare words and chains for the places; ``flush`` is what was gathered."""
    deal = _deal(places, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(score(batches)):
            docs = {k: batch.column(k) for k in ("uid", "doc_id", "held_out", "n_tokens", "known", "base", "weight")}
            schema = pa.schema([*PACKED, ("flush", pa.int64()), *[(k, c.type) for k, c in docs.items()]])
            n, uids = len(batch), batch.column("uid").to_numpy()
            first = int(uids[0])
            own = {"place": (uids % places).astype(np.int32), "kind": np.full(n, DOC, np.int32), "flush": np.full(n, first)}
            yield _padded(schema, n, own | docs)
            for asked in deal([batch]):
                n = len(asked)
                uids = [np.frombuffer(x, np.int64) for x in asked.column("uids").to_pylist()]
                steps = [np.diff(x, prepend=first).tobytes() for x in uids]
                part = {"place": asked.column("place").cast(pa.int32()), "kind": np.full(n, ASKED, np.int32)}
                yield _padded(schema, n, part | {"flush": np.full(n, first), "a": asked.column("words"), "b": steps})

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A place's index comes before the words that go there. Documents pass."""
    at, parts, index, counts, weights = None, [], None, None, None
    for batch in batches:
        is_doc = batch.column("kind").to_numpy() == DOC
        if is_doc.any():
            yield batch.filter(pa.array(is_doc))
        rows = batch.select([*PACKED.names, "flush"]).filter(pa.array(~is_doc)).to_pylist()
        found: dict[str, list] = {k: [] for k in ("place", "flush", *"abcd")}
        for row in rows:
            if row["place"] != at:
                at, parts, index = row["place"], [], None
            if row["kind"] == INDEX:
                parts.append(row)
                continue
            if index is None:
                keys, n, w, _ = _columns(parts)
                index, counts, weights, parts = HashIndex(keys), n.view(np.int64), w.view(float), []
            number = index.find(np.frombuffer(row["a"], np.uint64))
            met = number >= 0
            if not met.any():
                continue
            number = number[met]
            uids = row["flush"] + np.cumsum(np.frombuffer(row["b"], np.int64))[met]
            first = np.flatnonzero(np.diff(uids, prepend=-1))
            n = counts[number]
            sums = [np.add.reduceat(x, first) for x in (weights[number], (n > 0).astype(np.int64), np.log10(n + 1.0))]
            for k, v in zip("abcd", [np.diff(uids[first], prepend=row["flush"]), *sums], strict=True):
                found[k].append(v.tobytes())
            found["place"].append(at)
            found["flush"].append(row["flush"])
        if n := len(found["flush"]):
            yield _padded(batch.schema, n, found | {"kind": [FOUND] * n})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that were gathered together come before what was found for them."""
    names = ["doc_id", "held_out", "n_tokens", "known", "base", "weight"]

    def summed(docs: list[pa.RecordBatch], rows: list[dict]) -> pa.RecordBatch:
        batch = pa.concat_batches(docs)
        uids, n = batch.column("uid").to_numpy(), len(batch)
        order = np.argsort(uids)
        steps, weights, known, logs = ([np.frombuffer(r[k], t) for r in rows] for k, t in zip("abcd", "qdqd", strict=True))
        whose = [rows[i]["flush"] + np.cumsum(x) for i, x in enumerate(steps)]
        at = order[np.searchsorted(uids, np.concatenate([np.zeros(0, np.int64), *whose]), sorter=order)]

        def more(name: str, parts: list[np.ndarray]) -> np.ndarray:
            return batch.column(name).to_numpy() + np.bincount(at, weights=np.concatenate([np.zeros(0), *parts]), minlength=n)

        new = {"known": more("known", known).astype(np.int64), "base": more("base", logs), "weight": more("weight", weights)}
        return pa.RecordBatch.from_arrays([pa.array(new[k]) if k in new else batch.column(k) for k in names], names)

    at, docs, rows = None, [], []
    for batch in batches:
        flush = batch.column("flush").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(flush)) + 1), len(flush)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if docs and flush[a] != at:
                yield summed(docs, rows)
                docs, rows = [], []
            at, part = flush[a], batch.slice(a, b - a)
            is_doc = part.column("kind").to_numpy() == DOC
            if is_doc.any():
                docs.append(part.filter(pa.array(is_doc)).select([*names, "uid"]))
            rows += part.select(["flush", *"abcd"]).filter(pa.array(~is_doc)).to_pylist()
    if docs:
        yield summed(docs, rows)


def suffix_tree_scores(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    p_min: float = P_MIN,
    divergence: float = DIVERGENCE,
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` says which rows to learn from (null: not). Tokens are the words of the text with
    A-Z in lower case, and one end. ``base_score`` is the log10 probability under single tokens
    with one count added, ``score`` under the suffix tree. ``n_known`` counts tokens that occur
    in training rows.

    Null and empty texts are an end alone. Each row is a document, also where ids are null or
    repeat; rows alike are learned from as often as they occur. Without training rows both
    scores are 0. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        (~F.coalesce(train, F.lit(False))).alias("held_out"),
    )
    learned = rows.filter(~F.col("held_out")).select("text")

    tasks = fan_out(spark)

    def packed(rows: DataFrame, kind: int, of: str, to: int | None = None) -> DataFrame:
        """Rows of one kind as ``to``, with the columns ``of``."""
        columns = [F.col(k).alias(new) for k, new in zip(of, "abcd", strict=False)]
        columns += [F.lit(None).cast("binary").alias(k) for k in "abcd"[len(of) :]]
        return rows.filter(F.col("kind") == kind).select("place", F.lit(kind if to is None else to).alias("kind"), *columns)

    words = learned.mapInArrow(_count(0), "key bigint, n bigint")
    words = _saved(words.groupBy("key").agg(F.sum("n").alias("n")), "tree-words", kept := [])
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_total = math.log10(total + distinct + 1)
    places, size = total // PLACE_TOKENS + 1, _bits_size(total // LEAST)
    level = words.mapInArrow(_pack_words(places, log_total), _PACKED)
    done, known, weights = [], None, []
    for k in range(1, depth + 1):
        dead, kept = kept, []
        shared = spark.sparkContext.broadcast(known)
        chains = learned.mapInArrow(_count(k, shared, places), _PACKED)
        chains = _saved(_dealt(chains, _repeated(places, size)), "tree-chains", dead)
        # Nothing that is read later asks for it, and each executor has a copy on its disk.
        shared.destroy()
        known = None
        known = _bits(chains, size)
        shorter = packed(level, LEVEL, "ac").unionByName(packed(chains, CHAIN, "abc"))
        shorter = _dealt(shorter, _with_shorter(places))
        tested = packed(level, LEVEL, "abd").unionByName(shorter)
        level = _saved(_dealt(tested, _states(places, divergence, k == 1)), "tree-level", kept)
        done.append(_saved(packed(level, INDEX, "abc"), "tree-weights", weights))
        freed(spark, dead)
    done.append(packed(level, LEVEL, "abd", INDEX))

    least = max(2, math.ceil(p_min * total))
    keys, counts, word_weights = _bounded(done[0], least, words=True)
    hot = [_bounded(x, least) for x in done[1:]]
    deeper = reduce(DataFrame.unionByName, done[1:], done[0].limit(0)).withColumn("kind", F.lit(LEVEL))
    others = _saved(_dealt(deeper, _rare(least, size, places)), "tree-others")
    # Only the weights of words are read again.
    freed(spark, weights[1:] + kept)
    tree = Hot(
        HashIndex(keys),
        counts,
        word_weights,
        HashIndex(np.concatenate([np.zeros(0, np.uint64), *[x[0] for x in hot]])),
        np.concatenate([np.zeros(0), *[x[2] for x in hot]]),
        _bits(others, size),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    added = f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, weight double"
    fields = f"{_PACKED}, flush bigint, uid bigint, {added}"
    shared = spark.sparkContext.broadcast(tree)
    asked = _ask(_score(shared, depth), places)
    index = done[0].unionByName(others.filter(F.col("kind") == INDEX))
    base = F.col("base") - F.col("n_tokens") * log_total
    # A part of the documents at a time, so that the words on their way are never all on disk.
    turn, scored, dead = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)), [], []
    for k in range(ROUNDS):
        found = (
            index.unionByName(rows.filter(turn == k).mapInArrow(asked, fields), allowMissingColumns=True)
            .repartition(tasks, "place")
            .sortWithinPartitions("place", "kind")
            .mapInArrow(_look_up, fields)
            .repartition(tasks, "flush")
            .sortWithinPartitions("flush", "kind", "place")
            .mapInArrow(_add_up, added)
        )
        found = found.select(
            "doc_id",
            "held_out",
            "n_tokens",
            F.col("known").alias("n_known"),
            F.lit(int(total)).cast("bigint").alias("train_tokens"),
            base.alias("base_score"),
            (base + F.col("weight")).alias("score"),
        )
        scored.append(_saved(found, "tree-found", dead))
    shared.destroy()
    scores = _saved(reduce(DataFrame.unionByName, scored), "tree-scored")
    freed(spark, dead)
    return scores
