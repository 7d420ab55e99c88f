"""A quality classifier by co-training of two views.

One view sees the text: hashed words and measures of its form. The other sees metadata: source,
language, and sizes. Both are logistic regressions. In each round every view labels the
unlabelled documents of which it is surest, and these labels train the other view from then on.
Each view is calibrated on labelled documents that neither was fitted on. The views are taken to
be independent given the quality, so the calibrated log-odds are added and the prior's, which
both hold, taken off once.

At most ``SAMPLE`` labelled documents are taken, those with the smallest hash of their id; they
are on the driver. Unlabelled documents are all taken: their features are stored sparsely in the
shared folder, each round scores all of them, and gradients are summed over all that have been
labelled. Which those are follows from the rules of the rounds so far, so no document has a state.
A task holds one Arrow batch, the weight vectors and one matrix of curvature.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import saved
from tierbed.llm.text import blocks, encoded, word_hashes

SAMPLE = 4_000
ROUNDS = 4
PER_ROUND = 200
SHARE = 0.05
SURE = 0.9
STEPS = 4
PENALTY = 1e-3
BINS = 4096
MOST = 30.0
WORD_SLOTS = 1024
META_SLOTS = 256
FORM = 11
_LETTER = np.zeros(256, np.int64)
_LETTER[range(0x41, 0x5B)] = 1
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 2
_LETTER[range(0x30, 0x3A)] = 3
_LETTER[[0x20, *range(0x09, 0x0E)]] = 4


def text_features(texts: list[bytes]) -> np.ndarray:
    """Hashed word shares (square roots) and measures of form, one row per text."""
    hashes, bounds = word_hashes([x.lower() for x in texts])
    sizes = np.diff(bounds)
    rows = np.zeros((len(texts), WORD_SLOTS + FORM), np.float32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    slots = (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    counts = np.bincount(owner * WORD_SLOTS + slots, minlength=len(texts) * WORD_SLOTS)
    shares = counts.reshape(len(texts), WORD_SLOTS) / np.maximum(sizes, 1)[:, None]
    rows[:, :WORD_SLOTS] = np.sqrt(shares)
    for i, text in enumerate(texts):
        kinds = np.bincount(_LETTER[np.frombuffer(text, np.uint8)], minlength=5) / max(1, len(text))
        words, n = hashes[bounds[i] : bounds[i + 1]], int(sizes[i])
        lines = text.split(b"\n")
        rows[i, WORD_SLOTS:] = [
            *kinds,
            np.log1p(n) / 5,
            len(text) / max(1, n) / 10,
            len(np.unique(words)) / max(1, n),
            len(set(lines)) / len(lines),
            np.log1p(len(lines)) / 5,
            len(np.unique(words[:-1] ^ (words[1:] << np.uint64(1)))) / max(1, n - 1) if n > 1 else 1.0,
        ]
    return rows


def meta_features(sources: list, langs: list, sizes: list) -> np.ndarray:
    """Hashed source and language, alone and together, and classes of the text's length."""
    rows = np.zeros((len(sources), META_SLOTS + 2), np.float32)
    for i, (source, lang, size) in enumerate(zip(sources, langs, sizes, strict=True)):
        size = max(0, size or 0)
        for name in (f"s {source}", f"l {lang}", f"s {source} l {lang}", f"n {int(2 * np.log2(1 + size))}"):
            rows[i, zlib.crc32(name.encode()) % META_SLOTS] = 1
        rows[i, META_SLOTS:] = np.log1p(size) / 10, size == 0
    return rows


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, penalty: float = 1e-3,
                 steps: int = 100) -> np.ndarray:
    """Weights, the last for the constant, by accelerated gradient steps from ``w``; classes weigh
    the same."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / max(1, len(y))
    rate = 1 / (0.25 * float((weight[:, None] * x * x).sum()) + penalty) if len(y) else 0.0
    w = np.zeros(x.shape[1], np.float32) if w is None else w
    ahead = w
    for step in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - rate * (x.T @ (weight * (p - y)) + penalty * ahead)
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


def margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def fit_calibration(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into log-odds, by Newton steps on smoothed targets."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1).astype(float)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
    return max(float(at[0]), 1e-3), float(at[1])


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float

    def log_odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = margins(text, self.text) * self.text_scale[0] + self.text_scale[1]
        b = margins(meta, self.meta) * self.meta_scale[0] + self.meta_scale[1]
        return a, b


@dataclass
class Rule:
    """One view's labels of a round: good from bin ``high`` on, bad up to bin ``low``."""

    weights: np.ndarray
    scale: tuple[float, float]
    low: int = -1
    high: int = BINS

    def bins(self, x: np.ndarray) -> np.ndarray:
        odds = np.clip(margins(x, self.weights) * self.scale[0] + self.scale[1], -MOST, MOST)
        return np.minimum((odds + MOST) * (BINS / (2 * MOST)), BINS - 1).astype(np.int64)


def labels_by(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """1 and 0 by the first rule that says so, else -1."""
    y = np.full(len(x), -1)
    for rule in rules:
        at = rule.bins(x)
        y = np.where(y >= 0, y, np.where(at >= rule.high, 1, np.where(at <= rule.low, 0, -1)))
    return y


def thresholds(counts: np.ndarray, most: int) -> tuple[int, int]:
    """The last bin of bad and the first of good documents: the surest ``most`` of each, and what
    shares a bin with them, if they are sure enough."""
    log_odds = np.log(SURE / (1 - SURE))
    high_sure = int(np.ceil((log_odds + MOST) * (BINS / (2 * MOST))))
    low_sure = int((MOST - log_odds) * (BINS / (2 * MOST))) - 1
    up, down = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    high = max(high_sure, int(np.flatnonzero(up >= most)[-1]) if up[0] >= most else 0)
    low = min(low_sure, int(np.argmax(down >= most)) if down[-1] >= most else BINS - 1)
    return low, high


def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray, by_class: np.ndarray, curved: bool) -> np.ndarray:
    """Gradient of the loss, and with ``curved`` the upper half of a bound of its curvature."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = by_class[y].astype(np.float32)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -MOST, MOST)))
    gradient = x.T @ (weight * (p - y))
    if not curved:
        return gradient.astype(float)
    curve = 0.25 * (x.T @ (weight[:, None] * x))
    return np.concatenate([gradient, curve[np.triu_indices(len(w))]]).astype(float)


OTHER = {"text": "meta", "meta": "text"}


def _summed(pool: DataFrame, size: int, found) -> np.ndarray:
    """The sum of ``found(views)``, vectors of ``size``, over all blocks of rows of ``pool``."""
    width, of_text = WORD_SLOTS + FORM + META_SLOTS + 2, WORD_SLOTS + FORM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                slots = part.column("slots").to_pylist()
                x = np.zeros((len(slots), width), np.float32)
                row = np.repeat(np.arange(len(slots)), [len(k) // 2 for k in slots])
                x[row, np.frombuffer(b"".join(slots), np.uint16)] = np.frombuffer(
                    b"".join(part.column("values").to_pylist()), np.float16
                )
                total += found({"text": x[:, :of_text], "meta": x[:, of_text:]})
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    rows = pool.coalesce(2 * pool.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "total binary")
    return rows.rdd.map(lambda r: np.frombuffer(bytes(r[0]), np.float32).astype(float)).treeAggregate(
        np.zeros(size), np.add, np.add
    )


def cotrain(views: dict[str, np.ndarray], y: np.ndarray, pool: DataFrame, rounds: int = ROUNDS,
            per_round: int = PER_ROUND, share: float = SHARE) -> Model:
    """Fits both views to the labelled rows, ``y`` of 1 and 0, and to all rows of ``pool`` that
    they label for each other: ``share`` of it or ``per_round`` a class and round, whichever is
    more. Every fourth labelled row is kept for calibration."""
    held = np.arange(len(y))[3::4]
    own = np.setdiff1d(np.arange(len(y)), held)
    weights = {name: fit_logistic(views[name][own], y[own]) for name in views}
    rules: dict[str, list[Rule]] = {name: [] for name in views}
    chosen = {name: np.zeros(2) for name in views}
    most = max(per_round, math.ceil(share * pool.count())) if len(own) else 0
    for _ in range(rounds if most else 0):
        now = {n: Rule(weights[n], fit_calibration(margins(views[n][held], weights[n]), y[held])) for n in views}

        def tallied(x: dict[str, np.ndarray], now=now) -> np.ndarray:
            free = {n: x[n][labels_by(rules[n], x[n]) < 0] for n in x}
            return np.concatenate([np.bincount(now[n].bins(free[n]), minlength=BINS) for n in OTHER])

        for name, counts in zip(OTHER, _summed(pool, 2 * BINS, tallied).reshape(2, -1), strict=True):
            low, high = now[name].low, now[name].high = thresholds(counts, most)
            rules[name].append(now[name])
            chosen[OTHER[name]] += counts[: low + 1].sum(), counts[high:].sum()
        if not sum(x.sum() for x in chosen.values()):
            break
        by_class = {n: 0.5 / np.maximum(1, chosen[n] + np.bincount(y[own], minlength=2)) for n in views}
        curve: dict[str, np.ndarray] = {}
        for step in range(STEPS):
            curved = step == 0
            sizes = {n: len(w) + (len(w) * (len(w) + 1) // 2 if curved else 0) for n, w in weights.items()}

            def sloped(x: dict[str, np.ndarray], curved=curved, weights=dict(weights), by_class=by_class) -> np.ndarray:
                parts = []
                for n in OTHER:
                    label = labels_by(rules[OTHER[n]], x[OTHER[n]])
                    at = label >= 0
                    parts.append(slopes(x[n][at], label[at], weights[n], by_class[n], curved))
                return np.concatenate(parts)

            found = _summed(pool, sum(sizes.values()), sloped)
            for name, sums in zip(OTHER, np.split(found, [sizes["text"]]), strict=True):
                w = weights[name]
                sums = sums + slopes(views[name][own], y[own], w, by_class[name], curved)
                if curved:
                    half = np.zeros((len(w), len(w)))
                    half[np.triu_indices(len(w))] = sums[len(w) :]
                    curve[name] = half + np.triu(half, 1).T + PENALTY * np.eye(len(w))
                gradient = sums[: len(w)] + PENALTY * w
                weights[name] = (w - np.linalg.solve(curve[name], gradient)).astype(np.float32)
    scales = {n: fit_calibration(margins(views[n][held], weights[n]), y[held]) for n in views}
    good = (y[held].sum() + 1) / (len(held) + 2)
    prior = float(np.log(good / (1 - good)))
    return Model(weights["text"], weights["meta"], scales["text"], scales["meta"], prior)


def _features(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    texts = batch.column("text")
    for a, b in blocks(texts):
        raw = encoded(texts[a:b])
        part = batch.slice(a, b - a)
        sizes = [len(x) for x in raw]
        yield a, b, text_features(raw), meta_features(
            part.column("source").to_pylist(), part.column("lang").to_pylist(), sizes
        )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, text, meta in _features(batch):
            yield pa.RecordBatch.from_pydict(
                {
                    "y": batch.column("y").slice(a, b - a),
                    "rank": batch.column("rank").slice(a, b - a),
                    "text": pa.array([x.astype(np.float16).tobytes() for x in text], pa.binary()),
                    "meta": pa.array([x.astype(np.float16).tobytes() for x in meta], pa.binary()),
                }
            )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, text, meta in _features(batch):
            x = np.hstack([text, meta]).astype(np.float16)
            row, slot = np.nonzero(x)
            cuts, values = np.searchsorted(row, np.arange(b - a + 1)), x[row, slot]
            slot = slot.astype(np.uint16)
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "slots": pa.array([slot[i:j].tobytes() for i, j in spans], pa.binary()),
                    "values": pa.array([values[i:j].tobytes() for i, j in spans], pa.binary()),
                }
            )


def _score(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, text, meta in _features(batch):
                by_text, by_meta = (np.clip(x, -30, 30) for x in model.log_odds(text, meta))
                score = 1 / (1 + np.exp(-(by_text + by_meta - model.prior)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "text_score": pa.array(1 / (1 + np.exp(-by_text.astype(float)))),
                        "meta_score": pa.array(1 / (1 + np.exp(-by_meta.astype(float)))),
                        "score": pa.array(score.astype(float)),
                        "kept": pa.array(score >= threshold),
                    }
                )

    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str, sample: int) -> Model:
    """Co-trains on at most ``sample`` labelled and on all unlabelled rows of ``docs``."""
    named = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("of"))
    named = named.agg(F.max(F.col(label_col)).cast("int").alias("y"), F.min(label_col).alias("low"))
    named = named.filter(F.col("y") == F.col("low"))  # labels that disagree are none
    rank = F.xxhash64("doc_id", F.xxhash64("text")).alias("rank")
    # Which rows are sampled is decided on hashes alone; texts stay where they are.
    ranks = docs.select("doc_id", rank).join(named, F.col("doc_id") == F.col("of"))
    chosen = ranks.select(F.col("rank").alias("r"), "y").orderBy("r").limit(sample)
    # At most ``sample`` rows of two numbers.
    picked = docs.withColumn("rank", rank).join(
        F.broadcast(chosen.dropDuplicates(["r"])), F.col("rank") == F.col("r")
    )
    found = picked.mapInArrow(_sampled, "y int, rank bigint, text binary, meta binary").toPandas()
    found = found.drop_duplicates("rank").sort_values("rank")

    def matrix(name: str, width: int) -> np.ndarray:
        raw = b"".join(found[name])
        return np.frombuffer(raw, np.float16).reshape(-1, width).astype(np.float32)

    views = {"text": matrix("text", WORD_SLOTS + FORM), "meta": matrix("meta", META_SLOTS + 2)}
    kind = docs.schema["doc_id"].dataType.simpleString()
    features = docs.mapInArrow(_sparse, f"doc_id {kind}, slots binary, values binary")
    unlabelled = features.join(named, F.col("doc_id") == F.col("of"), "left_anti").select("slots", "values")
    pool = saved(unlabelled, "cotraining-pool") if len(found) else unlabelled.limit(0)
    return cotrain(views, found["y"].to_numpy(int), pool)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    label_col: str = "quality",
    sample: int = SAMPLE,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: ``doc_id, text_score, meta_score, score, kept``.

    Scores are probabilities of good quality; ``kept`` says whether ``score`` reaches
    ``threshold``. ``labels`` has ``doc_id`` and ``label_col``, 1 good and 0 bad; other values and
    labels that contradict each other are ignored. Without labels every score is one half.

    Null texts are empty; a null source or language is a value of its own. Each row is a
    document, also where ids are null or repeat. Other columns are ignored; an empty table gives
    no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    model = fit(rows, labels, label_col, sample)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model), threshold),
        f"doc_id {kind}, text_score double, meta_score double, score double, kept boolean",
    )
