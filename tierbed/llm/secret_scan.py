"""Secrets by pattern and by randomness.

Patterns find assigned values, access keys and hexadecimal strings. Beside them, long runs of
key-like characters are put through a battery of tests. The null hypothesis is ordinary text:

- chi-squared against a uniform alphabet: text is far from uniform, so a small statistic speaks
  against it. The alphabet is inferred from the characters of the run.
- runs: text changes seldom between lower case, upper case, digits and signs.
- serial correlation of being a digit: in text digits stand together.

Decimal runs have a null hypothesis of their own, numbers that are counted up, filled up or
repeated: uniformity is asked of the digits and of the steps between them, and the other two tests
take digits below five and from five as their classes. Below 16 digits a number is ordinary, be it
a time in milliseconds, a bar code or a telephone number.

A run that signs join is tested whole and in its parts between signs. Whichever has the strongest
evidence stands for it, the evidence divided by the number of tests.

The three p-values are combined, and the false-discovery rate is controlled over all
candidates of the corpus, apart for each encoding and class of length, since short runs can give
no strong evidence. All steps are DataFrame functions. Texts are scanned once and not shuffled:
matches become rows with lengths, and a running sum over a document's rows gives positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.storage import saved

# Fixed patterns; the second group of the first is the assigned value.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{12,}"
PIECE = r"[A-Za-z0-9]{12,}"
SIGN = "[+/_-]"
KINDS = ["assign", "access", "hex", "random"]

FALSE_DISCOVERY_RATE = 0.01
BINS_PER_NAT = 4
MOST_BIN = 400
# Ordinary text: chance that two characters are equal, that the class changes from one character
# to the next, and the serial correlation of digits.
TEXT_EQUAL = 0.06
TEXT_CHANGE = 0.2
TEXT_CORRELATION = 0.8
SHORTEST, SHORTEST_DECIMAL = 12, 16


def _places(text: str, pattern: str, kind: int, value: int) -> Column:
    """For each match: kind, number, length of the gap before it, its length and a group of it."""
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(
        f"if({text} rlike {quoted}, transform(zip_with("
        f"transform(split({text}, {quoted}), x -> length(x)),"
        f" zip_with(regexp_extract_all({text}, {quoted}, 0), regexp_extract_all({text}, {quoted}, {value}),"
        " (whole, part) -> named_struct('len', length(whole), 'part', part)),"
        f" (gap, m) -> named_struct('kind', {kind}, 'gap', gap, 'len', m.len, 'part', m.part)),"
        " (x, i) -> named_struct('kind', x.kind, 'nth', i, 'gap', x.gap, 'len', x.len, 'part', x.part)),"
        " null)"
    )


def _with_log_tails(frame: DataFrame, names: list[str]) -> DataFrame:
    """Turns standard normal values into ln of the distribution function, by a logistic
    approximation. Each step is a projection of its own, so no expression is written out twice."""
    cubic = {n: F.col(n) * 1.5976 + F.col(n) * F.col(n) * F.col(n) * 0.07056 for n in names}
    tail = {n: F.when(F.col(n) < -30, F.col(n)).otherwise(-F.log1p(F.exp(-F.greatest(F.col(n), F.lit(-30.0))))) for n in names}
    return frame.withColumns(cubic).withColumns(tail)


def encoding(value: str) -> Column:
    """The narrowest alphabet that holds the characters of a run."""
    v = F.col(value)
    return (
        F.when(v.rlike("^[0-9]+$"), "decimal")
        .when(v.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(v.rlike("^[A-Z2-7]+$"), "base32")
        .when(v.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36")
        .otherwise("base64")
    )


def with_p_values(found: DataFrame) -> DataFrame:
    """Adds ``encoding`` and ``log_p`` to rows with a candidate in ``part``.

    The tests leave signs out, which also join ordinary words, and do not count the change from a
    capital to a small letter. Runs shorter than ``SHORTEST`` without their signs, and decimal ones
    shorter than ``SHORTEST_DECIMAL``, get no p-value below 1.
    """
    sizes = {"hex": 16, "base32": 32, "base36": 36, "base64": 64}
    decimal = F.col("encoding") == "decimal"
    k = F.lit(10)
    for name, size in sizes.items():
        k = F.when(F.col("encoding") == name, size).otherwise(k)
    chars = F.expr("transform(sequence(1, n), i -> substring(part, i, 1))")
    classes = F.expr(
        "transform(chars, c -> case when c between 'a' and 'z' then 1 when c between 'A' and 'Z' then 2"
        " when c < '5' and encoding = 'decimal' then 1 else 3 end)"
    )
    steps = F.when(
        decimal,
        F.expr(
            "array_join(zip_with(slice(chars, 1, n - 1), slice(chars, 2, n),"
            " (a, b) -> cast(pmod(cast(b as int) - cast(a as int), 10) as string)), '')"
        ),
    )

    def squared(column: str) -> Column:
        """Sum of the squared counts of the characters, at most as many passes as the alphabet has."""
        return F.expr(
            f"aggregate(array_distinct(split({column}, '')), 0L, (a, c) -> a + if(c = '', 0L,"
            f" cast(length({column}) - length(replace({column}, c, '')) as bigint)"
            f" * (length({column}) - length(replace({column}, c, '')))))"
        )

    changes = F.expr(
        "aggregate(zip_with(classes, slice(classes, 2, n), (a, b) -> if(a != b and not (a = 2 and b = 1), 1, 0)), 0,"
        " (a, x) -> a + coalesce(x, 0))"
    )
    digits = F.expr("aggregate(classes, 0, (a, c) -> a + if(c = 3, 1, 0))")
    together = F.expr(
        "aggregate(zip_with(classes, slice(classes, 2, n), (a, b) -> if(a = 3 and b = 3, 1, 0)), 0,"
        " (a, x) -> a + coalesce(x, 0))"
    )
    plain = F.regexp_replace("part", SIGN, "")
    step = (
        found.withColumns({"encoding": encoding("part"), "part": plain})
        .withColumn("n", F.when(F.length("part") > 3, F.length("part")))
        .withColumn("chars", chars)
        .withColumns({"classes": classes, "steps": steps, "k": k})
        .withColumns({"squares": squared("part"), "step_squares": squared("steps")})
        .withColumns({"changes": changes, "digits": digits, "together": together})
    )
    n, share = F.col("n").cast("double"), F.col("digits") / F.col("n")
    far = n * (F.greatest(F.lit(2.0), F.col("k") * TEXT_EQUAL) - 1)
    expected = far + F.col("k") - 1
    # The steps are null but for decimal runs.
    chi = F.greatest(F.col("k") / n * F.col("squares") - n, F.col("k") / (n - 1) * F.col("step_squares") - (n - 1))
    z_chi = (chi - expected) / F.sqrt(2 * (F.col("k") - 1) + 4 * far)
    z_runs = -(F.col("changes") - (n - 1) * TEXT_CHANGE) / F.sqrt((n - 1) * TEXT_CHANGE * (1 - TEXT_CHANGE))
    spread = F.greatest(share * (1 - share), F.lit(1e-9))
    r = F.when((F.col("digits") > 2) & (share < 1), (F.col("together") / (n - 1) - share * share) / spread)
    bounded = F.greatest(F.lit(-0.99), F.least(F.lit(0.99), F.coalesce(r, F.lit(0.99))))
    z_serial = (F.atanh(bounded) - F.atanh(F.lit(TEXT_CORRELATION))) * F.sqrt(n - 3)
    tails = _with_log_tails(
        step.withColumns({"z_chi": z_chi, "z_runs": z_runs, "z_serial": z_serial}), ["z_chi", "z_runs", "z_serial"]
    ).withColumn("t", -(F.col("z_chi") + F.col("z_runs") + F.col("z_serial")))
    combined = -F.col("t") + F.log1p(F.col("t") + F.col("t") * F.col("t") / 2)
    least = F.when(decimal, SHORTEST_DECIMAL).otherwise(SHORTEST)
    log_p = F.when(F.coalesce(n, F.lit(0.0)) < least, 0.0).otherwise(combined)
    return tails.withColumn("log_p", log_p)


def discoveries(candidates: DataFrame, rate: float) -> DataFrame:
    """The rows of ``candidates(encoding, len, log_p)`` that step-up control at ``rate`` accepts.

    Strata are encodings and length classes; p-values are rounded up to bins. The thresholds
    come from a table of at most 5 x 7 x ``MOST_BIN`` counts.
    """
    stratum = F.struct("encoding", F.least(F.floor(F.log2(F.col("len") / float(SHORTEST)) * 2), F.lit(6)).alias("long"))
    binned = candidates.withColumn("stratum", stratum).withColumn(
        "bin", F.least(F.floor(-F.col("log_p") * BINS_PER_NAT), F.lit(MOST_BIN))
    )
    counts = binned.groupBy("stratum", "bin").agg(F.count("*").alias("m"))
    down = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    whole = Window.partitionBy("stratum")
    passed = counts.withColumns({"rank": F.sum("m").over(down), "all": F.sum("m").over(whole)}).filter(
        F.exp(-F.col("bin") / BINS_PER_NAT) * F.col("all") <= F.col("rank") * rate
    )
    limits = passed.groupBy(F.col("stratum").alias("s")).agg(F.min("bin").alias("least"))
    # At most one row for each of 35 strata.
    return (
        binned.join(F.broadcast(limits), (F.col("stratum") == F.col("s")) & (F.col("bin") >= F.col("least")))
        .drop("stratum", "s", "bin", "least")
    )


def random_candidates(runs: DataFrame) -> DataFrame:
    """Of ``runs(key, nth, start, end, part)`` those to be judged, ``key, start, end, len, encoding,
    log_p``: each run, or its parts between signs where one of these has stronger evidence.
    """
    columns = ["key", "nth", "start", "end", "part", "whole"]
    joined = runs.filter(F.col("part").rlike(SIGN) & F.col("part").rlike(PIECE))
    places = joined.select("key", "nth", "start", F.inline(_places("part", PIECE, 3, 0)).alias("kind", "piece", "gap", "len", "word"))
    order = Window.partitionBy("key", "nth").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        places.withColumn("end", F.col("start") + F.sum(F.coalesce(F.col("gap") + F.col("len"), F.lit(0))).over(order))
        .filter("len is not null")
        .select("key", "nth", (F.col("end") - F.col("len")).alias("start"), "end", F.col("word").alias("part"), F.lit(False).alias("whole"))
    )
    tested = with_p_values(runs.withColumn("whole", F.lit(True)).select(columns).union(pieces.select(columns)))
    run = Window.partitionBy("key", "nth")
    return (
        tested.select("key", "nth", "start", "end", (F.col("end") - F.col("start")).alias("len"), "encoding", "log_p", "whole")
        .withColumns(
            {
                "tests": F.count("*").over(run),
                "of_whole": F.min(F.when(F.col("whole"), F.col("log_p"))).over(run),
                "of_parts": F.coalesce(F.min(F.when(~F.col("whole"), F.col("log_p"))).over(run), F.lit(0.0)),
            }
        )
        .filter(F.col("whole") == (F.col("of_whole") <= F.col("of_parts")))
        .withColumn("log_p", F.least(F.lit(0.0), F.col("log_p") + F.ln("tests")))
        .select("key", "start", "end", "len", "encoding", "log_p")
    )


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = FALSE_DISCOVERY_RATE,
) -> DataFrame:
    """One row per distinct document with secrets: ``key, spans``.

    ``key`` is a hash of id and text; ``spans`` are sorted structs ``start, kind, end`` of code
    points, end exclusive, kind being a position in ``KINDS``. Random spans do not overlap others.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    patterns = ((ASSIGN, 2), (ACCESS, 0), (HEX, 0), (CANDIDATE, 0))
    places = rows.select("key", *[_places("text", p, i, v).alias(KINDS[i]) for i, (p, v) in enumerate(patterns)])
    empty = F.array().cast(places.schema["assign"].dataType)
    found = places.select("key", F.inline(F.concat(*[F.coalesce(k, empty) for k in KINDS])))
    # Rows alike give the same places once. The gap after the last match has no match.
    order = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = found.filter("len is not null").dropDuplicates(["key", "kind", "nth"])
    spans = saved(ends, "secret-matches").withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order).cast("bigint")).withColumn(
        "start", F.col("end") - F.col("len")
    )
    known = spans.filter((F.col("kind") < 3) & ((F.col("kind") > 0) | (F.length("part") >= 8)))
    columns = ["key", "start", "kind", "end"]
    candidates = random_candidates(spans.filter("kind = 3")).withColumn("kind", F.lit(3))
    tested = discoveries(saved(candidates, "secret-candidates"), rate)
    both = known.select(columns).union(tested.select(columns))
    line = Window.partitionBy("key").orderBy("start", "kind")
    base = F.col("kind") < 3
    before = F.max(F.when(base, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    apart = base | (
        (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    )
    return (
        both.withColumn("apart", apart)
        .filter("apart")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )


def joined_spans(spans: str, below: int) -> Column:
    """``kind:start:end`` of the spans with a kind below the given one, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform(filter({spans}, x -> x.kind < {below}),"
        f" x -> concat_ws(':', array({names})[x.kind], x.start, x.end)), ',')"
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = FALSE_DISCOVERY_RATE,
) -> DataFrame:
    """One row per input row: ``doc_id, spans``, an array of structs ``start, kind, end``.

    Null and empty texts have no spans. Each row is a document, also where ids are null or
    repeat; rows alike count once among the candidates. Other columns are ignored; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spans = secret_spans(docs, id_col, text_col, rate)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("row"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, F.col("row") == F.col("key"), "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )
