"""Quality rules with cross-document line frequencies.

Lines are normalised and hashed; for each host, the documents that hold a line are counted.
Lines above the limit are boilerplate and are removed; a document that loses most of its words
with them is rejected. Copies and near copies of a document share their lines, which is no sign of
boilerplate, so lines above the limit are counted once more with one vote for a class of copies,
and only those above the limit there as well are removed. No share of frequent lines takes a vote
away: pages of one template and a few words of their own each have a vote.

A class is known by what its documents have beside frequent lines: documents of a host with the same
other lines are copies. A line with the first or the last three words of a frequent line is an edited
copy of it, not another line. Documents without other lines are copies if their frequent lines are the
same, edited ones taken for what they were.

All steps are DataFrame functions. Lines become rows once and are kept in the shared folder
without their text. Counts need one partial aggregation; joins back to lines are salted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.storage import free_name, saved

SALTS = 16
LIKE_WORDS = 3


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate in a host if at least ``min_docs`` classes of copies hold it, and as
    many as more than ``share`` of the host's documents. A document is depleted when it loses at least
    ``depletion`` of its words. The rest are the rules on single documents."""

    min_docs: int = 10
    share: float = 0.01
    depletion: float = 0.8
    min_words: int = 20
    max_repeat_percent: int = 30


def with_word_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Arrays that several expressions read are columns of an earlier step, so they are computed
    once. A window of 8 words becomes a number, its hash above its position; after sorting,
    equal windows are neighbours, and neighbours with equal hashes are compared word by word.
    """
    words = F.expr(f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')")
    lines = F.expr(f"filter(split({text}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    keep = list(docs.columns)
    step = docs.withColumns({"__w": words, "__lines": lines})
    step = step.select(
        *keep,
        "__w",
        F.expr("length(bin(size(__w)))").alias("__bits"),
        F.expr("size(__w)").alias("n_words"),
        F.expr("length(array_join(__w, ''))").alias("word_chars"),
        F.expr(f"regexp_count({text}, '[#*$%&|<>]')").alias("n_symbols"),
        F.expr("size(__lines) - size(array_distinct(__lines))").alias("n_dup_lines"),
    )
    keep += ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    step = step.select(
        *keep,
        "__w",
        "__bits",
        F.expr(
            "sort_array(if(size(__w) < 9, cast(array() as array<bigint>),"
            " transform(sequence(1, size(__w) - 7),"
            " i -> shiftleft(xxhash64(slice(__w, i, 8)), __bits) | cast(i as bigint))))"
        ).alias("__keys"),
    )
    at = "cast(get(__keys, {}) & (shiftleft(1L, __bits) - 1) as int)"
    same = (
        "shiftrightunsigned(get(__keys, i), __bits) = shiftrightunsigned(get(__keys, i + 1), __bits)"
        f" and slice(__w, {at.format('i')}, 8) = slice(__w, {at.format('i + 1')}, 8)"
    )
    step = step.select(
        *keep,
        F.expr(
            "if(size(__keys) < 2, cast(array() as array<int>), sort_array(array_distinct(flatten("
            f"transform(filter(sequence(0, size(__keys) - 2), i -> {same}),"
            f" i -> array({at.format('i')}, {at.format('i + 1')}))))))"
        ).alias("__at"),
    )
    covered = (
        "aggregate(zip_with(__at, slice(__at, 2, size(__at)),"
        " (a, b) -> least(8, coalesce(b - a, 8))), 0, (x, y) -> x + y)"
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return step.select(
        *docs.columns,
        *[F.col(n).cast("bigint").alias(n) for n in names],
        F.expr(covered).cast("bigint").alias("n_repeat_words"),
    )


def normalised_lines(text: Column) -> Column:
    """One string per line: lower case, white space as one blank, trimmed."""
    plain = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(plain, "\n"), lambda line: F.trim(line))


def _prepared(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("text")
    ).withColumn("key", F.xxhash64("doc_id", "host", "text"))


def _line_rows(prepared: DataFrame) -> DataFrame:
    """One row per document and distinct line with words: ``key, host, doc_words, line, first, last, n``.

    ``line`` is a digest of it; ``n`` counts the words of all places of the line, ``doc_words`` those of all lines. ``first`` and
    ``last`` are hashes of its first and last ``LIKE_WORDS`` words, null where it has no more than those.
    """
    words = f"split(x, ' ', {LIKE_WORDS + 1})"
    first = f"if(size({words}) > {LIKE_WORDS}, xxhash64(substring_index(x, ' ', {LIKE_WORDS})), null)"
    last = f"if(size({words}) > {LIKE_WORDS}, xxhash64(substring_index(x, ' ', -{LIKE_WORDS})), null)"
    sorted_lines = prepared.select(
        "key", "host", F.filter(normalised_lines(F.col("text")), lambda x: x != "").alias("plain")
    ).select(
        "key",
        "host",
        F.expr(
            f"sort_array(transform(plain, x -> struct(unhex(md5(x)) as line, size(split(x, ' ')) as n,"
            f" {first} as first, {last} as last)))"
        ).alias("lines"),
    )
    starts = sorted_lines.select(
        "key",
        "host",
        "lines",
        F.expr("aggregate(lines, 0L, (a, x) -> a + x.n)").alias("doc_words"),
        F.expr(
            "filter(transform(lines, (x, i) -> if(i > 0 and get(lines, i - 1).line = x.line, -1, i)),"
            " i -> i >= 0)"
        ).alias("starts"),
    )
    return starts.select(
        "key",
        "host",
        "doc_words",
        F.expr(
            "inline(zip_with(starts, slice(starts, 2, size(starts)), (a, b) -> struct("
            "get(lines, a).line as line, get(lines, a).first as first, get(lines, a).last as last,"
            " cast(get(lines, a).n as bigint) * (coalesce(b, size(lines)) - a) as n)))"
        ),
    )


def _above_limits(counts: DataFrame, hosts: DataFrame, limits: Limits) -> DataFrame:
    """``counts(host, line, held)`` above the limits. Both sides have one row per group."""
    held = counts.filter(F.col("held") >= limits.min_docs)
    return held.join(hosts, F.col("host").eqNullSafe(F.col("host_name"))).filter(
        F.col("held") > F.col("host_docs") * limits.share
    ).select("host", "line")


def _salted(lines: DataFrame, listed: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """``lines`` joined with ``listed(host, column, ...)``, the columns but ``host`` and ``column`` added.
    ``listed`` has a row for each host and value; a hot line is met in many tasks."""
    salted = lines.withColumn("salt", F.pmod("key", F.lit(SALTS)))
    many = listed.withColumnsRenamed({"host": "h", column: "v"}).withColumn(
        "s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    same = F.col("host").eqNullSafe(F.col("h")) & (F.col(column) == F.col("v")) & (F.col("salt") == F.col("s"))
    return salted.join(many, same, how).drop("salt", "h", "v", "s")


def _classes(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``key, class`` of the documents with frequent lines; copies in a host have the same class."""
    listed = frequent.groupBy("host", "line").agg(F.min("first").alias("first"), F.min("last").alias("last"))
    marked = frequent.select(F.col("key").alias("k"), F.col("line").alias("l")).withColumn("known", F.lit(True))
    voters = frequent.select("key").distinct()
    rows = (
        lines.join(voters, "key", "left_semi")
        .join(marked, (F.col("key") == F.col("k")) & (F.col("line") == F.col("l")), "left")
        .select("key", "host", "line", "first", "last", "known")
    )
    others = rows.filter("known is null")
    for column in ("first", "last"):
        like = listed.filter(F.col(column).isNotNull()).groupBy("host", column)
        others = _salted(others, like.agg(F.min("line").alias(f"as_{column}")), column, "left")
    edited = F.coalesce("as_first", "as_last")
    held = rows.filter("known").select("key", F.col("line").alias("common"), F.lit(None).cast("binary").alias("own"))
    held = held.unionByName(
        others.select("key", edited.alias("common"), F.when(edited.isNull(), F.col("line")).alias("own"))
    )
    sets = held.groupBy("key").agg(F.collect_set("own").alias("own"), F.collect_set("common").alias("common"))
    own = F.size("own") > 0
    return sets.select(
        "key", F.xxhash64(own, F.when(own, F.sort_array("own")).otherwise(F.sort_array("common"))).alias("class")
    )


def boilerplate(prepared: DataFrame, limits: Limits) -> DataFrame:
    """The places of lines that are to be removed: ``key, host, doc_words, line, n``, once a
    document."""
    lines = saved(_line_rows(prepared), "quality-lines")
    hosts = prepared.groupBy(F.col("host").alias("host_name")).agg(F.count("*").alias("host_docs"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("held"))
    frequent = _salted(lines, _above_limits(counts, hosts, limits), "line")
    frequent = saved(frequent.dropDuplicates(["key", "line"]), "quality-frequent")
    votes = frequent.select("key", "host", "line").join(_classes(lines, frequent), "key")
    votes = votes.select("host", "line", "class").distinct()
    recounted = votes.groupBy("host", "line").agg(F.count("*").alias("held"))
    removed = _salted(frequent, _above_limits(recounted, hosts, limits), "line")
    return removed.select("key", "host", "doc_words", "line", "n")


def _verdicts(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits) -> DataFrame:
    """The columns of ``quality_rules``, the row's ``key`` and ``gone``, the hashes of its removed lines."""
    prepared = _prepared(docs, id_col, host_col, text_col)
    lost = (
        boilerplate(prepared, limits)
        .groupBy(F.col("key").alias("lost_key"))
        .agg(F.sum("n").alias("lost"), F.max("doc_words").alias("total"), F.collect_set("line").alias("gone"))
    )
    judged = with_word_statistics(prepared).drop("text", "host").join(
        lost, F.col("key") == F.col("lost_key"), "left"
    )
    failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent
    )
    depleted = F.coalesce(F.col("lost") >= F.col("total") * limits.depletion, F.lit(False))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.coalesce("lost", F.lit(0).cast("bigint")).alias("removed_words"),
        (~failed & ~depleted).alias("kept"),
        "key",
        "gone",
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_words, kept``.

    ``removed_words`` counts the words of removed lines. Null texts are empty, and fail the
    word count. A null host is a host; a null id is a document like any other. Rows alike in
    id, host and text count as several documents and get the same verdict. Lines without words
    are never counted. Other columns are ignored; an empty table gives no rows.
    """
    return _verdicts(docs, id_col, text_col, host_col, limits).drop("key", "gone")


def _without_lines(text_col: str, gone: str) -> Column:
    """The text without the lines whose hashes are in the column ``gone``."""
    text = F.col(f"`{text_col}`").cast("string")
    left = F.zip_with(
        F.split(text, "\n"),
        normalised_lines(text),
        lambda line, plain: F.when((plain == "") | ~F.array_contains(F.col(gone), F.unhex(F.md5(plain))), line),
    )
    return F.when(F.col(gone).isNull(), text).otherwise(F.array_join(F.filter(left, lambda x: x.isNotNull()), "\n"))


def _cleaned(
    docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits, chars_col: str, reject: bool
) -> DataFrame:
    own, theirs, kept, gone = (free_name(docs, x) for x in ("own_key", "their_key", "kept_row", "gone_lines"))
    verdicts = _verdicts(docs, id_col, text_col, host_col, limits)
    marks = (
        verdicts.filter(~F.col("kept") | F.col("gone").isNotNull())
        .select(F.col("key").alias(theirs), F.col("kept").alias(kept), F.col("gone").alias(gone))
        .dropDuplicates([theirs])
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(own, F.xxhash64(F.col(id_col), F.col(host_col).cast("string"), text))
    joined = keyed.join(marks, F.col(own) == F.col(theirs), "left")
    if reject:
        joined = joined.filter(F.coalesce(F.col(kept), F.lit(True)))
    joined = joined.withColumn(text_col, _without_lines(text_col, gone))
    if chars_col in docs.columns:
        chars = F.when(F.col(gone).isNull(), F.col(chars_col)).otherwise(F.length(text_col))
        joined = joined.withColumn(chars_col, chars.cast(docs.schema[chars_col].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])


def kept_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
    chars_col: str = "n_chars",
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without the lines above the limits.

    ``chars_col``, if there is one, is counted anew where lines go; other columns stay as they are, whatever
    their names. Null texts have no words and are rejected, as are empty ones. Rows alike in id,
    text and source share a verdict; a very long text is judged whole. An empty table gives no rows.
    """
    return _cleaned(docs, id_col, text_col, host_col, limits, chars_col, reject=True)


def without_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
    chars_col: str = "n_chars",
) -> DataFrame:
    """All rows of ``docs`` without the lines above the limits, ``chars_col`` counted anew where lines go,
    other columns as they are. Null texts stay null; a text may end up empty. An empty table gives
    no rows."""
    return _cleaned(docs, id_col, text_col, host_col, limits, chars_col, reject=False)
