"""Every operator and pipeline stage on nulls, empty and long texts, ties, repeated rows, empty
tables and columns whose names clash with inner ones."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierbed.llm.arc import convert_pages
from tierbed.llm.chosen_path import ngram_join
from tierbed.llm.cotraining import quality_scores
from tierbed.llm.curve_packing import pack_along_curve
from tierbed.llm.fair_mixing import fair_mix
from tierbed.llm.line_dedup import dedup_lines
from tierbed.llm.quality_rules import quality_rules, without_boilerplate
from tierbed.llm.secret_scan import scan_secrets
from tierbed.llm.simhash import fingerprints, neighbours
from tierbed.llm.suffix_tree import suffix_tree_scores

# Names that an operator may think of for columns of its own.
INNER = """__key __row __nth __null __mix_row __mix_copy __kept __rejected __gone own_key OWN_KEY_ own_row rejected_key
kept_row nth_row no_text mix_key n_copies nth_copy gone_key gone_lines""".split()
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string,"
    " size string, slice string, bucket string, h string, `at` string, `a b` string, kept string, "
    + ", ".join(f"{name} string" for name in INNER)
)
LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
TEXTS = [
    (1, "One line of words here\nanother line that is here", "en", "a"),
    (1, "One line of words here\nanother line that is here", "en", "a"),
    (2, "One line of words here\nanother line that is there", None, None),
    (3, None, "en", "a"),
    (4, "", "en", ""),
    (5, " \t\n \r\n", "en", "b"),
    (None, "a text without an id", "en", "b"),
    (None, None, None, None),
    (6, LONG, "en", "c"),
    (7, "É" * 3000, "fr", "c"),
    (8, "x", "en", "c"),
    (8, "another text with the same id", "en", "c"),
    (9, " ".join(f"own{i}" for i in range(60)), "en", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*t, len(t[1] or ""), *["clash"] * 9, *INNER) for t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (8, 7)], "doc_id bigint, quality int")


def operators(labels):
    return {
        "suffix_tree": lambda d: suffix_tree_scores(d, F.col("doc_id") % 3 != 2),
        "ngram_join": ngram_join,
        "simhash": fingerprints,
        "secrets": scan_secrets,
        "line_dedup": dedup_lines,
        "quality_rules": quality_rules,
        "cotraining": lambda d: quality_scores(d, labels),
        "fair_mix": fair_mix,
    }


@pytest.mark.parametrize("name", operators(None))
def test_one_row_for_every_row(docs, labels, name):
    run = operators(labels)[name]
    assert len(run(docs).collect()) == len(TEXTS)
    assert run(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, "")
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert rows and {r.kept for r in rows} == {"clash"}
        assert {tuple(r[name] for name in INNER) for r in rows} == {tuple(INNER)}
    else:
        assert out.count() >= len(TEXTS)
    assert stage(spark, docs.limit(0), "").collect() == []


def test_boilerplate_leaves_other_rows_alone(docs):
    assert sorted(without_boilerplate(docs).collect(), key=str) == sorted(docs.collect(), key=str)


def test_neighbours_of_nothing(docs):
    prints = fingerprints(docs)
    assert neighbours(prints.limit(0), prints).collect() == []


def test_packing_of_rows_alike(docs):
    pieces = pack_along_curve(docs).collect()
    total = sum(p.length for p in pieces)
    assert sum(p.doc_tokens for p in pieces if p.start == 0) == total
    assert sum(p.start == 0 and p.doc_id is None for p in pieces) == 2


def test_null_pages(spark, tmp_path):
    rows = [(1, "http://x/a b", "<p>é</p>"), (2, None, "<p>é</p>"), (None, "http://x", "<p>é</p>"),
            (3, "u", None), (4, "u", ""), (4, "u", ""), (None, None, None), (5, "u", "WARC/1.1\r\n\r\nfake")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = convert_pages(pages, str(tmp_path / "warc")).filter("type != 'warcinfo'").collect()
    got = sorted(((r.page_id or 0, r.type, r.refers_to) for r in out), key=str)
    assert got == sorted([(1, "response", None), (2, "revisit", 1), (0, "revisit", 1), (3, "response", None),
                          (4, "revisit", 3), (4, "revisit", 3), (0, "revisit", 3), (5, "response", None)], key=str)
    assert convert_pages(pages.limit(0), str(tmp_path / "none")).collect() == []


def test_suffix_tree_keeps_contexts_at_any_size(spark):
    """A context met forty times is a state however large the rest of the corpus is; texts, against
    the tree on arrays."""
    import numpy as np

    from tierbed.llm.suffix_tree import DIVERGENCE, END, Level, _next_level
    from tierbed.llm.text import HashIndex, combine, with_end, word_hashes

    texts = ["some rare context comes true"] * 40 + [f"w{i % 977} w{i % 89} w{i % 7} x" for i in range(2000)]
    texts = [(i, t, True) for i, t in enumerate(texts)] + [(9000, "a rare context comes true now", False)]
    df = spark.createDataFrame(texts, "doc_id long, text string, train boolean")
    got = {r.doc_id: r for r in suffix_tree_scores(df, F.col("train"), p_min=0.05).collect()}
    assert got[9000].score > got[9000].base_score + 5

    chains = [[with_end(*word_hashes([t.encode()]), END)[0] for _, t, _ in texts]]
    for _ in range(3):
        chains.append([combine(t[:-1], t[1:]) for t in chains[-1]])
    learned = [np.concatenate([t for t, (_, _, train) in zip(level, texts, strict=True) if train]) for level in chains]
    keys, counts = np.unique(learned[0], return_counts=True)
    log_total = np.log10(counts.sum() + len(keys) + 1)
    levels = [Level(HashIndex(keys), counts, np.log10(counts + 1.0) - log_total, np.zeros(len(keys)))]
    for depth in (1, 2, 3):
        pairs = [np.stack([t[:-1], t[1:]], 1) for t, (_, _, train) in zip(chains[depth - 1], texts, strict=True) if train]
        pairs, counts = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
        pairs, counts = pairs[counts > 1], counts[counts > 1]
        levels.append(_next_level(levels, pairs[:, 0], pairs[:, 1], counts, DIVERGENCE))
    for (doc, _, _), *of in zip(texts, *chains, strict=True):
        score = 0.0
        for t in range(len(of[0])):
            for depth in (3, 2, 1, 0):
                if depth > t:
                    continue
                find = lambda d, at: int(levels[d].index.find(of[d][at - d : at - d + 1])[0])
                if not depth:
                    at = find(0, t)
                    score += levels[0].log_p[at] if at >= 0 else -log_total
                    break
                before, at = find(depth - 1, t - 1), find(depth, t)
                share = levels[depth - 1].back_off[before] if before >= 0 else 0.0
                if share < 0 and at >= 0:
                    score += levels[depth].log_p[at]
                    break
                score += share
        assert got[doc].score == pytest.approx(score, rel=1e-9), doc


def test_cotraining_searches_the_whole_table(spark, monkeypatch):
    """Sources without labels: the sure documents of all of them train the metadata view, not only
    those of a sample."""
    from tierbed.llm import cotraining

    good, bad = "clear prose with care and sense", "buy cheap pills now click here"
    rows = [(i, f"{good if i % 2 else bad} {i}", "en", f"seen{i % 2}") for i in range(200)]
    rows += [(1000 + i, f"{good if i % 2 else bad} {i}", "en", f"new{i % 2}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    seen = []
    sums = cotraining._summed
    monkeypatch.setattr(cotraining, "_summed", lambda *a: seen.append(sums(*a)) or seen[-1])
    scores = {r.doc_id: r for r in quality_scores(df, labels, sample=100).collect()}
    assert seen[0].sum() == 2 * 600  # every unlabelled document, by both views
    assert all((r.meta_score > 0.5) == bool(r.doc_id % 2) for r in scores.values())


def test_rare_words_of_one_shard_are_dealt_to_many_places():
    import numpy as np
    import pyarrow as pa

    from tierbed.llm.suffix_tree import _deal

    words = [np.arange(10 * i, 10 * i + 10, dtype=np.uint64) for i in range(8)]
    batch = pa.RecordBatch.from_pydict({"uid": list(range(8)), "rare": [w.tobytes() for w in words]})
    rows = [r for out in _deal(1, 4)([batch]) for r in out.to_pylist()]
    assert [r["place"] for r in rows] == [0, 1, 2, 3]
    for r in rows:
        uids, got = np.frombuffer(r["uids"], np.int64), np.frombuffer(r["words"], np.uint64)
        assert len(got) == 20 and (got // 10 == uids).all() and set(uids % 4) == {r["place"]}
