"""The whole pipeline against plain Python, stage by stage on each stage's own input."""

import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tierbed.llm import queries
from tierbed.llm.tokenizer import WordTokenizer
from tierbed.llm.fair_mixing import fair_mix

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows that each stage reads, and the last stage's result."""
    frames, root = [spark.read.parquet(f"{SF}/documents.parquet")], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SF).write.parquet(str(root / name))
        frames.append(spark.read.parquet(str(root / name)))
    return frames


def by_id(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def test_quality(steps):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    verdicts = con.execute(f"SELECT doc_id, kept FROM ({queries.oracle_sql()['op7_quality_rules']}) q").fetchall()
    texts = by_id(steps[0])
    assert by_id(steps[1]) == {d: texts[d] for d, kept in verdicts if kept}


def test_lines(steps):
    texts, holders = by_id(steps[1]), defaultdict(set)
    for d, text in texts.items():
        for line in text.split("\n"):
            holders[key(line)].add(d)
    for r in steps[2].collect():
        kept = [x for x in texts[r.doc_id].split("\n")
                if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == r.doc_id]
        assert r.text == "\n".join(kept) and r.n_chars == len(r.text)
    assert steps[2].count() == len(texts)


def test_near_copies(steps):
    texts = by_id(steps[2])
    sets = {}
    for d, text in texts.items():
        w = WORD.findall(text)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    assert by_id(steps[3]) == {d: t for d, t in texts.items() if find(d) == d}


def test_mix(steps):
    copies = {r.doc_id: r.copies for r in fair_mix(steps[3]).collect()}
    got = Counter(r.doc_id for r in steps[4].collect())
    assert got == Counter({d: n for d, n in copies.items() if n})
    size = {d: len(WORD.findall(t)) for d, t in by_id(steps[3]).items()}
    total = sum(size.values())
    assert 0 <= total - sum(size[d] * n for d, n in got.items()) <= max(size.values())


def test_pack_and_run(spark, steps):
    tokenizer, want = WordTokenizer(None).model, Counter()
    for r in steps[4].collect():
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        want[(r.doc_id, len(ids))] += 1
    rows = steps[5].collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n * c for (_, n), c in want.items())
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    again = entry.queries()["pipeline"](spark, SF).collect()
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in again)
    assert sum(n * k[2] for k, n in pieces.items()) == sum(r.length for r in rows)
    assert zlib.crc32(b"") not in {k[3] for k in pieces}
