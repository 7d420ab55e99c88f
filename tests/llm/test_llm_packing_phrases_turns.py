"""Collocations, whole-document packing and conversation repair against plain Python, on odd rows."""

import bisect
import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierbed.llm import collocations as phrases
from tierbed.llm import turn_repair as repair
from tierbed.llm.best_fit import OpenCapacities, best_fit, pack_best_fit
from tierbed.llm.collocations import chunk_dictionary, collocations, phrase_counts
from tierbed.llm.queries import op11_turn_repair
from tierbed.llm.tokenizer import PieceTokenizer
from tierbed.llm.turn_repair import damaged, repair_turns, repaired_digests

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 700}" for i in range(30_000))
DOCS = "doc_id bigint, text string, lang string, chunk string, n bigint, part int, `rank` string, length bigint"


# --- packing ------------------------------------------------------------------------------------


def one_by_one(lengths, most):
    left, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(left, length)
        room = left.pop(i) if i < len(left) else most
        n += room == most
        if room > length:
            bisect.insort(left, room - length)
    return n, left


def test_tightest_open_capacity():
    tree, rng, held = OpenCapacities(37), random.Random(1), set()
    for _ in range(2000):
        c = rng.randint(0, 37)
        tree.put(c, c not in held)
        held ^= {c}
        asked = rng.randint(0, 37)
        assert tree.tightest(asked) == min((x for x in held if x >= asked), default=None)


@pytest.mark.parametrize("most", [1, 7, 100, 4096])
def test_plan_equals_packing_one_by_one(most):
    rng = random.Random(most)
    for size in (0, 1, 6, 60, 900):
        kinds = [rng.randint(1, most) for _ in range(size)] + [max(1, most // 3)] * size + [1] * size
        lengths = np.sort(np.array(kinds, np.int64))
        plan = best_fit(Counter(lengths.tolist()), most)
        expected, left = one_by_one(kinds, most)
        assert plan.n_sequences == expected
        if not size:
            continue
        rank = np.arange(len(lengths)) - np.searchsorted(lengths, lengths)
        filled = {}
        for sequence, offset, length in sorted(zip(*plan.place(lengths, rank), lengths, strict=True)):
            assert offset == filled.get(sequence, 0)
            filled[sequence] = offset + length
        assert sorted(filled) == list(range(expected))
        assert sorted(most - x for x in filled.values() if x < most) == left


def test_plan_of_a_large_corpus_is_small():
    rng = np.random.default_rng(0)
    counts = Counter(np.minimum(4096, rng.pareto(1.0, 300_000) * 80 + 1).astype(int).tolist())
    small = len(best_fit(counts, 4096).length)
    assert len(best_fit({k: 1000 * v for k, v in counts.items()}, 4096).length) < 2 * small


def packing(docs, **options):
    """Checked pieces of ``docs``: whole, cut only where longer, gapless, as many as one by one."""
    most = options.get("sequence_length", 4096)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = pack_best_fit(docs, with_ids=True, **options).collect()
    docs_ids = Counter()
    for r in docs.collect():
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 1]
        docs_ids[r.doc_id, tuple(ids)] += 1
    expected = Counter()
    lengths = []
    for (doc, ids), times in docs_ids.items():
        for piece, start in enumerate(range(0, len(ids), most)):
            part = ids[start : start + most]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected[doc, piece, start, len(part), crc, part] += times
            lengths += [len(part)] * times
    assert expected == Counter(
        (p.doc_id, p.piece, p.start, p.length, p.ids_crc32, tuple(p.ids)) for p in pieces
    )
    at = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at[p.sequence_id]
        at[p.sequence_id] += p.length
    assert max(at.values(), default=0) <= most
    assert len(at) == one_by_one(lengths, most)[0]
    return pieces


def test_packing_of_the_documents(spark):
    packing(spark.read.parquet(f"{SF}/documents.parquet").repartition(3))


def test_packing_of_odd_rows(spark):
    texts = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "no id"), (None, None), (4, LONG), (5, "É" * 500)]
    rows = [(*t, "en", "clash", 7, 3, "clash", 1) for t in texts] * 3
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing(docs, sequence_length=64)
    assert Counter(p.length for p in pieces if p.doc_id == 2) == {1: 3}
    assert pack_best_fit(docs.limit(0)).collect() == []


PLAIN = list("abcXYZ'''..,! \t\n019sstmdrevl<|>")
ODD = ["é", "É", "Ÿ", "ª", "²", "Ⱥ", "Ƀ", "Ɓ", "İ", "ß", "\u00a0", "\u0301", "中", "\x0b", "\x1c", "½", "×", "\u2003", "ſ"]


def test_ids_of_pieces_are_those_of_the_whole_tokenizer(monkeypatch):
    monkeypatch.setattr("tierbed.llm.tokenizer.CACHED_PIECES", 400)
    tokenizer, rng = PieceTokenizer(None), random.Random(1)
    assert tokenizer.direct
    for _ in range(1500):
        kinds = PLAIN if rng.random() < 0.7 else PLAIN + ODD
        texts = ["".join(rng.choices(kinds, k=rng.randint(0, 14))) for _ in range(rng.randint(0, 5))]
        got = tokenizer.texts([x.encode() for x in texts])
        want = [tokenizer.model.encode(x, add_special_tokens=False).ids for x in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


# --- collocations -------------------------------------------------------------------------------


def word_lists(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\n-\r]", low)]


def counted(rows, most):
    f = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for w in word_lists(text):
            for k in range(1, most + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def plain_collocations(rows, most=3, least=10, percent=50, top=2000):
    out = []
    for lang, f in counted(rows, most).items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = {}
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(a, longest.get(p[i : i + m], 0))
        scored = []
        for p, a in candidates.items():
            if 100 * longest.get(p, -1) >= percent * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def test_collocations_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()])
    assert want and sorted(map(tuple, collocations(docs).collect())) == want


ODD_TEXTS = [
    ("en", "A a a a a a a a a a a a. New york city, new york city\nnew york CITY"),
    ("en", "new york\tnew  york. new. york ... new york"),
    (None, "x y z x y z"),
    ("und", "x y z"),
    ("", "x y z w"),
    ("fr", None),
    ("fr", ""),
    ("fr", " . ,\t"),
    ("a b", "É é É é"),
    ("en", LONG),
]


@pytest.mark.parametrize("most, least, top, every", [(3, 2, 2000, 16), (2, 3, 2, 1), (4, 2, 7, 3)])
def test_collocations_of_odd_rows(spark, most, least, top, every):
    rows = [(1, t, lang, "clash", 7, 3, "clash", 1) for lang, t in ODD_TEXTS * 2]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = collocations(docs, most=most, least=least, top=top, every=every)
    want = plain_collocations([(r[2], r[1]) for r in rows], most, least, top=top)
    assert sorted(map(tuple, got.collect())) == want
    assert collocations(docs.limit(0)).collect() == []


def test_counts_behind_a_full_bit_array(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "HELD_PAIRS", 64)
    docs = spark.createDataFrame([(lang or "und", t) for lang, t in ODD_TEXTS], "lang string, text string")
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrase_counts(docs, least=3).collect()}
    want = {(lang, p): a for lang, f in counted([(x or "und", t) for x, t in ODD_TEXTS], 3).items() for p, a in f.items()}
    assert all(want[k] == v for k, v in got.items())
    assert {k for k, v in want.items() if v >= 3 or len(k[1]) == 1} <= got.keys()


def test_chunks_stand_for_the_texts(spark):
    """Own tokens of the chunks, counted by frequency, are the texts' tokens; passages share chunks."""
    rng = random.Random(3)
    passage = " ".join(f"p{rng.randint(0, 999)}" for _ in range(400))
    own = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(50)) for _ in range(6)]
    docs = spark.createDataFrame([("en", f"{x} {passage} {x}") for x in own], "lang string, text string")
    chunks = chunk_dictionary(docs).collect()
    tokens = Counter()
    for c in chunks:
        words = c.chunk.split(" ")
        assert len(words) == c.words + 2
        for w in words[2:]:
            tokens[w] += c.freq
    assert tokens == Counter(w for x in own for w in f"{x} {passage} {x}".split())
    shared = [c for c in chunks if c.freq == len(own) and c.chunk in passage]
    assert sum(c.words for c in shared) > 300
    ends = {tuple(c.chunk.split(" ")[-2:]) for c in shared}
    assert {tuple(c.chunk.split(" ")[:2]) for c in shared[1:]} & ends


def test_large_counts_stay_exact(spark):
    a = 3 * 10**12 + 7
    df = spark.createDataFrame([(a, a + 11, a + 5)], "a bigint, l bigint, r bigint")
    cast = df.select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in df.columns])
    got = cast.select(F.expr("(decimal(1000000) * a * a) div (l * r)")).first()[0]
    assert got == 10**6 * a * a // ((a + 11) * (a + 5))


# --- conversations ------------------------------------------------------------------------------

STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def shortest_repair(rows):
    """Least (cost, audit) by a search over (rows read, state), and the repaired rows."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, out
        ways = [(2, "I", i, q, f"{NAMES[x]}:") for (p, x), q in STEPS.items() if p == state and x in NAMES]
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((3, "D", i + 1, state, None))
            if fault not in ("blank", "duplicate"):
                for (p, x), q in STEPS.items():
                    if p == state:
                        more = fault == "truncated"
                        if role[:1] == x:
                            ways.append((more, "K", i + 1, q, f"{role}:{text}"))
                        if x in NAMES:
                            ways.append((2 + more, "R", i + 1, q, f"{NAMES[x]}:{text}"))
        for more, letter, at, q, row in ways:
            heapq.heappush(heap, (cost + more, audit + letter, at, q, out if row is None else (*out, row)))


def plain_repair(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
            faults.append((role, text, fault or ("truncated" if bare[-1] not in ".!?" else "")))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        n = Counter(f for _, _, f in faults)
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(faults))
        cost, audit, repaired = shortest_repair(faults)
        sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], bad, cost, audit, sha))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, conv string, part string, `at` string, n string"


def saved_table(rows, path):
    rows.write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_repair_of_the_conversations(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted(map(tuple, op11_turn_repair(spark, SF).collect()), key=str)
    assert got == plain_repair(map(tuple, table.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_repair_of_odd_rows(spark, tmp_path, seed):
    """Null and tied turns, null, empty and foreign roles, repeated rows, one large conversation."""
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "usr", " "]
    texts = ["a.", "b", "", "c!", None, "d d.\n", " \n\x0b", "e?", "é.", "é", "..."]
    rows = [
        (rng.choice([None, *range(30)]) if rng.random() < 0.5 else 99, rng.choice([None, *range(9 if seed else 400)]),
         rng.choice(roles), rng.choice(texts), *["clash"] * 4)
        for _ in range(500)
    ]
    path = saved_table(spark.createDataFrame(rows, CONVERSATIONS), tmp_path)
    got = sorted(map(tuple, op11_turn_repair(spark, path).collect()), key=str)
    assert got == plain_repair([r[:4] for r in rows])


def test_repair_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert op11_turn_repair(spark, saved_table(empty, tmp_path)).collect() == []
    assert repair_turns(empty).turns.collect() == []


def test_repair_of_one_long_conversation(spark):
    """Cut into parts of the sorted table, a conversation is repaired as a whole."""
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), f"text {rng.randint(0, 2500)}.") for i in range(3000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = repair_turns(table)
    r = found.conversations.first()
    seen, faults = set(), []
    for _, _, role, text in rows:
        faults.append((role, text, "duplicate" if (role, text) in seen else ""))
        seen.add((role, text))
    cost, audit, repaired = shortest_repair(faults)
    assert (r.cost, r.audit) == (cost, audit)
    turns = found.turns.orderBy("position").collect()
    assert [f"{t.role}:{t.text}" for t in turns] == list(repaired)
    assert [t.position for t in turns] == list(range(len(turns)))
    sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    assert repaired_digests(found.turns).first().sha256 == sha


def all_cuts(leaves):
    """CYK with every cut of every span."""
    n, cells = len(leaves), {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = {}
            for k in range(i + 1, i + length):
                for pq, found in repair.product(cells[i, k], cells[k, i + length]).items():
                    best[pq] = min(found, best.get(pq, found))
            cells[i, i + length] = best
    return cells[0, n]


def test_one_cut_a_span_is_enough():
    rng = random.Random(4)
    for _ in range(150):
        leaves = [
            repair.leaf("-", False, 1) if rng.random() < 0.2 else repair.leaf(rng.choice("sua-"), rng.random() < 0.3)
            for _ in range(rng.randint(1, 9))
        ]
        spans = repair.Spans()
        for cell in leaves:
            spans.add(cell)
        assert spans.whole() == all_cuts(leaves) == repair.read(repair.written(all_cuts(leaves)))


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "system", "A. b!") for c in range(40) for t in range(5)], "conv_id bigint, turn bigint, role string, text string")
    got = Counter(map(tuple, damaged(rows).collect()))
    want = Counter()
    for c in range(40):
        for t in range(5):
            kind = zlib.crc32(f"{c}:{t}".encode()) % 20
            text = {1: "", 2: "A b"}.get(kind, "A. b!")
            want[c, t, "user" if kind == 4 else "system", text] += {0: 0, 3: 2}.get(kind, 1)
    assert got == +want
