"""Operators 11, 12 and 13 against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalmart.llm import lexical_search, pivot_dedup, source_audit

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def ranked(docs, items, k):
    docs = [(d, Counter(WORD.findall(lower(t)))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m))
                for w in WORD.findall(lower(text))
                if w in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def got_ranks(docs, items, k=20):
    found = lexical_search.rank(docs, items, k)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    words = [f"w{int(rnd.paretovariate(0.6)) % 500}" for _ in range(4000)] + ["É", "漢字", "The", "x1"] * 20
    text = lambda n: rnd.choice([" ", "\n", ", "]).join(rnd.choice(words) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(400)]
    docs += [(400 + i, docs[7][1]) for i in range(50)] + [(900, None), (901, ""), (3, text(9)), (None, text(30))]
    items = [(i, text(rnd.randint(1, 40))) for i in range(25)] + [(25, docs[7][1]), (26, None), (27, "?!"), (None, "the")]
    rnd.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_ranks(spark, corpus, monkeypatch, small):
    docs, items = corpus
    if small:  # many segments, blocks of two documents, nearly all lists long, several passes
        monkeypatch.setattr(lexical_search, "SEGMENT_BYTES", 2000)
        monkeypatch.setattr(lexical_search, "BLOCK_BITS", 1)
        monkeypatch.setattr(lexical_search, "SHORT", 1000)
        monkeypatch.setattr(lexical_search, "ITEM_BYTES", 2000)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = got_ranks(frame, spark.createDataFrame(items, "item_id long, text string"), 10)
    assert got == ranked(docs, items, 10)


def test_blocks_are_skipped(corpus, monkeypatch):
    """Blocks that can't reach the best are never walked."""
    import pyarrow as pa

    from signalmart.llm import terms

    docs = [(i, "rare common" if i < 30 else "common filler " * (1 + i % 7)) for i in range(6400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]})
    made = lexical_search._index(batch, terms.Vocabulary([b"common", b"rare"]))
    row = {name: np.asarray(made[name][0]) for name in ("sizes", "term", "n", "docs", "tfs")}
    row["ids"] = made["ids"][0].to_numpy()
    segment = lexical_search._Segment(row, np.zeros(6400, bool), 6400, 20000)
    walked = []
    add = lexical_search._Best.add
    monkeypatch.setattr(lexical_search._Best, "add", lambda self, *a: (walked.append(len(a[0])), add(self, *a)))
    best = lexical_search._Best(20)
    segment.search([(0, 10), (1, 5000)], best)
    assert best.ids.tolist() == list(range(20)) and sum(walked) <= 64


def test_rank_hostile(spark, hostile, hostile_docs, no_docs):
    docs = [(d, t) for d, t, *_ in hostile]
    items = [(1, "cat dog hat"), (1, "cat dog hat"), (2, TEXT), (None, "id"), (4, None), (5, "z" * 3000)]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("rank", F.lit(1))
    assert got_ranks(hostile_docs, frame) == ranked(docs, items, 20)
    assert got_ranks(no_docs, frame) == [] == got_ranks(hostile_docs, frame.limit(0))


TEXT = "Ünïcödé 漢字 🙂 the the the"


def cosine_links(rows, threshold=0.9):
    usable = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            usable[i] = a / np.abs(a).max()
    links = defaultdict(set)
    for i, a in usable.items():
        for j, b in usable.items():
            if i < j and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i].add(j), links[j].add(i)
    return links


def near_truth(rows, threshold=0.9):
    links = cosine_links(rows, threshold)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(links[i]), least, vec_id == least))
    return sorted(out, key=repr)


def near_rows(spark, rows, kind="float", **more):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    for name, value in more.items():
        frame = frame.withColumn(name, F.lit(value))
    found = pivot_dedup.near_duplicates(frame)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()), key=repr)


def crowd(n, dim=32, seed=1, spread=0.02):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [np.float32(v).tolist() for v in centre + spread * rng.normal(size=(n, dim))]


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(pivot_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [np.float32(v).tolist() for v in rng.normal(size=(300, 32))]
    rows += crowd(60) + crowd(40, seed=2) + [rows[5]] * 70
    ids = rng.permutation(len(rows)).tolist()
    rows = list(zip(ids, rows))
    assert near_rows(spark, rows) == near_truth(rows)


def test_near_duplicates_hostile(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]),
        (8, [1e200, 1e200]), (9, [1e-200, 1e-200]), (10, [-1.0, -1.0]), (11, [1.0, 1.0, 0.0]), (12, [-0.0, 2.0]),
        (13, [0.0, 2.0]), (7, [1.0, 1.0]), (7, [2.0, -2.0]), (None, [1.0, 1.01]), (None, [5.0, -4.9, 1.0]), (None, None),
    ]
    assert near_rows(spark, rows, "double", c=1, n=2, p="x", root=3, label=None) == near_truth(rows)
    assert near_rows(spark, []) == []
    assert near_rows(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_near_duplicates_recall(spark):
    """Of pairs just above the threshold, among unrelated vectors, at least 0.9 are found."""
    rng = np.random.default_rng(9)
    one = rng.normal(size=(2000, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other = rng.normal(size=one.shape)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.901, 0.92, size=(len(one), 1))
    both = np.concatenate((one, cosine * one + np.sqrt(1 - cosine**2) * other))
    noise = rng.normal(size=(2000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((both, noise)))]
    found = sum(r[1] for r in near_rows(spark, rows, "double"))
    truth = sum(r[1] for r in near_truth_fast(rows))
    print("recall", found / truth)
    assert truth >= 4000 and 0.97 * truth <= found <= truth


def near_truth_fast(rows):
    matrix = np.array([v for _, v in rows])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    return [(i, int(n)) for i, n in enumerate((matrix @ matrix.T >= 0.9).sum(axis=1) - 1)]


def divergences(rows):
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for r in mine for t in set(r[2]))
        kept = [t for t, n in df.items() if n >= 3]
        sources = sorted({r[1] for r in mine})
        counts = {s: Counter(t for r in mine if r[1] == s for t in r[2]) for s in sources}
        whole = sum(counts.values(), Counter())

        def share(c, total):
            return {t: 1 + (1000000000 * (c[t] + 1)) // (total + len(kept)) for t in kept}

        p = {s: share(c, sum(c[t] for t in kept)) for s, c in counts.items()}
        q = share(whole, sum(whole[t] for t in kept))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            own = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pairs, None), ("term", own, 200)):
                values.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(values[:most])]
    return sorted(out)


def got_divergences(spark, rows, **more):
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    for name, value in more.items():
        frame = frame.withColumn(name, F.lit(value))
    found = source_audit.divergence(frame)
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in found.collect())


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, monkeypatch, small):
    if small:  # many slices, blocks of sources and buckets of terms
        monkeypatch.setattr(source_audit, "SLICE_BYTES", 500)
        monkeypatch.setattr(source_audit, "SOURCES", 2)
        monkeypatch.setattr(source_audit, "STEP", 7)
        monkeypatch.setattr(source_audit, "HELD", 60)
    rnd = random.Random(8)
    words = ["the", "The", "don't", "a-a", "É", "漢字", "12", "x1y", "--"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(250):
        text = rnd.choice([" ", "\t\n", " ", "  "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
        rows.append((text, rnd.choice(["en", "en", "de", None]), rnd.choice(["s0", "s0", "s1", "s2", None, "漢"])))
    rows += [(None, "en", "empty"), ("12 34", "xx", "a"), ("once", "xx", "b"), rows[0], rows[0]]
    assert got_divergences(spark, rows) == divergences(rows)


def test_divergence_hostile(spark, hostile):
    rows = [(t, "en" if i % 2 else None, "s") for i, (_, t, *_) in enumerate(hostile)] * 3
    rows += [("z " * 200_000, "en", "long"), ("y" * 300_000, "en", "long")] * 3
    want = divergences(rows)
    assert got_divergences(spark, rows, doc_id=1, slice=2, term="x", n=1, item="i", value=2, p="p", chunk="c") == want
    assert got_divergences(spark, []) == []
