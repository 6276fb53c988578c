"""Operators 3, 4, 5, 7 and 9 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from signalmart.llm import decontaminate, line_dedup, order_minhash, simhash, suffix_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    words = ["ab", "cd", "Ef", "gh", "é", "漢", "x1"]
    sentence = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = [sentence(30) for _ in range(4)]
    docs = []
    for _ in range(120):
        parts = [sentence(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 3))]
        parts += rnd.sample(shared, rnd.randint(0, 2))
        rnd.shuffle(parts)
        docs.append(rnd.choice(["\n", " "]).join(parts))
    docs += [docs[3]] * 5 + [docs[4] + " tail", "", None]
    ids = list(range(len(docs)))
    rnd.shuffle(ids)
    return list(zip(ids, docs, strict=True)), shared


def test_contamination(spark, corpus):
    rows, shared = corpus
    items = [(0, shared[0][:60]), (1, shared[0]), (2, "ab cd"), (3, "é"), (4, None), (5, "!"), (1, shared[1]), (None, "x1 x1 x1")]
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for k in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + 13])].add("" if item is None else str(item))
    want = []
    for doc, text in rows:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[g]
        want.append((doc, len(w), len(hit), sorted(found)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == sorted(want)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(fingerprints):
    ids = sorted(fingerprints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if b < a and (fingerprints[a] ^ fingerprints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark, corpus):
    rows, _ = corpus
    marks = {i: brute_fingerprint(t) for i, t in rows}
    roots = components(marks)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", simhash.hex_of().alias("fingerprint"), "component_id"
    ).collect()
    assert sorted(map(tuple, got)) == sorted((i, f"{m:016x}", roots[i]) for i, m in marks.items())


@pytest.mark.parametrize("hot", [2048, 1])
def test_simhash_links(spark, monkeypatch, hot):
    """Dense neighbourhoods, with the paired and with the enumerated path."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rnd = random.Random(2)
    seeds = [rnd.getrandbits(64) for _ in range(3)]
    marks = {s ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for s in seeds for _ in range(60)}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    got = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long")).distinct().collect()
    assert {(r.a, r.b) for r in got} == want


def brute_repeats(rows):
    first, out = {}, {}
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    for i, t in texts:
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_repeated_bytes(spark, corpus, monkeypatch, small):
    if small:  # many slices, buckets and blocks; tasks run in the same parameters by pickled values only
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1000)
    rows = [*corpus[0], (5000, "ab" * 200), (5001, "a" + "ab" * 300), (5002, "a" * 400), (5003, "a" * 399)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r[0]: (*r[1:4], bytes(r[4])) for r in got} == brute_repeats(rows)


def test_suffix_order_puts_equal_strings_together():
    rnd = random.Random(4)
    arounds = list({"".join(rnd.choice("ab") for _ in range(rnd.randint(50, 80))).encode() for _ in range(300)})
    arounds += [b"ab" * 40, b"a" * 70, b"ba" * 30 + b"b"]
    least = {}
    for k, a in enumerate(arounds):
        for p in range(len(a) - 49):
            least.setdefault(a[p : p + 50], k)
    got = suffix_dedup.least_ids(arounds, __import__("numpy").arange(len(arounds)))
    assert [x.tolist() for x in got] == [[least[a[p : p + 50]] for p in range(len(a) - 49)] for a in arounds]


def unique_lines(lines, lo, hi):
    places = {}
    for k in range(lo, hi):
        places[lines[k]] = -1 if lines[k] in places else k
    return {line: k for line, k in places.items() if k >= 0}


def patience(a, b):
    """Aligned places of equal lines: ends that agree, then lines unique on both sides, then between them."""
    out, ranges = [], [(0, len(a), 0, len(b))]
    while ranges:
        alo, ahi, blo, bhi = ranges.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        left, right = unique_lines(a, alo, ahi), unique_lines(b, blo, bhi)
        pairs = sorted((i, right[x], 1) for x, i in left.items() if x in right)
        at = (alo, blo)
        anchors = line_dedup._increasing(pairs)
        for i, j, _ in anchors:
            out.append((i, j))
            ranges.append((at[0], i, at[1], j))
            at = (i + 1, j + 1)
        if anchors:
            ranges.append((at[0], ahi, at[1], bhi))
    return sorted(out)


def brute_lines(rows, least=5):
    """Per row: lines in runs that an earlier document has, and those that any pairwise alignment finds."""
    docs = []
    for doc_id, text in rows:
        key = (-(1 << 63) if doc_id is None else doc_id, spark_hash(text or ""))
        docs.append((key, [(line, len(line.split())) for line in (text or "").split("\n") if line.split()]))
    out = []
    for key, lines in docs:
        earlier = [own for other, own in docs if other < key]
        known = {tuple(x for x, _ in own[a:b]) for own in earlier for a in range(len(own)) for b in range(a + 1, len(own) + 1)}
        gone, found = set(), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(w for _, w in lines[a:b]) >= least and tuple(x for x, _ in lines[a:b]) in known:
                    gone |= set(range(a, b))
        for own in earlier:
            block = []
            for i, j in [*patience([x for x, _ in own], [x for x, _ in lines]), (-9, -9)]:
                if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                    if sum(lines[y][1] for _, y in block) >= least:
                        found |= {y for _, y in block}
                    block = []
                block.append((i, j))
        out.append((gone, found))
    return out


def spark_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(spark, seed):
    """Every line that stands in an earlier document in its run goes; no alignment of any pair finds more."""
    rnd = random.Random(seed)
    stock = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 1, 2, 3, 6]))) for _ in range(14)] + ["", " ", "a  b"]
    rows = []
    for k in range(70):
        lines = [rnd.choice(stock) for _ in range(rnd.randint(0, 12))]
        if rows and rnd.random() < 0.5:
            other = (rnd.choice(rows)[1] or "").split("\n")
            a = rnd.randint(0, len(other))
            lines[rnd.randint(0, len(lines)) : 0] = other[a : a + rnd.randint(0, 6)]
        rows.append((rnd.choice([k, k, k // 2]), "\n".join(lines)))
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, None), (200, rows[7][1])]
    want = brute_lines(rows)
    frame = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int").repartition(4)
    got = {r.n: r for r in line_dedup.dedup(frame).collect()}
    n_found = 0
    for n, ((_, text), (gone, found)) in enumerate(zip(rows, want)):
        solid = [x for x in (text or "").split("\n") if x.split()]
        kept = [x for x in got[n].kept_text.split("\n") if x.split()]
        assert kept == [x for k, x in enumerate(solid) if k not in gone]
        assert got[n].n_lines - got[n].n_removed == (len(got[n].kept_text.split("\n")) if got[n].n_removed < got[n].n_lines else 0)
        assert found <= gone  # recall 1
        n_found += len(found)
    assert n_found > 50


def test_aligned_blocks():
    assert list(line_dedup.aligned_blocks([(0, 5, 1), (1, 6, 2), (4, 9, 1)])) == [(0, 3, 5), (4, 1, 9)]
    # Moved: the longest series first, the rest after it.
    assert list(line_dedup.aligned_blocks([(0, 7, 1), (1, 2, 1), (2, 3, 1)])) == [(1, 2, 2), (0, 1, 7)]
    assert line_dedup.shortest_runs([5, 1, 4, 9], 5) == [(0, 1), (0, 2), (1, 2), (2, 2), (3, 1)]
    assert line_dedup.shortest_runs([1, 1], 5) == line_dedup.shortest_runs([], 5) == []


def test_a_block_counts_whoever_holds_its_lines(spark):
    """Documents that hold single lines of a block don't hide the one that holds all of it."""
    block = ["one two", "three four", "five six", "seven eight"]
    rows = [(1, "\n".join(["first of all", *block, "end of it"]))]
    rows += [(k + 2, f"some other text {k}\n{line}\nmore of it {k}") for k, line in enumerate(block)]
    rows += [(6, "\n".join(["quite another", *block, "finish"]))]
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[6].n_removed == 4 and got[6].kept_text == "quite another\nfinish"
    assert [(b.k, b.start, b.size, b.earlier) for b in got[6].blocks] == [(1, 1, 4, 1)]
    assert all(got[k].n_removed == 0 for k in range(1, 6))


def test_lines_many_share(spark):
    """A passage that most documents hold stays in the first only."""
    rows = [(k, f"line of document number {k}\nthe licence applies to all of this text\n\nlast line {k}") for k in range(200)]
    done = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id > 0, r.n_removed) for r in done.collect()} == {(False, 0), (True, 1)}


def test_lines(spark):
    long = [f"this is line number {k} of many" for k in range(20)]
    rows = [
        (1, "\n".join(long[:6])), (2, "\n".join(["a new first line of its own", *long[2:5], "end"])),
        (3, "\n".join(long[:6])), (4, "nothing of the kind stands here"), (5, "short\nend"), (6, None), (7, ""),
        (8, "\n\n" + long[0] + "\n \n" + long[1] + "\n\n"), (9, "x\n\n" + long[0] + "\n\ny\n"),
    ]
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].kept_text == rows[0][1]
    assert got[2].kept_text == "a new first line of its own\nend" and got[2].n_removed == 3
    assert got[3].kept_text == "" and got[3].n_removed == 6
    assert [got[k].n_removed for k in (4, 5, 6, 7)] == [0, 0, 0, 0]
    assert got[8].kept_text == "" and got[8].n_removed == 7
    assert got[9].kept_text == "x\n\n\ny\n" and got[9].n_removed == 1


def test_edited_texts(spark, corpus):
    rows = [(i, t or "") for i, t in corpus[0]]
    down = sorted(rows, reverse=True)
    following = {i: down[(k + 1) % len(down)][1] for k, (i, _) in enumerate(down)}
    got = order_minhash.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    marks = {}
    for r in got:
        text, n = texts[r.doc_id], len(texts[r.doc_id]) // 3
        edited = text[: len(text) - n] + following[r.doc_id][:n]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert marks.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if following[r.doc_id] == text:
            assert r.near_next == 1
    for r in got:
        text = texts[r.doc_id]
        pairs = [(r.fingerprint[k : k + 8], marks[following[r.doc_id]][k : k + 8]) for k in range(0, len(r.fingerprint), 8)]
        counted = [p for p in pairs if p != ("-" * 8,) * 2]
        assert r.near_next == (sum(a == b for a, b in counted) / len(counted) if counted else 1.0)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*values):
    """Spark's xxhash64 of texts, longs and (as `(n,)`) ints: each is hashed with the hash before as its seed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v[0].to_bytes(4, "little") if isinstance(v, tuple) else \
            v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed=seed & ((1 << 64) - 1))
    return signed(seed)


def plain_order_minhash(text):
    """The definition, k-mer by k-mer and sketch by sketch."""
    words = [xx(w) for w in re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text)]
    kmers = [xx(a, b) for a, b in zip(words, words[1:])] if len(words) > 1 else [xx(*words)] if words else []
    seen, numbered = Counter(), []
    for place, kmer in enumerate(kmers):
        value = kmer & ((1 << 35) - 1)
        numbered.append((xx(value, (seen[value],)), place))
        seen[value] += 1
    out = []
    for b in range(order_minhash.SKETCHES):
        dealt = sorted((h & ((1 << 30) - 1), p) for h, p in numbered if (h >> 30) % order_minhash.SKETCHES == b)
        if len(dealt) < 2:
            dealt = sorted((xx(h, (b,)) & ((1 << 35) - 1), p) for h, p in numbered)
        places = sorted(p for _, p in dealt[:2])
        out.append(xx(*(kmers[p] for p in places)) & 0xFFFFFFFF if places else None)
    return out


def sketches(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.f for r in order_minhash.with_fingerprint(df, "t", "f").orderBy("i").collect()]


def test_sketches_are_the_plain_ones(spark, corpus):
    rnd = random.Random(2)
    texts = [t or "" for _, t in corpus[0]] + ["", " ", "one", "a" * 100, "x y " * 50, "x y " * 300, "é 漢字 🙂\u00a0z"]
    texts += [" ".join(rnd.choice("abcdefghijkl") for _ in range(n)) for n in (2, 3, 5, 31, 64, 200, 1500)]
    for text, got in zip(texts, sketches(spark, texts)):
        assert got == plain_order_minhash(text), text[:80]


@pytest.mark.parametrize("n", [8, 16, 32, 64, 128, 400])
def test_order_counts_at_every_length(spark, n):
    """Two halves in the other order: the tuples of both halves, half of all, differ."""
    rnd = random.Random(n)
    words = [[f"w{rnd.randrange(10**9)}" for _ in range(n)] for _ in range(30)]
    found = sketches(spark, [" ".join(w) for own in words for w in (own, own[n // 2 :] + own[: n // 2])])
    same = [sum(a == b for a, b in zip(x, y)) / len(x) for x, y in zip(found[::2], found[1::2])]
    assert (0.3 if n > 8 else 0.15) < sum(same) / len(same) < 0.6  # few words: the k-mer at the seam counts


def test_order_and_occurrence_matter(spark):
    words = [f"w{k}" for k in range(200)]
    plain, turned = " ".join(words), " ".join(words[100:] + words[:100])
    a, b, c = sketches(spark, [plain, turned, plain])
    assert a == c and a != b
    x, y = sketches(spark, ["x y " * 50, "x y " * 80])
    assert x != y


def test_hostile_rows(spark, hostile, hostile_docs, no_docs):
    bench = spark.createDataFrame([(1, hostile[5][1])], "item_id long, text string")
    n = len(hostile)
    assert decontaminate.contamination(hostile_docs, bench).count() == n
    assert simhash.near_duplicates(hostile_docs).count() == n
    assert suffix_dedup.remove_repeats(hostile_docs).count() == n
    assert order_minhash.edited_likeness(hostile_docs).count() == n
    lines = line_dedup.dedup(hostile_docs)
    assert lines.columns[:5] == hostile_docs.columns and lines.count() == n
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(hostile_docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert order_minhash.edited_likeness(no_docs).count() == 0
    assert line_dedup.dedup(no_docs).count() == 0
