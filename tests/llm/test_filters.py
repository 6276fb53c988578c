"""Operators 8 and 10, and the pipeline."""

import random

import check_oracle
import corpus_pipeline
import pytest

from signalmart.llm import queries, toxicity, url_reputation

SF_DIR = "/root/testdata/sf0.001"


def test_rules_hosts_and_paths(spark):
    urls = [
        None, "", "no scheme", "HTTP://A.Example.NET/en/x?q#f", "http://badexample.net/en/", "x://net/", "x://net",
        "http://example.com/de/y", "http://example.com/den", "http://a.org/fr/", "http://b.org?x=/fr/", "a://b://c/d",
    ]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    got = {r.i: r for r in url_reputation.judge(spark.createDataFrame(rows, "i int, url string, bad int")).collect()}
    assert [got[k].host for k in (0, 1, 2)] == ["", "", ""] and got[3].host == "a.example.net"
    assert [got[k].rule for k in range(12)] == [
        None, None, None, "example.net/en/", "net/", "net/", None, "example.com/de/", None, "org/fr/", None, None,
    ]
    assert [got[k].verdict for k in (3, 4, 7, 9)] == ["allow", "block", "block", "allow"]
    assert (got[11].host, got[11].path) == ("b:", "//c/d")
    assert got[3].path == "/en/x" and got[6].path == ""


def test_reputation_shrinks_to_the_domain(spark):
    rows = [(f"a{k % 5}.bad.com", 1) for k in range(100)] + [(f"b{k % 5}.good.com", 0) for k in range(100)]
    rows += [("new.bad.com", None), ("new.good.com", None), ("one.good.com", 1)]
    got = {r.host: r for r in url_reputation.reputation(spark.createDataFrame(rows, "host string, bad long")).collect()}
    assert got["new.bad.com"].rate > 0.8 and got["new.good.com"].rate < 0.2
    assert got["a0.bad.com"].low > 0.5 > got["one.good.com"].low
    empty = spark.createDataFrame([], "url string, bad int")
    assert url_reputation.judge(empty).count() == 0


def test_names_domains_and_suffixes(spark):
    want = {
        "a.b.example.com": ("a.b.example.com", "example.com", "com"),
        "user:pw@a.example.com:8080": ("a.example.com", "example.com", "com"),
        "example.com.": ("example.com", "example.com", "com"),
        "x.a.co.uk": ("x.a.co.uk", "a.co.uk", "co.uk"), "a.co.uk:80": ("a.co.uk", "a.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk", "co.uk"), "shop.de": ("shop.de", "shop.de", "de"), "localhost": ("localhost", "localhost", "localhost"),
        "192.168.1.7:8080": ("192.168.1.7", "192.168.1.7", "[address]"), "[::1]:443": ("[::1]", "[::1]", "[address]"),
        "": ("", "", ""), "aco.uk": ("aco.uk", "aco.uk", "uk"),
    }
    from pyspark.sql import functions as F

    name = url_reputation.name_of(F.col("host"))
    rows = spark.createDataFrame([(h,) for h in want], "host string").select(
        "host", name.alias("n"), url_reputation.domain_of(name).alias("d"), url_reputation.suffix_of(name).alias("s")).collect()
    assert {r.host: (r.n, r.d, r.s) for r in rows} == want


def test_one_host_does_not_speak_for_others(spark):
    """Neither under a two-label suffix nor among addresses; ports and users are one host."""
    rows = [(f"http://good{k % 20}.com/{k}", 0) for k in range(400)] + [(f"http://fine{k % 20}.co.uk/{k}", 0) for k in range(200)]
    rows += [("http://bad.co.uk/x", 1)] * 60 + [("http://192.168.1.7:8080/", 1)] * 60 + [("http://10.0.0.1/", 0)] * 60
    rows += [("http://new.co.uk/", None), ("http://10.9.1.7:8080/", None), ("http://u@192.168.1.7/", None), ("http://bad.co.uk.:81/", None)]
    frame = spark.createDataFrame([(*r, "h", 0.5) for r in rows], "url string, bad int, host string, bad_rate_low double")
    got = {r.url: r.verdict for r in url_reputation.judge(frame).collect()}
    assert got["http://bad.co.uk/x"] == got["http://bad.co.uk.:81/"] == "block"
    assert got["http://192.168.1.7:8080/"] == got["http://u@192.168.1.7/"] == "block"
    assert got["http://new.co.uk/"] == got["http://10.9.1.7:8080/"] == "allow"


def test_long_urls_and_repeated_rows(spark):
    url = "http://" + "a." * 500 + "example.com/" + "p" * 200_000
    rows = [(url, 1)] * 40 + [(url, None), (None, 0), ("http://ok.org/", 0)]
    got = url_reputation.judge(spark.createDataFrame(rows, "url string, bad int"))
    assert got.count() == 43 and {r.verdict for r in got.where("path like '/ppp%'").collect()} == {"block"}
    assert url_reputation.judge(spark.createDataFrame([], "url string, bad int, verdict int")).count() == 0


def test_twins(spark):
    duck = check_oracle.connect(SF_DIR)
    for name in queries.oracle_sql():
        assert check_oracle.difference(spark, duck, SF_DIR, name) is None


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(8)
    rude, plain = ["dolt", "oaf", "cad", "lout"], [f"w{k}" for k in range(60)]
    rows = []
    for i in range(600):
        toxic = i % 6 == 0
        words = [rnd.choice(plain) for _ in range(30)] + (rnd.sample(rude, 2) if toxic else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"), {r[0]: r[2] for r in rows}


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = toxicity.score(docs, labels).where(toxicity.held_out()).collect()
    assert len(got) > 80
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and any(r.evidence for r in got)


def test_held_out_labels_are_not_learned(spark, labelled):
    docs, labels, _ = labelled
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda y: {r.doc_id: r.score for r in toxicity.score(docs, y).collect()}
    assert scores(labels) == scores(turned)


def test_nearest_is_exact(labelled):
    docs, labels, _ = labelled
    index = toxicity.fit(docs, labels)
    dot = lambda a, b: sum(w * b.get(t, 0.0) for t, w in a.items())
    for counts in ({0: 1}, {0: 2, 1: 1}, {1: 1, 2: 3}, dict.fromkeys(range(len(index.terms)), 1)):
        query = index.vector(counts)
        sims = sorted(((dot(query, v), e) for e, v in enumerate(index.vectors)), reverse=True)
        least = sims[min(toxicity.NEIGHBOURS, len(sims)) - 1][0]
        want = {e for s, e in sims if s > 0 and s >= least - 1e-9}
        assert {e for e, _ in index.nearest(query)} == want


def test_hostile_rows(spark, hostile_docs, no_docs, labelled):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    scored = toxicity.score(hostile_docs, labels)
    assert scored.count() == hostile_docs.count() and set(scored.columns) >= {"doc_id", "k", "h", "score"}
    assert toxicity.score(hostile_docs, labels.limit(0)).where("score between 0 and 1").count() == hostile_docs.count()
    assert toxicity.score(no_docs, labels).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, seen, SF_DIR)
        if name != "sentencepiece":
            assert result.columns == docs.columns
            assert result.count() == result.select("doc_id").distinct().count()
        seen = result
    n, kept = docs.count(), seen.count()
    assert 0.5 * n < kept < n


def test_pipeline_keeps_columns_with_names_of_its_own(spark, tmp_path):
    """Columns named like an operator's pass through every stage; rows that repeat are one document."""
    text = "this document is one of its own kind, number {}\nand has a second line that is not like any other {}"
    names = "score evidence n_lines n_removed kept_text k h _k _h _in_0 in_0 root fp words copy".split()
    rows = [(n, text.format(n * 7919, "abcdefghij"[n] * 9), "en", "s", 100, *[f"{c}{n}" for c in names]) for n in range(8)]
    rows += [rows[3]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c for c in schema.replace(" string", "").replace(" long", "").split(", ")], name
        got = sorted(tuple(r) for r in docs.distinct().collect())
        assert got == sorted(set(rows)), name
    assert docs.count() == 8


def test_pipeline_on_hostile_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", None, 0), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3)]
    for k, own in enumerate((rows, [])):
        at = f"{tmp_path}/{k}"
        spark.createDataFrame(own, schema).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
        assert corpus_pipeline.run(spark, at).count() == (2 if own else 0)
