"""Operator 9, document fingerprints by Order MinHash, in DataFrame functions only.

A text is cut into words (longer ones into pieces of 16 characters); KMER neighbouring words make a
k-mer, numbered by how often it occurred before in the text. Hashes of the numbered k-mers deal them
to SKETCHES sketches; each sketch takes its TUPLE smallest, puts them back in text order and hashes
the tuple. A sketch that was dealt too few, as in short texts, ranks all k-mers of the text by a hash of
its own and takes the TUPLE smallest of them, so order counts at every length. Two texts share a sketch if
they share its smallest k-mers in the same order, so the share of equal sketches falls with edit distance.

A fingerprint is array functions over packed longs (hash above, position below), two sorts per text
and no exchange: n words take O(n log n) however they repeat.

Null and empty texts and texts of white space have no k-mer: all sketches are empty, and two such
fingerprints have likeness 1, with any other 0. A text of fewer than KMER words has one k-mer, the whole; a
text with one k-mer has tuples of one. Null ids order like the
smallest id. Rows that repeat an id are ordered by a hash of the text; rows that repeat id and text
are one document as a neighbour, and each gets its own result row. Extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmart.llm import common
from signalmart.operators import keys

KMER = 2
SKETCHES = 32
TUPLE = 2
WORD = r"\S{1,16}"
PLACE_BITS = 28  # more words than a string can hold
VALUE_BITS = 30
SMALLEST = -(1 << 63)


def _low(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _pack(high: Column, bits: int, place: Column) -> Column:
    return F.shiftleft(_low(high, bits), PLACE_BITS).bitwiseOR(place.cast("long"))


def _run_starts(items: Column, shift: int) -> Column:
    """Places in a sorted array where the bits above `shift` change."""
    begins = F.transform(
        items,
        lambda x, j: F.when(
            (j == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(items, j - 1), shift)), j
        ).otherwise(-1),
    )
    return F.filter(begins, lambda j: j >= 0)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: array of SKETCHES hashes (0 to 2^32 - 1), null for an empty sketch."""
    c = F.col
    kmers, items, runs, numbered, dealt, own = (
        f"_{out}_{x}" for x in ("kmers", "items", "runs", "numbered", "dealt", "own")
    )
    df = df.withColumn(
        kmers, F.transform(F.regexp_extract_all(c(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    )
    n = F.size(kmers)
    shifted = [F.slice(c(kmers), k + 1, F.greatest(n - (KMER - 1), F.lit(0))) for k in range(KMER)]
    joined = shifted[0]
    for other in shifted[1:]:
        joined = F.zip_with(joined, other, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(
        kmers, F.when(n >= KMER, joined).when(n > 0, F.array(F.xxhash64(c(kmers)))).otherwise(c(kmers))
    )
    # Equal k-mers side by side, in text order; their number is the distance from the run's start.
    df = df.withColumn(items, F.sort_array(F.transform(kmers, lambda h, i: _pack(h, 63 - PLACE_BITS, i))))
    df = df.withColumn(runs, _run_starts(c(items), PLACE_BITS))
    numbers = F.flatten(
        F.transform(
            runs,
            lambda s, r: F.sequence(F.lit(0), F.coalesce(F.get(c(runs), r + 1), F.size(items)) - s - 1),
        )
    )
    df = df.withColumn(
        numbered,
        F.zip_with(
            items,
            numbers,
            lambda x, o: F.struct(F.xxhash64(F.shiftright(x, PLACE_BITS), o).alias("h"), _low(x, PLACE_BITS).alias("p")),
        ),
    )
    bucket = lambda h: F.pmod(F.shiftright(h, VALUE_BITS), F.lit(SKETCHES))
    df = df.withColumn(
        dealt,
        F.sort_array(
            F.transform(
                numbered,
                lambda x: F.shiftleft(bucket(x["h"]), VALUE_BITS + PLACE_BITS).bitwiseOR(
                    _pack(x["h"], VALUE_BITS, x["p"])
                ),
            )
        ),
    )
    df = df.withColumn(runs, _run_starts(c(dealt), VALUE_BITS + PLACE_BITS))

    def tuple_hash(taken: Column) -> Column:
        places = F.sort_array(F.transform(taken, lambda x: _low(x, PLACE_BITS)))
        return _low(F.xxhash64(F.transform(places, lambda p: F.get(c(kmers), p.cast("int")))), 32)

    def sketch(s: Column, r: Column) -> Column:
        size = F.coalesce(F.get(c(runs), r + 1), F.size(dealt)) - s
        which = F.shiftright(F.get(c(dealt), s), VALUE_BITS + PLACE_BITS).cast("int")
        return F.struct(which.alias("b"), F.when(size >= TUPLE, tuple_hash(F.slice(c(dealt), s + 1, TUPLE))).alias("h"))

    def of_all(b: Column) -> Column:
        ranked = F.transform(numbered, lambda x: _pack(F.xxhash64(x["h"], b), 63 - PLACE_BITS, x["p"]))
        return tuple_hash(F.slice(F.sort_array(ranked), 1, TUPLE))

    df = df.withColumn(own, F.transform(runs, sketch))
    places = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda b: F.array_position(c(own)["b"], b))
    full = F.transform(
        places,
        lambda at, b: F.when(F.size(kmers) > 0, F.coalesce(F.get(c(own), at.cast("int") - 1)["h"], of_all(b))),
    )
    return df.withColumn(out, full).drop(kmers, items, runs, numbered, dealt, own)


def text_of(fingerprint: Column) -> Column:
    """Eight hex digits per sketch, eight dashes for an empty one."""
    return F.array_join(
        F.transform(fingerprint, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 8, "0")), F.lit("-" * 8))), ""
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of sketches equal among those not empty on both sides; 1 if all are empty."""
    pairs = F.zip_with(left, right, lambda a, b: F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a == b, F.lit(False))))
    counted = F.size(F.filter(pairs, lambda x: x.isNotNull()))
    equal = F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False))))
    return F.when(counted == 0, F.lit(1.0)).otherwise(equal / counted)


def neighbours(ids: DataFrame) -> DataFrame:
    """`k, h, next_k, next_h` of distinct `(k, h)`: the next in descending order, the first after the last.

    The one before in ascending order, found inside buckets of ids, so no task sorts all of them.
    """
    buckets = [F.shiftright("k", 12), F.shiftright("k", 24), F.shiftright("k", 40)]
    before = keys.lag_within(ids, [], "k", ["h"], buckets)
    top = ids.agg(F.max(F.struct("k", "h")).alias("m")).scalar()
    return before.select(
        "k",
        "h",
        F.coalesce("prev_k", top["k"]).alias("next_k"),
        F.when(F.col("prev_k").isNotNull(), F.col("prev_h")).otherwise(top["h"]).alias("next_h"),
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (last third from the next document).

    `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`.
    """
    rows = common.texts(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(SMALLEST)).alias("k"),
        F.xxhash64("text").alias("h"),
        F.col("doc_id").isNull().alias("no_id"),
        F.length("text").cast("long").alias("n_chars"),
        "text",
    )
    ids = rows.groupBy("k", "h").agg(F.first("n_chars").alias("n_chars"))
    links = neighbours(ids.select("k", "h")).join(
        ids.select("k", "h", F.expr("n_chars div 3").alias("taken")), ["k", "h"]
    )
    once = rows.select("k", "h", "text").withColumn(
        "_r", F.row_number().over(Window.partitionBy("k", "h").orderBy("k"))
    ).where("_r = 1")
    found = once.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), "text").join(
        links, ["next_k", "next_h"]
    ).select("k", "h", "next_k", "next_h", "taken", F.expr("left(text, int(taken))").alias("head"))
    # Written, so that the texts' two shuffles do not lie on disk at once.
    heads = common.staged(found, "order-minhash-heads", compression="zstd")
    edited = F.concat(F.expr("left(text, int(n_chars - taken))"), F.col("head"))
    both = rows.join(heads, ["k", "h"]).withColumn("edited", edited)
    both = with_fingerprint(with_fingerprint(both, "text", "own"), "edited", "other")
    done = common.staged(
        both.select(
            "k", "h", "no_id", "n_chars", "next_k", "next_h",
            F.sha2("edited", 256).alias("edited_sha256"), "own", "other",
        ),
        "order-minhash",
    )
    following = done.groupBy(F.col("k").alias("next_k"), F.col("h").alias("next_h")).agg(
        F.min("own").alias("following")
    )
    return done.join(following, ["next_k", "next_h"]).select(
        F.when(~F.col("no_id"), F.col("k")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
