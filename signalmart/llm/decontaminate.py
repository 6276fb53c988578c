"""Operator 3, benchmark decontamination by winnowing.

A text's k-gram hashes are thinned to the minimum of every w neighbours, with k + w - 1 the window
length: two texts that share a window always share the minimum inside it. Fingerprints of documents
and benchmark are joined, and every hit is extended word by word, in both directions and as far as a
window can reach; hits of a whole window are exact. Items shorter than a window are windows
themselves, with k and w of their own length.

The benchmark's side holds one row per different surrounding of a fingerprint, so items that share a
passage are joined once; the planner broadcasts it only if its measured size allows.

Null and empty texts have no words and no hits; items without words match nothing; rows that repeat
an id are judged by their own text; items that repeat an id count once, null item ids as the empty
string; extra columns are not read; empty tables give no hits.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common, wordhash

WINDOW = 13
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FINGERPRINT = "k long, h long, span int, gram long, pos int"


def split(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def scheme(span: int) -> tuple[int, int]:
    """k and w that guarantee a common fingerprint for a window of `span` words."""
    k = (span + 1) // 2
    return k, span - k + 1


def fingerprints(texts: list[bytes], spans: list[int]) -> dict[str, np.ndarray]:
    """`row, span, gram, pos` of the selected k-grams; a text too short for a span has none for it."""
    hashes, counts = wordhash.words(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    begin = np.cumsum(counts) - counts
    out: dict[str, list[np.ndarray]] = {"row": [], "span": [], "gram": [], "pos": []}
    for span in spans:
        if len(hashes) < span:
            continue
        k, w = scheme(span)
        values = wordhash.grams(hashes, k)
        at = wordhash.winnow(values, w)
        whole = owner[: len(at)] == owner[span - 1 : span - 1 + len(at)]
        at = at[whole]
        at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
        row = owner[at]
        out["row"].append(row)
        out["span"].append(np.full(len(at), span, np.int32))
        out["gram"].append(values[at].view(np.int64))
        out["pos"].append((at - begin[row]).astype(np.int32))
    empty = {"row": np.int64, "span": np.int32, "gram": np.int64, "pos": np.int32}
    return {c: np.concatenate(v) if v else np.zeros(0, empty[c]) for c, v in out.items()}


def _document_fingerprints(docs: DataFrame, spans: list[int]) -> DataFrame:
    def run(piece: pa.RecordBatch) -> dict:
        found = fingerprints([t.encode() for t in piece.column("text").to_pylist()], spans)
        rows = pa.array(found["row"])
        return {
            "k": piece.column("k").take(rows),
            "h": piece.column("h").take(rows),
            "span": pa.array(found["span"]),
            "gram": pa.array(found["gram"]),
            "pos": pa.array(found["pos"]),
        }

    return common.map_slices(docs.select("k", "h", "text"), run, FINGERPRINT)


def _surroundings(items: DataFrame, window: int) -> DataFrame:
    """`item_id, span, gram, off, around`: each item fingerprint with all a window can reach around it."""

    def run(piece: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"item_id": [], "span": [], "gram": [], "off": [], "around": []}
        for item, text in zip(piece.column("item_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
            words = split(text)
            if not words:
                continue
            span = min(window, len(words))
            k, _ = scheme(span)
            found = fingerprints([text.encode()], [span])
            for gram, pos in zip(found["gram"].tolist(), found["pos"].tolist(), strict=True):
                first = max(0, pos + k - span)
                out["item_id"].append(item)
                out["span"].append(span)
                out["gram"].append(gram)
                out["off"].append(pos - first)
                out["around"].append(b" ".join(words[first : pos + span]).decode())
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string())
        return {c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)}

    return common.map_slices(items, run, "item_id string, span int, gram long, off int, around string")


def extend(words: list[bytes], pos: int, around: list[bytes], off: int) -> tuple[int, int]:
    """Largest common run around `words[pos]` = `around[off]`, as places in `words`."""
    lo = 0
    while lo < off and lo < pos and words[pos - lo - 1] == around[off - lo - 1]:
        lo += 1
    hi, most = 0, min(len(words) - pos, len(around) - off)
    while hi < most and words[pos + hi] == around[off + hi]:
        hi += 1
    return pos - lo, pos + hi


def _verified(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """`k, h, n_hit, spans, arounds` of documents with fingerprint hits."""

    def run(piece: pa.RecordBatch) -> dict:
        n_hit, spans, arounds = [], [], []
        for text, found in zip(piece.column("text").to_pylist(), piece.column("hits").to_pylist(), strict=True):
            words = split(text)
            marked, own, ranges = np.zeros(len(words) + 1, np.int64), set(), set()
            cut: dict[str, list[bytes]] = {}
            for hit in found:
                around = cut.setdefault(hit["around"], hit["around"].encode().split(b" "))
                lo, hi = extend(words, hit["pos"], around, hit["off"])
                if hi - lo >= hit["span"]:
                    own.add(hit["id"])
                    ranges.add((lo, hi))
            for lo, hi in ranges:
                marked[lo] += 1
                marked[hi] -= 1
            n_hit.append(int((np.cumsum(marked) > 0).sum()))
            spans.append([{"first": lo, "last": hi - 1} for lo, hi in sorted(ranges)])
            arounds.append(sorted(own))
        return {
            "k": piece.column("k"),
            "h": piece.column("h"),
            "n_hit": pa.array(n_hit, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
            "arounds": pa.array(arounds, pa.list_(pa.string())),
        }

    joined = docs.select("k", "h", "text").join(hits, ["k", "h"])
    return common.map_slices(
        joined,
        run,
        "k long, h long, n_hit long, spans array<struct<first:long,last:long>>, arounds array<string>",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """`doc_id, k, h, n_words, n_hit, items, spans` of every document row.

    `items` are the item ids (as strings, sorted) with a window in the text, `spans` the word ranges
    hit, overlaps not joined.
    """
    own = common.keyed(docs, id_col, text_col)
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
    )
    around = _surroundings(items, window).withColumn("id", F.md5(F.concat_ws(" ", "span", "off", "around")))
    # At most `window` values: the lengths of windows there are.
    spans = sorted(r["span"] for r in around.select("span").distinct().collect())
    places = around.select("span", "gram", "off", "around", "id").distinct()
    hits = (
        _document_fingerprints(own, spans)
        .join(places, ["span", "gram"])
        .groupBy("k", "h")
        .agg(F.collect_list(F.struct("pos", "off", "span", "around", "id")).alias("hits"))
    )
    checked = _verified(own, hits).dropDuplicates(["k", "h"])
    named = (
        checked.select("k", "h", F.explode("arounds").alias("id"))
        .join(around.select("id", "item_id").distinct(), "id")
        .groupBy("k", "h")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )

    def count(piece: pa.RecordBatch) -> dict:
        n = wordhash.count_words([t.encode() for t in piece.column("text").to_pylist()])
        return {c: piece.column(c) for c in ("doc_id", "k", "h")} | {"n_words": pa.array(n, pa.int64())}

    counted = common.map_slices(own, count, "doc_id long, k long, h long, n_words long")
    found = checked.where("n_hit > 0").select("k", "h", "n_hit", "spans").join(named, ["k", "h"])
    return counted.join(found, ["k", "h"], "left").select(
        "doc_id",
        "k",
        "h",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )
