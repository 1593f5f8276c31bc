"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks, in DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words at white space; shingles have five words (an item with fewer words
is one shingle). Windows have the size of a benchmark item. Only windows around a shingle of an item are set against
it; all others share nothing with that item, so nothing is lost. Each window gets a 64-bit SimHash of its shingles.
Fingerprints are cut into ``RADIUS + 1`` blocks: two that differ in ``RADIUS`` bits at most agree in one block, so an
equality join of a window's blocks with those of its item finds all of them. Candidates are verified exactly, by the
weighted Jaccard similarity of the shingle counts (sum of minima over sum of maxima), 0.8 or more.

A window of similarity 0.8 whose shingles all differ is expected to differ in about 10 of 64 bits; the radius leaves
five deviations. A shingle that repeats weighs on every bit and voids that estimate, so windows and items with a
repeated shingle are verified exactly without asking their fingerprints.

Defined results: a finding is a pair of document and item with its best window, counted in words from 0 (the first
of equals among the starts that shared shingles set; where the edge of an item is edited, an earlier start may tie).
Null or wordless texts and items find nothing; documents shorter than an item are one window; rows that share id and
text are one document, items that share them one item; an item id with several texts is found by any of them; an
empty table finds nothing; other columns are ignored.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .common import small_side

SHINGLE = 5
BITS = 64
RADIUS = 24
PERCENT = 80
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[ \t-\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: Column, first: Column, last: Column, size: int) -> Column:
    """Hashes of the shingles that start at words ``first`` to ``last``; none if ``last`` lies before ``first``."""
    hashed = F.transform(F.sequence(first, last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(last >= first, hashed).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Per bit the majority among the hashes. Three bits are counted side by side in one long."""
    lanes = range(-(-BITS // 3))
    spread, mask = 1 + (1 << 20) + (1 << 40), 1 + (1 << 21) + (1 << 42)

    def add(total: Column, h: Column) -> Column:
        return F.struct(*[(total[f"l{k}"] + ((F.shiftrightunsigned(h, 3 * k).bitwiseAND(7)) * F.lit(spread)).bitwiseAND(F.lit(mask))).alias(f"l{k}") for k in lanes])

    def bits(total: Column) -> Column:
        set_bits = []
        for b in range(BITS):
            count = F.shiftright(total[f"l{b // 3}"], 21 * (b % 3)).bitwiseAND((1 << 21) - 1)
            value = (1 << b) - (1 << 64 if b == 63 else 0)
            set_bits.append(F.when(count * 2 > F.size(hashes), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
        return reduce(lambda a, b: a.bitwiseOR(b), set_bits)

    return F.aggregate(hashes, F.struct(*[F.lit(0).cast("long").alias(f"l{k}") for k in lanes]), add, bits)


def repeats(hashes: Column) -> Column:
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def blocks(fingerprint: Column) -> Column:
    """``RADIUS + 1`` structs of block number and its bits."""
    n = RADIUS + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, cuts[k]).bitwiseAND((1 << (cuts[k + 1] - cuts[k])) - 1).alias("bits"))
        for k in range(n)
    ])


def row_key(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def findings(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, row, item_id, first_word, n_words, similarity``; ``row`` is ``row_key`` of the document."""
    items = staged(
        benchmark.select(F.col(item).alias("id"), word_hashes(F.col(item_text)).alias("w")).distinct()
        .select(F.struct("id", F.xxhash64("w").alias("text")).alias("item_id"), "w", F.size("w").alias("n")).filter("n > 0")
    )
    short = sorted(r["n"] for r in items.filter(F.col("n") < SHINGLE).select("n").distinct().collect())  # four values at most
    sizes = [*short, SHINGLE]
    own = reduce(DataFrame.union, [
        items.filter((F.col("n") == k) if k < SHINGLE else (F.col("n") >= k)).select(
            "item_id", "n", F.lit(k).alias("k"), shingles(F.col("w"), F.lit(0), F.col("n") - k, k).alias("s"))
        for k in sizes
    ])
    own = staged(own.select("*", simhash(F.col("s")).alias("item_print"), repeats(F.col("s")).alias("item_repeats")))
    places = staged(own.select("item_id", "n", "k", F.posexplode("s").alias("item_at", "h")))

    texts = docs.select(F.col(key).alias("doc_id"), row_key(key, text).alias("row"), word_hashes(F.col(text)).alias("w"))
    marks = reduce(DataFrame.union, [
        texts.select("row", F.size("w").alias("words"), F.lit(k).alias("k"), F.posexplode(shingles(F.col("w"), F.lit(0), F.size("w") - k, k)).alias("at", "h"))
        for k in sizes
    ])
    aligned = marks.join(small_side(places, places.count()), ["k", "h"]).select(
        "row", "item_id", "n", "k", F.greatest(F.lit(0), F.least(F.col("words") - F.col("n"), F.col("at") - F.col("item_at"))).alias("start"),
    ).distinct()
    # every start between two alignments of an item that lie within its length
    later = F.expr("lead(start) over (partition by row, item_id order by start)")
    gap = aligned.withColumn("later", later)
    upto = F.when(F.col("later") - F.col("start") <= F.col("n"), F.col("later") - 1).otherwise(F.col("start"))
    met = staged(gap.select("row", "item_id", "n", "k", F.explode(F.sequence("start", upto)).alias("start")))
    starts = met.select("row", "n", "k", "start").distinct()

    touched = met.select("row").distinct()
    held = texts.dropDuplicates(["row"]).join(small_side(touched, met.count()), "row", "left_semi")
    ends = F.least(F.col("start") + F.col("n"), F.size("w"))
    windows = held.join(starts, "row").select("doc_id", "row", "n", "start", ends.alias("stop"), "k", "w")
    by_size = F.coalesce(*[F.when(F.col("k") == k, shingles(F.col("w"), F.col("start"), F.col("stop") - k, k)) for k in sizes])
    windows = windows.select("doc_id", "row", "n", "start", (F.col("stop") - F.col("start")).alias("words"), by_size.alias("s"))
    windows = staged(windows.select("*", simhash(F.col("s")).alias("print"), repeats(F.col("s")).alias("repeats")))

    columns = ["row", "n", "start", "item_id"]
    apart = F.array(F.struct(F.lit(-1).alias("block"), F.lit(0).cast("long").alias("bits")))  # meets the item whatever its print
    pairs = met.select(columns).join(windows.select("row", "n", "start", "print", "repeats"), ["row", "n", "start"])
    window_blocks = pairs.select(*columns, "print", "repeats", F.inline(F.concat(blocks(F.col("print")), apart)))
    item_blocks = own.select("item_id", "item_print", "item_repeats", F.inline(F.concat(blocks(F.col("item_print")), apart)))
    within = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    asked = F.when(F.col("block") >= 0, within).otherwise(F.col("repeats") | F.col("item_repeats"))
    near = window_blocks.join(small_side(item_blocks, own.count() * (RADIUS + 2)), ["item_id", "block", "bits"]).filter(asked)
    candidates = near.select(columns).distinct()

    counted = candidates.join(windows, ["row", "n", "start"]).select("doc_id", *columns, "words", F.size("s").alias("total"), F.explode("s").alias("h"))
    counted = counted.groupBy("doc_id", *columns, "words", "total", "h").agg(F.count(F.lit(1)).alias("c"))
    item_counts = own.select("item_id", F.size("s").alias("item_total"), F.explode("s").alias("h")).groupBy("item_id", "item_total", "h").agg(F.count(F.lit(1)).alias("ic"))
    shared = counted.join(item_counts, ["item_id", "h"])
    least = shared.groupBy("doc_id", "row", "item_id", "n", "start", "words", "total", "item_total").agg(F.sum(F.least("c", "ic")).alias("both"))
    either = F.col("total") + F.col("item_total") - F.col("both")
    alike = least.filter(F.col("both") * 100 >= either * PERCENT).withColumn("similarity", F.col("both") / either)
    best = F.max_by(F.struct("start", "words", "similarity"), F.struct("similarity", -F.col("start"))).alias("best")
    return alike.groupBy("doc_id", "row", F.col("item_id.id").alias("item_id")).agg(best).select(
        "doc_id", "row", "item_id", F.col("best.start").alias("first_word"), F.col("best.words").alias("n_words"), "best.similarity",
    )


def without_findings(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    rows = found.select(F.col("row").alias("_row")).distinct()
    return docs.join(rows, row_key(key, text) == F.col("_row"), "left_anti")
