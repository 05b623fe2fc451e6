"""Document fingerprints: one-permutation MinHash (DataFrame functions only).

Method.  Every shingle of ``SHINGLE`` words is hashed once; the top bits of
the hash name one of ``BINS`` bins, and each bin keeps its least hash.  An
empty bin takes the value of another bin by optimal densification: bins
named by a fixed pseudo-random sequence of its own, until one is filled;
after ``PROBES`` of them, the filled bin that comes first in a second fixed
order of its own.  The low ``BITS`` bits of all bins are packed into longs.  Two
fingerprints that agree in a share m of the bins have the likeness
(m - c) / (1 - c), c = 2 ** -BITS being the share that agrees by chance,
held within 0 and 1.

Edge cases.  A NULL text counts as empty.  A text without a word has the
fingerprint of zeros; its likeness to any text with words is 0, to another
without 1.  A text of fewer than ``SHINGLE`` words is one shingle.  Equal
texts have equal fingerprints.

Next document: the one that follows in the order of (key, text); after the
last comes the first.  A row without a key has none, which counts as empty.

Scale.  Fingerprints are computed where the text is read.  For the next
document, texts are shuffled once, into ranges of the key; the first row of
each range also goes to the range before it, so each range finds its next
documents alone.  Only the range bounds reach the driver.
"""

from __future__ import annotations

import functools
import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import id_bounds, range_of, shuffle_partitions, table

SHINGLE = 5
BINS = 256
BITS = 8
PROBES = 12
#: Bits of a hash below its bin; all set: no shingle in the bin.
LOW = 64 - BINS.bit_length() + 1
EMPTY = (1 << LOW) - 1
PER_LONG = 64 // BITS


def constant(values, kind: str) -> Column:
    """An array constant that the optimizer folds into one literal."""
    return F.from_json(F.lit(json.dumps([int(v) for v in values])), f"array<{kind}>")


def filled(value: Column) -> Column:
    return F.when(value.bitwiseAND(F.lit(EMPTY)) != EMPTY, value)


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the packed fingerprint (array of longs) of column ``text`` as ``name``."""
    own = {x: f"_{x}_{name}" for x in ("words", "codes", "hashes", "least", "held", "dense")}
    col = {k: F.col(v) for k, v in own.items()}
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    n = F.size(col["words"])
    hashes = (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(n < SHINGLE, F.array(F.xxhash64(col["codes"])))
        .otherwise(
            # single look-ups: slicing would copy the whole array for every shingle
            F.transform(
                F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(col["codes"], i + j) for j in range(SHINGLE)]),
            )
        )
    )
    # one mark per bin, greater than any hash in it: the first of each bin in order is its least hash
    half = BINS // 2
    marks = constant([(b - half) * (1 << LOW) + EMPTY for b in range(BINS)], "bigint")
    rows = rows.withColumn(own["words"], words)
    rows = rows.withColumn(own["codes"], F.transform(own["words"], lambda w: F.xxhash64(w)))
    rows = rows.withColumn(own["hashes"], F.sort_array(F.concat(hashes, marks)))
    bin_of = lambda x: F.shiftright(x, LOW)
    least = F.filter(
        col["hashes"], lambda x, i: ~bin_of(x).eqNullSafe(bin_of(F.get(col["hashes"], i - 1)))
    )
    rows = rows.withColumn(own["least"], least)
    rows = rows.withColumn(own["held"], F.filter(col["least"], lambda x: filled(x).isNotNull()))
    probes = np.random.default_rng(31).integers(0, BINS, BINS * PROBES)
    table_ = constant(probes, "int")

    def value(x: Column, b: Column) -> Column:
        tries = [filled(F.get(col["least"], F.get(table_, b * PROBES + j))) for j in range(PROBES)]
        ordered = F.transform(col["held"], lambda s: F.struct(F.xxhash64(b, bin_of(s)).alias("o"), s.alias("s")))
        return F.coalesce(filled(x), *tries, F.array_min(ordered)["s"])

    rows = rows.withColumn(own["dense"], F.transform(col["least"], value))
    longs = F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1))
    low_bits = F.lit((1 << BITS) - 1)

    def long_of(w: Column) -> Column:
        parts = [F.shiftleft(F.get(col["dense"], w * PER_LONG + j).bitwiseAND(low_bits), BITS * j) for j in range(PER_LONG)]
        return functools.reduce(Column.bitwiseOR, parts)

    none = F.array(*[F.lit(0).cast("long")] * (BINS // PER_LONG))
    rows = rows.withColumn(name, F.when(n == 0, none).otherwise(F.transform(longs, long_of)))
    rows = rows.withColumn(f"{name}_empty", n == 0)
    return rows.drop(*own.values())


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Estimated shingle likeness of two fingerprint columns, corrected for chance agreement."""
    ones = sum(1 << (BITS * i) for i in range(PER_LONG))
    lowest = F.lit(ones - (1 << 64) if ones >> 63 else ones)

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        spread = d
        for shift in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(d, shift))
        return F.bit_count(spread.bitwiseAND(lowest))

    bins = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    corrected = (1 - bins / BINS - chance) / (1 - chance)
    a_empty, b_empty = F.col(f"{a}_empty"), F.col(f"{b}_empty")
    return (
        F.when(a_empty | b_empty, (a_empty & b_empty).cast("double"))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), corrected)))
    )


def with_next(rows: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``next_<c>`` for each of ``columns`` (which include ``text``): the next document's."""
    parts = 4 * shuffle_partitions(rows.sparkSession)
    bounds = id_bounds(rows, key, parts)
    at = range_of(F.col(key), bounds)
    # a range's first key is its bound; its rows also close the range before
    before = F.when(at > 0, at - 1).otherwise(max(len(bounds) - 1, 0))
    first = F.get(constant(bounds, "bigint"), at) == F.col(key)
    own = F.struct(at.alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(before.cast("int").alias("part"), F.lit(True).alias("guest"))
    keyless = F.struct(
        (-1 - F.pmod(F.xxhash64(text), F.lit(parts))).cast("int").alias("part"), F.lit(False).alias("guest")
    )
    places = F.when(F.col(key).isNull(), F.array(keyless)).when(first, F.array(own, guest)).otherwise(F.array(own))
    rows = rows.withColumn("_place", F.explode(places))
    # plain columns: one exchange and one sort serve all the look-aheads
    rows = rows.withColumn("_part", F.col("_place.part")).withColumn("_guest", F.col("_place.guest")).drop("_place")
    order = Window.partitionBy("_part").orderBy("_guest", key, text)
    ahead = {f"next_{c}": F.lead(c).over(order) for c in columns}
    rows = rows.withColumns(ahead).where(~F.col("_guest"))
    return rows.withColumns({c: F.when(F.col(key).isNotNull(), F.col(c)) for c in ahead}).drop("_part", "_guest")


def edited_text(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by as many first ones (or all) of ``other``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(F.coalesce(other, F.lit("")), F.lit(1), half))


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness; see the module."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_fingerprint(docs, "text", "own")
    rows = with_next(rows, "doc_id", "text", ["text", "own", "own_empty"])
    rows = rows.withColumn("next_own_empty", F.coalesce("next_own_empty", F.lit(True)))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = with_fingerprint(rows, "edited", "changed")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        hex_of(F.col("own")).alias("fingerprint"),
        hex_of(F.col("changed")).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
