"""Near-duplicate documents by order MinHash, verified by banded alignment.

Method.  A text's words form k-mers of ``K`` words, each labelled with its
occurrence number.  Each of ``SKETCHES`` hash functions picks the ``PICKS``
k-mers with the least hashes and keeps them in text order; two texts that
share such an ordered tuple are candidates, which favours texts at a small
edit distance.  Texts of fewer than ``SHORT`` words are also candidates if
they differ by one word.  A candidate pair is linked if the word edit distance, found
by alignment within a band of diagonals, is at most ``1 - SIMILARITY`` of
the longer text.  Classes are the connected components of the links.

Work within a bucket of g texts is not g * g: equal texts are one node; the
nodes meet the bucket's least and greatest node only (2 g pairs), each node
first that one of them with which it shares most buckets, the others only if
they are then still in different components.  Buckets that lie in several
components after that are completed.  In one of at most ``SMALL`` nodes, all
pairs across components whose lengths fit are aligned, ``SMALL`` a node at
most.  The nodes of larger ones first meet one node of the component that holds
most of their bucket.  Those of buckets that are open still, the mark of a
passage or of word pairs that very many texts share, meet by an exact filter: a text's ``allowed + 1``
disjoint runs of up to ``WINDOW`` words that the fewest others hold, one of
which every text that links with it holds too (``met_by_windows``).  Components
meet by it as a whole, with one row for a run, and their texts then by units of
about ``UNIT`` (``linked_components``): rows grow with components and units, not
with pairs of texts, and no link between components is lost.  Only texts whose
words agree are aligned.  Components of one text that share their rarest runs
and still do not link pay pair by pair.

Edge cases.  A NULL text counts as empty; empty texts, and texts of white
space only that are equal, are one class.  A text of fewer than ``K`` words
has one k-mer.  Repeated rows and repeated or NULL doc_ids get the class of
their text.  An empty table gives an empty result.

Scale.  Texts are shuffled once, to those that are candidates; sketches are
eight bytes per tuple.  Alignments of one text with many are dealt out in
units of ``UNIT`` texts.  Hot buckets and hot texts meet in sort-merge joins
of written tables, which adaptive execution splits.  Nothing is collected.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, ship_package, table

#: Two texts share a sketch with about 1 - (1 - J**PICKS)**SKETCHES, J being the likeness of their k-mers:
#: 98 % if a fifth of the words is replaced, all over the text.
K = 2
PICKS = 3
SKETCHES = 40
SIMILARITY = 0.8
#: Texts of fewer words are linked by one edit at most.
SHORT = 10
UNIT = 64
BAND = 40
#: Nodes of a bucket up to which all of them meet; those of larger ones meet by shared windows of words.
SMALL = 32
WINDOW = 4
#: Counters of windows, and what one counts, at most.
SLOTS = 1 << 23
MOST = (1 << 16) - 1
#: Largest components that the filter knows by number.
KNOWN = 250
#: Counters of a text's words when texts are compared many at once.
BINS = 1 << 11
#: Edges to a partition.
EDGES = 50_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word (polynomial over its bytes, then mixed)."""
    data = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    powers, inverse = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)])])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        base = int(_ODD[0])
        made = []
        for factor in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row))
        _TABLES[:] = made
    return _TABLES


def sketch(text: str) -> list[int]:
    """``SKETCHES`` hashes of ordered tuples (signed 64 bit), and ``one_edit``'s; none without a word."""
    words = words_of(text)
    if not words:
        return []
    w = word_hashes(words)
    n = max(1, len(w) - K + 1)
    kmers = np.zeros(n, np.uint64)
    for j in range(min(K, len(w))):
        kmers += w[j : j + n] * _ODD[j]
    kmers = mix(kmers)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(n)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    labelled = kmers + occurrence * _ODD[4]
    picks = min(PICKS, n)
    out = np.empty(SKETCHES, np.uint64)
    block = max(1, (1 << 18) // n)
    for r in range(0, SKETCHES, block):
        seeds = _SEEDS[r : min(r + block, SKETCHES), None]
        h = (labelled ^ seeds) * _ODD[np.arange(r, r + len(seeds)) % 5][:, None]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        rows, chosen = np.arange(len(seeds)), np.empty((len(seeds), picks), np.int64)
        for i in range(picks):
            chosen[:, i] = h.argmin(axis=1)
            h[rows, chosen[:, i]] = _LAST
        chosen.sort(axis=1)
        code = labelled[chosen] * _ODD[:picks]
        out[r : r + len(seeds)] = np.bitwise_xor.reduce(code + (code >> np.uint64(31)), axis=1) ^ seeds[:, 0]
    return [*dict.fromkeys([*mix(out).view(np.int64).tolist(), *one_edit(w)])]


def one_edit(w: np.ndarray) -> list[int]:
    """Hashes of a short text's words in order, and of all but one of them.

    Two texts of fewer than ``SHORT`` words are linked by one edit at most;
    then they share such a hash.
    """
    if len(w) >= SHORT or not allowed(len(w) + 1):
        return []
    parts = [w, *(np.delete(w, i) for i in range(len(w)) if allowed(len(w)))]
    place = np.arange(SHORT, dtype=np.uint64) * _ODD[1]
    return np.array([mix(x * _ODD[0] + place[: len(x)]).sum() for x in parts], np.uint64).view(np.int64).tolist()


def distance(a: list, b: list, most: int, least: int = 0) -> int | None:
    """The edit distance of two sequences if it is at most ``most``; it is known to be at least ``least``.

    Furthest-reaching points on a band of diagonals that widens with the
    distance (Ukkonen), up to ``BAND`` to each side; a larger distance is
    then found on bit vectors, a column of the alignment at a time (Myers).
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    low = 0
    while low < n and low < m and a[low] == b[low]:
        low += 1
    while n > low and m > low and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    goal = m - n
    a, b, n, m = a[low:n], b[low:m], n - low, m - low
    if not n or not m:
        return max(n, m) if max(n, m) <= most else None
    if least > BAND:
        return columns(a, b, most)
    reach: dict[int, int] = {}
    for e in range(min(most, BAND) + 1):
        spare = most - e
        now = {}
        for k in range(max(-e, goal - spare), min(e, goal + spare) + 1):
            i = -1 if e else 0
            for d, step in ((k, 1), (k - 1, 0), (k + 1, 1)):
                if d in reach and reach[d] + step > i:
                    i = reach[d] + step
            if i < 0:
                continue
            i = min(i, n, m - k)
            while i < n and i + k < m and a[i] == b[i + k]:
                i += 1
            now[k] = i
        if now.get(goal, -1) >= n:
            return e
        reach = now
    return columns(a, b, most) if most > BAND else None


def columns(a: list, b: list, most: int) -> int | None:
    """The edit distance if at most ``most``; a column's differences are two bit vectors."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = full, 0, len(a), len(b)
    for x in b:
        same = places.get(x, 0)
        level = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = (down | ~(across | up)) & full, up & across
        score += bool(more & last) - bool(less & last)
        left -= 1
        if score - left > most:
            return None
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(level | more)) & full, more & level & full
    return score if score <= most else None


def allowed(longer: int) -> int:
    """Word edits that still link two texts of which the longer has so many words."""
    return int((1 - SIMILARITY) * longer + 1e-9)


def alike(a: list[str], b: list[str], bag_a: Counter | None = None) -> bool:
    """Whether the word edit similarity of two texts is at least ``SIMILARITY``."""
    longer = max(len(a), len(b))
    most = allowed(longer)
    if abs(len(a) - len(b)) > most:
        return False
    least = longer - ((bag_a or Counter(a)) & Counter(b)).total()
    return least <= most and distance(a, b, most, least) is not None


def node_of(text: Column) -> Column:
    """Identity of a text (NULL: empty): its MD5 digest."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketches(docs: DataFrame, key: str) -> DataFrame:
    """(key, node, n_words, tuples) of every row."""

    def run(batches):
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([hashlib.md5(t.encode()).digest() for t in texts], pa.binary()),
                    pa.array([len(t.split()) for t in texts], pa.int32()),
                    pa.array([sketch(t) for t in texts], pa.list_(pa.int64())),
                ],
                names=["key", "node", "n_words", "tuples"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), "text").mapInArrow(
        run, f"key {kind}, node binary, n_words int, tuples array<bigint>"
    )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts align; ``size`` of a pair says how many pairs ``a`` may have."""
    units = F.ceil(F.col("size") / UNIT).cast("int")
    pairs = pairs.select("a", "b", units.alias("of")).withColumn("unit", F.pmod(F.xxhash64("b"), F.col("of")))
    held = texts.select(F.col("node").alias("b"), "text")
    members = pairs.join(held, "b").select("a", "of", "unit", "b", "text")
    heads = pairs.select(F.col("a").alias("head"), F.col("of").alias("head_of"), F.col("unit").alias("head_unit"))
    heads = heads.distinct().join(texts.select(F.col("node").alias("head"), F.col("text").alias("head_text")), "head")

    def check(key, head: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(head):
            one = words_of(head["head_text"].iloc[0])
            bag = Counter(one)
            found = [b for b, text in zip(rest["b"], rest["text"]) if alike(one, words_of(text), bag)]
        return pd.DataFrame({"a": [key[0]] * len(found), "b": found})

    by_head = heads.groupBy("head", "head_of", "head_unit")
    return by_head.cogroup(members.groupBy("a", "of", "unit")).applyInPandas(check, "a binary, b binary")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written and read back, and its number of rows: seen as they are written, not by a job of its own."""
    seen = Observation()
    return materialise(df.observe(seen, F.count(F.lit(1)).alias("n")), name), seen.get["n"]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the least node it is connected with.

    Alternates two steps on written edge tables: every node's larger
    neighbours, then its smaller ones, are linked to its least neighbour.  The
    first step also sees when all are: no node then has a smaller neighbour
    and another one.  The tables have a partition for every ``EDGES`` edges.
    """

    def to_least(edges: DataFrame, parts: int, tangled: Observation) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        met = both.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")).coalesce(parts)
        met = met.observe(tangled, F.max((F.col("least") < F.col("a")) & (F.col("n") > 1)).alias("any"))
        met = met.select(F.col("a").alias("b"), F.least("least", "a").alias("m"))
        return edges.join(met, "b").select("a", F.col("m").alias("b")).distinct().coalesce(parts)

    def smaller_to_least(edges: DataFrame, parts: int) -> DataFrame:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts)
        joined = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return joined.unionAll(least.select("a", F.col("m").alias("b"))).distinct().coalesce(parts)

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges, n = counted(edges, "links")
    while n:
        parts, tangled = -(-n // EDGES), Observation()
        stars = materialise(to_least(edges, parts, tangled), "links")
        if not tangled.get["any"]:
            break
        edges, n = counted(smaller_to_least(stars, parts), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    nodes = nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
    return nodes.coalesce(max(1, -(-n // EDGES)))


def classes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, node, class_id, first) of every row; ``class_id``: least key of its class.

    ``first``: the row holds the text and key that stand for its class.
    """
    ship_package(docs.sparkSession)
    rows = materialise(sketches(docs, key), "sketches")
    nodes = materialise(
        rows.groupBy("node").agg(
            F.min("key").alias("key"), F.first("n_words").alias("n_words"), F.first("tuples").alias("tuples")
        ),
        "nodes",
    )
    members = nodes.select("node", "n_words", F.explode("tuples").alias("bucket"))
    marked = F.struct("node", "n_words")
    buckets = materialise(
        members.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(marked).alias("low"), F.max(marked).alias("high"))
        .where("size > 1"),
        "buckets",
    )
    members = materialise(members.join(buckets, "bucket"), "members")

    def pairs_with(end: str) -> DataFrame:
        met = (F.col("node") != F.col(f"{end}.node")) & lengths_fit(F.col("n_words"), F.col(f"{end}.n_words"))
        return members.where(met).select(F.col(f"{end}.node").alias("a"), F.col("node").alias("b"), "size")

    ends = pairs_with("low").unionAll(pairs_with("high").where(F.col("high.node") != F.col("low.node")))
    ends = materialise(ends.groupBy("a", "b").agg(F.max("size").alias("size"), F.count("*").alias("shared")), "pairs")
    met = ends.select(F.explode(F.array("a", "b")).alias("node")).unionAll(completed(members).select("node"))
    wanted = met.distinct().join(nodes.select("node", "key"), "node")
    source = docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("node", node_of(F.col("text")))
    same_row = source["node"].eqNullSafe(wanted["node"]) & source["key"].eqNullSafe(wanted["key"])
    texts = materialise(
        source.join(wanted, same_row, "left_semi").groupBy("node").agg(F.first("text").alias("text")), "texts"
    )
    nearest = ends.groupBy("b").agg(F.max(F.struct("shared", "a", "size")).alias("best"))
    nearest = materialise(nearest.select("best.a", "b", "best.size"), "pairs")
    labels = materialise(components(verified(nearest, texts)), "labels")
    apart = still_apart(ends.join(nearest, ["a", "b"], "left_anti").select("a", "b", "size"), labels)
    labels = joined_by(verified(apart, texts), labels)
    still_open = open_members(members, labels)  # components only grow: no other bucket opens later
    labels = joined_by(links_to_largest(still_open, texts), labels)
    labels = joined_by(links_across(still_open.drop("label"), labels, texts), labels)
    named = nodes.select("node", "key").join(labels, "node", "left")
    named = named.select("node", "key", F.coalesce("label", "node").alias("label"))
    heads = named.groupBy("label").agg(F.min(F.struct(F.col("key").isNull(), "key", "node")).alias("head"))
    named = materialise(
        named.join(heads, "label").select(
            "node", F.col("head.key").alias("class_id"), (F.col("head.node") == F.col("node")).alias("head")
        ),
        "classes",
    )
    joined = rows.select("key", "node").join(named, "node")
    first = F.col("head") & F.col("key").eqNullSafe(F.col("class_id"))
    return joined.select(F.col("key").alias(key), "node", "class_id", first.alias("first"))


def joined_by(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels after more links (a, b).

    Only the components that a link joins are connected anew, each as one
    node: however many links there are between two of them, they make one edge.
    """
    between = label_of(label_of(links.select("a", "b"), labels, "a", "_of_a"), labels, "b", "_of_b")
    roots, found = counted(components(between.select(F.col("_of_a").alias("a"), F.col("_of_b").alias("b"))), "roots")
    if not found:
        return labels
    known = label_of(labels.select("node", F.col("label").alias("_was")), roots, "_was", "label").select("node", "label")
    return materialise(known.unionAll(roots.join(labels, "node", "left_anti").select("node", "label")), "labels")


def label_of(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the label of a node column; a node without links is its own component."""
    held = labels.select(F.col("node").alias(node), F.col("label").alias(name))
    return rows.join(held, node, "left").withColumn(name, F.coalesce(name, node))


def still_apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose nodes lie in different components."""
    both = label_of(label_of(pairs, labels, "a", "_of_a"), labels, "b", "_of_b")
    return materialise(both.where(F.col("_of_a") != F.col("_of_b")).drop("_of_a", "_of_b"), "pairs")


def lengths_fit(one: Column, other: Column) -> Column:
    """Whether two texts of so many words may link at all."""
    longer, shorter = F.greatest(one, other), F.least(one, other)
    return longer - shorter <= F.floor((1 - SIMILARITY) * longer + 1e-9)


def completed(members: DataFrame) -> DataFrame:
    """The members of buckets that are completed if open; up to three nodes all meet through the ends."""
    return members.where("size > 3").select("bucket", "node", "n_words", "size")


def windows(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first word, length) of every run of up to ``WINDOW`` words of a text."""
    words = words_of(text)
    w = word_hashes(words) if words else np.zeros(0, np.uint64)
    lengths = range(1, min(WINDOW, len(w)) + 1)
    keys = [mix(sum(w[j : j + len(w) - n + 1] * _ODD[j] for j in range(n)) + np.uint64(n)) for n in lengths]
    at = [np.arange(len(k)) for k in keys]
    none = np.zeros(0, np.int64)
    return (
        np.concatenate([none.view(np.uint64), *keys]), np.concatenate([none, *at]),
        np.concatenate([none, *[np.full(len(k), n) for k, n in zip(keys, lengths)]]),
    )


def ranges(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, ...]:
    """Each key of some texts' windows (keys, first words, words of the text) once.

    (key, first, last, low, high): its first and last place, and the least
    and most words of a text that holds it.
    """
    key, at = (np.concatenate([part[i] for part in parts]) for i in (0, 1))
    n_words = np.repeat([part[2] for part in parts], [len(part[0]) for part in parts])
    order = np.argsort(key, kind="stable")
    key, at, n_words = key[order], at[order].astype(np.int32), n_words[order].astype(np.int32)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    if not len(start):
        return key, at, at, n_words, n_words
    ends = [fold.reduceat(x, start) for x in (at, n_words) for fold in (np.minimum, np.maximum)]
    return (key[start], *ends)


def tally(rows: DataFrame, slots: int, layers: int, kind: type, add, fold) -> np.ndarray:
    """``layers`` arrays of ``slots`` counters, filled by ``add(total, batch)`` in every task and joined by ``fold``.

    A counter that several keys share only makes a worse choice of windows.
    """
    size = min(slots, 1 << 16)

    def count(batches):
        total = np.zeros((layers, slots), np.int32 if kind is np.uint16 else kind)
        for batch in batches:
            add(total, batch)
        total = np.minimum(total, np.iinfo(kind).max, out=total).reshape(layers, -1, size)
        for part in np.flatnonzero(total.any(axis=(0, 2))).tolist():
            held = zlib.compress(total[:, part].astype(kind).tobytes(), 1)
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([held])], names=["part", "held"])

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(layers * size, kind)
        for held in rows["held"]:
            total = fold(total, np.frombuffer(zlib.decompress(held), kind))
        return pd.DataFrame({"part": [key[0]], "held": [zlib.compress(total.astype(kind).tobytes(), 1)]})

    out = np.zeros((layers, slots // size, size), kind)
    for row in rows.mapInArrow(count, "part int, held binary").groupBy("part").applyInPandas(join, "part int, held binary").collect():
        out[:, row["part"]] = np.frombuffer(zlib.decompress(row["held"]), kind).reshape(layers, size)
    return out.reshape(layers, slots)


def slots_for(keys: int) -> int:
    """Counters for so many keys: a power of two, ``SLOTS`` at most."""
    return min(SLOTS, 1 << (4 * keys).bit_length())


def length_class(n_words):
    """A number below 255 that never falls as a text gets longer."""
    return np.minimum(254, 20 * np.log(np.maximum(n_words, 1))).astype(np.uint8)


def rarest(n_words: int, at: np.ndarray, length: np.ndarray, holders: np.ndarray) -> list[int]:
    """Which of a text's windows stand for it: ``allowed + 1`` disjoint ones whose greatest ``holders`` is least.

    Windows that are not given are held by this text alone; chosen ones of
    those are left out, since no other text can meet them.
    """
    wanted = allowed(n_words) + 1
    # by length and end: holders, and the place among the given windows
    cost = np.full((WINDOW + 1, n_words + 1), np.iinfo(np.int64).max)
    for size in range(1, WINDOW + 1):
        cost[size, size:] = 1
    given = np.full((WINDOW + 1, n_words + 1), -1)
    cost[length, at + length], given[length, at + length] = holders, np.arange(len(at))

    def disjoint(most: int) -> list[tuple[int, int]]:
        """As many disjoint windows (length, end) of up to ``most`` holders as there can be: the first to end, each time."""
        fits = cost <= most
        shortest = np.where(fits.any(axis=0), fits.argmax(axis=0), n_words + 1).tolist()
        found, free = [], 0
        for end in range(1, n_words + 1):
            if end - shortest[end] >= free:
                found.append((shortest[end], end))
                free = end
        return found

    levels = np.unique(np.concatenate([[1], holders]))
    low, high = 0, len(levels) - 1  # single words of any number of holders are always enough
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if len(disjoint(levels[middle])) >= wanted else (middle + 1, high)
    chosen = sorted(disjoint(levels[low]), key=lambda x: cost[x])[:wanted]
    return [int(given[x]) for x in chosen if given[x] >= 0]


def dealt_out(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (node, n_words, label) with the ``unit`` of their component, and (label, held, of): its nodes and units."""
    sizes = nodes.groupBy("label").agg(F.count("*").alias("held"))
    sizes = materialise(sizes.withColumn("of", F.ceil(F.col("held") / UNIT).cast("int")), "sizes")
    unit = F.pmod(F.xxhash64("node"), F.col("of")).cast("int")
    dealt = nodes.join(sizes, "label").select("node", "n_words", "label", unit.alias("unit"))
    return materialise(dealt, "nodes"), sizes


def units(batch: pa.RecordBatch) -> list[tuple[bytes, list[tuple[str, int]]]]:
    """(label, texts with their numbers of words) of each run of rows of one unit."""
    marks = list(zip(batch.column("label").to_pylist(), batch.column("unit").to_pylist()))
    texts = list(zip(batch.column("text").to_pylist(), batch.column("n_words").to_pylist()))
    starts = [i for i, mark in enumerate(marks) if not i or mark != marks[i - 1]]
    return [(marks[i][0], texts[i:end]) for i, end in zip(starts, [*starts[1:], len(marks)])]


def met_by_windows(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs (a, b) of components, a < b, of which any texts may link; none is left out.

    Each edit touches one at most of a text's disjoint windows.  So of
    ``allowed + 1`` disjoint windows of the longer of two texts that link, the
    shorter one holds one, shifted by ``allowed`` words at most.  Those that
    hardly any other unit holds are chosen; a window that no other unit holds
    needs no partner.  A component has one row for a window, however many of
    its texts hold it.
    """
    spark = held.sparkSession
    many = held.agg(F.sum("n_words")).first()[0] or 1
    slots = slots_for(WINDOW * many)
    known = sizes.where("held > 1").orderBy(F.desc("held"), "label").limit(KNOWN).collect()
    number = {bytes(row["label"]): i for i, row in enumerate(known, 1)}

    def slot(key: np.ndarray, of: int) -> np.ndarray:
        return (key & np.uint64(of - 1)).astype(np.int64)

    def count(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, texts in units(batch):
            np.add.at(total[0], slot(np.unique(np.concatenate([windows(text)[0] for text, _ in texts])), slots), 1)

    counts = spark.sparkContext.broadcast(
        tally(held.select("text", "n_words", "label", "unit"), slots, 1, np.uint16, count,
              lambda x, y: np.minimum(x.astype(np.int64) + y, MOST))[0]
    )

    def spread(of_text) -> DataFrame:
        def run(batches):
            for batch in batches:
                for label, texts in units(batch):
                    key, *bounds = ranges([(*of_text(text, n_words, label), n_words) for text, n_words in texts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * len(key), pa.binary()), pa.array(key.view(np.int64)), *map(pa.array, bounds)],
                        names=["label", "key", "first", "last", "low", "high"],
                    )

        made = held.select("text", "n_words", "label", "unit").mapInArrow(
            run, "label binary, key long, first int, last int, low int, high int"
        )
        ends = [fold(name).alias(name) for name, fold in (("first", F.min), ("last", F.max), ("low", F.min), ("high", F.max))]
        return made.groupBy("key", "label").agg(*ends)

    def rare(text: str, n_words: int, label: bytes):
        key, at, length = windows(text)
        holders = counts.value[slot(key, slots)].astype(np.int64)
        more = np.flatnonzero(holders > 1)
        chosen = more[rarest(len(words_of(text)), at[more], length[more], holders[more])]
        return key[chosen], at[chosen]

    chosen, runs = counted(spread(rare), "chosen")
    counts.destroy()  # what it chose is written
    wanted_slots = slots_for(WINDOW * runs)

    def choosers(total: np.ndarray, batch: pa.RecordBatch) -> None:
        at = slot(batch.column("key").to_numpy().view(np.uint64), wanted_slots)
        label = np.array([number.get(x, 255) for x in batch.column("label").to_pylist()], np.uint8)
        shortest, longest = (length_class(batch.column(name).to_numpy()) for name in ("low", "high"))
        for layer, value in enumerate((longest + 1, 255 - shortest, label, np.where(label == 255, 255, 255 - label))):
            np.maximum.at(total[layer], at, value.astype(np.uint8))

    # by slot: length of the longest and shortest text that chose it, and the component if only one did that is known
    wanted = spark.sparkContext.broadcast(
        tally(chosen.select("key", "label", "low", "high"), wanted_slots, 4, np.uint8, choosers, np.maximum)
    )

    def met(text: str, n_words: int, label: bytes):
        key, at, _ = windows(text)
        longest, shortest, one, other = wanted.value[:, slot(key, wanted_slots)]
        fits = (longest > length_class(n_words)) & (255 - shortest <= length_class(n_words / SIMILARITY + 2))
        own = (one == number.get(label, 0)) & (other == 255 - one)
        found = np.flatnonzero(fits & ~own)
        return key[found], at[found]

    ours = chosen.select("key", *[F.col(c).alias(f"_{c}") for c in ("label", "first", "last", "low", "high")])

    def edits(n_words: Column) -> Column:
        return F.floor((1 - SIMILARITY) * n_words + 1e-9)

    shift = edits(F.col("_high"))
    near = (F.col("first") - F.col("_last") <= shift) & (F.col("_first") - F.col("last") <= shift)
    fits = (F.col("low") <= F.col("_high")) & (F.col("_low") - F.col("high") <= edits(F.col("_low")))
    pairs = spread(met).join(ours, "key").where(near & fits & (F.col("_label") != F.col("label")))
    return pairs.select(F.least("_label", "label").alias("a"), F.greatest("_label", "label").alias("b")).distinct()


def histogram(words: list[str]) -> np.ndarray:
    return np.bincount((word_hashes(words) & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS).astype(np.int32)


def linked_components(pairs: DataFrame, held: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links (a, b) of nodes for the pairs (a, b) of components: one at least if any of their texts align.

    Units meet units, not each text each other one: a unit of the larger
    component is read once for about ``UNIT`` texts of the smaller ones.
    """
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("label").alias(side), F.struct("held", "label", "of").alias(f"_{side}")), side)
    pairs = materialise(pairs.select(F.greatest("_a", "_b").alias("a"), F.least("_a", "_b").alias("b")), "pairs")
    total = pairs.groupBy(F.col("a.label").alias("label")).agg(F.ceil(F.sum("b.held") / UNIT).alias("parts"))
    met = pairs.select(F.col("a.label").alias("label"), F.col("a.of").alias("of"), F.col("b.label").alias("other"), F.col("b.of").alias("other_of"))
    met = met.join(total, "label").withColumn("unit", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    met = met.withColumn("other_unit", F.explode(F.sequence(F.lit(0), F.col("other_of") - 1)))
    met = met.withColumn("part", F.pmod(F.xxhash64("other", "other_unit"), F.col("parts")))
    met = materialise(met.select("label", "unit", "part", "other", "other_unit"), "met")
    ours = held.select(*[F.col(c).alias(f"head_{c}") for c in ("label", "unit", "node", "text")])
    heads = met.select(*[F.col(c).alias(f"head_{c}") for c in ("label", "unit", "part")]).distinct()
    heads = heads.join(ours, ["head_label", "head_unit"])
    rest = held.select(F.col("label").alias("other"), F.col("unit").alias("other_unit"), "node", "text")
    members = met.join(rest, ["other", "other_unit"]).select("label", "unit", "part", "other", "node", "text")

    def check(key, heads: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        ours = [words_of(text) for text in heads["head_text"]]
        bags, counts = [Counter(words) for words in ours], np.array([histogram(words) for words in ours])
        lengths, found, done = np.array([len(words) for words in ours]), [], set()
        for other, node, text in zip(rest["other"], rest["node"], rest["text"]) if len(ours) else ():
            if other in done:
                continue
            words = words_of(text)
            longer = np.maximum(lengths, len(words))
            common = np.minimum(counts, histogram(words)).sum(axis=1)  # words of equal counters count as equal
            near = longer - np.minimum(lengths, len(words)), longer - common
            for i in np.flatnonzero(np.maximum(*near) <= np.floor((1 - SIMILARITY) * longer + 1e-9)).tolist():
                if alike(ours[i], words, bags[i]):
                    found.append((heads["head_node"].iloc[i], node))
                    done.add(other)
                    break
        found = [(min(x), max(x)) for x in found]
        return pd.DataFrame({"a": [x[0] for x in found], "b": [x[1] for x in found]})

    by_unit = heads.groupBy("head_label", "head_unit", "head_part")
    return by_unit.cogroup(members.groupBy("label", "unit", "part")).applyInPandas(check, "a binary, b binary")


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of the buckets that lie in several components."""
    labelled = materialise(label_of(completed(members), labels, "node", "label"), "labelled")
    open_ones = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    return materialise(labelled.join(open_ones.select("bucket"), "bucket"), "open")


def links_to_largest(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of nodes in large open buckets with a node of the component that holds most of the bucket.

    A node that links with most of a large group meets one of them here, not
    each of them; which one differs from bucket to bucket.
    """
    large = rows.where(F.col("size") > SMALL)
    one = F.max(F.struct(F.xxhash64("node", "bucket").alias("dealt"), "node", "n_words"))
    held = large.groupBy("bucket", "label").agg(F.count("*").alias("n"), one.alias("one"))
    head = held.groupBy("bucket").agg(F.max(F.struct("n", "label", "one")).alias("head")).select("bucket", "head")
    met = large.join(head, "bucket").where(
        (F.col("label") != F.col("head.label")) & lengths_fit(F.col("n_words"), F.col("head.one.n_words"))
    )
    pairs = met.groupBy(F.col("head.one.node").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared"))
    nearest = pairs.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select("best.a", "b")
    nearest = materialise(nearest, "pairs")
    return verified(nearest.join(nearest.groupBy("a").agg(F.count("*").alias("size")), "a"), texts)


def links_across(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) across components within the open buckets: all of small buckets, one for two components of large ones."""
    rows = open_members(members, labels)
    small = rows.where(F.col("size") <= SMALL).drop("size")
    other = small.select("bucket", *[F.col(c).alias(f"_{c}") for c in ("node", "label", "n_words")])
    fits = lengths_fit(F.col("n_words"), F.col("_n_words"))
    pairs = small.join(other, "bucket").where((F.col("node") < F.col("_node")) & (F.col("label") != F.col("_label")) & fits)
    pairs = materialise(pairs.select(F.col("node").alias("a"), F.col("_node").alias("b")).distinct(), "pairs")
    links = verified(pairs.join(pairs.groupBy("a").agg(F.count("*").alias("size")), "a"), texts)
    large, found = counted(rows.where(F.col("size") > SMALL).select("node", "n_words", "label").distinct(), "nodes")
    if not found:
        return links
    dealt, sizes = dealt_out(large)
    held = texts.join(dealt, "node").repartition("label", "unit").sortWithinPartitions("label", "unit")
    held = materialise(held, "open-texts")
    return links.unionAll(linked_components(met_by_windows(held, sizes), held, sizes))


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: the one with the least key."""
    heads = classes(docs, key).where("first").select(F.col(key).alias("key"), "node").distinct()
    # all columns of docs travel in one, so that none can clash with the names used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row").getField(key).alias("_key"), node_of(F.col("row").getField("text")).alias("_node"))
    same = rows["_node"].eqNullSafe(heads["node"]) & rows["_key"].eqNullSafe(heads["key"])
    kept = rows.join(heads, same, "left_semi").dropDuplicates(["_node", "_key"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; see the module."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
