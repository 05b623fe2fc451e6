"""Phrase collocations from depth-truncated suffix subtrees, partitioned by word prefixes.

Method.  A text is a string of words cut into pieces; every word starts a
suffix, truncated after ``DEPTH`` words or at the end of its piece.  The
suffix tree of a language is never built whole.  Vertical partitioning cuts
it: the word prefixes of all suffixes are counted (in hashed slots, first one
word long); slots whose suffixes fit the memory budget are packed into groups
of about ``BUDGET`` suffixes, and the prefixes of fuller slots are extended by
one more word, counted again and packed or extended in turn.  A full suffix
that is still too frequent is one leaf, which is dealt over several groups.
Each group then builds its subtrees on its own: its suffixes in lexicographic
order, the leaves' totals, and from them the totals of the nodes above, which
are the phrases' numbers of occurrences.  Nodes above an extended prefix are
partial and are added up across groups; all others are whole, and go at once
if they occur fewer than ``MIN_COUNT`` times.

Scores.  A phrase of 2 to ``DEPTH`` words with a >= ``MIN_COUNT`` occurrences,
cut into parts of l and r occurrences, scores floor(10**6 a a / (l r)); the
lowest-scoring cut counts, ties to the shortest first part.  A phrase inside a
longer one that occurs at least half as often goes.  Arithmetic is exact
(DECIMAL).

Edge cases.  NULL text is empty, NULL language is 'und'.  Texts without words
add nothing; an empty table returns nothing.  Documents are rows: a repeated
row counts again.  Ties rank by the phrase's UTF-8 bytes.  Extra columns are
not read.

Scale.  Equal suffixes are added up within a block of text before the shuffle,
so a passage that every document shares is a few rows per block.  Driver and
broadcast hold one number per slot and level, 8 to 16 slots a group and at
least ``SLOTS``; a task holds one block or one group.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, ship_package, table

DEPTH = 3
MIN_COUNT = 10
TOP = 2000
BUDGET = 1 << 21  # suffixes of a group
SLOTS = 1 << 14
CHARS = 1 << 23  # of text in a block
SPREAD = 64  # groups that a leaf over the budget is dealt to

#: fixed values: what ends a piece, and the other blank between words
_ENDS, _BLANK = b".,;:!?\x0b\x0c\r", b"\t"
_FOLD = bytes.maketrans(_ENDS + _BLANK, b"\n" * len(_ENDS) + b" ")
BLOCK = "lang string, n_words long, words binary, ids binary"
NODE = "lang string, words int, phrase string, f long"


# --- blocks of text -------------------------------------------------------------


def words_of(text: str) -> list[bytes]:
    """Words of a text with a line feed after every piece; only A-Z get small."""
    folded = text.encode().lower().translate(_FOLD)  # bytes.lower() leaves all but ASCII alone
    return [w for w in folded.replace(b"\n", b" \n ").split(b" ") if w] + [b"\n"]


def block_of(texts: list[str]) -> tuple[int, bytes, bytes]:
    """Number of words, distinct words (line feed first), and the texts as their numbers."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    assert numbers[b"\n"] == 0
    ids = [np.fromiter(map(numbers.__getitem__, words_of(t)), np.int32) for t in texts]
    whole = np.concatenate(ids)
    return int((whole != 0).sum()), b" ".join(numbers), whole.tobytes()


def blocks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The texts as blocks of word numbers, one language a block."""

    def read(batches):
        held: dict[str, list[str]] = {}
        size = 0

        def made():
            rows = [(of, *block_of(texts)) for of, texts in held.items()]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "n_words", "words", "ids"])

        for batch in batches:
            for of, whole in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(of, []).append(whole)
                size += len(whole) + 1
                if size >= CHARS:
                    yield made()
                    held.clear()
                    size = 0
        if held:
            yield made()

    known = lambda c, name, empty: F.coalesce(F.col(c).cast("string"), F.lit(empty)).alias(name)
    return docs.select(known(lang, "lang", "und"), known(text, "text", "")).mapInArrow(read, BLOCK)


def ordered(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns in lexicographic order, with their numbers (sums of ``n``)."""
    rows = len(columns[0])
    size = max((int(c.max(initial=0)) for c in columns), default=0) + 1
    code = columns[0].astype(np.int64)
    for column in columns[1:]:
        if int(code.max(initial=0)) * size >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * size + column
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if rows else np.zeros(0, np.int64)
    totals = np.diff(np.append(first, rows)) if n is None else np.add.reduceat(n[order], first) if rows else first
    return [c[order[first]] for c in columns], totals.astype(np.int64)


def suffixes(ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct truncated suffixes (0 beyond a piece's end) and how often each occurs."""
    columns, inside = [ids], ids != 0
    for d in range(1, DEPTH):
        following = np.append(ids[d:], np.zeros(min(d, len(ids)), ids.dtype))
        columns.append(np.where(columns[-1] != 0, following, 0))
    return ordered([c[inside].astype(np.int64) for c in columns])


# --- vertical partitioning ------------------------------------------------------


class Plan:
    """For each level the group of every slot; -1: the slot's prefixes are extended by a word."""

    def __init__(self, slots: int):
        self.slots, self.levels, self.n_groups = slots, [], 0

    def add(self, counts: np.ndarray, budget: int) -> bool:
        """Pack the slots of a level whose suffixes fit the budget; whether some do not."""
        fits = counts <= budget
        packed = np.cumsum(np.where(fits, counts, 0))
        group = self.n_groups + (packed - np.where(fits, counts, 0)) // budget
        self.levels.append(np.where(fits, group, -1).astype(np.int32))
        self.n_groups = int(group[fits].max(initial=self.n_groups - 1)) + 1
        return not fits.all()

    def slots_of(self, lang: str, words: list[bytes], columns: list[np.ndarray]) -> list[np.ndarray]:
        """The slot of every suffix's prefix of one word, two words and so on."""
        start = zlib.crc32(lang.encode() + b"\n")
        hashes = np.array([zlib.crc32(w, start) for w in words], np.uint64)
        mixed, out = np.zeros(len(columns[0]), np.uint64), []
        for column in columns:
            mixed = (mixed ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            out.append((mixed % np.uint64(self.slots)).astype(np.int64))
        return out

    def route(self, slots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group and number of prefix words of every suffix; group -1: extended beyond the last level."""
        group = np.full(len(slots[0]), -1, np.int32)
        length = np.full(len(group), len(self.levels) + 1, np.int32)
        for i, (level, slot) in enumerate(zip(self.levels, slots)):
            here = (group < 0) & (level[slot] >= 0)
            group[here], length[here] = level[slot[here]], i + 1
        return group, length


def slot_counts(held: DataFrame, plan: Plan) -> np.ndarray:
    """Suffixes per slot of the next level, of those the plan has not put into a group."""
    shared = held.sparkSession.sparkContext.broadcast(plan)

    def count(batches):
        plan = shared.value
        total = np.zeros(plan.slots, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                columns, _ = suffixes(np.frombuffer(row["ids"], np.int32))
                slots = plan.slots_of(row["lang"], row["words"].split(b" "), columns[: len(plan.levels) + 1])
                left = plan.route(slots)[0] < 0
                total += np.bincount(slots[-1][left], minlength=plan.slots)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    rows = held.select("lang", "words", "ids").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    out = np.zeros(plan.slots, np.int64)
    out[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def partition(held: DataFrame, n_words: int, budget: int) -> Plan:
    """The plan of all groups; one pass over the blocks per level."""
    plan = Plan(max(SLOTS, 1 << (8 * n_words // budget).bit_length()))
    while len(plan.levels) < DEPTH and plan.add(slot_counts(held, plan), budget):
        pass
    return plan


# --- subtrees -------------------------------------------------------------------


def dealt(held: DataFrame, plan: Plan) -> DataFrame:
    """Every block's suffixes, split by group and by words of the prefix."""
    shared = held.sparkSession.sparkContext.broadcast(plan)
    names = ["part", "lang", "prefix", "words", "suffixes", "n"]

    def split(batches):
        plan = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                words = row["words"].split(b" ")
                columns, n = suffixes(np.frombuffer(row["ids"], np.int32))
                group, length = plan.route(plan.slots_of(row["lang"], words, columns[: len(plan.levels)]))
                group = np.where(group < 0, plan.n_groups + zlib.crc32(row["ids"]) % SPREAD, group)
                order = np.lexsort((length, group))
                key = group[order].astype(np.int64) * (DEPTH + 2) + length[order]
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
                rows = []
                for a, b in zip(starts, [*starts[1:], len(key)]):
                    some = order[a:b]
                    used, at = np.unique(np.concatenate([c[some] for c in columns]), return_inverse=True)
                    rows.append((
                        int(group[some[0]]), row["lang"], int(length[some[0]]), b" ".join([words[i] for i in used]),
                        at.astype(np.int32).tobytes(), n[some].astype(np.int32).tobytes()))
                    if len(rows) >= 64:
                        yield as_batch(rows)
                        rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "part int, lang string, prefix int, words binary, suffixes binary, n binary"
    return held.select("lang", "words", "ids").mapInArrow(split, schema)


def subtree(pieces: list[dict], prefix: int, min_count: int) -> list[tuple[int, list[bytes], np.ndarray]]:
    """Nodes (words, phrases, occurrences) of the subtrees over suffixes with prefixes of ``prefix`` words."""
    own = [p["words"].split(b" ") for p in pieces]
    words = sorted(set().union(*own) - {b"\n"})
    number = {w: i + 1 for i, w in enumerate(words)} | {b"\n": 0}
    parts = []
    for piece, names in zip(pieces, own):
        at = np.fromiter(map(number.__getitem__, names), np.int64, len(names))
        parts.append(at[np.frombuffer(piece["suffixes"], np.int32)].reshape(DEPTH, -1))
    n = np.concatenate([np.frombuffer(p["n"], np.int32) for p in pieces]).astype(np.int64)
    columns, totals = ordered(list(np.concatenate(parts, axis=1)), n)
    nodes = []
    for depth in range(1, DEPTH + 1):
        # suffixes stand in order, so a node's leaves are neighbours
        new = np.zeros(len(totals), bool)
        new[:1] = True
        for column in columns[:depth]:
            new[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(new)
        counts = np.add.reduceat(totals, first)
        keep = columns[depth - 1][first] != 0
        if prefix <= depth:  # the whole node is here
            keep &= counts >= min_count
        first, counts = first[keep], counts[keep]
        labels = [[words[i - 1] for i in column[first].tolist()] for column in columns[:depth]]
        nodes.append((depth, [b" ".join(x) for x in zip(*labels)], counts))
    return nodes


def phrases(held: DataFrame, plan: Plan, min_count: int) -> DataFrame:
    """(lang, words, phrase, f) of all phrases that occur at least ``min_count`` times."""

    def build(group: pa.Table) -> pa.Table:
        made = []
        rows = group.to_pylist()
        for lang, prefix in sorted({(r["lang"], r["prefix"]) for r in rows}):
            pieces = [r for r in rows if (r["lang"], r["prefix"]) == (lang, prefix)]
            for depth, found, counts in subtree(pieces, prefix, min_count):
                size = len(found)
                made.append(pa.table({
                    "lang": pa.array([lang] * size, pa.string()), "words": pa.array([depth] * size, pa.int32()),
                    "phrase": pa.array(found, pa.binary()).cast(pa.string()), "f": pa.array(counts, pa.int64())}))
        return pa.concat_tables(made)

    nodes = dealt(held, plan).groupBy("part").applyInArrow(build, NODE)
    nodes = nodes.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return nodes.where(F.col("f") >= min_count)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
    top: int | None = TOP, budget: int = BUDGET,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases (None: all); see the module."""
    ship_package(docs.sparkSession)
    held = materialise(blocks(docs, text, lang), "word-blocks")
    sizes = held.groupBy("lang").agg(F.sum("n_words").alias("n"))
    n_words = sizes.agg(F.sum("n")).first()[0] or 0
    nodes = materialise(phrases(held, partition(held, n_words, budget), min_count), "phrases")
    parts = nodes.where(F.col("words") < DEPTH).select("lang", "phrase", "f")
    cuts = nodes.where(F.col("words") > 1).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({
        "first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    score = F.call_function("div", million * (wide("f") * wide("f")), wide("l") * wide("r"))
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "words", "phrase", "f").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = scored.where(F.col("words") == DEPTH)
    for size in range(DEPTH - 1, 1, -1):
        shorter = scored.where(F.col("words") == size)
        kept = kept.unionByName(shorter.join(covering(nodes, size), ["lang", "phrase"], "left").where(
            F.col("longest").isNull() | (100 * F.col("longest") < 50 * F.col("f"))).drop("longest"))
    out = kept.join(sizes, ["lang"]).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order))
    out = out if top is None else out.where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def covering(nodes: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, longest): for phrases of ``size`` words, the most frequent longer one around each."""
    inner: Column = F.expr(
        f"transform(sequence(0, words - {size}), i -> array_join(slice(split(phrase, ' '), i + 1, {size}), ' '))")
    longer = nodes.where(F.col("words") > size).select("lang", F.explode(inner).alias("phrase"), "f")
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of all documents; see the module."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), starts as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words where len(w) > 0
), grams as (
  select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase
  from starts, (values (1), (2), (3)) as sizes(k) where i + k - 1 <= len(w)
), nodes as (
  select lang, k, phrase, count(*)::hugeint as f from grams group by all having count(*) >= 10
), sizes as (
  select lang, count(*)::bigint as n from starts group by lang
), split as (
  select *, string_split(phrase, ' ') as w from nodes where k > 1
), cuts as (
  select c.lang, c.k, c.phrase, c.f as a, j, c.w, array_to_string(list_slice(c.w, 1, j), ' ') as head,
         array_to_string(list_slice(c.w, j + 1, c.k), ' ') as tail
  from split c, (values (1), (2)) as cut(j) where j < c.k
), scored as (
  select c.lang, c.k, c.phrase, c.a, h.f as l, t.f as r, (1000000::hugeint * c.a * c.a) // (h.f * t.f) as score,
         row_number() over (partition by c.lang, c.phrase
                            order by (1000000::hugeint * c.a * c.a) // (h.f * t.f), j) as place
  from cuts c join nodes h on h.lang = c.lang and h.phrase = c.head
  join nodes t on t.lang = c.lang and t.phrase = c.tail
), around as (
  select lang, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) as phrase, f
  from split where k = 3
), kept as (
  select s.* from scored s
  left join (select lang, phrase, max(f) as f from around group by all) o on o.lang = s.lang and o.phrase = s.phrase and s.k = 2
  where s.place = 1 and (o.f is null or 100 * o.f < 50 * s.a)
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join sizes using (lang) where rank <= 2000
"""
