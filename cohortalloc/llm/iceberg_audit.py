"""Source divergence audit: how far each source's terms stand from its language's.

Terms are runs of letters (A-Z in lower case) and of characters beyond ASCII.
A term of a language is kept if at least ``MIN_DOCS`` of the language's
documents hold it.  The kept terms are found by iceberg prefix refinement,
never by counting all terms: level by level the byte prefixes of the terms
grow (``FIRST`` bytes, then twice as many each time), the documents that hold
a prefix are counted, and a prefix in fewer than ``MIN_DOCS`` documents is
discarded together with every term that starts with it.  A term that ends
within a level's length is complete there (an end mark tells it from longer
ones) and is kept if its own documents suffice.  Levels go on until no
incomplete prefix is left.

A level learns the survivors of the level before as a bitmap of
``FILTER_BITS`` hashed prefixes.  A bit that two prefixes share only lets a
discarded one be counted again: its count cannot grow, so it is discarded
again, and the kept terms are exact at every size.

Every group (language, source) gives a kept term, with ``count`` occurrences
there, p = 1 + floor(10**9 (count + 2) / (N + 2V)), N being its occurrences of
kept terms, V the language's kept terms; the language's own p are formed alike.
The divergence of p and q is floor((p - q)**2 / (p + q)).  All of it is exact.

Results.  ``pair`` rows: each other source of the language, value summed over
all kept terms (0 if there is none), all ranks.  ``term`` rows: kept terms the
group uses more than its language does, the ``TOP`` of largest divergence.
Equal values rank by the item's UTF-8 bytes.

Edge cases.  NULL text, language and source are read as ''.  Documents are
rows: a repeated row counts again.  Groups without terms take part in the
pairs.  A source alone in its language has no pair row; an empty table returns
nothing.  Extra columns are not read.

Scale.  Texts are read once, into blocks of term numbers; a level reads the
blocks and shuffles one row per prefix and block.  Only a bitmap of
``FILTER_BITS`` bits and counts reach the driver.  Pair sums are made block of
terms by block of terms, and tile of sources by tile of sources, over small
matrices, so that no pair of sources becomes a row per term.

Memory.  A worker holds one block of text and ``REMEMBERED`` answers at a time,
whatever the size of the table; blocks are stored ``ROW_GROUP`` bytes at a time
and travel in batches of ``BATCH`` bytes.  What the blocks of text have of a
block of terms is added up as it arrives, so a worker holds no more than the
sums and ``PENDING`` numbers.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import arrow_batches, materialise, ship_package, table

MIN_DOCS = 10
TOP = 10
FIRST = 8  # bytes of the first level's prefixes; shorter ones are hardly ever rare
FILTER_BITS = 1 << 25
CHARS = 1 << 22  # of text in a block
TERMS = 1 << 12  # kept terms of a block of terms, about
TILE = 512  # sources of a tile, about
MATRIX = 1 << 21  # numbers in one matrix
REMEMBERED = 1 << 17  # answers a worker keeps per filter
ROW_GROUP = 1 << 23  # bytes of blocks that are stored and loaded at once
BATCH = 1 << 23  # bytes of an Arrow batch
PENDING = 1 << 19  # numbers that wait until they are added up

END = b"\0"  # no term holds it
BITMAP = 1 << 15  # bits of one of Spark's bitmaps

_FOLD = bytes(x if x >= 0x80 or 0x61 <= x <= 0x7A else x + 32 if 0x41 <= x <= 0x5A else 0x20 for x in range(256))

BLOCK = "lang string, sources array<string>, terms binary, doc binary, doc_source binary, term binary, n binary"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order."""
    return text.encode().translate(_FOLD).split()


def block_of(lang: str, sources: list[str], texts: list[str]) -> dict:
    """One block: the documents' distinct terms, numbered, with their counts."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    found = [np.fromiter(map(numbers.__getitem__, terms_of(text)), np.int64) for text in texts]
    docs = np.repeat(np.arange(len(texts)), [len(x) for x in found])
    pairs, n = np.unique(docs * max(1, len(numbers)) + np.concatenate(found), return_counts=True)
    doc, term = np.divmod(pairs, max(1, len(numbers)))
    names, of_doc = np.unique(np.array(sources, object), return_inverse=True)
    return {
        "lang": lang, "sources": names.tolist(), "terms": END.join(numbers), "doc": doc.astype(np.int32).tobytes(),
        "doc_source": of_doc.astype(np.int32).tobytes(), "term": term.astype(np.int32).tobytes(),
        "n": n.astype(np.int32).tobytes(),
    }


def _documents(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 128):  # not all of a batch as Python text at once
            some = batch.slice(at, 128)
            yield from zip(*(some.column(c).to_pylist() for c in ("lang", "source", "text")))


def blocks(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """The documents as blocks of term numbers, one language a block."""

    def read(batches):
        schema = pa.schema([("lang", pa.string()), ("sources", pa.list_(pa.string()))] + [
            (c, pa.binary()) for c in ("terms", "doc", "doc_source", "term", "n")])
        held: dict[str, tuple[list, list]] = {}
        sizes: dict[str, int] = {}

        def made(of):
            sizes.pop(of)
            return pa.RecordBatch.from_pylist([block_of(of, *held.pop(of))], schema)

        for of, at, whole in _documents(batches):
            sources, texts = held.setdefault(of, ([], []))
            sources.append(at)
            texts.append(whole)
            sizes[of] = sizes.get(of, 0) + len(whole) + 1
            if sizes[of] >= CHARS or sum(sizes.values()) >= 2 * CHARS:
                yield made(max(sizes, key=sizes.get))
        for of in list(held):
            yield made(of)

    known = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    return docs.select(known(lang, "lang"), known(source, "source"), known(text, "text")).mapInArrow(read, BLOCK)


class Filter:
    """The hashed prefixes that survived, as bitmaps by their number."""

    def __init__(self, bitmaps: dict[int, bytes], bits: int):
        self.bitmaps, self.bits = bitmaps, bits
        self.known: dict[str, dict[bytes, bool]] = {}
        self.room = REMEMBERED

    def among(self, lang: str, prefixes: list[bytes]) -> list[bool]:
        """For each prefix of the language whether its bit is set; answers are remembered."""
        if self.room <= 0:
            self.known, self.room = {}, REMEMBERED
        known = self.known.setdefault(lang, {})
        start, out = zlib.crc32(lang.encode() + END), []
        for prefix in prefixes:
            held = known.get(prefix)
            if held is None:
                part, at = divmod(zlib.crc32(prefix, start) % self.bits, BITMAP)
                bitmap = self.bitmaps.get(part)
                held = bitmap is not None and bool(bitmap[at >> 3] >> (at & 7) & 1)
                if self.room > 0:
                    known[prefix] = held
                    self.room -= 1
            out.append(held)
        return out


def filter_of(prefixes: DataFrame) -> Filter:
    """The filter of (lang, prefix) rows: at most ``FILTER_BITS`` bits reach the driver."""
    key = F.crc32(F.concat(F.encode("lang", "utf-8"), F.lit(END), F.col("prefix"))) % FILTER_BITS + 1
    rows = prefixes.select(key.alias("key")).groupBy(F.bitmap_bucket_number("key").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bitmap"))
    return Filter({r["part"] - 1: bytes(r["bitmap"]) for r in rows.collect()}, FILTER_BITS)


def prefix_of(term: bytes, length: int) -> bytes:
    """The term's prefix at a level; a complete term carries the end mark."""
    return term + END if len(term) <= length else term[:length]


def alive(lang: str, terms: list[bytes], length: int, before: Filter | None) -> list[bool]:
    """Which terms take part in a level: not complete before, and their shorter prefix survived."""
    if before is None:
        return [True] * len(terms)
    last = length // 2
    return [ok and len(t) > last for ok, t in zip(before.among(lang, [t[:last] for t in terms]), terms)]


def _numbers(row: dict, *names: str) -> list[np.ndarray]:
    return [np.frombuffer(row[name], np.int32).astype(np.int64) for name in names]


def _terms(row: dict) -> list[bytes]:
    return row["terms"].split(END) if row["terms"] else []


def _rows(batch: pa.RecordBatch):
    """The rows of a batch, one at a time: they may be large."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def counted(held: DataFrame, length: int, before: Filter | None) -> DataFrame:
    """(lang, prefix, docs): documents that hold each prefix of the level."""
    shared = held.sparkSession.sparkContext.broadcast(before)

    def count(batches):
        for batch in batches:
            for row in _rows(batch):
                lang, terms, ids = row["lang"], _terms(row), {}
                at = np.array([
                    ids.setdefault(prefix_of(t, length), len(ids)) if ok else -1
                    for t, ok in zip(terms, alive(lang, terms, length, shared.value))], np.int64)
                if ids:
                    doc, term = _numbers(row, "doc", "term")
                    # a document holds a complete term once; only longer ones can share a prefix there
                    long = np.array([len(t) > length for t in terms])[term]
                    used = at[term] >= 0
                    docs = np.bincount(at[term[used & ~long]], minlength=len(ids))
                    pairs = np.unique(doc[used & long] * len(ids) + at[term[used & long]])
                    docs += np.bincount(pairs % len(ids), minlength=len(ids))
                    yield pa.record_batch(
                        [pa.array([lang] * len(ids), pa.string()), pa.array(list(ids), pa.binary()), pa.array(docs, pa.int64())],
                        names=["lang", "prefix", "docs"])

    rows = held.mapInArrow(count, "lang string, prefix binary, docs long")
    return rows.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))


def kept_terms(held: DataFrame, min_docs: int = MIN_DOCS, first: int = FIRST) -> DataFrame:
    """(lang, prefix, docs) of the complete kept terms, the end mark included."""
    complete = F.substring("prefix", -1, 1) == F.lit(END)
    length, before, found = first, None, []
    while True:
        level = materialise(counted(held, length, before).where(F.col("docs") >= min_docs), f"level-{length}")
        found.append(level.where(complete))
        open_ones = level.where(~complete)
        if open_ones.isEmpty():
            break
        before = filter_of(open_ones)
        length *= 2
    kept = found[0]
    for more in found[1:]:
        kept = kept.unionByName(more)
    return kept


def cells(held: DataFrame, kept: DataFrame, n_blocks: int, n_tiles: int) -> DataFrame:
    """(lang, block, tile, source, term, n): occurrences of every kept term in every group that has it.

    What a block of text has of a block of terms and a tile of sources travels
    as one row of numbers, which are added up in the order they arrive.
    """
    shared = held.sparkSession.sparkContext.broadcast(filter_of(kept))
    kinds = {"sources": pa.list_(pa.string()), "terms": pa.binary(), "source": pa.binary(), "term": pa.binary(), "n": pa.binary()}
    keys = ["lang", "block", "tile"]

    def count(batches):
        for batch in batches:
            for row in _rows(batch):
                terms, rows = _terms(row), []
                kept_here = np.array(shared.value.among(row["lang"], [t + END for t in terms]), bool)
                doc, of_doc, term, n = _numbers(row, "doc", "doc_source", "term", "n")
                if not kept_here.any():
                    continue
                used = kept_here[term]
                pair, at = np.unique(of_doc[doc[used]] * len(terms) + term[used], return_inverse=True)
                total = np.bincount(at, weights=n[used], minlength=len(pair)).astype(np.int64)
                source, term = np.divmod(pair, len(terms))
                tile = np.array([zlib.crc32(s.encode()) % n_tiles for s in row["sources"]])
                block = np.array([zlib.crc32(t) % n_blocks for t in terms])
                key = block[term] * n_tiles + tile[source]
                order = np.argsort(key, kind="stable")
                for some in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                    names, of = np.unique(term[some], return_inverse=True)
                    groups, of_group = np.unique(source[some], return_inverse=True)
                    rows.append({
                        "lang": row["lang"], "block": int(key[some[0]] // n_tiles), "tile": int(key[some[0]] % n_tiles),
                        "sources": [row["sources"][i] for i in groups], "terms": END.join([terms[i] for i in names]),
                        "source": of_group.astype(np.int32).tobytes(), "term": of.astype(np.int32).tobytes(),
                        "n": total[some].astype(np.int32).tobytes(),
                    })
                schema = [("lang", pa.string()), ("block", pa.int32()), ("tile", pa.int32()), *kinds.items()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(schema))

    def add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_terms: set[bytes] = set()  # the filter also lets others through
        terms: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        sources: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        pair, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, n, waiting = [], [], 0

        def added():
            summed, at = np.unique(np.concatenate([pair, *pairs]), return_inverse=True)
            more = np.zeros(len(summed), np.int64)
            np.add.at(more, at, np.concatenate([total, *n]))
            return summed, more

        for batch in batches:
            for row in _rows(batch):
                if row["kept"] is not None:
                    kept_terms.update(t[:-1] for t in row["kept"])
                    continue
                of_term = np.fromiter(map(terms.__getitem__, _terms(row)), np.int64)
                of_source = np.fromiter(map(sources.__getitem__, row["sources"]), np.int64)
                source, term, some = _numbers(row, "source", "term", "n")
                pairs.append(of_source[source] << 32 | of_term[term])
                n.append(some)
                waiting += len(some)
                if waiting >= max(PENDING, len(pair)):
                    pair, total = added()
                    pairs, n, waiting = [], [], 0
        pair, total = added()
        pairs, n = [], []
        true = np.array([t in kept_terms for t in terms], bool)[pair & 0xFFFFFFFF] if terms else np.zeros(0, bool)
        pair, total = pair[true], total[true]
        names = pa.array(list(sources), pa.string())
        items = pa.array(list(terms), pa.binary()).cast(pa.string())
        same = lambda value, size, kind: pa.array([value.as_py()] * size, kind)
        for at in range(0, len(pair), PENDING):
            some, sums = pair[at : at + PENDING], total[at : at + PENDING]
            lang, block, tile = (same(v, len(some), kind) for v, kind in zip(key, (pa.string(), pa.int32(), pa.int32())))
            yield pa.record_batch({
                "lang": lang, "block": block, "tile": tile, "source": names.take(pa.array(some >> 32)),
                "term": items.take(pa.array(some & 0xFFFFFFFF)), "n": pa.array(sums, pa.int64()),
            })

    schema = "lang string, block int, tile int, sources array<string>, terms binary, source binary, term binary, n binary"
    pieces = held.mapInArrow(count, schema)
    bare = F.substring("prefix", 1, F.octet_length("prefix") - 1)
    known = kept.groupBy("lang", (F.crc32(bare) % n_blocks).cast("int").alias("block")).agg(F.collect_list("prefix").alias("kept"))
    known = known.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    met = pieces.unionByName(known, allowMissingColumns=True).groupBy(*keys)
    return met.applyInArrow(add_up, "lang string, block int, tile int, source string, term string, n long")


def share(n: Column, total: Column, kinds: Column) -> Column:
    """p of a term with ``n`` of ``total`` occurrences; exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    scaled = F.lit(1_000_000_000).cast("decimal(10,0)") * wide(n + 2)
    return F.lit(1) + F.call_function("div", scaled, wide(total + 2 * kinds))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(counts: DataFrame, groups: DataFrame, n_blocks: int, n_tiles: int) -> DataFrame:
    """(lang, source, item, value) for every two groups of a language.

    ``counts`` holds (lang, block, tile, source, term, p), ``groups`` (lang, source, none, tile),
    ``none`` being p of a term the group lacks.
    """

    def add_up(found: pa.Table, known: pa.Table) -> pa.Table:
        names = known["source"].to_pylist()
        place = {s: i for i, s in enumerate(names)}
        tiles, none = known["tile"].to_numpy(), known["none"].to_numpy().astype(np.int64)
        low, high = known["lo"][0].as_py(), known["hi"][0].as_py()
        rows, columns = np.flatnonzero(tiles == low), np.flatnonzero(tiles == high)
        total = np.zeros((len(names), len(names)), np.int64)
        if found.num_rows:
            at_source = np.fromiter(map(place.__getitem__, found["source"].to_pylist()), np.int64, found.num_rows)
            numbers: dict[str, int] = {}
            at_term = np.fromiter((numbers.setdefault(t, len(numbers)) for t in found["term"].to_pylist()), np.int64)
            terms, p = len(numbers), found["p"].to_numpy()
            step = max(1, MATRIX // len(names))
            order = np.argsort(at_term, kind="stable")
            cuts = np.searchsorted(at_term[order], np.arange(0, terms + step, step))
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                width = min(step, terms - k * step)
                dense = np.repeat(none[:, None], width, axis=1)
                some = order[a:b]
                dense[at_source[some], at_term[some] - k * step] = p[some]
                for i in rows:
                    gap = dense[columns] - dense[i]
                    total[i, columns] += (gap * gap // (dense[columns] + dense[i])).sum(axis=1)
        one, other = (x.ravel() for x in np.meshgrid(rows, columns, indexing="ij"))
        value = total[one, other]
        if low == high:
            one, other, value = (x[one != other] for x in (one, other, value))
        else:
            one, other, value = np.concatenate([one, other]), np.concatenate([other, one]), np.tile(value, 2)
        label = pa.array(names, pa.string())
        return pa.table({
            "lang": pa.array([known["lang"][0].as_py()] * len(one), pa.string()), "source": label.take(pa.array(one)),
            "item": label.take(pa.array(other)), "value": pa.array(value, pa.int64())})

    def dealt(df: DataFrame) -> DataFrame:
        """Each row to every pair of tiles that holds its own."""
        other = F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1)))
        df = df.withColumn("other", other)
        return df.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")}).drop("other")

    found = dealt(counts)
    known = dealt(groups).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    keys = ["lang", "block", "lo", "hi"]
    met = found.groupBy(*keys).cogroup(known.groupBy(*keys))
    sums = met.applyInArrow(add_up, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module."""
    ship_package(docs.sparkSession)
    with arrow_batches(docs.sparkSession, BATCH):
        held = materialise(blocks(docs, text, lang, source), "term-blocks", ROW_GROUP)
        kept = kept_terms(held, min_docs)
    kinds = kept.groupBy("lang").agg(F.count("*").alias("kinds"))
    groups = held.select("lang", F.explode("sources").alias("source")).distinct()
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    n_tiles, n_blocks = -(-most // TILE), max(1, -(-kept.count() // TERMS))
    with arrow_batches(docs.sparkSession, BATCH):
        found = materialise(cells(held, kept, n_blocks, n_tiles), "term-cells")
    used = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(used, ["lang", "source"], "left").join(kinds, ["lang"], "left").na.fill(0, ["total", "kinds"])
    none = F.when(F.col("kinds") > 0, share(F.lit(0), F.col("total"), F.col("kinds"))).otherwise(F.lit(1))
    tile = (F.crc32(F.encode("source", "utf-8")) % n_tiles).cast("int")
    groups = materialise(groups.withColumn("none", none), "groups")
    counts = found.join(groups, ["lang", "source"])
    counts = counts.withColumn("p", share(F.col("n"), F.col("total"), F.col("kinds")))
    known = groups.select("lang", "source", "none").toDF("lang", "source", "none").withColumn("tile", tile)
    pairs = pair_sums(counts.select("lang", "block", "tile", "source", "term", "p"), known, n_blocks, n_tiles)
    overall = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    totals = found.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    terms = counts.join(overall, ["lang", "term"]).join(totals, ["lang"])
    terms = terms.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))).where("p > q")
    terms = terms.select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.withColumns({"part": F.lit(part), "rank": F.row_number().over(order)})
    both = ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
    return both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op12_iceberg_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents; see the module."""
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), tokens as (
  select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term from tokens group by lang, term having count(distinct doc) >= 10
), cells as (
  select lang, source, term, count(*)::hugeint as n from tokens join kept using (lang, term) group by all
), kinds as (
  select lang, count(*)::hugeint as v from kept group by lang
), groups as (
  select g.lang, g.source, coalesce(k.v, 0)::hugeint as v, coalesce(t.total, 0)::hugeint as total
  from (select distinct lang, source from docs) g left join kinds k using (lang)
  left join (select lang, source, sum(n) as total from cells group by all) t using (lang, source)
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) as p
  from groups g join kept k using (lang) left join cells c using (lang, source, term)
), overall as (
  select lang, term, 1 + (1000000000::hugeint * (n + 2)) // (total + 2 * v) as q
  from (select lang, term, sum(n)::hugeint as n from cells group by all)
  join (select lang, sum(n)::hugeint as total from cells group by all) using (lang) join kinds using (lang)
), pair_values as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pair_values s on s.lang = a.lang and s.source = a.source and s.item = b.source
), terms as (
  select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value
  from shares join overall using (lang, term) where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
