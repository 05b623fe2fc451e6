"""Token ids in a compact file: canonical length-limited Huffman blocks.

Method.  Every text is encoded with a public tokenizer and closed by an end
id.  One global count of all ids gives the code lengths (package-merge, at
most ``MAX_BITS`` bits); canonical codes follow from the lengths alone, so a
file stores one byte per id as its code book.  Ids are packed most
significant bit first into blobs; every ``STEP`` ids a blob records the bit
offset, so each block can be decoded by itself, and a reader decodes all
blocks of a blob side by side with one table look-up per id.

File set (Parquet rows on shared storage, written and read by Spark):
``part`` (range of doc_id, ascending), ``before`` (ids of the range in earlier
blobs), ``n_tokens`` and ``blob``; a blob holds, little endian: magic, number of
documents, number of ids, number of blocks, doc_id null flags, doc_ids,
ids per document, bit offset per block, then the bits.

Edge cases.  A NULL text counts as empty and holds the end id alone.  Rows
with equal doc_id all stay, ordered by their ids; NULL doc_ids come first, in
parts of their own by a hash of the text.
An empty table gives an empty file set and an empty result.  Columns other
than ``doc_id`` and ``text`` are ignored.

Scale.  Each text is tokenised once; ids (2 bytes each), not texts, are
shuffled, by doc_id range.  Only the range bounds, one total per range and
the counts (one row per id of the vocabulary) reach the driver.  A blob
holds about ``BLOB_TOKENS`` ids (more only if one document has more).
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import id_bounds, materialise, range_of, runs_of_texts, ship_package, shuffle_partitions, table

#: Longest code, ids between two recorded bit offsets, ids per blob.
MAX_BITS = 18
STEP = 256
BLOB_TOKENS = 1 << 18
MAGIC = b"HUF1"
#: Words, and pieces, kept per Python worker between two runs of texts (about 200 bytes each).
CACHE_PIECES = 160_000


# fixed value: the split of the word-level vocabulary, for ASCII and Latin letters
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
# the same for a whole text: white space only parts words
_PLAIN_TEXT = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]*").fullmatch
# what parts the words of such a text beside white space, and is a word itself
_BETWEEN = r"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-zß-öø-ÿ0-9 \t\n\r]+"
#: Code points of the texts whose words are looked up together.
RUN_CHARS = 1 << 22


class PieceEncoder:
    """Ids of a text by its words or pieces, each encoded once.

    The tokenizer folds white space and drops it, and neither its
    normalisation nor its split crosses it, so the ids of a text are the ids
    of its white-space separated pieces in order, and those of a piece the
    ids of its words.  The texts of common signs alone of a run are cut into words
    together, and each different word of the run is looked up once; others go
    piece by piece, and pieces with unusual signs or a special token through
    the whole tokenizer.  Words and pieces seen before come from bounded
    tables; new words go to the library's model.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {ord(c): letters.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, 256)) if _PLAIN(c)}
        self.known, self.words = Remembered(self.piece), Remembered(self.word)

    @staticmethod
    def pieces(text: str) -> list[str]:
        # str.split() also cuts at U+001C..U+001F, which are no white space in Unicode
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            import regex

            return regex.findall(r"\P{White_Space}+", text)
        return text.split()

    def whole(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u2").tobytes()

    def word(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(word if word.isascii() else word.translate(self.shown))]
        return struct.pack(f"<{len(ids)}H", *ids)

    def piece(self, piece: str) -> bytes:
        if not _PLAIN(piece) or "<|" in piece and any(s in piece for s in self.special):
            return self.whole(piece)
        return b"".join(map(self.words.__getitem__, _WORDS.findall(piece.lower())))

    def encode_one(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of common signs alone: each different word of them is looked up once."""
        spaced = pc.replace_substring_regex(pa.array([t.lower() for t in texts], pa.large_string()), _BETWEEN, r" \0 ")
        cut = pc.ascii_split_whitespace(spaced)
        words = cut.flatten().dictionary_encode()
        held = [self.words[w] if w else b"" for w in words.dictionary.to_pylist()]
        ids = np.frombuffer(b"".join(held), "<u2")
        size = np.fromiter(map(len, held), np.int64, len(held)) // 2
        at = words.indices.to_numpy()
        first, n = (np.cumsum(size) - size)[at], size[at]
        before = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.repeat(first - before[:-1], n) + np.arange(before[-1])].tobytes()
        bounds = (2 * before[cut.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 16-bit numbers."""
        self.words, self.known = self.words.kept(), self.known.kept()
        plain = ["<|" not in t and bool(_PLAIN_TEXT(t)) for t in texts]
        made = iter(self.encode_plain([t for t, p in zip(texts, plain) if p]))
        return [next(made) if p else self.encode_one(t) for t, p in zip(texts, plain)]


class Remembered(dict):
    """A table that fills itself: ``make`` gives the value of a key it lacks.

    A table that has grown full is followed by a new one, which asks the full
    one first, so that what is used again is not made again.
    """

    def __init__(self, make, old=None):
        super().__init__()
        self.make, self.old = make, old or {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def kept(self) -> Remembered:
        if len(self) <= CACHE_PIECES:
            return self
        self.old = {}
        return Remembered(self.make, self)


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    """One more than the largest id of a tokenizer file (read on the driver)."""
    with open(path) as f:
        spec = json.load(f)
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]
    return max(ids) + 1


def tokenise(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, part, ids): one row per document, ``part`` its doc_id range."""
    if vocabulary_size(tokenizer) > 1 << 16:
        raise ValueError("ids are stored as 16-bit numbers")
    parts = 4 * shuffle_partitions(ship_package(docs.sparkSession))
    bounds = id_bounds(docs, "doc_id", parts)
    end = struct.pack("<H", end_id)

    def run(batches):
        enc = _encoder(tokenizer)
        for batch in batches:
            ids = [x + end for texts in runs_of_texts(batch.column("text"), RUN_CHARS) for x in enc.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "ids"],
            )

    # rows without a key are spread, before all others
    unkeyed = -1 - F.pmod(F.xxhash64("text"), F.lit(parts))
    part = F.when(F.col("doc_id").isNull(), unkeyed).otherwise(range_of(F.col("doc_id"), bounds)).cast("int")
    narrow = docs.select("doc_id", part.alias("part"), "text")
    return narrow.mapInArrow(run, "doc_id long, part int, ids binary")


def id_counts(ids: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents (``size`` numbers)."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2")
            total += np.bincount(flat, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"]
        )

    rows = ids.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for id_, n in rows.collect():  # one row per id of the vocabulary at most
        out[id_] = n
    return out


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` bits (package-merge); 0: unused."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    if n <= 1:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.float64)
    packages, levels = np.empty(0), []
    for _ in range(max_bits):
        both = np.concatenate([weight, packages])
        order = np.argsort(both, kind="stable")
        levels.append(np.cumsum(order >= n))  # packages among the first items of the level
        both = both[order]
        both = both[: len(both) // 2 * 2]
        packages = both[0::2] + both[1::2]
    take = 2 * n - 2
    for packed in reversed(levels):
        if not take:
            break
        inner = int(packed[take - 1])
        lengths[used[: take - inner]] += 1
        take = 2 * inner
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes numbered by (length, id)."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    codes = np.zeros(len(lengths), np.uint64)
    code, previous = 0, 0
    for i in used.tolist():
        code <<= int(lengths[i]) - previous
        previous = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of the longest code; for each window of so many bits, its id and code length."""
    bits = max(1, int(lengths.max(initial=1)))
    ids, sizes = np.zeros(1 << bits, np.uint16), np.ones(1 << bits, np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = np.left_shift(1, bits - lengths[used].astype(np.int64))
    filled = int(spans.sum())
    ids[:filled] = np.repeat(used, spans)
    sizes[:filled] = np.repeat(lengths[used], spans)
    return bits, ids, sizes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offset of every ``STEP``-th id, and the codes one after another."""
    size = lengths[ids].astype(np.int64)
    code = codes[ids]
    end = np.cumsum(size)
    start = end - size
    word, room = start >> 6, 64 - (start & 63)
    spill = size - room  # bits that belong to the next word
    over = spill > 0
    high = np.where(
        over, code >> np.maximum(spill, 0).astype(np.uint64), code << np.maximum(-spill, 0).astype(np.uint64)
    )
    out = np.zeros(int(end[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(high, first)
    rest = code[over] << (64 - spill[over]).astype(np.uint64)
    out[word[over] + 1] |= rest
    return start[::STEP], out.byteswap().tobytes()[: (int(end[-1]) + 7) // 8]


def unpack(n: int, offsets: np.ndarray, data: bytes, book) -> np.ndarray:
    """The ``n`` ids of a blob; all blocks advance together, one id a step."""
    bits, ids, sizes = book
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = offsets.astype(np.int64)
    out = np.zeros((len(at), STEP), np.uint16)
    for step in range(min(n, STEP)):
        if step and len(at) * STEP - n > STEP - 1 - step and len(at) == len(out):
            at = at[:-1]  # the last block is shorter
        seen = (window[at >> 3] >> (32 - bits - (at & 7)).astype(np.uint32)) & np.uint32((1 << bits) - 1)
        out[: len(at), step] = ids[seen]
        at = at + sizes[seen]
    return out.reshape(-1)[:n]


def make_blob(doc_ids: list, ids: list[bytes], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """Blob of whole documents; each has at least one id."""
    flat = np.frombuffer(b"".join(ids), "<u2")
    offsets, data = pack(flat, codes, lengths)
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        MAGIC,
        struct.pack("<QQQ", len(doc_ids), len(flat), len(offsets)),
        null.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([len(x) // 2 for x in ids], "<u8").tobytes(),
        offsets.astype("<u8").tobytes(),
        data,
    ])


def read_blob(blob: bytes, book) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, ids per document, all ids."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token blob")
    docs, n, blocks = struct.unpack_from("<QQQ", blob, 4)
    at = 28
    null = np.frombuffer(blob, np.uint8, docs, at)
    doc_ids = np.frombuffer(blob, "<i8", docs, at := at + docs)
    counts = np.frombuffer(blob, "<u8", docs, at := at + 8 * docs)
    offsets = np.frombuffer(blob, "<u8", blocks, at := at + 8 * docs)
    ids = unpack(n, offsets, blob[at + 8 * blocks :], book)
    return [None if z else d for z, d in zip(null.tolist(), doc_ids.tolist())], counts, ids


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[DataFrame, np.ndarray]:
    """The file set (part, before, n_tokens, blob) and its code book (a length per id)."""
    spark = docs.sparkSession
    in_order = Window.partitionBy("part").orderBy("doc_id", "ids").rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.floor(F.octet_length("ids") / 2)
    ids = tokenise(docs, tokenizer, end_id).withColumn(
        "before", F.coalesce(F.sum(tokens).over(in_order), F.lit(0)).cast("long")
    )
    ids = materialise(ids, "token-ids")
    lengths = code_lengths(id_counts(ids, max(vocabulary_size(tokenizer), end_id + 1)))
    shared = spark.sparkContext.broadcast(lengths)  # one entry per id of the vocabulary

    def run(batches):
        lengths = shared.value
        codes = canonical_codes(lengths)
        part, first, doc_ids, held, size = None, 0, [], [], 0

        def blob():
            made = make_blob(doc_ids, held, codes, lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([made], pa.binary())],
                names=["part", "before", "n_tokens", "blob"],
            )

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "before", "doc_id", "ids")))
            for p, at, d, x in rows:
                # a task may read several pieces of the table: a blob never spans two
                if held and (p != part or at != first + size or size >= BLOB_TOKENS):
                    yield blob()
                    doc_ids, held, size = [], [], 0
                if not held:
                    part, first = p, at
                doc_ids.append(d)
                held.append(x)
                size += len(x) // 2
        if held:
            yield blob()

    files = ids.mapInArrow(run, "part int, before long, n_tokens long, blob binary")
    return materialise(files, "token-files"), lengths


def file_starts(files: DataFrame) -> DataFrame:
    """``files`` with ``start``: ids in all blobs before, in file order."""
    totals = sorted(files.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row per range
    base, bases = 0, []
    for part, n in totals:
        bases.append((part, base))
        base += n
    first = files.sparkSession.createDataFrame(bases, "part int, base long")
    return files.join(F.broadcast(first), "part").withColumn("start", F.col("base") + F.col("before"))


def read_token_files(files: DataFrame, lengths: np.ndarray) -> DataFrame:
    """(doc_id, start, ids as little-endian unsigned 16-bit numbers) of every document of the files."""
    shared = files.sparkSession.sparkContext.broadcast(lengths)

    def run(batches):
        book = decode_table(shared.value)
        for batch in batches:
            for start, blob in zip(batch.column("start").to_pylist(), batch.column("blob").to_pylist()):
                doc_ids, counts, ids = read_blob(blob, book)
                raw = ids.astype("<u2").tobytes()
                bounds = [0, *np.cumsum(counts.astype(np.int64)).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array([start + b for b in bounds[:-1]], pa.int64()),
                     pa.array([raw[2 * a : 2 * b] for a, b in zip(bounds, bounds[1:])], pa.binary())],
                    names=["doc_id", "start", "ids"],
                )

    return file_starts(files).select("start", "blob").mapInArrow(run, "doc_id long, start long, ids binary")


def with_checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32); the checksum is over 32-bit little-endian ids."""

    def run(batches):
        for batch in batches:
            raw = batch.column("ids").to_pylist()
            crc = [zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array([len(x) // 2 for x in raw], pa.int64()),
                 pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back; see the module."""
    import public_tokenizers

    files, lengths = write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return with_checksums(read_token_files(files, lengths))
