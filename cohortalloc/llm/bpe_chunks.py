"""BPE encoding and decoding with content-defined chunk reuse.

Method.  A rolling hash over 16 bytes cuts every text at content-defined
places, so documents that share passages share chunks.  A chunk is encoded
once per worker and kept.  By itself a chunk is right only between two sure
splits: places where the byte-level split into words (contractions; an
optional blank with letters, digits or other signs; white space) falls
whatever stands around.  So each join is repaired: the text from the last
sure split of the left side to the first one of the right chunk is encoded
again; where the right chunk has none, the seam grows over it and into the
next, until both sides agree.  Strings of special tokens become their ids,
as the tokenizers library does by default; the parts between are split apart.

Chunks and seams are encoded with the rank file of the same vocabulary
(tiktoken); text with signs outside the common blocks, whose classes depend
on the Unicode version, goes through the tokenizers library.  The tests hold
both against the library on whole texts.

Edge cases.  A NULL text counts as empty: no ids, decoded to the empty
string.  Repeated rows and repeated or NULL doc_ids stay as they are.
Columns other than the ones named are ignored.

Scale.  One narrow pass, no shuffle; tables of a worker are bounded by
``CACHE_CHARS``; a text is split in runs of about a
million code points at most per step, however many rows a batch has.
"""

from __future__ import annotations

import base64
import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import runs_of_texts, ship_package, table

#: One cut in so many bytes on average; chunk sizes in code points.
CUT_MASK, LEAST_CHUNK, MOST_CHUNK = 511, 128, 4096
WINDOW = 16
CACHE_CHARS = 24_000_000
# fixed value: the split pattern of the byte-level vocabulary
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these blocks, Unicode versions may differ: the tokenizers library does it all.
_RARE = re.compile("[^\x00-\u024f\u2000-\u206f]")
#: A split whatever stands around: a blank between two other signs starts a word.
_SURE = re.compile(r"(?<=\S) (?=\S)")


def byte_table(spec: dict) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary (special ids: their string)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    out = [b""] * size
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(byte_of[c] for c in token)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


def cuts(data: bytes) -> np.ndarray:
    """Byte positions after which the rolling hash of ``WINDOW`` bytes cuts."""
    if len(data) <= WINDOW:
        return np.empty(0, np.int64)
    h = np.frombuffer(data, np.uint8).astype(np.uint32) * np.uint32(0x9E3779B1) ^ np.uint32(0x85EBCA6B)
    factor = np.uint32(0x01000193)
    width = 1
    while width < WINDOW:  # hash of the last 2 * width bytes from two of width
        h = h[width:] + h[:-width] * factor
        factor = np.uint32(int(factor) * int(factor) & 0xFFFFFFFF)
        width *= 2
    return np.flatnonzero((h >> np.uint32(15)) & np.uint32(CUT_MASK) == 0) + WINDOW


def chunks(text: str) -> list[str]:
    """``text`` in content-defined pieces (their concatenation is the text)."""
    data = text.encode()
    at = cuts(data)
    if len(data) != len(text) and len(at):  # to code points; a cut inside one moves behind it
        starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        at = np.cumsum(starts)[at - 1]
    out, last = [], 0
    for p in at.tolist():
        while p - last > MOST_CHUNK:
            out.append(text[last : last + MOST_CHUNK])
            last += MOST_CHUNK
        if p - last >= LEAST_CHUNK:
            out.append(text[last:p])
            last = p
    while last < len(text):
        out.append(text[last : last + MOST_CHUNK])
        last += MOST_CHUNK
    return out


class Chunk:
    """A chunk's part between its first and last sure split, encoded once (None: no such split)."""

    __slots__ = ("first", "ids", "last")

    def __init__(self, text: str, encode):
        self.ids = None
        found = _SURE.search(text)
        if found:
            self.first = found.start()
            reach = 64
            while not (ends := [m.start() for m in _SURE.finditer(text, max(0, len(text) - reach))]):
                reach *= 8
            self.last = ends[-1]
            self.ids = encode(text[self.first : self.last])


class ChunkEncoder:
    """Texts to ids and back for one byte-level tokenizer file and its rank file."""

    def __init__(self, path: str, ranks: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(path) as f:
            spec = json.load(f)
        self.bytes_of = byte_table(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t["content"]: struct.pack("<H", t["id"]) for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        with open(ranks, "rb") as f:
            by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ordinary = tiktoken.Encoding(
            "chunks", pat_str=_SPLIT, mergeable_ranks=by_bytes, special_tokens={}
        ).encode_ordinary
        self.chunks: dict[str, Chunk] = {}
        self.held = 0

    def direct(self, text: str) -> bytes:
        """Ids of a piece of text, without reuse."""
        if not text:
            return b""
        if text.isascii() or not _RARE.search(text):
            ids = self.ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def chunk(self, text: str) -> Chunk:
        found = self.chunks.get(text)
        if found is None:
            if self.held > CACHE_CHARS:
                self.chunks.clear()
                self.held = 0
            self.held += len(text)
            found = self.chunks[text] = Chunk(text, self.direct)
        return found

    def join(self, parts: list[str]) -> bytes:
        """Ids of the text that ``parts`` make together; every seam is encoded again.

        A seam reaches from the last sure split of the text so far to the
        first one of the next chunk, so both sides agree with the whole text
        there; a chunk without one becomes part of the seam.
        """
        out, seam = [], ""
        for part in parts:
            chunk = self.chunk(part)
            if chunk.ids is None:
                seam += part
                continue
            out += [self.direct(seam + part[: chunk.first]), chunk.ids]
            seam = part[chunk.last :]
        return b"".join([*out, self.direct(seam)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 16-bit numbers."""
        segments = [self.marks.split(t) if self.marks else [t] for t in texts]
        return [
            b"".join([self.special[s] if i % 2 else self.join(chunks(s)) for i, s in enumerate(ss)])
            for ss in segments
        ]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u2").tolist()]).decode("utf-8", "replace")


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def _encoder(*paths: str) -> ChunkEncoder:
    if paths not in _ENCODERS:
        _ENCODERS[paths] = ChunkEncoder(*paths)
    return _ENCODERS[paths]


def _id_lists(raw: list[bytes]) -> pa.Array:
    flat = np.frombuffer(b"".join(raw), "<u2").astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(x) // 2 for x in raw], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def encode_texts(docs: DataFrame, tokenizer: str, ranks: str, key: str = "doc_id", decode: bool = False) -> DataFrame:
    """(key, ids array<int>) of every row; with ``decode`` also ``decoded``, the text of those ids."""
    ship_package(docs.sparkSession)

    def run(batches):
        enc = _encoder(tokenizer, ranks)
        for batch in batches:
            at = 0
            for texts in runs_of_texts(batch.column("text")):
                raw = enc.encode(texts)
                columns = [batch.column(key).slice(at, len(texts)), _id_lists(raw)]
                if decode:
                    columns.append(pa.array([enc.decode(x) for x in raw], pa.string()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [key, "ids", "decoded"][: 2 + decode]
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(
        run, f"`{key}` {kind}, ids array<int>" + ", decoded string" * decode
    )


def decode_ids(rows: DataFrame, tokenizer: str, ranks: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) of rows with ``ids`` array<int> (NULL: empty)."""
    ship_package(rows.sparkSession)

    def run(batches):
        enc = _encoder(tokenizer, ranks)
        for batch in batches:
            texts = [enc.decode(np.array(x or [], "<u2").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(texts, pa.string())], names=[key, "decoded"]
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; see the module."""
    import public_tokenizers

    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return digests(encode_texts(table(spark, sf_dir, "documents"), *files, decode=True))
