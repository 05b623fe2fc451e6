"""Exact top-k inner-product search on a bit-sliced index.

Method.  Every component becomes a whole number, floor(scale * x).  An index
block holds, for each attribute, one bitmap over its rows per bit of the
(shifted) number.  For a query, the slices of all attributes, each at the
place value its query number gives it (negative numbers take the
complement), are added by bitmap arithmetic: carry-save adders reduce the
bitmaps of each place until one remains, which is the bit-sliced score of
all rows.  The k best rows are selected from the most significant slice
downward; rows that tie at the boundary are resolved by their id, and the
selected rows' scores are read from the slices.  Everything is exact.

Edge cases.  Vectors that are NULL or hold a NULL or non-finite component
take no part, nor do rows without an id.  Rows with a query's own id are not
its candidates.  A row repeated under one id is a candidate once per row; a
query id with several rows asks once per row, and returns one list for each.
Vectors only meet vectors of their own dimension.  Queries with fewer than k
candidates return them all; an empty table returns nothing.  There are as
many slices as the widest number needs; only a number or a score beyond a
64-bit whole number, which the result could not hold, raises an error.

Scale.  Rows are packed into minis of ``MINI`` rows (one row of bitmaps
each), minis into blocks of ``BLOCK`` minis, queries into lists of ``LIST``;
a task handles one block and one list, so memory is bounded, and returns at
most k rows per query.  That every query meets every block is the job.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, ship_package, table

MINI = 512
BLOCK = 32
LIST = 256
LONG = 1 << 63


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, dim, v array<bigint>) of the vectors that take part."""
    v = F.col("v")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("key").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite))
    fits = lambda x: F.abs(x * scale) < float(LONG)
    number = F.when(F.forall(v, fits), F.transform(v, lambda x: F.floor(x * scale).cast("long"))).otherwise(
        F.raise_error(F.lit("a vector component is beyond a 64-bit whole number")).cast("array<bigint>")
    )
    return rows.select("key", F.size(v).alias("dim"), number.alias("v"))


# --- bitmaps ------------------------------------------------------------------


def slices(v: np.ndarray, low: int, bits: int) -> np.ndarray:
    """Bitmaps (dim, bits, words) of the numbers ``v`` (rows, dim) less ``low``; rows padded to whole words."""
    rows, dim = v.shape
    words = -(-rows // 64)
    raised = np.zeros((words * 64, dim), np.uint64)
    raised[:rows] = v.astype(np.uint64) - np.uint64(low % (1 << 64))  # modulo 2**64, as the numbers' range fits
    out = np.empty((dim, bits, words), np.uint64)
    for j in range(bits):
        bit = ((raised >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T
        out[:, j] = np.packbits(np.ascontiguousarray(bit), axis=1, bitorder="little").view("<u8")
    return out


def add_up(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The bit slices of the sum; ``columns[p]`` holds arrays of bitmaps (n, words) of place value 2**p."""
    out, p, words = [], 0, None
    columns = [list(c) for c in columns]
    while p < len(columns):
        held = [c for c in columns[p] if len(c)]
        if held:
            stack = np.concatenate(held) if len(held) > 1 else held[0]
            words = stack.shape[1]
            carried = []
            while len(stack) > 1:
                n = len(stack) // 3
                if n:
                    a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
                    half = a ^ b
                    carried.append((a & b) | (half & c))
                    stack = np.concatenate([half ^ c, stack[3 * n :]])
                else:
                    carried.append((stack[0] & stack[1])[None])
                    stack = (stack[0] ^ stack[1])[None]
            out.append(stack[0])
            if carried:
                if p + 1 == len(columns):
                    columns.append([])
                columns[p + 1] += carried
        else:
            out.append(None)
        p += 1
    return [np.zeros(words, np.uint64) if s is None else s for s in out] if words else []


def score_slices(index: np.ndarray, inverse: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Slices of sum |q| * u, u being a component's number less the least one, or its complement if q < 0."""
    bits = index.shape[1]
    size = np.abs(query).view(np.uint64)  # also of the least number
    columns: list[list[np.ndarray]] = [[] for _ in range(int(size.max(initial=0)).bit_length() + bits)]
    for i in range(int(size.max(initial=0)).bit_length()):
        on = (size >> np.uint64(i)) & np.uint64(1) == 1
        for used, source in ((np.flatnonzero(on & (query > 0)), index), (np.flatnonzero(on & (query < 0)), inverse)):
            if len(used):
                for j in range(bits):
                    columns[i + j].append(source[used, j])
    return add_up(columns)


def ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.astype("<u8").view(np.uint8), bitorder="little"))


def select_top(sums: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the k best, and of those that tie for the places left."""
    sure, tied = np.zeros_like(among), among
    for s in reversed(sums):
        high = tied & s
        count = ones(sure) + ones(high)
        if count > k:
            tied = high
        else:
            sure, tied = sure | high, tied & ~s
            if count == k:
                return sure, np.zeros_like(tied)
    return sure, tied


class Block:
    """Bit-sliced index of rows in ascending key order."""

    def __init__(self, keys: np.ndarray, index: np.ndarray, low: int):
        self.keys, self.index, self.low = keys, index, low
        self.inverse = ~index
        self.all = np.zeros(index.shape[2], np.uint64)
        full, rest = divmod(len(keys), 64)
        self.all[:full] = ~np.uint64(0)
        if rest:
            self.all[full] = np.uint64((1 << rest) - 1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the query's k best rows other than its own (ties to smaller keys)."""
        sums = score_slices(self.index, self.inverse, query)
        among = self.all
        a, b = np.searchsorted(self.keys, [own, own + 1])
        if a < b:
            among = among.copy()
            at = np.arange(a, b)
            np.bitwise_and.at(among, at >> 6, ~(np.uint64(1) << (at & 63).astype(np.uint64)))
        sure, tied = select_top(sums, among, k)
        best, ties = positions(sure), positions(tied)[: max(0, k - ones(sure))]
        chosen = np.concatenate([best, ties])
        kind = np.int64 if len(sums) < 63 else object  # Python's whole numbers have no limit
        raised = np.zeros(len(chosen), kind)
        for p, s in enumerate(sums):
            bit = (s[chosen >> 6] >> (chosen & 63).astype(np.uint64)) & np.uint64(1)
            raised += bit.astype(np.int64).astype(kind) << p
        # a positive q counted q * (x - low), a negative one |q| * (top - (x - low)) with top = 2**bits - 1
        most = (1 << self.index.shape[1]) - 1
        q = query.tolist()
        scores = raised.astype(object) + sum(q) * self.low + sum(x for x in q if x < 0) * most
        if any(not -LONG <= x < LONG for x in scores):
            raise OverflowError("a score is beyond a 64-bit whole number")
        return self.keys[chosen], scores.astype(np.int64)


# --- Spark ---------------------------------------------------------------------


def minis(rows: DataFrame, low: int, bits: int) -> DataFrame:
    """(dim, mini, keys, bitmaps): rows of (key, dim, v) packed ``MINI`` at a time."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        made = []
        for at in range(0, len(pdf), 2 * MINI):  # hashing is uneven: a group may hold a few more
            part = pdf.iloc[at : at + 2 * MINI]
            keys = part["key"].to_numpy(np.int64)
            maps = slices(np.stack(part["v"].to_list()).astype(np.int64), low, bits)
            made.append((int(pdf["dim"].iloc[0]), int(pdf["mini"].iloc[0]), keys.tobytes(), maps.tobytes()))
        return pd.DataFrame(made, columns=["dim", "mini", "keys", "maps"])

    return rows.groupBy("dim", "mini").applyInPandas(pack, "dim int, mini int, keys binary, maps binary")


def as_block(pdf: pd.DataFrame, low: int, bits: int) -> Block:
    """One block of several minis; rows in ascending key order."""
    dim = int(pdf["dim"].iloc[0])
    keys = [np.frombuffer(x, np.int64) for x in pdf["keys"]]
    maps = [np.frombuffer(x, np.uint64).reshape(dim, bits, -1) for x in pdf["maps"]]
    everything = np.concatenate([np.unpackbits(m.view(np.uint8), axis=2, bitorder="little")[:, :, : len(k)]
                                 for m, k in zip(maps, keys)], axis=2)
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    words = -(-len(joined) // 64)
    bitmap = np.zeros((dim, bits, words * 64), np.uint8)
    bitmap[:, :, : len(joined)] = everything[:, :, order]
    index = np.packbits(bitmap, axis=2, bitorder="little").view("<u8")
    return Block(joined[order], index, low)


def search(
    vectors: DataFrame, is_query: Column, k: int, scale: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): every query's ``k`` rows of largest inner product, ties to smaller keys."""
    ship_package(vectors.sparkSession)
    rows = materialise(whole_numbers(vectors, key, vector, scale), "numbers")
    counts = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")
    )
    found = counts.agg(F.sum("n"), F.min("low"), F.max("high")).first()
    total, low, high = found[0] or 0, found[1] or 0, found[2] or 0
    bits = max(1, int(high - low).bit_length())
    n_minis = max(1, math.ceil(total / MINI))
    n_blocks = math.ceil(n_minis / BLOCK)
    # by place, not by key, so that rows of one key spread; the place of a row in the written table is fixed
    mini = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_minis)).cast("int")
    packed = minis(rows.withColumn("mini", mini), low, bits)
    packed = materialise(packed.withColumn("block", F.pmod("mini", F.lit(n_blocks)).cast("int")), "minis")
    queries = rows.withColumnRenamed("key", key).where(is_query).withColumnRenamed(key, "key")
    queries = queries.withColumn("asker", F.monotonically_increasing_id())  # every query row asks for itself
    n_lists = max(1, math.ceil(queries.count() / LIST))
    in_list = F.pmod(F.xxhash64("asker", F.lit(9)), F.lit(n_lists)).cast("int")
    wanted = queries.select("dim", in_list.alias("list"), "key", "asker", "v").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    index = packed.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(n_lists - 1))))
    names = ["dim", "block", "list"]
    index = index.select(*[F.col(c).alias(f"index_{c}") for c in names], "dim", "keys", "maps")

    def run(_, blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"asker": [], "query_id": [], "hit": [], "score": []}
        if len(blocks) and len(asked):
            block = as_block(blocks, low, bits)
            for own, asker, v in zip(asked["key"], asked["asker"], asked["v"]):
                hits, scores = block.top(np.asarray(v, np.int64), int(own), k)
                out["asker"] += [asker] * len(hits)
                out["query_id"] += [own] * len(hits)
                out["hit"] += hits.tolist()
                out["score"] += scores.tolist()
        return pd.DataFrame(out).astype("int64")

    by_index = index.groupBy(*[f"index_{c}" for c in names])
    hits = by_index.cogroup(wanted.groupBy(*names)).applyInPandas(run, "asker long, query_id long, hit long, score long")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "hit")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("hit").alias(key), "score")


def op3_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every vector whose id is divisible by 20; see the module."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


OP3_SQL = """
with numbers as (
  select row_number() over () as asker, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.asker, q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from numbers q join numbers c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)
  where q.vec_id % 20 = 0
), ranked as (
  select *, row_number() over (partition by asker order by score desc, vec_id) as place from scored
)
select query_id, place::integer as rank, vec_id, score from ranked where place <= 20
"""
