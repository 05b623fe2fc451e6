"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Method.  Vectors are rotated by ``ROTATIONS`` learned rotations (iterative
quantisation on a bounded sample: alternate between the signs of the rotated
sample and the rotation that fits them best) and the signs are their code, so
a code has ``ROTATIONS`` bits a dimension.  Inner products become angles first:
every row gets one more coordinate that lifts all rows to the greatest norm.
A code is cut into substrings of eight bits, and an index block holds one
bucket table per substring.  A code within Hamming distance r = m * a + b of a
query's code (m substrings) must come within a of it in one of the first b + 1
substrings or within a - 1 in one of the others (pigeonhole), so probing the
buckets of those few patterns and counting the differing bits of what they
hold finds *every* code within r.  Those rows are ranked by the inner product
of the original vectors in double precision, summed from the first component
to the last.

The radius is learned from the sample: the distance within which the given
share of true neighbours lies.  The sample's neighbours are taken to the rank
that the k-th neighbour among all rows has in a sample of that size, so the
radius shrinks as the table grows.  A block in which the radius holds fewer
than k rows is probed with the next larger radius until it holds k or is
exhausted.  There is no cap on candidates.

Edge cases.  Vectors that are NULL, empty, all zero or hold a NULL or
non-finite component take no part, nor do rows without an id.  Vectors meet
vectors of their own dimension only.  Every query *row* asks for itself; rows
that carry a query's own id are not its candidates, so a repeated query id
returns one list per row, and a repeated candidate counts once per row.  Equal
scores go to the smaller id.  Fewer candidates than k are all returned; an
empty table returns nothing.  Extra columns are not read.

Scale.  Index rows lie in blocks of ``BLOCK`` rows, queries in lists of
``LIST``; one task handles one block and one list and returns at most k rows a
query, so memory is bounded and no task sees a whole table.  Only the models
(a few square matrices per dimension) and the sample reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortalloc.llm.common import materialise, ship_package, table

ROTATIONS = 2
ITERATIONS = 20
SAMPLE = 8192  # rows per dimension that models and radius are fitted on
SAMPLE_QUERIES = 512
SHARE = 0.97  # of the sample's true neighbours that the radius must hold
BLOCK = 16384
LIST = 1024
BITS = 8  # of a substring

_WEIGHT = np.array([bin(x).count("1") for x in range(1 << BITS)], np.uint8)
_NEAREST = np.argsort(_WEIGHT, kind="stable")  # bit patterns by the number of bits set
_WITHIN = np.cumsum(np.bincount(_WEIGHT, minlength=BITS + 1))  # patterns of at most i bits


@dataclass
class Model:
    """Rotations of one dimension; ``radius`` is the learned Hamming radius."""

    norm: float  # the greatest norm of a row
    centre: np.ndarray
    turns: list[np.ndarray]
    radius: int

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """(rows, substrings) of bytes; a query has no lift."""
        x = lifted(vectors, self.norm, query) - self.centre
        signs = np.concatenate([x @ turn > 0 for turn in self.turns], axis=1)
        return np.packbits(signs, axis=1)


def lifted(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Unit vectors whose inner product orders rows as the original one does."""
    size = (vectors * vectors).sum(axis=1, keepdims=True)
    if query:
        unit = vectors / np.sqrt(size)
        return np.concatenate([unit, np.zeros_like(size)], axis=1)
    return np.concatenate([vectors / norm, np.sqrt(np.maximum(0.0, 1.0 - size / norm**2))], axis=1)


def fit(sample: np.ndarray, norm: float, total: int, k: int, seed: int = 7) -> Model:
    """Model of one dimension from ``sample`` (rows, dim) of a table of ``total`` rows."""
    random = np.random.default_rng(seed)
    x = lifted(sample, norm, query=False)
    centre = x.mean(axis=0)
    x = x - centre
    turns = []
    for _ in range(ROTATIONS):
        turn, _ = np.linalg.qr(random.normal(size=(x.shape[1], x.shape[1])))
        for _ in range(ITERATIONS):
            left, _, right = np.linalg.svd(np.where(x @ turn > 0, 1.0, -1.0).T @ x)
            turn = (left @ right).T
        turns.append(turn)
    model = Model(norm, centre, turns, 0)
    codes, asked = model.codes(sample), sample[:SAMPLE_QUERIES]
    asked_codes = model.codes(asked, query=True)
    rank = max(1, math.ceil(k * len(sample) / max(1, total)))
    found: list[np.ndarray] = []
    for i, (q, code) in enumerate(zip(asked, asked_codes)):
        scores = sample @ q
        scores[i] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(rank, len(sample) - 1)]
        found.append(np.bitwise_count(codes[best] ^ code).sum(axis=1))
    near = np.concatenate(found) if found else np.zeros(0)
    model.radius = int(np.quantile(near, SHARE, method="higher")) if len(near) else 0
    return model


class Block:
    """Rows of one index block with a bucket table for every substring."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.keys, self.vectors, self.codes = keys, vectors, codes
        self.columns = np.ascontiguousarray(vectors.T)
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        counts = [np.bincount(codes[:, j], minlength=1 << BITS) for j in range(codes.shape[1])]
        self.starts = [np.concatenate([[0], np.cumsum(c)]).tolist() for c in counts]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within ``radius`` of ``code``, by pigeonhole probing."""
        m = len(code)
        if radius >= m * BITS:
            return np.arange(len(self.keys))
        share, rest = divmod(radius, m)
        seen = np.zeros(len(self.keys), bool)
        for j in range(m):
            reach = share if j <= rest else share - 1
            if reach >= 0:
                order, starts = self.order[j], self.starts[j]
                for value in (_NEAREST[: _WITHIN[reach]] ^ int(code[j])).tolist():
                    a, b = starts[value], starts[value + 1]
                    if a < b:
                        seen[order[a:b]] = True
        probed = np.flatnonzero(seen)
        distance = np.bitwise_count(self.codes[probed] ^ code).sum(axis=1)
        return probed[distance <= radius]

    def search(self, query: np.ndarray, code: np.ndarray, own: int, radius: int, k: int):
        """Keys and scores of the k best rows within the radius, at least k if the block has them."""
        widest = len(code) * BITS
        while True:
            rows = self.within(code, radius)
            rows = rows[self.keys[rows] != own]
            if len(rows) >= k or radius >= widest:
                break
            radius = min(widest, radius + max(1, len(code) // 2))
        scores = np.zeros(len(rows))
        for d, x in enumerate(query):
            scores += self.columns[d][rows] * x
        best = np.lexsort((self.keys[rows], -scores))[:k]
        return self.keys[rows[best]], scores[best]


# --- Spark ---------------------------------------------------------------------


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, dim, v array<double>) of the rows that take part."""
    v = F.col("v")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("key").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    return rows.select(F.col("key").cast("long").alias("key"), F.size("v").alias("dim"), "v")


def models(rows: DataFrame, k: int) -> dict[int, Model]:
    """One model per dimension; each is fitted on at most ``SAMPLE`` rows."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    known = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("norm")).collect()
    made = {}
    for row in known:
        spread = F.xxhash64("key", "v")
        sample = rows.where(F.col("dim") == row["dim"]).orderBy(spread, "key").limit(SAMPLE).select("v").toPandas()
        made[row["dim"]] = fit(np.stack(sample["v"].to_list()), row["norm"], row["n"], k)
    return made


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column of ``dim`` doubles a row as a matrix."""
    flat = [c.flatten().to_numpy() for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column])]
    return np.concatenate(flat).reshape(-1, dim) if flat else np.zeros((0, dim))


def search(
    vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest found for every row for which ``is_query`` holds."""
    spark = ship_package(vectors.sparkSession)
    rows = materialise(usable(vectors, key, vector), "vectors")
    fitted = models(rows, k)
    shared = spark.sparkContext.broadcast(fitted)  # ROTATIONS square matrices per dimension
    total = rows.count()
    n_blocks = max(1, math.ceil(total / BLOCK))
    # by place in the written table, not by key, so that rows of one key spread
    place = F.monotonically_increasing_id()
    block = F.pmod(F.xxhash64(place), F.lit(n_blocks)).cast("int")
    asked = rows.withColumnRenamed("key", key).where(is_query).withColumnRenamed(key, "key")
    asked = asked.select("key", "dim", "v", place.alias("asker"))
    n_lists = max(1, math.ceil(asked.count() / LIST))
    in_list = F.pmod(F.xxhash64("asker", F.lit(3)), F.lit(n_lists)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = packed(rows.select("dim", block.alias("block"), "key", "v"))
    index = index.select(F.col("dim").alias("of_dim"), F.col("block").alias("of_block"), every(n_lists).alias("of_list"), "keys", "vectors")
    wanted = asked.select("dim", in_list.alias("list"), "key", "asker", "v").withColumn("block", every(n_blocks))

    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"asker": [], "query_id": [], "hit": [], "score": []}
        if blocks.num_rows and queries.num_rows:
            dim = queries["dim"][0].as_py()
            model = shared.value[dim]
            keys = np.concatenate([np.frombuffer(x, np.int64) for x in blocks["keys"].to_pylist()])
            held = np.concatenate([np.frombuffer(x).reshape(-1, dim) for x in blocks["vectors"].to_pylist()])
            part = Block(keys, held, model.codes(held))
            asking = matrix(queries["v"], dim)
            codes = model.codes(asking, query=True)
            for i, (own, asker) in enumerate(zip(queries["key"].to_pylist(), queries["asker"].to_pylist())):
                hits, scores = part.search(asking[i], codes[i], own, model.radius, k)
                out["asker"].append(np.full(len(hits), asker, np.int64))
                out["query_id"].append(np.full(len(hits), own, np.int64))
                out["hit"].append(hits)
                out["score"].append(scores)
        kinds = {"asker": np.int64, "query_id": np.int64, "hit": np.int64, "score": np.float64}
        return pa.table({c: np.concatenate(x).astype(kinds[c]) if x else np.zeros(0, kinds[c]) for c, x in out.items()})

    met = index.groupBy("of_dim", "of_block", "of_list").cogroup(wanted.groupBy("dim", "block", "list"))
    hits = met.applyInArrow(run, "asker long, query_id long, hit long, score double")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "hit")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("hit").alias(key), "score")


def packed(rows: DataFrame, pieces: int = 2048) -> DataFrame:
    """(dim, block, keys, vectors): the rows of a block as a few binary pieces, packed before any shuffle."""

    def pack(batches):
        for batch in batches:
            pdf = pd.DataFrame({"dim": batch.column("dim").to_numpy(), "block": batch.column("block").to_numpy()})
            keys, lists = batch.column("key").to_numpy(), batch.column("v")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            made: dict[str, list] = {"dim": [], "block": [], "keys": [], "vectors": []}
            for (dim, block), at in pdf.groupby(["dim", "block"]).indices.items():
                for start in range(0, len(at), pieces):
                    some = at[start : start + pieces]
                    taken = values[(offsets[some][:, None] + np.arange(dim)).ravel()]
                    made["dim"].append(dim)
                    made["block"].append(block)
                    made["keys"].append(keys[some].astype(np.int64).tobytes())
                    made["vectors"].append(taken.astype(np.float64).tobytes())
            yield pa.record_batch(
                [pa.array(made["dim"], pa.int32()), pa.array(made["block"], pa.int32()),
                 pa.array(made["keys"], pa.binary()), pa.array(made["vectors"], pa.binary())],
                names=list(made),
            )

    return rows.mapInArrow(pack, "dim int, block int, keys binary, vectors binary")


def op13_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20; see the module."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
