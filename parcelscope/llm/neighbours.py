"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a bounded sample turns each vector into a code of up to 64 bits whose Hamming
distance follows the angle. Codes are cut into substrings, and each substring has an index of its
own. Codes within Hamming radius R of a query's agree with it up to R / m bits in at least one of m
substrings (pigeonhole), so probing every index within that many bits retrieves every code of the
radius. What is retrieved is ranked by cosine in double precision on the original vectors.

Every valid row is indexed. Rows are dealt evenly into blocks and queries into groups, so that a
group of equal vectors is spread over all blocks, and a task holds one block and one group.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, floor, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.settings import staged

K = 5
QUERY_EVERY = 50
BITS = 64
# The rotation and the radius are fitted on at most this many vectors, those with the lowest hash.
SAMPLE = 10_000
PROBES = 500
# The radius holds this share of the true neighbours within the sample, whose neighbours are
# farther than those in the whole table.
RECALL = 0.97
ROUNDS = 30
SEED = 7
# Rows of a block, about, and most queries of a group. Neither they nor who meets whom depend on the
# cluster, so a table gives the same result anywhere.
BLOCK, GROUP_MOST = 16_384, 8_192


class Codes(NamedTuple):
    """A fitted model: code bits are the signs of ``(unit vector - mean) @ rotation``."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of vectors, one unsigned 64-bit integer each."""
        up = ((unit(vectors) - self.mean) @ self.rotation > 0).astype(np.uint8)
        padded = np.zeros((len(up), 64), dtype=np.uint8)
        padded[:, : self.bits] = up
        return np.packbits(padded, axis=1, bitorder="little").view("<u8").ravel()


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (unit(vectors) * unit(query[None, :])).sum(axis=1)


def fit(sample: np.ndarray, k: int = K, bits: int = BITS) -> Codes:
    """Iterative quantisation: principal directions, then the rotation that brings the projected
    vectors nearest to their signs."""
    units = unit(sample)
    mean = units.mean(axis=0)
    centred = units - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    projection = directions[:, ::-1][:, : min(bits, sample.shape[1])]
    flat = centred @ projection
    rotation, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((flat.shape[1],) * 2))
    for _ in range(ROUNDS):
        signs = np.where(flat @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(flat.T @ signs)
        rotation = u @ v
    model = Codes(mean, projection @ rotation, 0)
    codes, probes = model.of(sample), units[:PROBES]
    near = np.argsort(-(probes @ units.T), axis=1)[:, : k + 1]
    apart = np.bitwise_count(codes[: len(probes), None] ^ codes[near])
    own = near == np.arange(len(probes))[:, None]
    return model._replace(radius=int(np.quantile(np.where(own, 0, apart), RECALL, method="higher")))


@lru_cache(maxsize=64)
def _masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)])


class Substrings:
    """The indexes of a block: for each substring, rows sorted by its value."""

    def __init__(self, codes: np.ndarray, bits: int, radius: int):
        parts = min(bits, max(1, ceil(bits / max(1, floor(log2(max(2, len(codes))))))))
        edges = [round(bits * i / parts) for i in range(parts + 1)]
        self.codes, self.radius, self.parts = codes, radius, []
        for j in range(parts):
            width = edges[j + 1] - edges[j]
            # R = parts * r + rest: rest + 1 substrings are probed within r bits, the others r - 1
            own = radius // parts - (1 if j > radius % parts else 0)
            if own < 0:
                continue
            value = (codes >> np.uint64(edges[j]) & np.uint64((1 << width) - 1)).astype(np.int64)
            order = np.argsort(value, kind="stable")
            values, starts = np.unique(value[order], return_index=True)
            self.parts.append((edges[j], width, min(own, width), order, values, np.append(starts, len(codes))))

    def within(self, code: np.uint64) -> np.ndarray:
        """Rows whose codes lie within the radius."""
        seen = np.zeros(len(self.codes), dtype=bool)
        for edge, width, own, order, values, starts in self.parts:
            value = int(code) >> edge & (1 << width) - 1
            masks = _masks(width, own) if _count(width, own) <= len(values) else None
            if masks is None:  # fewer values are there than would be probed
                hit = np.flatnonzero(np.bitwise_count(values ^ value) <= own)
            else:
                at = np.minimum(np.searchsorted(values, masks ^ value), len(values) - 1)
                hit = at[values[at] == masks ^ value]
            size = starts[hit + 1] - starts[hit]
            place = np.arange(size.sum()) + np.repeat(starts[hit] - np.cumsum(size) + size, size)
            seen[order[place]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= self.radius]


@lru_cache(maxsize=256)
def _count(width: int, radius: int) -> int:
    total = term = 1
    for r in range(1, radius + 1):
        term = term * (width - r + 1) // r
        total += term
    return total


def search(ids, places, vectors, codes, query_places, queries, query_codes, model: Codes, k: int):
    """(query place, id, score) of each query's nearest rows of a block: of those in the radius, or,
    where these are fewer than ``k``, of the ``k`` nearest codes."""
    index = Substrings(codes, model.bits, model.radius)
    found = []
    for q in range(len(queries)):
        other = places != query_places[q]
        rows = index.within(query_codes[q])
        rows = rows[other[rows]]
        if len(rows) < k:
            rest = np.flatnonzero(other)
            apart = np.bitwise_count(codes[rest] ^ query_codes[q])
            rows = rest[np.argsort(apart, kind="stable")[:k]]
        if len(rows):
            score = cosines(queries[q], vectors[rows].astype(np.float64))
            best = np.lexsort((ids[rows], -score))[:k]
            found += [(q, int(ids[rows[b]]), float(score[b])) for b in best]
    return found


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 1)


def valid_vectors(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of rows that take part: an id, and a vector without null or non-finite
    components and not all zero, of the most frequent dimension (the smaller of equals)."""
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = rows.select(F.col(f"`{id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    )
    good = staged(good, "neighbours-vectors")
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return good.where(F.size("vector") == (sizes[0]["size"] if sizes else 0))


def nearest(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` nearest
    other rows found, by cosine, ties to the smaller id; all other rows if they are fewer.

    Rows with an invalid vector or no id take no part, neither do vectors of another than the usual
    dimension. Rows that repeat an id are candidates each, for each other, too, and queries each. Other columns are ignored; an empty table gives no rows.
    """
    good = valid_vectors(rows, id, vector)
    total = good.count()
    if not total:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    model = fit(_matrix(sample.column("vector")).astype(np.float64), k)

    def encode(batches):
        for batch in batches:
            codes = model.of(_matrix(batch.column(1)).astype(np.float64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], names=["vec_id", "vector", "code"])

    kind = good.schema["vector"].dataType.simpleString()
    coded = good.mapInArrow(encode, f"vec_id long, vector {kind}, code long")
    coded = staged(coded.withColumn("place", F.monotonically_increasing_id()), "neighbours-codes")
    asked = coded.where(F.col("vec_id") % every == 0)
    n_asked = asked.count()
    blocks = ceil(total / BLOCK)
    groups = max(1, ceil(n_asked / GROUP_MOST))
    # places count up within a partition and start at multiples of 2^33
    dealt = lambda n: F.pmod(F.xxhash64("place"), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own_block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    index = coded.withColumn("block", own_block).withColumn("group", every_of(groups))
    asked = asked.withColumn("group", dealt(groups)).withColumn("block", every_of(blocks))

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            of = lambda t, c: t.column(c).to_numpy()
            found = search(
                of(left, "vec_id"), of(left, "place"), _matrix(left.column("vector")), of(left, "code").view(np.uint64),
                of(right, "place"), _matrix(right.column("vector")).astype(np.float64), of(right, "code").view(np.uint64),
                model, k,
            )
        at = [f[0] for f in found]
        return pa.table(
            {
                "place": right.column("place").take(pa.array(at, pa.int64())),
                "query_id": right.column("vec_id").take(pa.array(at, pa.int64())),
                "vec_id": pa.array([f[1] for f in found], pa.int64()),
                "score": pa.array([f[2] for f in found], pa.float64()),
            }
        )

    pairs = index.groupBy("block", "group").cogroup(asked.groupBy("block", "group"))
    found = pairs.applyInArrow(pair, "place long, query_id long, vec_id long, score double")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
