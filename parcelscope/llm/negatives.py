"""Hard negatives from blocks in Hilbert order, read by what their zone maps allow.

Vectors become whole numbers and lie in one order: by label, then along a Hilbert curve through a few
leading directions, so that neighbours in the table are mostly neighbours in space. Consecutive rows
of one label form a block, and a zone map keeps the least and greatest value of each of its
dimensions. By interval arithmetic a zone map bounds every score that an anchor can have in its block
from both sides, so a block is read for a group of anchors only if one of them may find something
in it:

- positives: rows of the anchor's label. The anchor's neighbours in the table give it a score that its
  last positive reaches at least; blocks that cannot reach it are not read.
- negatives: rows of other labels with a score in one of the windows that the anchor's positives
  span; blocks whose bounds miss all windows are not read.

Bounds only leave out what cannot be part of the result, so the result is exact, and the same for any
order or block size; the directions of the curve, fitted on a bounded sample, decide how much is
read. Anchors meet blocks in pairs of an anchor group and a shard of consecutive rows, both of bounded
size, whatever a label's share of the rows. Scores are whole numbers, exact beyond the precision of
doubles.

What takes no part: rows with a null id, label or vector, with a null or non-finite component, or
with a component beyond ``GREATEST`` after scaling (with 1,024 dimensions scores would leave 64 bits). Vectors are compared
with those of their own length only. Rows that repeat an id or a vector are rows of their own; equal
scores go by id, and after that by position. An anchor is no candidate of its own; without positives
it has no rows. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.llm.ordering import numbered
from parcelscope.settings import staged

# Rows of a block, of a shard (read together), and anchors of a group.
BLOCK, SHARD, GROUP = 512, 4096, 2048
# Zone maps that a task looks through at once.
ZONES = 4096
# The curve: leading directions, bits in each, and the rows they are fitted on.
DIRECTIONS, BITS, SAMPLE = 8, 4, 10_000
GREATEST = 2**26
INT = np.int64


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (one row each, whole numbers below ``2 ** bits``) along a Hilbert curve."""
    x = cells.T.astype(np.uint64).copy()
    n = len(x)
    if not n:
        return np.zeros(cells.shape[0], dtype=INT)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:  # undo the turns and mirrors of each level, from the coarsest on
        low = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        flip ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << one | (x[i] >> np.uint64(bit) & one)
    return key.astype(INT)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, exactly."""
    dim = a.shape[1]
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dim
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(INT)
    return a.astype(INT) @ b.astype(INT).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor (row) can have in each block (column)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return scores(up, low) + scores(down, high), scores(up, high) + scores(down, low)


def windows(positive: np.ndarray, percent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative to positives of these scores, in whole numbers."""
    hundreds, rest = np.divmod(positive, 100)  # first, as a score times a percentage could overflow
    return percent[0] * hundreds - (-percent[0] * rest) // 100, percent[1] * hundreds + percent[1] * rest // 100


def codes(rows: DataFrame, anchor: Column, scale: int, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, dim, code, anchor) of the rows that take part."""
    rows = rows.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") * scale).alias("scaled"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    # before they become whole numbers: a null is not between, NaN is above all and infinities are beyond
    sound = F.forall("scaled", lambda x: F.coalesce(x.between(-GREATEST, GREATEST), F.lit(False)))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND scaled IS NOT NULL").where(sound)
    code = F.transform("scaled", lambda x: F.floor(x).cast("int"))
    rows = rows.select("id", "label", code.alias("scaled"), "anchor")
    return rows.select("id", "label", F.size("scaled").alias("dim"), F.col("scaled").alias("code"), "anchor")


def _curve(rows: DataFrame, directions: int, bits: int, sample: int):
    """A function from codes of the most frequent length to their places on the curve, fitted on the
    ``sample`` rows with the lowest hash of their id; other lengths are not ordered further."""
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    seen = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(sample).select("code").toArrow()
    x = _matrix(seen["code"], dim).astype(np.float64)
    if not dim or not len(x):
        return lambda code: np.zeros(len(code), dtype=INT)
    middle = x.mean(axis=0)
    _, vectors = np.linalg.eigh((x - middle).T @ (x - middle))
    axes = vectors[:, ::-1][:, :directions]
    cuts = np.quantile((x - middle) @ axes, np.arange(1, 2**bits) / 2**bits, axis=0)

    def place(code: np.ndarray) -> np.ndarray:
        if code.shape[1] != dim:
            return np.zeros(len(code), dtype=INT)
        spread = (code - middle) @ axes
        return hilbert_key(np.stack([np.searchsorted(cuts[:, k], spread[:, k]) for k in range(axes.shape[1])], 1), bits)

    return place


def _by_dim(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The lengths of codes in a table, and the places of the rows of each."""
    dims = np.asarray(table["dim"])
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def ordered(rows: DataFrame, block: int, directions: int, bits: int, sample: int) -> DataFrame:
    """``rows`` with their place ``pos`` by label, length and curve, and their ``block``, a number that is
    unique together with label and length."""
    place = _curve(rows, directions, bits, sample)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, dtype=INT)
            for dim, at in _by_dim(batch):
                key[at] = place(_matrix(batch["code"].take(pa.array(at)), dim))
            yield batch.append_column("key", pa.array(key))

    keys = rows.mapInArrow(keyed, T.StructType([*rows.schema, T.StructField("key", T.LongType())]))
    keys = keys.withColumn("tie", F.monotonically_increasing_id())
    placed = numbered(keys, [], ["label", "dim", "key", "id", "tie"])
    return placed.select("id", "label", "dim", "code", "anchor", "pos", F.floor(F.col("pos") / block).alias("block"))


def zone_maps(placed: DataFrame) -> DataFrame:
    """(label, dim, block, low, high) per block. Each task sums up the rows it reads, so that only
    zone maps cross the network."""
    schema = "label long, dim int, block long, low array<int>, high array<int>"

    def sums(table: pa.Table | pa.RecordBatch, low: str, high: str) -> Iterator[pa.RecordBatch]:
        for dim, at in _by_dim(table):
            part = table.take(pa.array(at))
            keys = np.stack([np.asarray(part["label"]), np.asarray(part["block"])], 1)
            kinds, which = np.unique(keys, axis=0, return_inverse=True)
            order = np.argsort(which, kind="stable")
            starts = np.searchsorted(which[order], np.arange(len(kinds)))
            least = np.minimum.reduceat(_matrix(part[low], dim)[order], starts, axis=0)
            most = np.maximum.reduceat(_matrix(part[high], dim)[order], starts, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds[:, 0]), pa.array(np.full(len(kinds), dim, np.int32)), pa.array(kinds[:, 1]),
                 _lists(least), _lists(most)], names=["label", "dim", "block", "low", "high"]
            )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from sums(batch, "code", "code")

    def merged(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(sums(table.combine_chunks(), "low", "high"))

    found = placed.select("label", "dim", "block", "code").mapInArrow(parts, schema)
    return found.groupBy("label", "dim", "block").applyInArrow(merged, schema)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(matrix.ravel().astype(np.int32)))


def _seeds(placed: DataFrame, wanted: int) -> DataFrame:
    """Anchors with a score, ``least``, that at least ``wanted`` rows of their label reach: those that a
    task reads together with them. Null where it reads too few."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            is_anchor = np.asarray(batch["anchor"])
            at = np.flatnonzero(is_anchor)
            least: list[int | None] = [None] * len(at)
            label, dims, pos = (np.asarray(batch[c]) for c in ("label", "dim", "pos"))
            for n, i in enumerate(at):
                near = np.flatnonzero((label == label[i]) & (dims == dims[i]) & (pos != pos[i]))
                near = near[np.argsort(np.abs(pos[near] - pos[i]), kind="stable")[:BLOCK]]
                if len(near) >= wanted:
                    own = _matrix(batch["code"].take(pa.array([i])), int(dims[i]))
                    found = scores(own, _matrix(batch["code"].take(pa.array(near)), int(dims[i])))[0]
                    least[n] = int(np.partition(found, -wanted)[-wanted])
            yield batch.select(["id", "label", "dim", "code", "pos"]).take(pa.array(at)).append_column(
                "least", pa.array(least, pa.int64())
            )

    return placed.mapInArrow(seed, "id long, label long, dim int, code array<int>, pos long, least long")


def _chosen(anchors: DataFrame, zones: DataFrame, shards: int, groups: int, choose) -> DataFrame:
    """(label, dim, block, team): the blocks that the anchors of each team must read. ``choose(dim,
    anchors, zones)`` tells which zones (columns) each anchor (row) must read."""
    shard = F.pmod(F.xxhash64("label", "dim", "block"), F.lit(shards)).cast("int")
    left = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = zones.withColumn("shard", shard).withColumn(
        "team", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    )

    def pick(own: pa.Table, maps: pa.Table) -> pa.Table:
        taken = [np.zeros(0, dtype=INT)]
        if own.num_rows and maps.num_rows:
            here = dict(_by_dim(own))
            for dim, at in _by_dim(maps):
                if dim in here:
                    part = maps.take(pa.array(at))
                    taken.append(at[choose(dim, own.take(pa.array(here[dim])), part).any(axis=0)])
        taken = np.concatenate(taken)
        return maps.select(["label", "dim", "block", "team"]).take(pa.array(taken))

    pairs = left.groupBy("team", "shard").cogroup(right.groupBy("team", "shard"))
    return pairs.applyInArrow(pick, "label long, dim int, block long, team long")


def _read(
    anchors: DataFrame, placed: DataFrame, chosen: DataFrame, block: int, shard: int, schema: str, score
) -> DataFrame:
    """``score(anchors, rows)`` for each team of anchors and shard of the rows chosen for it."""
    rows = placed.select("id", "label", "dim", "code", "pos", "block").join(chosen, ["label", "dim", "block"])
    rows = rows.withColumn("shard", F.floor(F.col("pos") / shard))
    reads = chosen.select("team", F.floor(F.col("block") * block / shard).alias("shard")).distinct()
    left = anchors.join(reads, "team")

    def run(own: pa.Table, part: pa.Table) -> pa.Table:
        found = [pa.table([[]] * len(names), names=names).cast(arrow)]
        if own.num_rows and part.num_rows:
            here = dict(_by_dim(own))
            for dim, at in _by_dim(part):
                if dim in here:
                    made = score(dim, own.take(pa.array(here[dim])), part.take(pa.array(at)))
                    found.append(pa.table([pa.array(c) for c in made], names=names).cast(arrow))
        return pa.concat_tables(found)

    names = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(name, pa.int64()) for name in names])
    pairs = left.groupBy("team", "shard").cogroup(rows.groupBy("team", "shard"))
    return pairs.applyInArrow(run, schema)


def _first(rows: DataFrame, keys: list[str], score: str, id: str, pos: str, wanted: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), id, pos)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def _best(score: np.ndarray, id: np.ndarray, pos: np.ndarray, wanted: int) -> np.ndarray:
    """Places of the best ``wanted``: higher score, then smaller id, then earlier row."""
    if len(score) > wanted:
        least = np.partition(score, -wanted)[-wanted]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((pos[at], id[at], -score[at]))][:wanted]


def hard_negatives(
    rows: DataFrame, anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256,
    block: int = BLOCK, shard: int = SHARD, group: int = GROUP,
    directions: int = DIRECTIONS, bits: int = BITS, sample: int = SAMPLE,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best rows
    of other labels whose score lies between the two ``percent`` of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    if shard % block:
        raise ValueError("a shard is a whole number of blocks")
    sound = staged(codes(rows, anchor, scale, id, vector, label), "codes")
    placed = staged(ordered(sound, block, directions, bits, sample), "placed")
    zones = staged(zone_maps(placed), "zones")
    seeds = numbered(_seeds(placed, positives), [], ["pos"], "place", "anchors")
    seeds = staged(seeds.withColumn("team", F.floor(F.col("place") / group)).drop("place", "anchors"), "anchors")
    teams = (seeds.agg(F.max("team")).first()[0] or 0) + 1
    shards = -(-zones.count() // ZONES) or 1

    def may_be_positive(dim: int, own: pa.Table, maps: pa.Table) -> np.ndarray:
        low, high = bounds(_matrix(own["code"], dim), _matrix(maps["low"], dim), _matrix(maps["high"], dim))
        least = own["least"].fill_null(np.iinfo(INT).min).to_numpy()
        same = np.asarray(own["label"])[:, None] == np.asarray(maps["label"])[None, :]
        return same & (high >= least[:, None])

    def positive(dim: int, own: pa.Table, part: pa.Table) -> list[np.ndarray]:
        found = scores(_matrix(own["code"], dim), _matrix(part["code"], dim))
        label, ids, pos = (np.asarray(part[c]) for c in ("label", "id", "pos"))
        out = [np.zeros((0, 4), dtype=INT)]
        for n, (mine, at) in enumerate(zip(own["label"].to_pylist(), own["pos"].to_pylist())):
            others = np.flatnonzero((label == mine) & (pos != at))
            best = others[_best(found[n, others], ids[others], pos[others], positives)]
            out.append(np.stack([np.full(len(best), at), ids[best], pos[best], found[n, best]], 1))
        return list(np.concatenate(out).T)

    chosen = staged(_chosen(seeds, zones, shards, teams, may_be_positive), "chosen")
    schema = "pos long, positive_id long, positive_pos long, positive_score long"
    near = _read(seeds, placed, chosen, block, shard, schema, positive)
    near = _first(near, ["pos"], "positive_score", "positive_id", "positive_pos", positives).drop("rank")
    kept = F.sort_array(F.collect_list(F.struct("positive_pos", "positive_id", "positive_score"))).alias("near")
    anchors = staged(seeds.drop("least").join(near.groupBy("pos").agg(kept), "pos"), "positives")

    def spans(own: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positives of all anchors, the anchor of each, and the ends of their windows."""
        lists = own["near"].combine_chunks()
        flat = lists.flatten()
        of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        least, most = windows(np.asarray(flat.field("positive_score")), percent)
        return flat, of, least, most

    def may_be_negative(dim: int, own: pa.Table, maps: pa.Table) -> np.ndarray:
        low, high = bounds(_matrix(own["code"], dim), _matrix(maps["low"], dim), _matrix(maps["high"], dim))
        _, of, least, most = spans(own)
        meets = (low[of] <= most[:, None]) & (high[of] >= least[:, None]) & (least <= most)[:, None]
        return meets & (np.asarray(own["label"])[of][:, None] != np.asarray(maps["label"])[None, :])

    def negative(dim: int, own: pa.Table, part: pa.Table) -> list[np.ndarray]:
        found = scores(_matrix(own["code"], dim), _matrix(part["code"], dim))
        label, ids, pos = (np.asarray(part[c]) for c in ("label", "id", "pos"))
        flat, of, least, most = spans(own)
        chosen_pos, chosen_id, chosen_score = (np.asarray(flat.field(k)) for k in range(3))
        own_id, own_label, own_pos = (np.asarray(own[c]) for c in ("id", "label", "pos"))
        out = [np.zeros((0, 8), dtype=INT)]
        for k, n in enumerate(of):
            inside = np.flatnonzero((found[n] >= least[k]) & (found[n] <= most[k]) & (label != own_label[n]))
            best = inside[_best(found[n, inside], ids[inside], pos[inside], negatives)]
            same = [own_pos[n], chosen_pos[k], own_id[n], chosen_id[k], chosen_score[k]]
            out.append(np.column_stack([np.tile(same, (len(best), 1)), ids[best], pos[best], found[n, best]]))
        return list(np.concatenate(out).T)

    chosen = staged(_chosen(anchors, zones, shards, teams, may_be_negative), "chosen")
    schema = (
        "pos long, positive_pos long, anchor_id long, positive_id long, positive_score long, "
        "negative_id long, negative_pos long, negative_score long"
    )
    far = _read(anchors, placed, chosen, block, shard, schema, negative)
    far = _first(far, ["pos", "positive_pos"], "negative_score", "negative_id", "negative_pos", negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
