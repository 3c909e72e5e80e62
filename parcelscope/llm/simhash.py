"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Two
fingerprints within three bits differ in at most three of their eight bytes, so they share at least
five positional bytes: pairs from the index are tallied by shared positional bytes, those with
fewer than five are dropped, and the rest are verified by counting differing bits.

A posting list per single byte would hold 1/256 of all fingerprints, and its pairs would grow with
the square of the input. The index is therefore keyed by four positional bytes at once: the
fourteen blocks of the Steiner system S(3, 4, 8) contain every three of the eight positions, so the
complement of one of them, itself a block, is free of the differing bytes. No pair is lost, and a
list holds 1/2^32 of unrelated fingerprints. Lists that are still long (large groups of near
copies) are split again by a further shared part of the free bits until a list cannot hold more
than ``2**9`` distinct fingerprints; every split keeps all pairs within three bits.

Equal fingerprints are folded before anything is paired, so a group of exact copies is one entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.llm.components import components
from parcelscope.llm.text import own_name
from parcelscope.settings import staged

SEED = 42
SHINGLE = 3
BITS = 3
LEAST_BYTES = 8 - BITS
# Lists up to this length are paired at once; longer ones are split first.
LIST_MOST = 256
# Words of long texts are hashed in pieces of this many shingles.
PIECE = 1 << 16

_BYTES = np.arange(256, dtype=np.uint8)
# _SPREAD[v] holds bit 0 to 7 of byte value v.
_SPREAD = ((_BYTES[:, None] >> np.arange(8, dtype=np.uint8)) & 1).astype(np.int64)


def steiner_blocks() -> list[int]:
    """The 14 blocks of S(3, 4, 8) as masks of byte positions: the words of weight four of the
    extended Hamming code, which are the 4-sets of positions whose numbers xor to zero."""
    return [
        sum(1 << p for p in four)
        for four in combinations(range(8), 4)
        if four[0] ^ four[1] ^ four[2] ^ four[3] == 0
    ]


def _byte_mask(positions: int) -> int:
    return sum(0xFF << (8 * p) for p in range(8) if positions >> p & 1)


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text; zero for a text without words (or null)."""
    words = (text or "").encode().lower().split()  # ASCII letters and white space only, as bytes
    if not words:
        return 0
    ends = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, ends, PIECE):
        part = [
            digest(b" ".join(words[i : i + shingle]), seed) for i in range(at, min(at + PIECE, ends))
        ]
        octets = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        for p in range(8):
            ones[8 * p : 8 * p + 8] += np.bincount(octets[:, p], minlength=256) @ _SPREAD
    bits = (2 * ones > ends).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and the fingerprint of each text as a signed long ``out``."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(out, T.LongType())])
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(t.as_py()) for t in batch.column(len(kept))]
            column = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], column], names=[*kept, out])

    return source.mapInArrow(prints, schema)


def _index(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """Posting lists by block of four positional bytes: (block, key, fp)."""
    entries = [
        F.struct(F.lit(i).alias("block"), F.col(fp).bitwiseAND(F.lit(_signed(_byte_mask(b)))).alias("key"))
        for i, b in enumerate(steiner_blocks())
    ]
    return prints.select(fp, F.explode(F.array(*entries)).alias("e")).select("e.block", "e.key", fp)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _parts(free: list[list[int]], shared: int) -> list[tuple[int, list[list[int]]]]:
    """Choices of ``shared`` of the free parts as (bit mask, parts that stay free)."""
    found = []
    for chosen in combinations(range(len(free)), shared):
        mask = sum(1 << bit for c in chosen for bit in free[c])
        found.append((mask, [free[i] for i in range(len(free)) if i not in chosen]))
    return found


def finer_masks(bits: int = BITS) -> list[list[list[int]]]:
    """Per round of splitting and per list number, the masks that split a list further.

    The free bits of a list are cut into parts; at most ``bits`` parts differ, so all others are
    equal, and some choice of that many parts is shared. Round 1 shares one of the four free
    bytes (24 bits stay free), round 2 one of four six-bit parts (18 stay free), round 3 three of
    six three-bit parts (9 stay free, so at most 512 fingerprints share a list).
    """
    lists = [[p for p in range(8) if not b >> p & 1] for b in steiner_blocks()]
    free = [[bit for p in four for bit in range(8 * p, 8 * p + 8)] for four in lists]
    rounds = []
    for width in (8, 6, 3):
        masks, after = [], []
        for own in free:
            parts = [own[i : i + width] for i in range(0, len(own), width)]
            chosen = _parts(parts, len(parts) - bits)
            masks.append([_signed(m) for m, _ in chosen])
            after += [[bit for part in rest for bit in part] for _, rest in chosen]
        rounds.append(masks)
        free = after
    return rounds


def _split_again(entries: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Entries of long lists under the finer keys; lists get new consecutive numbers."""
    per = len(masks[0])
    table = F.array(*[F.array(*[F.lit(m) for m in own]) for own in masks])
    finer = entries.select("block", "key", "fp", F.posexplode(F.element_at(table, F.col("block") + 1)))
    return finer.select(
        (F.col("block") * per + F.col("pos")).alias("block"),
        F.col("key").bitwiseOR(F.col("fp").bitwiseAND(F.col("col"))).alias("key"),
        "fp",
    )


def _roots(link: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, from a boolean adjacency matrix."""
    low = np.arange(len(link))
    while True:
        new = np.where(link, low[None, :], len(link)).min(axis=1)
        new = np.minimum(new, low)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _pair_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each list: tally shared positional bytes per pair, keep pairs that reach the least
    number, verify their bits, and return each member with the smallest one linked to it."""
    for batch in batches:
        lists = batch.column(0)
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        src, dst = [], []
        sizes = np.diff(offsets)
        two = sizes == 2  # most lists
        a, b = flat[offsets[:-1][two]], flat[offsets[:-1][two] + 1]
        near = _near(a, b)
        src.append(np.maximum(a[near], b[near]))
        dst.append(np.minimum(a[near], b[near]))
        for i in np.flatnonzero(sizes > 2):
            own = np.sort(flat[offsets[i] : offsets[i + 1]])
            link = _near(own[:, None], own[None, :])
            root = _roots(link)
            moved = root != np.arange(len(own))
            src.append(own[moved])
            dst.append(own[root[moved]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(src), pa.int64()), pa.array(np.concatenate(dst), pa.int64())], names=["a", "b"]
        )


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = np.bitwise_xor(a, b).view(np.uint64) if a.shape == b.shape else np.bitwise_xor(a, b).astype(np.uint64)
    tally = np.zeros(apart.shape, dtype=np.uint8)
    for p in range(8):
        tally += (apart >> np.uint64(8 * p)) & np.uint64(0xFF) == 0
    return (tally >= LEAST_BYTES) & (np.bitwise_count(apart) <= BITS)


def linked_prints(prints: DataFrame, list_most: int = LIST_MOST) -> DataFrame:
    """Links (a, b), a > b, that connect exactly the distinct ``fp`` reachable within three bits.

    Lists are counted before they are gathered, so a gathered list has at most ``list_most``
    members, or 512 after the last split.
    """
    entries = _index(prints)
    links = None
    for masks in [*finer_masks(), None]:
        sizes = staged(
            entries.groupBy("block", "key").count().where("count > 1"), "simhash-lists"
        )
        short = sizes if masks is None else sizes.where(F.col("count") <= list_most)
        gathered = (
            entries.join(short.select("block", "key"), ["block", "key"])
            .groupBy("block", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select("fps")
            .mapInArrow(_pair_lists, "a long, b long")
        )
        links = gathered if links is None else links.unionByName(gathered)
        if masks is None:
            break
        long = sizes.where(F.col("count") > list_most)
        if long.isEmpty():
            break
        entries = staged(
            _split_again(entries.join(long.select("block", "key"), ["block", "key"]), masks), "simhash-split"
        )
    return links.distinct()


def classes(prints: DataFrame, list_most: int = LIST_MOST) -> DataFrame:
    """Per distinct ``fp`` of (doc_id, fp) rows: its class, as the smallest ``fp`` linked to it
    (``root``) and the smallest doc_id of the class (``component_id``, null if all are null)."""
    lowest = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-prints")
    links = staged(linked_prints(lowest.select("fp"), list_most), "simhash-links")
    roots = components(links, "a", "b").withColumnsRenamed({"a": "fp", "b": "root"})
    labelled = lowest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    return staged(labelled.select("fp", "root").join(least, "root"), "simhash-classes")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", list_most: int = LIST_MOST
) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id, and the signed
    fingerprint and class root.

    A null or empty text has fingerprint zero and is linked like any other. Repeated rows are kept
    and share a component. A null id has no say in component_id, which is null only if the whole
    component has none. Other columns are ignored; an empty table gives an empty result.
    """
    narrow = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = staged(with_fingerprint(narrow, "fp", keep=["doc_id"]), "simhash-docs")
    return prints.join(classes(prints, list_most), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "root"
    )


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", list_most: int = LIST_MOST
) -> DataFrame:
    """``docs`` with one row of each class: one with its smallest id (of a class without ids, any).

    Only ids travel to the decision: texts are read once more and lose the ids that go, which are
    fewer than those that stay. Rows without an id of their own (null, or one that other rows have
    too) are told apart by fingerprint.
    """
    found = staged(near_duplicates(docs, id, text, list_most), "simhash-found")
    chosen = F.col("doc_id").eqNullSafe(F.col("component_id"))
    shared = staged(
        found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "simhash-shared"
    )
    gone = found.where(~chosen & F.col("doc_id").isNotNull()).select("doc_id")
    gone = staged(gone.unionByName(shared.where("doc_id IS NOT NULL")).distinct(), "simhash-gone")
    key, gone_id = F.col(f"`{id}`"), gone["doc_id"]
    kept = docs.where(key.isNotNull()).join(gone, docs[f"`{id}`"] == gone_id, "left_anti")
    if shared.isEmpty():
        return kept
    fp, root = own_name(docs, "_fp"), own_name(docs, "_root")
    nameless = docs.join(shared, docs[f"`{id}`"].eqNullSafe(shared["doc_id"]), "left_semi")
    nameless = with_fingerprint(nameless, fp, text)
    stays = found.where(chosen).select("doc_id", "fp", F.col("root").alias(root)).distinct()
    same = nameless[f"`{id}`"].eqNullSafe(stays["doc_id"]) & (nameless[fp] == stays["fp"])
    once = nameless.join(stays, same).dropDuplicates([root])
    return kept.unionByName(once.select(*[nameless[f"`{c}`"] for c in docs.columns]))
