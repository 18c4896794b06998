"""SimHash near-duplicates by meeting in the middle.

Two fingerprints differ in at most r bits exactly if some value lies within r/2 bits of
both. So every distinct fingerprint stands for its ball of variants (all values within half the
radius), variants are shuffled, and fingerprints that meet at a variant are linked.

A fingerprint has 2,081 variants at radius 4. They are not sent one by one: a row carries
a variant's leading bits, the fingerprint and the flips still allowed, 37 rows for 8 leading bits,
and the task that receives a prefix expands the remaining bits itself. Prefixes with too many
variants (`MOST_VARIANTS`) are lengthened, in the end to all 64 bits, where a group has at
most 2,081 rows; so a hot ball is split without losing a link. At a shared variant all
fingerprints are mutual partners (triangle inequality), so each is linked to the smallest one only:
no pairs within a group. Every link is verified by its bit distance.
"""

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialized, texts
from revlens.llm.components import smallest_reachable

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
MOST_VARIANTS = 4_000_000
MEAN_VARIANTS = 1_000_000
STEP_BITS = 8


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    count = max(1, len(parts) - words + 1)
    if count == 1:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = [0, *(ends[:count - 1] + 1).tolist()]
        digest = xxhash.xxh64_digest
        digests = b"".join([
            digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())
        ])
    bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(count, 8), axis=1)
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > count
    return int(np.packbits(majority).view(">i8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(t, words) for t in batch], dtype="int64")

    return fingerprints(text)


def _masks(bits: int, flips: int) -> list[tuple[int, int]]:
    """(mask over `bits` bits, flips it takes)."""
    return [
        (sum(1 << p for p in places), n)
        for n in range(flips + 1)
        for places in combinations(range(bits), n)
    ]


def _ball_size(bits: int, flips: int) -> int:
    return sum(math.comb(bits, n) for n in range(flips + 1))


def _lengthen(rows: DataFrame, done: int, bits: int, half: int) -> DataFrame:
    """Rows (prefix over `done` bits, fp, left) to prefixes over `bits` bits."""
    step = bits - done
    masks = F.array(*[
        F.struct(F.lit(mask).cast("long").alias("mask"), F.lit(n).alias("flips"))
        for mask, n in _masks(step, half)
    ])
    own = F.shiftrightunsigned(F.col("fp"), 64 - bits).bitwiseAND(
        F.lit((1 << step) - 1 if step < 64 else -1).cast("long"))
    return (
        rows.withColumn("m", F.explode(F.filter(masks, lambda m: m["flips"] <= F.col("left"))))
        .select(
            F.shiftleft(F.col("prefix"), step).bitwiseOR(own.bitwiseXOR(F.col("m.mask")))
            .alias("prefix"),
            "fp", "id", (F.col("left") - F.col("m.flips")).alias("left"),
        )
    )


def _linked(bits: int, half: int, most_bits: int):
    """Expand a prefix group, meet at equal variants, return a forest of verified links."""
    rest = 64 - bits
    by_left = {
        left: np.array([m for m, _ in _masks(rest, left)], dtype=np.uint64)
        for left in range(half + 1)
    }

    def link(group: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(group["id"].to_numpy(), kind="stable")
        ids = group["id"].to_numpy()[order]
        prints = group["fp"].to_numpy()[order].view(np.uint64)
        left = group["left"].to_numpy()[order]
        tail = prints & np.uint64((1 << rest) - 1)
        values, owners = [], []
        for flips, masks in by_left.items():
            rows = np.flatnonzero(left == flips)
            values.append((tail[rows][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(rows.astype(np.int32), len(masks)))
        values, owners = np.concatenate(values), np.concatenate(owners)
        by_value = np.argsort(values, kind="stable")
        values, owners = values[by_value], owners[by_value]
        fresh = np.concatenate(([True], values[1:] != values[:-1]))
        run = np.cumsum(fresh) - 1
        size = np.bincount(run)
        shared = size[run] > 1
        owners, run = owners[shared], run[shared]
        if not len(owners):
            return pd.DataFrame({"a": ids[:0], "b": ids[:0]})
        first = np.full(len(size), len(ids), dtype=np.int64)
        np.minimum.at(first, run, owners)
        pairs = np.unique(first[run] * len(ids) + owners)
        low, high = pairs // len(ids), pairs % len(ids)
        near = np.bitwise_count(prints[low] ^ prints[high]) <= most_bits
        near &= low != high
        low, high = low[near], high[near]
        label = np.arange(len(ids))
        while True:  # smallest label along the links
            before = label.copy()
            smaller = np.minimum(label[low], label[high])
            np.minimum.at(label, low, smaller)
            np.minimum.at(label, high, smaller)
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[label[moved]], "b": ids[moved]})

    return link


def links(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b): ids of linked fingerprints, a < b, enough of them to connect every pair
    within `most_bits`. `prints` has distinct rows (fp long, id long)."""
    if most_bits % 2:
        raise ValueError("an even number of bits is needed to halve the radius")
    half = most_bits // 2
    total = prints.count() * _ball_size(64, half)
    bits = min(64, max(STEP_BITS, math.ceil(math.log2(max(1, total / MEAN_VARIANTS)))))
    rows = _lengthen(
        prints.select(F.lit(0).cast("long").alias("prefix"), "fp", "id", F.lit(half).alias("left")),
        0, bits, half,
    )
    found = None
    while True:
        weight = F.lit(0)
        for left in range(half + 1):
            weight = F.when(F.col("left") == left, _ball_size(64 - bits, left)).otherwise(weight)
        hot = None
        if bits < 64:
            hot = materialized(
                rows.groupBy("prefix").agg(F.sum(weight).alias("variants"))
                .filter(F.col("variants") > MOST_VARIANTS).select("prefix"),
                "hot-prefixes",
            )
            if hot.isEmpty():
                hot = None
        calm = rows if hot is None else rows.join(hot, "prefix", "left_anti")
        part = calm.groupBy("prefix").applyInPandas(
            _linked(bits, half, most_bits), "a long, b long")
        found = part if found is None else found.union(part)
        if hot is None:
            return found
        longer = min(64, bits + STEP_BITS)
        rows = _lengthen(rows.join(hot, "prefix", "left_semi"), bits, longer, half)
        bits = longer


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """One row per document: doc_id, fp (long) and component_id, the smallest doc_id that links
    of at most `most_bits` bits reach.

    Null and empty texts have fingerprint zero and link like any other. Equal fingerprints are one
    node, however many documents share it. Repeated rows each give a row. Documents without id
    neither link nor change a component.
    """
    prints = materialized(
        texts(docs).select("doc_id", fingerprint(F.col("text"), words).alias("fp")),
        "fingerprints",
    )
    distinct = materialized(
        prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints")
    labels = smallest_reachable(links(distinct.filter("id is not null"), most_bits))
    components = distinct.join(labels, "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(components, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """The document with the smallest doc_id of every group, with its own columns. Rows that share
    a doc_id are one document; documents without id stay."""
    gone = near_duplicates(docs, words, most_bits).filter("doc_id <> component_id").select(
        F.col("doc_id").alias("_gone")).distinct()
    kept = docs.filter("doc_id is not null").join(
        gone, F.col("doc_id") == F.col("_gone"), "left_anti").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id is null"))
