"""Near-duplicates by SimHash fingerprints, with meet-in-the-middle balls.

Two 64-bit fingerprints that differ in at most 2 r bits have a number in common that differs from each in at
most r bits. So each distinct fingerprint emits all such numbers, its variants, and fingerprints that emit
the same variant are within 2 r of each other. Variants are shuffled on their leading bits: a row with a
prefix and a fingerprint stands for all variants of that fingerprint with that prefix, which the reading
task spells out (2,081 variants for r = 2 travel as a few dozen rows). Prefixes with too many variants
are split by further bits, up to single variants, which have a bounded number of fingerprints.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.llm.components import connected_components
from accordant.llm.text import LOWER, map_rows, stored

BITS = 64
#: Variants of one prefix that a task holds at once (8 bytes each, and as many for their order); half of it is aimed at.
HELD = 6_000_000
#: Rows with a prefix that one task makes, about.
EMITTED = 2_000_000
#: Shingles whose bits are added up at once.
SLICE = 1 << 15


def shingle_hashes(text: str | None, size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` lower-cased words, space-joined, repeats included; the whole sequence if it is shorter."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    flat, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(flat, seed)], np.uint64)
    spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32).tolist()
    starts, stops = [0, *(s + 1 for s in spaces)], [*spaces[size - 1 :], len(flat)]
    return np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts, stops)), np.uint64, len(stops))


def simhash(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; 0 without any."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, seed: int = 42) -> DataFrame:
    """(``doc_id``, ``fingerprint`` as a signed long) of every row; 0 for null, empty and blank texts."""
    def make():
        def step(ids, texts):
            return ids, np.array([simhash(shingle_hashes(t, size, seed)) for t in texts], np.uint64).view(np.int64)

        return step

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make, "doc_id long, fingerprint long")


@cache
def ball(bits: int, radius: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``radius`` of them set."""
    return np.array([sum(1 << b for b in chosen) for r in range(min(radius, bits) + 1) for chosen in combinations(range(bits), r)], np.uint64)


def _leading(fp: Column, depth: int) -> Column:
    return F.shiftrightunsigned(fp, BITS - depth)


def _extend(rows: DataFrame, depth: int, bits: int, radius: int) -> DataFrame:
    """Rows (``prefix`` of ``depth`` bits, ``fp``) dealt to prefixes of ``bits`` more bits, as far as the radius allows."""
    own = _leading(F.col("fp"), depth + bits).bitwiseAND((1 << bits) - 1)
    longer = F.shiftleft("prefix", bits).bitwiseOR(own.bitwiseXOR(F.col("mask"))) if depth else own.bitwiseXOR(F.col("mask"))
    masks = F.array(*[F.lit(int(m)) for m in ball(bits, radius)])
    rows = rows.select("prefix", "fp", F.explode(masks).alias("mask")).select(longer.alias("prefix"), "fp")
    return rows.filter(_flips(depth + bits) <= radius)


def _flips(depth: int) -> Column:
    """Leading bits in which the variants of a row differ from its fingerprint."""
    return F.bit_count(_leading(F.col("fp"), depth).bitwiseXOR(F.col("prefix")))


def _variants(depth: int, radius: int) -> Column:
    """Variants that a row stands for: those of the bits after its prefix, with the flips that are left."""
    sizes = [sum(comb(BITS - depth, k) for k in range(r + 1)) for r in range(radius + 1)]
    return F.element_at(F.array(*[F.lit(s) for s in sizes]), (F.lit(radius) - _flips(depth) + 1).cast("int")).cast("long")


def colliding(prefix: int, depth: int, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of one prefix that join all its fingerprints with a variant in common.

    Variants are spelled out and sorted. Fingerprints with the same variant are all linked to the smallest of
    them; each such pair is verified once, and pairs that add nothing to what others join are left out.
    """
    rest = np.uint64((1 << (BITS - depth)) - 1)
    head = np.uint64(prefix << (BITS - depth))
    left = radius - np.bitwise_count((fps ^ head) & ~rest).astype(np.int64)
    variants, owners = [], []
    for r in range(radius + 1):
        at = np.flatnonzero(left == r)
        masks = ball(BITS - depth, r)
        variants.append((((fps[at] & rest) | head)[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(at.astype(np.int32), len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants)
    variants = variants[order]
    same = variants[1:] == variants[:-1]
    first = np.concatenate(([True], ~same)) & np.concatenate((same, [False]))
    inside = np.concatenate(([False], same)) | first
    owners, starts = owners[order[inside]], np.flatnonzero(first[inside])
    if not len(starts):
        return fps[:0], fps[:0]
    rank = np.argsort(np.argsort(fps))  # fingerprints of a prefix are distinct
    low = np.minimum.reduceat(rank[owners], starts)
    low = np.repeat(low, np.diff(np.append(starts, len(owners))))
    links = np.unique(low * np.int64(len(fps)) + rank[owners])
    a, b = links // len(fps), links % len(fps)
    by_rank = np.sort(fps)
    near = (a != b) & (np.bitwise_count(by_rank[a] ^ by_rank[b]) <= 2 * radius)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a[near].tolist(), b[near].tolist()):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    kept = np.array(kept, np.int64).reshape(-1, 2)
    return by_rank[kept[:, 0]], by_rank[kept[:, 1]]


def _links_of(rows: DataFrame, depth: int, radius: int) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key, table):
        fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
        a, b = colliding(key[0].as_py() & ((1 << BITS) - 1), depth, fps, radius)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return rows.groupBy("prefix").applyInArrow(run, "a long, b long")


def near_fingerprints(found: DataFrame, radius: int = 2, held: int = HELD) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints (column ``fingerprint``) within 2 ``radius`` bits.

    Every two such fingerprints are joined by a path of links, and every link is between two such; of a group
    that shares a variant there are not all pairs. Prefixes get as many leading bits as the number of
    fingerprints asks for. Those with over ``held`` variants get four more, again and again; a
    single variant, at 64 bits, has at most as many fingerprints as there are variants of one.
    """
    n = found.count()
    bits = max(1, int(np.ceil(np.log2(max(n * len(ball(BITS, radius)) / (held / 2), 2)))))
    width = len(ball(bits, radius))
    rows = found.select(F.lit(0).cast("long").alias("prefix"), F.col("fingerprint").alias("fp")).repartition(max(1, -(-n * width // EMITTED)))
    rows, depth, links = _extend(rows, 0, bits, radius), bits, None
    while True:
        full = rows.groupBy("prefix").agg(F.sum(_variants(depth, radius)).alias("v")).filter(F.col("v") > held).select("prefix")
        full = stored(full, "simhash-full") if depth < BITS else None
        split = full is not None and not full.isEmpty()
        part = _links_of(rows.join(full, "prefix", "left_anti") if split else rows, depth, radius)
        links = part if links is None else links.unionAll(part)
        if not split:
            return links
        more = min(4, BITS - depth)
        rows = _extend(stored(rows.join(full, "prefix", "left_semi"), "simhash-split"), depth, more, radius)
        depth += more


def group_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, seed: int = 42, radius: int = 2) -> DataFrame:
    """(``doc_id``, ``fingerprint`` as 16 hex digits, ``component_id``) for every row of ``docs``.

    Documents link where their fingerprints differ in at most 2 ``radius`` bits; ``component_id`` is the smallest
    id reachable by links, itself included. Null, empty and blank texts have fingerprint zero and link like any
    other, repeated rows link with each other, and a null id counts as none: such a row gets the smallest id of
    its component, if any. Equal fingerprints meet before anything else, so copies cost one row each.
    """
    rows = stored(fingerprints(docs, id_col, text_col, size, seed), "simhash-rows")
    found = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "simhash-found")
    component = connected_components(near_fingerprints(found, radius)).select(F.col("node").alias("fingerprint"), "root")
    rooted = found.join(component, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = stored(rooted.join(lowest, "root").select("fingerprint", "component_id"), "simhash-components")
    return rows.join(ids, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                                                F.coalesce("component_id", "doc_id").alias("component_id"))
