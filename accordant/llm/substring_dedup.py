"""Removal of passages that repeat from earlier documents, by FM-indexes of routed passages.

Windows of ``length`` consecutive words are routed by their smallest run of ``ANCHOR`` words (by hash), as
equal windows have equal anchors: consecutive windows with one anchor form a segment. Segments whose
anchor occurs in one document only need no look; a fixed-size bitmap drops most of those before anything
is shuffled (a fuller one drops fewer), an exact count the rest. The others are reduced to distinct ones
with their first document, and each shard of anchors builds an FM-index of its segments and streams them
through it by backward search: the smallest document in a window's suffix interval is where it occurs
first. Anchors with too many segments for a shard are cut into single windows instead, for which the first
document is a plain minimum; so no shard depends on how often an anchor occurs.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.fm_index import FMIndex
from accordant.llm.text import gram_hashes, hashed_words, map_rows, stored

LENGTH, ANCHOR = 13, 4
#: Words that a shard indexes, about; and distinct segments of one anchor beyond which it is cut into windows.
SHARD_WORDS, BUSY = 200_000, 2_000
#: Bits of the bitmap of anchors.
CELLS = 1 << 26
NO_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def segments(texts: list[str | None], length: int) -> tuple[np.ndarray, ...]:
    """Segments of a slice of texts: (anchor hash, index of the text, first word, windows, hash of the words)."""
    h, sizes = hashed_words([(t or "").encode() for t in texts])
    n = len(h) - length + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 5
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    g = gram_hashes(h, ANCHOR)
    low = g[:n].copy()
    for i in range(1, length - ANCHOR + 1):
        np.minimum(low, g[i : n + i], out=low)
    at = np.flatnonzero(np.arange(n) + length <= ends[text[:n]])  # windows within one text
    if not len(at):
        return (np.empty(0, np.int64),) * 5
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]])]))
    start, windows = at[fresh], np.diff(np.append(fresh, len(at)))
    # hashes of word runs from prefix sums of a polynomial
    power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(h), _BASE, np.uint64)]))
    back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(h), _INVERSE, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)])
    content = (sums[start + windows + length - 1] - sums[start]) * back[start]
    owner = text[start]
    return low[start].view(np.int64), owner, start - (ends - sizes)[owner], windows, content.view(np.int64)


def _cells(anchors: np.ndarray) -> np.ndarray:
    return (anchors.view(np.uint64) >> np.uint64(7) & np.uint64(CELLS - 1)).astype(np.int64)


def anchor_bitmap(docs: DataFrame, length: int) -> np.ndarray:
    """A bit for every class of anchors that more than one row may hold: CELLS / 8 bytes.

    Each task marks the classes it has met once and more than once; compressed marks meet in a tree.
    """
    def make():
        once, more = np.zeros(CELLS, bool), np.zeros(CELLS, bool)

        def step(ids, texts):
            anchor, owner, *_ = segments(texts, length)
            cell = np.unique(_cells(anchor) * len(texts) + owner) // max(1, len(texts))  # once for each text
            again = cell[1:][cell[1:] == cell[:-1]]
            more[again] = True
            more[cell[once[cell]]] = True
            once[cell] = True
            return ([],)

        step.last = lambda: ([zlib.compress(np.packbits(once).tobytes() + np.packbits(more).tobytes(), 1)],)
        return step

    def add(a: bytes, b: bytes) -> bytes:
        (a1, a2), (b1, b2) = (np.frombuffer(zlib.decompress(x), np.uint8).reshape(2, -1) for x in (a, b))
        return zlib.compress(np.stack([a1 | b1, a2 | b2 | (a1 & b1)]).tobytes(), 1)

    parts = map_rows(docs, make, "marks binary").rdd.map(lambda r: bytes(r[0]))
    if parts.isEmpty():
        return np.zeros(CELLS // 8, np.uint8)
    return np.frombuffer(zlib.decompress(parts.treeReduce(add, 3)), np.uint8).reshape(2, -1)[1]


def _row(i: int | None, text: str | None) -> int:
    """Tells rows with one id apart by their texts."""
    return xxhash.xxh3_64_intdigest(text or "") & NO_ID


def anchored(docs: DataFrame, length: int) -> DataFrame:
    """(``anchor``, ``id``, ``doc``, ``row``, ``at``, ``n``) for each segment that the bitmap lets pass; ``id``
    stands for its words, ``doc`` and ``row`` for the document."""
    bitmap = docs.sparkSession.sparkContext.broadcast(anchor_bitmap(docs, length))  # CELLS / 8 bytes

    def make():
        marks = bitmap.value

        def step(ids, texts):
            anchor, owner, at, n, content = segments(texts, length)
            cell = _cells(anchor)
            keep = (marks[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool) if len(anchor) else np.empty(0, bool)
            doc = np.array([NO_ID if i is None else i for i in ids], np.int64)
            row = np.array([_row(i, t) for i, t in zip(ids, texts, strict=True)], np.int64)
            return anchor[keep], content[keep], doc[owner[keep]], row[owner[keep]], at[keep], n[keep]

        return step

    return map_rows(docs, make, "anchor long, id long, doc long, row long, at int, n int")


def passages(docs: DataFrame, first: DataFrame, length: int) -> DataFrame:
    """(``anchor``, ``id``, ``doc``, ``n``, ``passage``) of the places in ``first``, from the texts."""
    by_row = first.groupBy("doc", "row").agg(F.collect_list(F.struct("anchor", "id", "at", "n")).alias("of"))
    found = _with_row(docs).dropDuplicates(["_doc", "_row"]).join(
        by_row, (F.col("_row") == F.col("row")) & (F.col("_doc") == F.col("doc"))).select("doc", "packed", "of")

    def make():
        def step(doc, packed, of):
            out = []
            for d, data, places in zip(doc, packed, of, strict=True):
                words = _unpack(data).split()
                out += [(p["anchor"], p["id"], d, p["n"], b" ".join(words[p["at"] : p["at"] + p["n"] + length - 1])) for p in places]
            return tuple(map(list, zip(*out))) if out else ([],) * 5

        return step

    return map_rows(found, make, "anchor long, id long, doc long, n int, passage binary", rows=64)


def _with_row(docs: DataFrame) -> DataFrame:
    """Rows as (``_doc``, ``_row``, ``doc_id``, ``packed`` text)."""
    def make():
        press = zstandard.ZstdCompressor(level=3)
        return lambda ids, texts: ([NO_ID if i is None else i for i in ids], [_row(i, t) for i, t in zip(ids, texts, strict=True)], ids,
                                   [press.compress((t or "").encode()) for t in texts])

    return map_rows(docs, make, "_doc long, _row long, doc_id long, packed binary")


def _unpack(data: bytes) -> bytes:
    return zstandard.decompress(data) if data else b""


def first_documents(distinct: DataFrame, length: int, shard_words: int, busy: int) -> DataFrame:
    """(``anchor``, ``id``, ``firsts``): for every window of each distinct segment, the smallest document it occurs in."""
    counted = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments"))
    # stored, so that Spark knows its size: few anchors are joined without moving the passages
    hot = stored(counted.filter(F.col("segments") > busy).select("anchor"), "substring-busy")
    calm = distinct.join(hot, "anchor", "left_anti")
    words = distinct.agg(F.sum(F.col("n") + (length - 1))).first()[0] or 0
    shards = max(1, -(-words // shard_words))

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        vocabulary: dict[bytes, int] = {}
        texts = [[vocabulary.setdefault(w, len(vocabulary) + 1) for w in p.split(b" ")] for p in frame["passage"]]
        sizes = np.array([len(t) for t in texts])
        flat = np.zeros(int(sizes.sum() + len(sizes)), np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        for s, t in zip(starts, texts, strict=True):
            flat[s : s + len(t)] = t
        fm = FMIndex(flat, np.repeat(frame["doc"].to_numpy(np.int64), sizes + 1))
        windows = sizes - length + 1
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, windows, strict=True)])
        firsts = np.empty(len(at), np.int64)
        for k in range(0, len(at), 50_000):
            lo, hi = fm.search(flat[at[k : k + 50_000, None] + np.arange(length)], until_alone=True)
            firsts[k : k + 50_000] = fm.smallest_owner(lo, hi)
        return pd.DataFrame({"anchor": frame["anchor"], "id": frame["id"], "firsts": np.split(firsts, np.cumsum(windows)[:-1])})

    by_index = calm.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "id", "doc", "passage").groupBy("shard").applyInPandas(index, "anchor long, id long, firsts array<long>")

    words_of_passage = F.split(F.decode("passage", "utf-8"), " ")
    single = distinct.join(hot, "anchor", "left_semi").select("anchor", "id", "doc", words_of_passage.alias("w")).select(
        "anchor", "id", "doc", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - (length - 1)), lambda i: F.unhex(F.sha2(F.array_join(F.slice("w", i, F.lit(length)), " "), 256)))).alias("k", "window"))
    first = single.groupBy("window").agg(F.min("doc").alias("first"))
    by_window = (single.join(first, "window").groupBy("anchor", "id").agg(F.array_sort(F.collect_list(F.struct("k", "first"))).alias("f"))
                 .select("anchor", "id", F.transform("f", lambda x: x["first"]).alias("firsts")))
    return by_index.unionAll(by_window)


def repeated_starts(docs: DataFrame, length: int = LENGTH, shard_words: int = SHARD_WORDS, busy: int = BUSY) -> DataFrame:
    """(``doc``, ``row``, ``starts``): where windows of ``docs`` start that also start in earlier documents."""
    met = stored(anchored(docs, length), "substring-segments")
    repeated = met.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo <> hi").select("anchor")
    places = stored(met.join(repeated, "anchor"), "substring-places")
    first = places.groupBy("anchor", "id").agg(F.min(F.struct("doc", "row", "at", "n")).alias("f")).select("anchor", "id", "f.*")
    distinct = stored(passages(docs, first, length), "substring-distinct")
    firsts = stored(first_documents(distinct, length, shard_words, busy), "substring-firsts")
    earliest = firsts.withColumn("low", F.array_min("firsts"))
    later = places.select("doc", "row", "at", "anchor", "id").join(earliest, ["anchor", "id"]).filter("low < doc").select(
        "doc", "row", F.filter(F.transform("firsts", lambda f, k: F.when(f < F.col("doc"), F.col("at") + k)), lambda x: x.isNotNull()).alias("starts"))
    return later.groupBy("doc", "row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     shard_words: int = SHARD_WORDS, busy: int = BUSY) -> DataFrame:
    """(``doc_id``, ``n_words``, ``n_removed``, ``kept``, ``kept_sha256``) for every row of ``docs``.

    A word goes if a window of ``length`` words over it also starts in a document with a smaller id.
    ``kept`` has the other words joined by one space. Null, empty and short texts lose nothing; rows that
    repeat an id don't take words from each other; a null id counts as the largest.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    covered = repeated_starts(plain, length, shard_words, busy)
    joined = _with_row(plain).join(covered, (F.col("_row") == F.col("row")) & (F.col("_doc") == F.col("doc")), "left").select("doc_id", "packed", "starts")

    def make():
        def step(ids, packed, starts):
            n, removed, kept = [], [], []
            for data, at in zip(packed, starts, strict=True):
                words = _unpack(data).split()
                gone = np.zeros(len(words) + 1, np.int32)
                if at:
                    np.add.at(gone, at, 1)
                    np.add.at(gone, np.array(at) + length, -1)
                gone = np.cumsum(gone[: len(words)]) > 0
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if at else words
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            return ids, n, removed, [k.decode() for k in kept], [hashlib.sha256(k).hexdigest() for k in kept]

        return step

    return map_rows(joined, make, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


#: Same rows from all windows.
ORACLE_SQL = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, p, w[p:p+12] AS win FROM w, unnest(generate_series(1, len(w) - 12)) AS s(p)),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY win) AS low FROM g),
c AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + 13)))) AS gone FROM f WHERE low < doc_id GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w) AS n, len(coalesce(c.gone, [])) AS removed,
             CASE WHEN c.gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(c.gone, i)), lambda i: w[i]) END AS kept
      FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
