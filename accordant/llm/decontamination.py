"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching."""

from __future__ import annotations

import heapq
import re
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import PLAIN, WordHashes, gram_hashes, map_rows

#: Fewest consecutive words of a tile, and of a seed.
TILE = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.5
#: Words of benchmark items that one broadcast holds; more items take more passes.
INDEX_WORDS = 1_000_000


#: Scripts written without spaces, of which every character is a word: Thai, Lao, Khmer, Myanmar, Han, Kana and their kin.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation, so that case and marks don't hide a passage; characters of
    scripts without spaces are words."""
    low = (text or "").lower()
    if not low.isascii() and _UNSPACED.search(low):
        low = _UNSPACED.sub(r" \g<0> ", low)
    return low.encode().translate(PLAIN).split()


def greedy_tiles(item: list, doc: list, shortest: int = TILE) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles (item start, document start, length), longest first.

    Running Karp-Rabin: windows of the current search length over unmarked words are hashed, equal ones
    are compared and extended; a much longer match restarts the search at its length. Otherwise the matches are
    marked, longest first; of one that others have covered in part, what is left goes back among them if it is
    long enough. Then the search length shrinks, until ``shortest``. ``None`` in ``doc`` never matches,
    so it separates passages.
    """
    used_item, used_doc = [False] * len(item), [x is None for x in doc]
    tiles, size = [], max(shortest, len(item))
    while True:
        table: dict[int, list[int]] = {}
        for at, key in _windows(doc, used_doc, size):
            table.setdefault(key, []).append(at)
        found, longest = [], 0
        for p, key in _windows(item, used_item, size):
            for t in table.get(key, ()):
                n = _common(item, used_item, p, doc, used_doc, t)
                if n >= size:
                    found.append((-n, p, t))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        heapq.heapify(found)
        while found:
            n, p, t = heapq.heappop(found)
            free = _free_runs(used_item, p, used_doc, t, -n)
            if free == [(0, -n)]:
                used_item[p : p - n] = [True] * -n
                used_doc[t : t - n] = [True] * -n
                tiles.append((p, t, -n))
            else:
                for a, b in free:
                    if b - a >= size:
                        heapq.heappush(found, (a - b, p + a, t + a))
        if size == shortest:
            return tiles
        size = size // 2 if size > 2 * shortest else shortest


def _free_runs(used_item: list[bool], p: int, used_doc: list[bool], t: int, n: int) -> list[tuple[int, int]]:
    """Runs of a match of ``n`` words that no tile covers on either side."""
    runs, start = [], None
    for k in range(n + 1):
        free = k < n and not used_item[p + k] and not used_doc[t + k]
        if free and start is None:
            start = k
        elif not free and start is not None:
            runs.append((start, k))
            start = None
    return runs


def _windows(words, used, size, base=1_000_003, mod=(1 << 61) - 1):
    """(start, rolling hash) of the windows of unmarked words."""
    top, value, run = pow(base, size - 1, mod), 0, 0
    for i, w in enumerate(words):
        if used[i]:
            value = run = 0
            continue
        if run >= size:
            value = (value - hash(words[i - size]) * top) % mod
        value = (value * base + hash(w)) % mod
        run += 1
        if run >= size:
            yield i - size + 1, value


def _common(item, used_item, p, doc, used_doc, t):
    n = 0
    while p + n < len(item) and t + n < len(doc) and not used_item[p + n] and not used_doc[t + n] and item[p + n] == doc[t + n]:
        n += 1
    return n


class SeedIndex:
    """Seeds (windows of ``tile`` words) of some benchmark items, as sorted arrays."""

    def __init__(self, items: list[tuple[int, str]], tile: int):
        hashes = WordHashes()
        self.ids, self.words, seeds, owner, place = [], [], [], [], []
        self.short: dict[tuple, list] = {}
        for item_id, text in items:
            w = words_of(text)
            if 0 < len(w) < tile:
                self.short.setdefault(tuple(w), []).append(item_id)
            g = gram_hashes(hashes.of(w), tile)
            seeds.append(g)
            owner.append(np.full(len(g), len(self.ids), np.int64))
            place.append(np.arange(len(g)))
            self.ids.append(item_id)
            self.words.append(w)
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        seeds, owner, place = cat(seeds, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order]

    def shared(self, grams: np.ndarray) -> dict[int, tuple[list[int], set[int]]]:
        """Items with seeds among ``grams``: the document's seed starts and the item's."""
        lo = np.searchsorted(self.seeds, grams, "left")
        hit = np.flatnonzero(self.seeds[np.minimum(lo, len(self.seeds) - 1)] == grams) if len(self.seeds) else []
        found: dict[int, tuple[list[int], set[int]]] = {}
        for at in hit:
            for k in range(lo[at], np.searchsorted(self.seeds, grams[at], "right")):
                starts, places = found.setdefault(int(self.owner[k]), ([], set()))
                starts.append(int(at))
                places.add(int(self.place[k]))
        return found


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text: str = "text", tile: int = TILE, coverage: float = COVERAGE, index_words: int = INDEX_WORDS) -> DataFrame:
    """(``doc_id``, ``item_id``, ``n_tiles``, ``covered``, ``coverage``) for documents whose tiles cover an item.

    The benchmark is read in parts of about ``index_words`` words, each broadcast once and compared with
    every document in one pass without a shuffle. Items of fewer than ``tile`` words match documents of the
    same words and no others. Items without an id or with a repeated one take part each. Tiles may lie in any order, so reordered passages count alike.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    parts = max(1, -(-size // index_words))
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = [_pairs(texts, [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()], tile, coverage)
             for k in range(parts)]
    return reduce(DataFrame.unionAll, found)


def _pairs(texts: DataFrame, items: list, tile: int, coverage: float) -> DataFrame:
    shared_index = texts.sparkSession.sparkContext.broadcast(SeedIndex(items, tile))

    def make():
        hashes, index = WordHashes(), shared_index.value

        def one(words):
            if len(words) < tile:
                yield from ((item, 1, len(words), 1.0) for item in index.short.get(tuple(words), ()))
            for k, (starts, places) in index.shared(gram_hashes(hashes.of(words), tile)).items():
                item = index.words[k]
                need = coverage * len(item)
                if len({p + i for p in places for i in range(tile)}) < need:
                    continue
                passages, end = [], -1
                for s in sorted(set(starts)):
                    if s > end:
                        passages.append(None)
                        end = s
                    passages += words[end : s + tile]
                    end = max(end, s + tile)
                tiles = greedy_tiles(item, passages, tile)
                covered = sum(n for _, _, n in tiles)
                if covered >= need:
                    yield index.ids[k], len(tiles), covered, covered / len(item)

        def step(ids, rows):
            out = [(i, *pair) for i, text in zip(ids, rows, strict=True) for pair in one(words_of(text))]
            return tuple(map(list, zip(*out))) if out else ([],) * 5

        return step

    return map_rows(texts, make, "doc_id long, item_id long, n_tiles long, covered long, coverage double")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``contaminated``, ``n_items``, ``item_id`` and ``coverage`` of the best covered item.

    Null and empty texts are clean. A tie for the best item goes to the smallest id, items without an id
    come last and count as one. Rows that repeat an id are judged together; rows without an id each by its own
    text. An empty benchmark leaves all clean.
    """
    own = F.xxhash64(F.col(id_col).cast("string"), F.when(F.col(id_col).isNull(), F.col(text_col).cast("string")))
    pairs = contaminated_pairs(docs.select(own.alias("_row"), F.col(text_col).alias("_text")), benchmark, "_row", "_text", **options)
    none = F.lit((1 << 63) - 1)
    item = F.coalesce("item_id", none)
    best = pairs.groupBy(F.col("doc_id").alias("_row")).agg(F.max(F.struct("coverage", (-item).alias("item"))).alias("best"), F.countDistinct(item).alias("n_items"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), own.alias("_row")).join(best, "_row", "left").select(
        "doc_id", F.col("best").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.nullif(-F.col("best.item"), none).alias("item_id"), F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"))
