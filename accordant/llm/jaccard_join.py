"""Exact self-join on the Jaccard similarity of word shingles, with adaptive multi-match prefixes.

The shingles of a set are put in one order for the whole corpus, rarest first as far as a fixed-size
sketch of document frequencies can tell (any total order is right; the sketch only makes it cheap). With
threshold t, two similar sets share at least l shingles among their first n - ceil(t n) + l ones, for any
l. Each set picks its own l by the estimated cost of its candidates, and a pair is verified only if it
shares as many as the sizes of both and the prefix that ends earlier call for, never fewer than its l.
Sets that are equal are one node, so copies are never paired.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.llm.components import connected_components
from accordant.llm.text import LOWER, WordHashes, gram_hashes, map_rows, stored

#: Cells of the frequency sketch.
CELLS = 1 << 22
#: Tokens of a set up to which its postings carry them all, so that a pair is met once.
NARROW = 512
#: Cost of verifying one candidate, and of posting one shingle (written, shuffled and sorted), in postings read.
VERIFY, POST = 20.0, 200.0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def shingles(words: list[bytes], size: int) -> set:
    """Distinct runs of ``size`` words; the whole sequence if it is shorter; none without words."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def shingle_hashes(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(hashes.of(words), min(size, len(words))) ^ np.uint64(0 if len(words) >= size else len(words)))


def set_key(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def members_and_sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """One pass over the texts: ``doc_id``, ``n_shingles``, ``key`` and ``node`` of every row (key and node are
    null for empty sets), and for each task one more row with its compressed part of the ``sketch``."""
    def make():
        counts, hashes = np.zeros(CELLS, np.uint32), WordHashes()

        def step(ids, texts):
            sets = [shingle_hashes(words_of(t), size, hashes) for t in texts]
            cells = np.concatenate(sets) & np.uint64(CELLS - 1) if sets else np.empty(0, np.uint64)
            np.add.at(counts, cells.astype(np.int64), 1)
            keys = [set_key(h) if len(h) else None for h in sets]
            return ids, [len(h) for h in sets], keys, [node_of(k) if k else None for k in keys], [None] * len(ids)

        step.last = lambda: ([None], [None], [None], [None], [zlib.compress(counts.tobytes(), 1)])
        return step

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make,
                    "doc_id long, n_shingles long, key binary, node long, sketch binary", rows=1024)


def node_of(key: bytes) -> int:
    """Half of a key, as a number: stands for the set in postings and candidates, never in results."""
    return int.from_bytes(key[:8], "little", signed=True)


def frequency_classes(partial: DataFrame) -> np.ndarray:
    """Eighths of a power of two of the summed ``sketch`` counts: ``CELLS`` bytes.

    Compressed partial sums meet in a tree, so what reaches the driver has a fixed size.
    """
    def add(a: bytes, b: bytes) -> bytes:
        return zlib.compress((_cells(a) + _cells(b)).tobytes(), 1)

    parts = partial.filter("sketch IS NOT NULL").select("sketch").rdd.map(lambda r: bytes(r[0]))
    total = np.zeros(CELLS, np.uint32) if parts.isEmpty() else _cells(parts.treeReduce(add, 3))
    return np.minimum(8 * np.log2(total + 1.0), 255).astype(np.uint8)


def _cells(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint32)


def prefix(h: np.ndarray, sketch: np.ndarray, need: Callable[[int], int]) -> tuple[np.ndarray, int, int]:
    """The shingles to post for a set, how many more than the shortest prefix, and the place of the last
    one in the order of the corpus (its top 63 bits).

    For every l the postings to write are as many as the prefix is long, those to read its estimated frequencies, and the
    candidates are at most the latter divided by l; l with the least cost wins.
    """
    cell = sketch[h & np.uint64(CELLS - 1)]
    order = np.lexsort((h, cell))
    n, c = len(h), need(len(h))
    others = np.cumsum(np.exp2(cell[order] / 8.0) - 1.0)[n - c :]
    more = np.arange(1, c + 1)
    at = 1 + int(np.argmin(POST * more + others * (1 + VERIFY / more**2)))
    posted = order[: n - c + at]
    return h[posted], at, int(cell[posted[-1]]) << 55 | int(h[posted[-1]]) >> 9


def postings(docs: DataFrame, text_col: str, size: int, sketch: np.ndarray, need: Callable[[int], int]) -> DataFrame:
    """(``token``, ``node``): the prefix of every set, and a row without a token for each set with its
    ``size``, number of ``posted`` tokens and ``last`` place. Of equal sets in one task, the first posts."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # CELLS bytes

    def make():
        hashes, sketch, seen = WordHashes(), shared.value, set()

        def step(texts):
            tokens, nodes, facts = [], [], []
            for text in texts:
                h = shingle_hashes(words_of(text), size, hashes)
                if not len(h) or (key := set_key(h)) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(key)
                posted, _, last = prefix(h, sketch, need)
                tokens += [*posted.view(np.int64).tolist(), None]
                nodes += [node_of(key)] * (len(posted) + 1)
                facts += [(None, None, None)] * len(posted) + [(len(h), len(posted), last)]
            return tokens, nodes, *(map(list, zip(*facts)) if facts else ([], [], []))

        return step

    return map_rows(docs.select(F.col(text_col).cast("string")), make, "token long, node long, size int, posted int, last long")


def required_overlap(numerator: int, denominator: int) -> Column:
    """Shingles that sets of sizes ``x_size`` and ``y_size`` must share to reach the threshold."""
    total = numerator + denominator
    return F.floor((F.lit(numerator).cast("long") * (F.col("x_size") + F.col("y_size")) + (total - 1)) / total)


def of_earlier(x: Column, y: Column) -> Column:
    """The value of the side whose prefix ends earlier in the order; the greater one if they end together.

    All shingles that this side has posted and the other contains are posted by the other, too. So they
    share what they share in prefixes, and at most what this side has not posted.
    """
    return (F.when(F.col("x_last") < F.col("y_last"), x).when(F.col("x_last") > F.col("y_last"), y).otherwise(F.greatest(x, y)))


def texts_of(nodes: DataFrame, docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(``node``, ``key``, ``text``): one text for each set of the given nodes.

    A set that only rows without an id have is not found, and links nothing.
    """
    wanted = nodes.join(rows.filter("key IS NOT NULL").groupBy("node", "key").agg(F.min("doc_id").alias("_doc")), "node")
    found = (docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("text")).join(wanted, "_doc")
             .dropDuplicates(["_doc", "node", "key", "text"]))

    def make():
        hashes = WordHashes()

        def step(nodes, keys, texts):  # rows that repeat an id with another text are left out
            keep = [i for i, t in enumerate(texts) if set_key(shingle_hashes(words_of(t), size, hashes)) == bytes(keys[i])]
            return [[c[i] for i in keep] for c in (nodes, keys, texts)]

        return step

    return map_rows(found.select("node", "key", "text"), make, "node long, key binary, text string")


def verify(pairs: DataFrame, docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, size: int, numerator: int, denominator: int) -> DataFrame:
    """Of the pairs of nodes (``a``, ``b``), those whose shingle sets, taken from the texts anew, reach the
    threshold, with the keys of the sets (``a_key``, ``b_key``)."""
    def make():
        last = [None, None]

        def step(a, b, a_key, b_key, left, right):
            keep = []
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                if last[0] != x:
                    last[:] = x, shingles(words_of(x), size)
                other = shingles(words_of(y), size)
                shared = len(last[1] & other)
                if denominator * shared >= numerator * (len(last[1]) + len(other) - shared):
                    keep.append(i)
            return [[c[i] for i in keep] for c in (a, b, a_key, b_key)]

        return step

    pairs = stored(pairs, "jaccard-pairs")
    texts = stored(texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, rows, id_col, text_col, size), "jaccard-texts")

    def side(name, text):
        return texts.select(F.col("node").alias(name), F.col("key").alias(f"{name}_key"), F.col("text").alias(text))

    with_texts = pairs.join(side("b", "right"), "b").join(side("a", "left"), "a")
    return map_rows(with_texts.select("a", "b", "a_key", "b_key", "left", "right"), make, "a long, b long, a_key binary, b_key binary", rows=64)


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, numerator: int = 80,
                   denominator: int = 100) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) for every row of ``docs``.

    Two documents link when ``denominator`` times the size of the intersection of their shingle sets is at
    least ``numerator`` times that of their union. ``component_id`` is the smallest id reachable by links,
    itself included. Null, empty and blank texts have an empty set and no links, repeated rows link with
    each other, and a null id counts as none: such a row gets the smallest id of its component, if any.

    First every set is verified against one hub of its shingles (the one with which most are shared),
    which joins a group of near copies in as many steps as it has members; what these links connect is a star.
    Then only sets in different stars are paired: for each shingle, those outside its largest star
    with all others, as far as their sizes, what they share in prefixes and what they have beyond can reach
    the threshold. A pair is met once, at the first shingle that both have posted.
    """
    def need(n: int) -> int:
        return -(-numerator * n // denominator)

    first = stored(members_and_sketch(docs, id_col, text_col, size), "jaccard-members")
    rows = first.filter("sketch IS NULL").drop("sketch")
    posted = stored(postings(docs, text_col, size, frequency_classes(first), need), "jaccard-postings")
    tokens = posted.filter("token IS NOT NULL").select("token", "node")
    shared = tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("top")).filter("low <> top").select("token")
    live = stored(tokens.join(shared, "token").distinct(), "jaccard-live")

    # the most that a set can share: its posted shingles that others posted, and those not posted
    facts = posted.filter("token IS NULL").groupBy("node").agg(F.min("size").alias("size"), F.min("posted").alias("posted"), F.min("last").alias("last"))
    reach = live.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    facts = stored(facts.join(reach, "node").select("node", "size", "last", (F.col("size") - F.col("posted")).alias("rest"), "n",
                                                    (F.col("posted") - F.col("n")).alias("alone")), "jaccard-facts")
    # the hub of a shingle is the set with the fewest shingles of its own: the middle of a group of copies
    hubs = live.join(facts.select("node", "alone"), "node").groupBy("token").agg(F.min(F.struct("alone", "node")).alias("h")).select("token", F.col("h.node").alias("hub"))

    def side(name):
        return facts.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "last", "rest", "n")])

    overlap = required_overlap(numerator, denominator)
    fitting = (F.least("x_size", "y_size") * denominator >= F.greatest("x_size", "y_size") * numerator) & (
        of_earlier(F.col("x_n") + F.col("x_rest"), F.col("y_n") + F.col("y_rest")) >= overlap)
    missing = overlap - of_earlier(F.col("x_rest").cast("long"), F.col("y_rest").cast("long"))  # to be shared in the prefixes

    def toward(sets: DataFrame, hubs: DataFrame) -> DataFrame:
        """Verified links (``a``, ``b``, with keys) of each set with the one hub of its tokens that it shares most with."""
        met = sets.join(hubs, "token").filter("node <> hub").groupBy(F.col("node").alias("x"), F.col("hub").alias("y")).agg(F.count(F.lit(1)).alias("n"))
        met = met.join(side("x"), "x").join(side("y"), "y").filter(fitting & (2 * F.col("n") >= missing))
        best = met.groupBy("x").agg(F.max(F.struct("n", "y")).alias("best")).select(F.col("best.y").alias("a"), F.col("x").alias("b"))
        return stored(verify(best, docs, rows, id_col, text_col, size, numerator, denominator), "jaccard-stars")

    links = toward(live, hubs)
    star_of = connected_components(links, "a", "b").select("node", F.col("root").alias("star"))
    starred = live.join(star_of, "node", "left").select("token", "node", F.coalesce("star", "node").alias("star"))
    per_star = starred.groupBy("token", "star").agg(F.count(F.lit(1)).alias("n"))
    mixed = per_star.groupBy("token").agg(F.max(F.struct("n", "star")).alias("top"), F.count(F.lit(1)).alias("stars")).filter("stars > 1")
    before = stored(starred.join(mixed.select("token", F.col("top.star").alias("top")), "token"), "jaccard-apart")
    # each posting of a set carries 32-bit digests of all its tokens in the join, unless they are very many
    digest = F.hash("token")
    held = before.groupBy("node").agg(F.array_sort(F.collect_set(digest)).alias("tokens"), F.count(F.lit(1)).alias("all"))
    held = held.select("node", F.when(F.col("all") <= NARROW, F.col("tokens")).alias("tokens"), (F.col("all") - F.size("tokens")).cast("int").alias("lost"))
    apart = stored(before.join(facts.join(held, "node"), "node"), "jaccard-paired")

    def end(name):
        return apart.select(F.col("token").alias(f"{name}_token"), F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "last", "rest", "n", "star", "tokens", "lost")],
                            (F.col("star") == F.col("top")).alias(f"{name}_major"))

    # two sets meet at the first tokens they share (three, lest digests that are equal by chance stand before them), and
    # what they share is counted there; sets with very many tokens meet at every one
    shared = F.array_intersect("x_tokens", "y_tokens")
    number = F.size(shared) + F.col("x_lost") + F.col("y_lost")
    wide = F.col("x_tokens").isNull() | F.col("y_tokens").isNull()
    met = end("x").filter("NOT x_major").join(end("y"), (F.col("x_token") == F.col("y_token")) & (F.col("x_star") != F.col("y_star"))
                                              & (F.col("y_major") | (F.col("x") < F.col("y"))) & fitting
                                              & (wide | (F.array_contains(F.slice(shared, 1, 3), F.hash("x_token")) & (number >= missing))))
    candidates = (met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), missing.alias("missing"),
                             F.when(wide, 1).otherwise(0).alias("one"), F.when(~wide, number).otherwise(0).alias("counted"))
                  .groupBy("a", "b").agg((F.sum("one") + F.max("counted")).alias("n"), F.min("missing").alias("missing")).filter("n >= missing").select("a", "b"))
    links = links.unionAll(verify(candidates, docs, rows, id_col, text_col, size, numerator, denominator))

    component = connected_components(links, "a_key", "b_key").select(F.col("node").alias("key"), "root")
    smallest = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("low")).join(component, "key", "left").withColumn("root", F.coalesce("root", "key"))
    by_root = smallest.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = smallest.join(by_root, "root").select("key", "component_id")
    return rows.join(by_key, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


#: Same rows by comparing every pair of documents that share a shingle.
ORACLE_SQL = """
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) END AS s FROM w),
k AS (SELECT DISTINCT s.s AS s, min(doc_id) OVER (PARTITION BY s) AS low FROM (SELECT doc_id, list_sort(s) AS s FROM s) s WHERE len(s.s) > 0),
e AS (SELECT low, len(s) AS n, unnest(s) AS g FROM k),
p AS (SELECT a.low AS a, b.low AS b FROM e a JOIN e b ON a.g = b.g AND a.low < b.low AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
      GROUP BY a.low, b.low, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT low AS node, low AS root FROM k UNION SELECT r.node, l.b FROM r JOIN l ON r.root = l.a),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id
FROM s LEFT JOIN k ON list_sort(s.s) = k.s LEFT JOIN c ON c.node = k.low
"""
