"""Packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import struct
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm import bpe
from accordant.llm.text import map_rows, stored

CAPACITY = 2048
#: Pieces that one deme packs, and islands that pack them apart from each other before elites migrate.
DEME, ISLANDS = 3_000, 2
POPULATION, GENERATIONS = 3, 3
#: A bin filled to this share of the capacity is kept; the pieces of others are dealt to new demes.
WELL_FILLED = 0.998


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The token pieces of every row: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its ids followed by id 0, so a null or empty text has one id. Only longer documents are
    cut, so that all pieces but the first have ``capacity`` ids.
    """
    file = path or bpe.default_path()

    def make():
        fst = bpe.Transducer(file, bpe.packed, limit=250_000)
        inside, special, end = fst.__getitem__, struct.pack("<I", bpe.SPECIAL_ID), struct.pack("<I", 0)

        def ids_of(part: str) -> bytes:
            head, *rest = bpe.symbols(part)
            return (fst.start(head) if head else b"") + b"".join(map(inside, rest))

        def step(ids, texts):
            out = []
            for i, text in zip(ids, texts, strict=True):
                data = special.join(map(ids_of, (text or "").split(bpe.SPECIAL))) + end
                n = len(data) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                out += [(i, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            return tuple(map(list, zip(*out))) if out else ([],) * 5

        return step

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make,
                    "doc_id long, piece int, start long, length long, ids_crc32 long", rows=128)


class Bins:
    """Bins with best-fit lookup: bins by free space, and a bit for every space in use."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.free = capacity, [], []
        self.by_space = [[] for _ in range(capacity + 1)]
        self.spaces = 0

    def _file(self, b: int) -> None:
        self.by_space[self.free[b]].append(b)
        self.spaces |= 1 << self.free[b]

    def add_bin(self, items: list[int], lengths: list[int]) -> None:
        self.items.append(list(items))
        self.free.append(self.capacity - sum(lengths[i] for i in items))
        self._file(len(self.items) - 1)

    def best_fit(self, item: int, length: int) -> None:
        fitting = self.spaces >> length
        if not fitting:
            self.items.append([item])
            self.free.append(self.capacity - length)
            self._file(len(self.items) - 1)
            return
        space = length + (fitting & -fitting).bit_length() - 1
        b = self.by_space[space].pop()
        if not self.by_space[space]:
            self.spaces ^= 1 << space
        self.items[b].append(item)
        self.free[b] -= length
        self._file(b)


def best_fit_decreasing(order: list[int], lengths: list[int], capacity: int) -> list[list[int]]:
    bins = Bins(capacity)
    for i in order:
        bins.best_fit(i, lengths[i])
    return bins.items


def fitness(solution: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean square of the fill)."""
    return -len(solution), sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in solution) / max(1, len(solution))


def crossover(host: list[list[int]], donor: list[list[int]], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """``host`` with whole well-filled bins of ``donor``: host bins that repeat an item go, and the items
    displaced by that are put back best-fit, longest first."""
    ranked = sorted(donor, key=lambda b: -sum(lengths[i] for i in b))
    full = [b for b in ranked if sum(lengths[i] for i in b) >= WELL_FILLED * capacity] or ranked[: len(ranked) // 2]
    injected = [b for b in full if rng.random() < 0.7]
    taken = {i for b in injected for i in b}
    bins, displaced = Bins(capacity), []
    for b in injected:
        bins.add_bin(b, lengths)
    worst = capacity * (1 - 0.5 * rng.random())
    for b in host:
        if taken.isdisjoint(b) and sum(lengths[i] for i in b) >= worst:
            bins.add_bin(b, lengths)
        else:
            displaced += [i for i in b if i not in taken]
    for i in sorted(displaced, key=lambda i: (-lengths[i], rng.random())):
        bins.best_fit(i, lengths[i])
    return bins.items


def evolve(lengths: list[int], seeds: list[list[list[int]]], capacity: int, rng: random.Random,
           population: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """Best packing found from ``seeds`` (elites of other islands) and fresh best-fit solutions."""
    ideal = -(-sum(lengths) // capacity)
    people = list(seeds)
    while len(people) < max(population, len(seeds)):
        noise = 0.0 if not people else 0.15
        order = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random()))
        people.append(best_fit_decreasing(order, lengths, capacity))
    score = lambda s: fitness(s, lengths, capacity)
    people = sorted(people, key=score, reverse=True)
    for _ in range(generations):
        if len(people[0]) <= ideal:
            break
        children = [crossover(*rng.sample(people, 2), lengths, capacity, rng) for _ in range(len(people))] if len(people) > 1 else []
        people = sorted([*people, *children], key=score, reverse=True)[: len(people)]
    return people[0]


def _pack_level(items: DataFrame, capacity: int, demes: int, islands: int, level: int) -> DataFrame:
    """``items`` (``uid``, ``length``, columns) with ``deme``, ``bin`` and ``filled``, by two rounds: islands evolve
    each deme apart; then their elites migrate to its home island, which breeds and answers."""
    dealt = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(demes)).alias("deme"))
    first = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.lit(-1).cast("long").alias("bin"))
    schema = "uid long, length long, deme long, island int, bin long"

    def solve(frame: pd.DataFrame, home: bool) -> pd.DataFrame:
        frame = frame.sort_values(["island", "uid"])
        origins = [g for _, g in frame.groupby("island", sort=True)]
        base = origins[0]
        lengths = base["length"].tolist()
        seeds = []
        for g in origins if home else []:
            bins: dict[int, list[int]] = {}
            for i, b in enumerate(g["bin"].tolist()):
                bins.setdefault(b, []).append(i)
            seeds.append(list(bins.values()))
        deme, island = int(base["deme"].iloc[0]), int(base["island"].iloc[0])
        best = evolve(lengths, seeds, capacity, random.Random(f"{level}-{deme}-{island}-{home}"))
        place = [0] * len(lengths)
        for k, b in enumerate(best):
            for i in b:
                place[i] = k
        return base.assign(bin=place)

    elites = first.groupBy("deme", "island").applyInPandas(lambda f: solve(f, False), schema)
    return elites.groupBy("deme").applyInPandas(lambda f: solve(f, True), schema)


def pack(items: DataFrame, capacity: int = CAPACITY, deme: int = DEME, islands: int = ISLANDS) -> DataFrame:
    """(``uid``, ``sequence_id``, ``offset``) for ``items`` (``uid`` unique, ``length`` 1 to ``capacity``).

    Full pieces are sequences by themselves. Others are dealt by hash into demes of about ``deme`` pieces,
    whatever their number; the well-filled bins of each level stay, and the pieces of the others are dealt
    again to fewer demes, until one deme is left or a level saves no sequence.
    """
    whole = items.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left, done = items.filter(F.col("length") < capacity).select("uid", "length"), [whole]
    left = stored(left, "packing-left")
    level, before = 0, None  # bins that the pieces left had at the level before, and how many
    while n := left.count():
        demes = max(1, round(n / deme))
        placed = stored(_pack_level(left, capacity, demes, islands, level), "packing-level")
        fill = placed.groupBy("deme", "bin").agg(F.collect_list(F.struct("length", "uid")).alias("of"), F.sum("length").alias("filled")).withColumn("level", F.lit(level))
        fill = stored(fill, "packing-fill")
        saved = before[1] - fill.count() if before else 1
        if saved < 0:
            fill = before[0]
        last = demes == 1 or saved <= 0
        kept = fill if last else fill.filter(F.col("filled") >= WELL_FILLED * capacity)
        member = F.inline(F.transform(F.sort_array("of"), lambda m, i: F.struct(m["uid"].alias("uid"), F.aggregate(
            F.slice(F.sort_array("of"), F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("offset"))))
        # ids of sequences: a negative number made of level, deme and bin, so none meets the uid of a full piece
        number = (-((F.col("level") + 1) * F.lit(1 << 54) + F.col("deme") * (1 << 24) + F.col("bin"))).alias("sequence_id")
        done.append(kept.select(number, member).select("uid", "sequence_id", "offset"))
        if last:
            break
        rest = fill.filter(F.col("filled") < WELL_FILLED * capacity)
        level, before = level + 1, (rest, rest.count())
        left = stored(rest.select(F.inline("of")).select("uid", "length"), "packing-left")
    return reduce(DataFrame.unionAll, done)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row with its sequence and its offset there; repeated rows are packed each.

    An empty table gives no rows. A null id is carried along. Texts are read once; only pieces' numbers
    are stored and shuffled.
    """
    cut = stored(pieces(docs, id_col, text_col, path, capacity), "packing-pieces")
    items = stored(cut.withColumn("uid", F.monotonically_increasing_id()), "packing-items")
    where = pack(items.select("uid", "length"), capacity)
    return items.join(where, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
