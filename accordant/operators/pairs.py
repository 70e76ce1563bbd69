"""Pair generation, blocking and leakage checks.

No operator here enumerates the pairs within a group: positives come from a fixed list of source
combinations per project, negatives are drawn by ranking rows in hashed order and pairing
neighbours, and block sizes are counted, not expanded.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.ids import hash_int, packed_id, pair_key, shuffle_hash, unpacked_id, zero_pad
from accordant.functions.text import block_key, choose_column
from accordant.operators.ranking import hash_neighbours, ordered_rank
from accordant.session import stored

COLUMNS = ["pair_id", "source_a", "source_b", "record_a_id", "record_b_id", "master_id_a", "master_id_b", "label"]
DRAWN = COLUMNS[1:-1]
# Number ranges of the three pair kinds.
NUMBER_OFFSET = {"positive": 0, "negative": 100000, "hard": 200000}
RANGE = 100000
HARD_SOURCES = ["crm", "erp", "partner"]


def record_map(records: DataFrame) -> DataFrame:
    """(source, record, project) per record; the project is the id the source reports."""
    return records.select(F.col("source_system").alias("source_name"), F.col("record_id").alias("source_record_id"),
                          F.col("record_id").alias("master_project_id"))


def presence(master: DataFrame, records: DataFrame) -> DataFrame:
    """Projects with one flag per source that holds a record of them.

    Both sides are as long as the projects, so they are merged: by its compressed file and the columns in use Spark takes
    a stored table of millions of ids for small, and would broadcast it.
    """
    flags = (records.where(F.col("record_id").isNotNull()).groupBy(F.col("record_id").alias("project_id"))
             .agg(*[F.max(F.col("source_system") == s).alias(s) for s in policy.SOURCES]))
    return master.join(flags.hint("merge"), "project_id")


def with_pair_id(df: DataFrame) -> DataFrame:
    return df.withColumn("pair_id", pair_key(F.col("source_a"), F.col("record_a_id"), F.col("source_b"), F.col("record_b_id")))


def _finish(df: DataFrame, label: int, also: list[str] = ()) -> DataFrame:
    return with_pair_id(df).withColumn("label", F.lit(label)).select(*COLUMNS, *also)


def positive_pairs(master: DataFrame, records: DataFrame) -> DataFrame:
    """Every combination of two sources that both hold a record of the project."""
    combos = [F.when(F.col(a) & F.col(b), F.struct(F.lit(a).alias("source_a"), F.lit(b).alias("source_b")))
              for a, b in combinations(policy.SOURCES, 2)]
    rows = presence(master, records).select(
        "project_id", F.explode(F.array_compact(F.array(*combos))).alias("s"))
    ids = [F.col("project_id").alias(c) for c in ("record_a_id", "record_b_id", "master_id_a", "master_id_b")]
    return _finish(rows.select("s.*", *ids), 1)


def positives_of(folded: DataFrame) -> DataFrame:
    """Like ``positive_pairs`` from folded records, with the structs ``_a`` and ``_b`` of both: nothing is moved."""
    combos = [F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(F.lit(a).alias("source_a"), F.lit(b).alias("source_b"), F.col(a).alias("_a"), F.col(b).alias("_b")))
              for a, b in combinations(policy.SOURCES, 2)]
    rows = folded.select("record_id", F.explode(F.array_compact(F.array(*combos))).alias("s"))
    ids = [F.col("record_id").alias(c) for c in ("record_a_id", "record_b_id", "master_id_a", "master_id_b")]
    return _finish(rows.select("s.*", *ids), 1, ["_a", "_b"])


def _slim(folded: DataFrame) -> DataFrame:
    """Folded records in matching form; a field of a later source is null if it equals the first source's."""
    first, *later = policy.SOURCES

    def field(s: str, f: str) -> Column:
        same = F.col(first).isNotNull() & F.col(f"{s}.{f}").eqNullSafe(F.col(f"{first}.{f}"))
        return F.when(~same, F.struct(F.col(f"{s}.{f}").alias("v"))).alias(f) if f == "system_size_kw" else F.when(~same, F.col(f"{s}.{f}")).alias(f)

    return folded.withColumns({s: F.when(F.col(s).isNotNull(), F.struct(*[field(s, f) for f in policy.FEATURE_COLUMNS])) for s in later})


def _whole(at: str = "") -> dict[str, Column]:
    """The sources' structs of a row of ``_slim``, or of the one in the struct ``at``."""
    first, *later = policy.SOURCES
    mine = F.col(f"{at}{first}")

    def field(s: str, f: str) -> Column:
        held = F.col(f"{at}{s}.{f}")
        return (F.when(held.isNull(), mine[f]).otherwise(held["v"]) if f == "system_size_kw" else F.coalesce(held, mine[f])).alias(f)

    return {first: mine} | {s: F.when(F.col(f"{at}{s}").isNotNull(), F.struct(*[field(s, f) for f in policy.FEATURE_COLUMNS])) for s in later}


def neighbours_of(folded: DataFrame, seed: int = 42) -> DataFrame:
    """Folded records with ``next``, the struct of the following one in hashed order; records travel with it.

    Records that come along are in matching form, so no text is null; they are moved without what two sources both say.
    """
    if not set(policy.SOURCES) <= set(folded.columns):
        return hash_neighbours(folded, [], "record_id", seed)
    paired = hash_neighbours(_slim(folded.select("record_id", *policy.SOURCES)), [], "record_id", seed)
    following = F.struct(F.col("next.record_id").alias("record_id"), *[c.alias(s) for s, c in _whole("next.").items()])
    return paired.select("record_id", *[c.alias(s) for s, c in _whole().items()], following.alias("next"))


def moved_by_pair(df: DataFrame, numbers: list[str]) -> DataFrame:
    """``numbers`` of pairs, partitioned by ``_pair``, the id as ``join_pairs`` moves it, in place of ``pair_id``.

    Tables that are made of the result share its one shuffle. Numbers travel as one array, so that all of
    them move the same columns, whichever they use.
    """
    moved = df.select(packed_id(F.col("pair_id")).alias("_pair"), F.array(*[F.col(c).cast("double") for c in numbers]).alias("_n")).repartition("_pair")
    return moved.select("_pair", *[F.col("_n")[i].alias(c) for i, c in enumerate(numbers)])


def join_pairs(left: DataFrame, right: DataFrame, how: str = "inner", *more: DataFrame) -> DataFrame:
    """Join on ``pair_id``; ids are moved as bytes of their digests, which take half the room of their texts.

    ``more`` tables are joined in turn: rows that are already together, also those of ``moved_by_pair``, are not moved again.
    """
    joined, *others = (df if "_pair" in df.columns else df.withColumn("_pair", packed_id(F.col("pair_id"))).drop("pair_id") for df in (left, right, *more))
    for other in others:
        joined = joined.join(other, "_pair", how)
    return joined.withColumn("_pair", unpacked_id(F.col("_pair"))).withColumnRenamed("_pair", "pair_id")


def negatives_of(paired: DataFrame, seed: int = 42) -> DataFrame:
    """Like ``negative_pairs`` from folded records with their ``next``, with the structs ``_a`` and ``_b`` of both."""
    return negatives_of_draws(draws_of(paired, seed))


def negatives_of_draws(draws: DataFrame) -> DataFrame:
    """The pairs of those draws whose two records are there."""
    return _finish(draws.where(F.col("_a").isNotNull() & F.col("_b").isNotNull()), 0, ["_a", "_b"])


def draws_of(paired: DataFrame, seed: int = 42) -> DataFrame:
    """Every id with its following one, the sources drawn for the two, and their structs ``_a`` and ``_b``, null where a source has none."""
    sides = paired.select(F.col("record_id").alias("id_a"), F.col("next.record_id").alias("id_b"),
                          *[F.col(s).alias(f"{s}_record_a") for s in policy.SOURCES], *[F.col(f"next.{s}").alias(f"{s}_record_b") for s in policy.SOURCES])
    payload = [choose_column(F.col(f"source_{side}"), {s: F.col(f"{s}_record_{side}") for s in policy.SOURCES}).alias(f"_{side}") for side in "ab"]
    return _drawn_sources(sides, policy.SOURCES, seed).select(*DRAWN, *payload)


def _drawn_sources(df: DataFrame, sources: list[str], seed: int) -> DataFrame:
    """Two different sources per row, chosen by hash, with the ids of its pair."""
    text = F.concat_ws("|", "id_a", "id_b")
    n = len(sources)
    first = hash_int(text, seed, n)
    second = (first + 1 + hash_int(text, seed + 1, n - 1)) % n
    names = F.array(*[F.lit(s) for s in sources])
    return df.withColumns({
        "source_a": F.get(names, first.cast("int")), "source_b": F.get(names, second.cast("int")),
        **{f"{kind}_{side}" + ("_id" if kind == "record" else ""): F.col(f"id_{side}") for kind in ("record", "master_id") for side in "ab"}})


def _draw_sources(df: DataFrame, sources: list[str], seed: int) -> DataFrame:
    """Two different sources per row, chosen by hash, kept when both hold the wanted record."""
    def held(side: str) -> Column:
        return reduce(lambda a, b: a | b,
                      [(F.col(f"source_{side}") == s) & F.col(f"{s}_{side}") for s in sources])

    return _drawn_sources(df, sources, seed).where(held("a") & held("b")).select(*DRAWN)


def _drawn(paired: DataFrame, carried: list[str]) -> DataFrame:
    """Row and successor as columns ending in _a and _b."""
    return paired.select(F.col("project_id").alias("id_a"), F.col("next.project_id").alias("id_b"),
                         *[F.col(c).alias(f"{c}_a") for c in carried], *[F.col(f"next.{c}").alias(f"{c}_b") for c in carried])


def negative_pairs(master: DataFrame, records: DataFrame, n_pairs: int | None = None, seed: int = 42) -> DataFrame:
    """Random pairs of different projects from different sources.

    Projects are put in hashed order and each is drawn with its successor; ``n_pairs`` stops after
    that many draws (draws whose record is missing are dropped, so fewer pairs may remain).
    """
    base = presence(master.select("project_id"), records)
    if n_pairs is not None:
        base = base.orderBy(shuffle_hash(F.col("project_id"), seed), "project_id").limit(n_pairs + 1)
    paired = hash_neighbours(stored(base), [], "project_id", seed)
    return _finish(_draw_sources(_drawn(paired, policy.SOURCES), policy.SOURCES, seed), 0)


def hard_negative_pairs(master: DataFrame, records: DataFrame, seed: int = 42) -> DataFrame:
    """Different projects that share the customer, the installer or the address.

    One equi-grouping per rule instead of an OR condition. Within a shared value each project is
    drawn with its successor in hashed order, so a value shared by a third of all projects gives
    as many draws as it has projects, spread over many tasks.
    """
    base = presence(master.select("project_id", "customer_name", "installer", "address"), records)
    shared = base.select("project_id", *HARD_SOURCES, F.explode(F.array(*[
        F.struct(F.lit(c).alias("rule"), F.col(c).alias("shared_value"))
        for c in ("customer_name", "installer", "address")])).alias("g")).select("project_id", *HARD_SOURCES, "g.*")
    paired = hash_neighbours(shared.where(F.col("shared_value").isNotNull()), ["rule", "shared_value"], "project_id", seed)
    drawn = _drawn(paired, HARD_SOURCES)
    flags = [F.first(f"{s}_{side}").alias(f"{s}_{side}") for s in HARD_SOURCES for side in "ab"]
    distinct = drawn.groupBy("id_a", "id_b").agg(*flags)
    return _finish(_draw_sources(distinct, HARD_SOURCES, seed), 0)


def numbered(pairs: DataFrame, kind: str, order: list[str]) -> DataFrame:
    """Dense ``PAIR-000001`` style numbers in ``order`` within the range of the pair kind.

    Ranges hold 100,000 numbers each; the numbers after the last range are dealt to the kinds in
    turn, so kinds never share a number, however many pairs they have.
    """
    ranked = ordered_rank(pairs.drop("pair_id"), [], order, name="_n")
    beyond = RANGE * len(NUMBER_OFFSET) + (F.col("_n") - RANGE - 1) * len(NUMBER_OFFSET) + NUMBER_OFFSET[kind] // RANGE + 1
    number = zero_pad(F.when(F.col("_n") <= RANGE, F.col("_n") + NUMBER_OFFSET[kind]).otherwise(beyond), 6)
    return ranked.withColumn("pair_id", F.concat(F.lit("PAIR-"), number)).drop("_n").select(*COLUMNS)


def with_block_keys(records: DataFrame) -> DataFrame:
    return records.withColumn("block_key", block_key("state", "city"))


def block_filter(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """Candidate pairs whose two records lie in the same block.

    ``keyed``: (record_id, block_key), one row per id. Two lookups by id instead of a join on the
    block key, so the size of a block does not matter. Pairs and ids are merged, never broadcast.
    """
    a = keyed.select(F.col("record_id").alias("master_id_a"), F.col("block_key").alias("block_a")).hint("merge")
    b = keyed.select(F.col("record_id").alias("master_id_b"), F.col("block_key").alias("block_b")).hint("merge")
    return (pairs.join(a, "master_id_a").join(b, "master_id_b").where(F.col("block_a") == F.col("block_b"))
            .withColumn("block_key", F.col("block_a")).select(*COLUMNS, "block_key"))


def _pairs_among(n: Column) -> Column:
    """n (n - 1) / 2 in whole numbers, of up to 38 digits."""
    wide = n.cast("decimal(19,0)")
    halved = F.when(n % 2 == 0, F.floor(wide / 2) * (wide - 1)).otherwise(F.floor((wide - 1) / 2) * wide)
    return halved.cast("decimal(38,0)")


def block_sizes(keyed: DataFrame) -> DataFrame:
    """Records and implied candidate pairs per block (arithmetic, nothing is expanded)."""
    sizes = keyed.where(F.col("block_key").isNotNull()).groupBy("block_key").agg(F.count("*").alias("records"))
    return sizes.withColumn("candidates", _pairs_among(F.col("records")))


def blocking_statistics(keyed: DataFrame) -> DataFrame:
    """Candidates before and after blocking and the reduction ratio."""
    total = F.sum("records")
    before = _pairs_among(total)
    return block_sizes(keyed).agg(
        F.count("*").alias("blocks"), total.alias("records"), F.max("records").alias("largest_block"),
        before.alias("candidates_before"), F.sum("candidates").alias("candidates_after"),
        F.round(1 - F.try_divide(F.sum("candidates").cast("double"), before.cast("double")), 6).alias("reduction_ratio"))


def candidate_recall(positives: DataFrame, blocked: DataFrame) -> DataFrame:
    """Share of the true pairs that blocking keeps."""
    kept = positives.select("pair_id").join(
        blocked.select("pair_id", F.lit(1).alias("hit")).hint("merge"), "pair_id", "left")
    return kept.agg(F.count("*").alias("true_pairs"), F.count("hit").alias("kept_pairs"),
                    F.round(F.try_divide(F.count("hit"), F.count("*")), 6).alias("recall"))


def leakage(pairs: DataFrame) -> DataFrame:
    """Labels that contradict the project ids."""
    same = F.col("master_id_a").eqNullSafe(F.col("master_id_b"))
    return pairs.agg(
        F.count_if((F.col("label") == 0) & same).alias("negatives_same_project"),
        F.count_if((F.col("label") == 1) & ~same).alias("positives_different_project"),
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))


def entity_ids(pairs: DataFrame) -> DataFrame:
    """All projects on either side of a pair."""
    return pairs.select(F.explode(F.array("master_id_a", "master_id_b")).alias("entity")).distinct()
