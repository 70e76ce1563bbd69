"""A stored review queue that is kept up to date with changed records.

The store holds a digest for each record id, the neighbour each id is drawn with for its negative pair, and the
scored pairs. A pair belongs to its first record. An update compares digests, works out which ids own a
pair that changed, scores the pairs of those owners only, and writes them as a new version beside the
old ones; a reader takes, for each owner, the rows of its latest version. Versions become visible by one
small commit that is written last, so a failed update changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant import policy
from accordant.operators import explain, features, pairs, queue
from accordant.operators.models import LinearModel
from accordant.session import durable, stored

#: Share of all owners in versions after the first beyond which a store is written anew.
REBUILD_SHARE = 0.25


def _read(spark: SparkSession, root: str, part: str, versions: list[int]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/{part}").parquet(*[f"{root}/{part}/version={v}" for v in versions])


def _commits(spark: SparkSession, root: str) -> list:
    """Commits from the last full build on: (version, full, owners, ids)."""
    rows = sorted(spark.read.json(f"{root}/commits").collect(), key=lambda r: r["version"])  # one row for a version
    start = max(i for i, r in enumerate(rows) if r["full"])
    return rows[start:]


def _commit(spark: SparkSession, root: str, version: int, full: bool, owners: int, ids: int) -> None:
    row = spark.createDataFrame([(version, full, owners, ids)], "version long, full boolean, owners long, ids long")
    row.coalesce(1).write.mode("append").json(f"{root}/commits")


def _digests(folded: DataFrame) -> DataFrame:
    """(``record_id``, ``digest``) of everything a pair takes from an id's records."""
    return folded.select("record_id", F.md5(F.to_json(F.struct(*policy.SOURCES))).alias("digest"))


def _scored(folded: DataFrame, negatives: DataFrame, model: LinearModel) -> DataFrame:
    """The pairs of folded records, and those with their neighbours, as queue rows."""
    keep = pairs.COLUMNS[1:-1]
    found = features.features_of(pairs.positives_of(folded), keep).unionByName(features.features_of(negatives, keep, mostly_equal=False))
    return queue.with_route(explain.explain_pairs(found), model.match_probability())


def build(records: DataFrame, model: LinearModel, root: str, version: int = 0) -> None:
    """Score all pairs of ``records`` into an empty store, or as a full new version of one."""
    _build(stored(features.folded_records(records)), model, root, version)


def _build(folded: DataFrame, model: LinearModel, root: str, version: int) -> None:
    draws = stored(pairs.draws_of(pairs.neighbours_of(folded)))  # of a neighbour, the one record it is drawn with
    rows = _scored(folded, pairs.negatives_of_draws(draws), model)
    rows.write.parquet(f"{root}/rows/version={version}")
    _digests(folded).write.parquet(f"{root}/digests/version={version}")
    draws.select(F.col("record_a_id").alias("record_id"), F.col("record_b_id").alias("next_id")).write.parquet(f"{root}/links/version={version}")
    _commit(folded.sparkSession, root, version, True, 0, folded.count())


def update(records: DataFrame, model: LinearModel, root: str, folded: DataFrame | None = None) -> dict[str, int]:
    """Bring the store to the state of ``records``, scoring only pairs whose records or drawing changed.

    Returns the number of changed ids, of owners written and of pairs scored. The cost is one fold of the records, a
    comparison of digests, and the pairs of the owners; links are drawn anew only if ids came or went. ``folded``: the
    stored ``folded_records`` of ``records``, where the caller has them.
    """
    spark = records.sparkSession
    commits = _commits(spark, root)
    base, version = commits[0]["version"], commits[-1]["version"] + 1
    versions = [c["version"] for c in commits]
    folded = stored(features.folded_records(records)) if folded is None else folded
    digests = _digests(folded)
    old = _latest(_read(spark, root, "digests", versions), "record_id").where("digest IS NOT NULL")
    both = digests.join(old.select("record_id", F.col("digest").alias("was")), "record_id", "full")
    changed = durable(both.where(~F.col("digest").eqNullSafe(F.col("was"))).select("record_id", "digest", F.col("was").isNull().alias("came"), F.col("digest").isNull().alias("went")))
    counts = changed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("came") | F.col("went")).alias("moved")).first()
    if not counts["n"]:
        return {"changed": 0, "owners": 0, "pairs": 0}

    links_before = _latest(_read(spark, root, "links", versions), "record_id")
    if counts["moved"]:
        ids = stored(pairs.neighbours_of(folded.select("record_id")).select("record_id", F.col("next.record_id").alias("next_id")))
        compared = ids.join(links_before.select("record_id", F.col("next_id").alias("was_next")), "record_id", "full")
        relinked = durable(compared.where(~F.col("next_id").eqNullSafe(F.col("was_next"))).select("record_id", "next_id"))
    else:
        ids, relinked = links_before.select("record_id", "next_id"), None
    ids = ids.where("next_id IS NOT NULL")
    owners = changed.select("record_id").unionByName(ids.join(changed.select(F.col("record_id").alias("next_id")), "next_id", "left_semi").select("record_id"))
    if relinked is not None:
        owners = owners.unionByName(relinked.select("record_id"))
    owners = stored(owners.distinct())
    number, known = owners.count(), folded.count()
    if sum(c["owners"] for c in commits) + number > REBUILD_SHARE * max(known, 1):
        _build(folded, model, root, version)
        return {"changed": counts["n"], "owners": known, "pairs": read(spark, root).count()}

    mine = folded.join(owners, "record_id", "left_semi")
    drawn = mine.join(ids, "record_id").join(folded.select(F.col("record_id").alias("next_id"), F.struct("record_id", *policy.SOURCES).alias("next")), "next_id").drop("next_id")
    rows = stored(_scored(mine, pairs.negatives_of(drawn), model))
    rows.write.parquet(f"{root}/rows/version={version}")
    owners.withColumnRenamed("record_id", "owner").write.parquet(f"{root}/owners/version={version}")
    changed.select("record_id", "digest").write.parquet(f"{root}/digests/version={version}")
    links = relinked if relinked is not None else links_before.select("record_id", "next_id").limit(0)
    links.write.parquet(f"{root}/links/version={version}")
    _commit(spark, root, version, False, number, known)
    return {"changed": counts["n"], "owners": number, "pairs": rows.count()}


def _latest(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key in its latest version."""
    rest = [c for c in rows.columns if c not in (key, "version")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("r")).select(key, "r.*")


def read(spark: SparkSession, root: str) -> DataFrame:
    """The current queue."""
    commits = _commits(spark, root)
    rows = _read(spark, root, "rows", [c["version"] for c in commits])
    later = [c["version"] for c in commits[1:]]
    if later:
        latest = _read(spark, root, "owners", later).groupBy(F.col("owner").alias("record_a_id")).agg(F.max("version").alias("_latest"))
        rows = rows.join(latest, "record_a_id", "left").where(F.col("version") == F.coalesce("_latest", F.lit(commits[0]["version"]))).drop("_latest")
    return rows.drop("owner", "version")
