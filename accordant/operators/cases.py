"""Case lifecycle as a fold over an append-only event table.

Events: (case_id, at, seq, to, actor, note, implicit). An illegal event never changes the state; it
stays in the output as rejected. ``implicit`` marks the opening step a decision brings along; it
counts only for cases that are NEW or REOPENED and is ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.text import choose, is_blank, strip
from accordant.functions.times import age_hours
from accordant.operators.ranking import halo_buckets, ordered_rank
from accordant.session import durable, stored

LEGAL = [f"{a}>{b}" for a, targets in policy.TRANSITIONS.items() for b in targets]
STATES = list(policy.TRANSITIONS)
EVENT = ["at", "seq", "to", "actor", "note", "implicit"]


def _accepted(state: Column, event: Column) -> Column:
    legal = F.concat(state, F.lit(">"), event["to"]).isin(LEGAL)
    return legal & (~event["implicit"] | state.isin("NEW", "REOPENED"))


def _step(state: Column, event: Column) -> Column:
    return F.when(_accepted(state, event), event["to"]).otherwise(state)


def _start_states(functions: DataFrame, segment: int, runs: int) -> DataFrame:
    """(case_id, run, start) for each run, given what every run does to each status.

    ``functions``: (case_id, run, ends), ``ends`` aligned with STATES. Up to ``segment`` runs are
    composed at a time; more runs than that are composed into coarser runs first, and so on, so a
    case of any length is handled in lists of bounded size.
    """
    states = F.array(*[F.lit(s) for s in STATES])
    grouped = (functions.withColumn("part", F.floor(F.col("run") / segment)).groupBy("case_id", "part")
               .agg(F.array_sort(F.collect_list(F.struct("run", "ends"))).alias("runs")))
    prefixes = F.aggregate("runs", F.array(states), lambda seen, r: F.concat(seen, F.array(F.transform(
        F.element_at(seen, -1), lambda s: F.element_at(r["ends"], F.array_position(states, s).cast("int"))))))
    composed = grouped.select("case_id", "part", prefixes.alias("prefixes"))
    if runs > segment:
        whole = composed.select("case_id", F.col("part").alias("run"), F.element_at("prefixes", -1).alias("ends"))
        coarse = _start_states(whole, segment, -(-runs // segment)).withColumnRenamed("run", "part")
        composed = composed.join(coarse, ["case_id", "part"])
    else:
        composed = composed.withColumn("start", F.lit(policy.INITIAL_STATUS))
    opened = composed.select("case_id", "part", "start", F.posexplode("prefixes").alias("pos", "prefix"))
    return opened.select("case_id", (F.col("part") * segment + F.col("pos")).alias("run"),
                         F.element_at("prefix", F.array_position(states, F.col("start")).cast("int")).alias("start"))


def annotate(events: DataFrame, segment: int = 512) -> DataFrame:
    """Each event with the status before it and its outcome: accepted, ignored or rejected.

    Cases of at most ``segment`` events are gathered by one shuffle and replayed. Events of a longer case are cut
    into runs of ``segment``. A run is a function from start status to end status; those functions are chained to
    give every run its start status, and each run is then replayed on its own. No list holds more than one run.
    """
    events = events.where(F.col("case_id").isNotNull())
    counts = events.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    longer = durable(counts.where(F.col("n") > segment).select("case_id"))
    if longer.isEmpty():
        return _replay_whole(events)
    rest = _replay_whole(events.join(longer, "case_id", "left_anti"))
    return rest.unionByName(_replay_runs(events.join(longer, "case_id", "left_semi"), segment))


def _replay_whole(events: DataFrame) -> DataFrame:
    """``annotate`` for cases whose events fit in one list."""
    entry = F.struct(*EVENT)
    gathered = events.repartition("case_id").groupBy("case_id").agg(F.array_sort(F.collect_list(entry)).alias("events"))
    runs = gathered.select("case_id", F.transform("events", lambda e, i: F.struct(
        (i + 1).cast("long").alias("n"), *[e[c].alias(c) for c in EVENT])).alias("events"), F.lit(policy.INITIAL_STATUS).alias("start"))
    return _replayed(runs)


def _replay_runs(events: DataFrame, segment: int) -> DataFrame:
    ranked = ordered_rank(events, ["case_id"], ["at", "seq"], name="n")
    longest = ranked.agg(F.max("n")).first()[0] or 0
    entry = F.struct("n", *EVENT)
    # stored: read for what runs do to each status, and again for the replay
    runs = stored(ranked.withColumn("run", F.floor((F.col("n") - 1) / segment))
                   .groupBy("case_id", "run").agg(F.array_sort(F.collect_list(entry)).alias("events")))
    ends = F.aggregate("events", F.array(*[F.lit(s) for s in STATES]),
                       lambda now, e: F.transform(now, lambda s: _step(s, e)))
    functions = runs.select("case_id", "run", ends.alias("ends"))
    return _replayed(runs.join(_start_states(functions, segment, -(-longest // segment)), ["case_id", "run"]))


def _replayed(runs: DataFrame) -> DataFrame:
    """The events of runs (case_id, events in order, start status), each with its status before and its outcome."""
    trail = F.aggregate(
        "events", F.struct(F.col("start").alias("state"),
                           F.array().cast("array<string>").alias("before")),
        lambda acc, e: F.struct(_step(acc["state"], e).alias("state"),
                                F.concat(acc["before"], F.array(acc["state"])).alias("before")),
        lambda acc: acc["before"])
    replayed = runs.select(
        "case_id", F.explode(F.arrays_zip(F.col("events").alias("event"), trail.alias("before"))).alias("z"))
    flat = replayed.select("case_id", F.col("z.event").alias("event"), F.col("z.before").alias("from_status"))
    outcome = (F.when(_accepted(F.col("from_status"), F.col("event")), "accepted")
               .when(F.col("event.implicit") | (F.col("from_status") == F.col("event.to")), "ignored")
               .otherwise("rejected"))
    return flat.select("case_id", "event.*", "from_status", outcome.alias("outcome"))


def case_states(annotated: DataFrame, opened: DataFrame) -> DataFrame:
    """Current state per case. ``opened``: (case_id, created_at).

    Under the lifecycle every move into RESOLVED or REJECTED starts from an open status, so the
    last such move dates the resolution, and reopening clears it.
    """
    ok = F.col("outcome") == "accepted"
    closing = ok & F.col("to").isin("RESOLVED", "REJECTED")
    folded = annotated.groupBy("case_id").agg(
        F.max_by("to", F.when(ok, F.col("n"))).alias("_to"),
        F.min_by("at", F.when(ok & (F.col("to") == "IN_REVIEW"), F.col("n"))).alias("started_at"),
        F.max_by("at", F.when(closing, F.col("n"))).alias("_closed"),
        F.max_by("actor", F.when(ok, F.col("n"))).alias("assigned_to"),
        F.count_if(ok).alias("_moves"), F.count_if(F.col("outcome") == "rejected").alias("rejected_events"))
    status = F.coalesce("_to", F.lit(policy.INITIAL_STATUS))
    return opened.join(folded, "case_id", "left").select(
        "case_id", status.alias("status"), "assigned_to", "created_at", "started_at",
        F.when(status.isin(policy.TERMINAL_STATUSES), F.col("_closed")).alias("resolved_at"),
        (F.coalesce("_moves", F.lit(0)) + 1).alias("history_rows"),
        F.coalesce("rejected_events", F.lit(0)).alias("rejected_events"))


def history(annotated: DataFrame, opened: DataFrame) -> DataFrame:
    """Accepted moves in order, with the opening row of every case."""
    opening = opened.select(
        "case_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("from_status"),
        F.lit("NEW").alias("to"), F.lit("system").alias("actor"), F.lit("case opened").alias("note"),
        F.col("created_at").alias("at"))
    moves = annotated.where(F.col("outcome") == "accepted").select(*opening.columns)
    return opening.unionByName(moves)


def previous_event(events: DataFrame, bucket: int = 10000) -> DataFrame:
    """Events with the target of the preceding event of the case (legal or not)."""
    ranked = ordered_rank(events, ["case_id"], ["at", "seq"], name="n")
    w = Window.partitionBy("case_id", "_bucket").orderBy("n")
    lagged = halo_buckets(ranked, "n", bucket, 1, 0).withColumn("previous_to", F.lag("to").over(w))
    return lagged.where("_owned").drop("_owned", "_bucket")


def is_terminal() -> Column:
    return F.col("status").isin(policy.TERMINAL_STATUSES)


def with_age(cases: DataFrame, as_of: Column, sla_hours: int = policy.SLA_HOURS) -> DataFrame:
    """Age in hours and whether an open case is past its deadline."""
    aged = cases.withColumn("age_hours", age_hours(F.col("created_at"), F.col("resolved_at"), is_terminal(), as_of))
    return aged.withColumn("sla_breach", ~is_terminal() & (F.col("age_hours") > sla_hours))


def check_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions with the first rule they break (null when they are fine)."""
    error = (F.when(is_blank("reviewer_id"), "Reviewer ID is required.")
             .when(is_blank("reason"), "An explanation is required.")
             .when(~F.coalesce(F.col("reason_code").isin(policy.REASON_CODES), F.lit(False)), "Unknown reason code.")
             .when(~F.coalesce(F.col("decision").isin(list(policy.TARGET_OF_DECISION)), F.lit(False)),
                   "Unknown decision."))
    return decisions.withColumn("error", error)


def decision_events(decisions: DataFrame) -> DataFrame:
    """Lifecycle events of valid decisions: the implicit opening step, then the target status."""
    target = choose(F.col("decision"), policy.TARGET_OF_DECISION)
    steps = F.array(
        F.struct(F.lit("IN_REVIEW").alias("to"), F.lit("reviewer opened the case").alias("note"),
                 F.lit(True).alias("implicit"), (F.col("seq") * 2).alias("seq")),
        F.struct(target.alias("to"), F.concat("decision", F.lit(": "), "reason_code").alias("note"),
                 F.lit(False).alias("implicit"), (F.col("seq") * 2 + 1).alias("seq")))
    rows = decisions.select(F.col("pair_id").alias("case_id"), "at", strip("reviewer_id").alias("actor"),
                            F.explode(steps).alias("s"))
    return rows.select("case_id", "at", "s.seq", "s.to", "actor", "s.note", "s.implicit")


def handoff(cases: DataFrame, corrections: DataFrame, synced_at: Column) -> DataFrame:
    """Correction rows of RESOLVED cases, in the layout of the handoff file."""
    ready = cases.where(F.col("status") == "RESOLVED").select("case_id")
    return corrections.join(ready, "case_id", "left_semi").withColumn("synced_at", synced_at).select(
        *policy.HANDOFF_COLUMNS)


def sync_checks(cases: DataFrame, corrections: DataFrame) -> DataFrame:
    """Whether each case can be synced; the reason when it cannot; the number of corrections."""
    counts = corrections.groupBy("case_id").agg(F.count("*").alias("corrections"))
    joined = cases.join(counts, "case_id", "left").na.fill(0, ["corrections"])
    error = (F.when(F.col("status") != "RESOLVED", "only RESOLVED cases can be synced")
             .when(F.col("corrections") == 0, "no approved corrections to sync"))
    return joined.withColumn("error", error)


def sync_events(checked: DataFrame, at: Column, actor: str = "reviewer") -> DataFrame:
    """The SYNCED event of every case that passed the checks."""
    note = F.concat(F.col("corrections").cast("string"), F.lit(" corrections handed off"))
    return checked.where(F.col("error").isNull()).select(
        "case_id", at.alias("at"), F.lit(2**62).alias("seq"), F.lit("SYNCED").alias("to"),
        F.lit(actor).alias("actor"), note.alias("note"), F.lit(False).alias("implicit"))


def case_listing(cases: DataFrame, corrections: DataFrame) -> DataFrame:
    """Audit listing of the case states with the number of corrections."""
    counts = corrections.groupBy("case_id").agg(F.count("*").alias("corrections"))
    return cases.join(counts, "case_id", "left").select(
        "case_id", "status", "created_at", "resolved_at", F.coalesce("corrections", F.lit(0)).alias("corrections"))
