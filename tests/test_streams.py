"""Streams against batch results: late and repeated arrivals, case states in event-time order, quoted files."""

from __future__ import annotations

import csv
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accordant import policy, schemas
from accordant.operators.cases import LEGAL, annotate, case_states
from accordant.sources import files, records
from accordant.streaming import case_replay, jobs

START = datetime(2024, 3, 1)
EVENTS = "case_id string, at timestamp, seq long, to string, actor string, note string, implicit boolean, created_at timestamp"


def arrive(spark, folder, batches, schema):
    """Files in the given order, one to a micro-batch."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def case_events(rng, n):
    """Events of some cases over five days; one case has a third of them."""
    states = list(policy.TRANSITIONS)
    rows = []
    for i in range(n):
        case = "busy" if i % 3 == 0 else f"c{rng.randrange(25)}"
        at = START + timedelta(seconds=rng.randrange(5 * 86_400 if case == "busy" else 2 * 86_400))
        rows.append((case, at, i, rng.choice(states[1:]), "r", "", rng.random() < 0.2, datetime(at.year, at.month, at.day)))
    rows.append(("end", START + timedelta(days=6), n, "IN_REVIEW", "r", "", False, START))
    return rows


def test_case_states_follow_event_time(spark, tmp_path):
    rng = random.Random(1)
    rows = case_events(rng, 600)
    late = sorted(rows, key=lambda r: (r[1] + timedelta(minutes=rng.randrange(55)), r[2]))
    cuts = sorted(rng.sample(range(len(late)), 7))
    batches = [late[a:b] for a, b in zip([0, *cuts], [*cuts, len(late)]) if a < b]
    for b in batches:
        rng.shuffle(b)
    assert sum(x[1] > y[1] for x, y in zip(late, late[1:])) > 100  # out of order, also across files
    stream = arrive(spark, tmp_path / "in", batches, EVENTS)
    jobs.run_to_files(case_replay.case_updates(stream), str(tmp_path / "out"), str(tmp_path / "progress"), "update")
    got = spark.read.parquet(str(tmp_path / "out/b*"))
    latest = got.where("kind = 'state'").groupBy("case_id").agg(F.max_by(F.struct("status", "moves", "created_at", "started_at"), "batch").alias("s"))
    events = spark.createDataFrame(rows, EVENTS)
    opened = events.groupBy("case_id").agg(F.min("created_at").alias("created_at"))
    annotated = annotate(events.drop("created_at"))
    expected = {r.case_id: r for r in case_states(annotated, opened).collect()}
    for r in latest.collect():
        e = expected[r.case_id]
        assert (r.s.status, r.s.moves, r.s.created_at, r.s.started_at) == (e.status, e.history_rows - 1, e.created_at, e.started_at)
    assert latest.count() == len(expected)

    settled = START + timedelta(days=6, hours=-1)
    breaches = {}
    for case in expected:
        due = min(r[7] for r in rows if r[0] == case) + timedelta(hours=policy.SLA_HOURS)
        status, passed = "NEW", False
        for _, at, _, to, _, _, implicit, _ in sorted((r for r in rows if r[0] == case and r[1] < settled), key=lambda r: (r[1], r[2])):
            if at > due and not passed:
                passed = True
                if status in policy.OPEN_STATUSES:
                    breaches.setdefault(case, status)
            if f"{status}>{to}" in LEGAL and (not implicit or status in ("NEW", "REOPENED")):
                status = to
            if at > due and status in policy.OPEN_STATUSES:
                breaches.setdefault(case, status)
        if due < settled and status in policy.OPEN_STATUSES:
            breaches.setdefault(case, status)
    alerts = [(r.case_id, r.status) for r in got.where("kind = 'sla_breach'").collect()]
    assert sorted(alerts) == sorted(breaches.items()) and len(alerts) > 5


def test_first_rows_over_batches(spark, tmp_path):
    schema = "k string, at long, v string"
    batches = [[("a", 5, "x"), ("a", 3, "y"), (None, 1, "n")], [("a", 1, "late"), ("b", 9, "p"), ("b", 8, "q"), (None, 0, "m")], [("b", 1, "r"), ("c", 1, "s")]]
    out = str(tmp_path / "out")
    jobs.run_to_unique(arrive(spark, tmp_path / "in", batches, schema), ["k"], out, str(tmp_path / "progress"), ["at"])
    assert sorted(map(str, ((r.k, r.at, r.v) for r in spark.read.parquet(out).collect()))) == sorted(
        map(str, [("a", 3, "y"), (None, 1, "n"), ("b", 8, "q"), ("c", 1, "s")]))
    # a restart reads the new file only, and knows the keys
    again = arrive(spark, tmp_path / "in", [[("c", 0, "t"), ("d", 2, "u")]], schema)
    jobs.run_to_unique(again, ["k"], out, str(tmp_path / "progress"), ["at"])
    assert spark.read.parquet(out).where("k = 'd'").count() == 1 and spark.read.parquet(out).count() == 5


HEADER = "customer_ref,project_reference,customer,installed_capacity,region,record_status\n"


def test_watched_folder_with_line_breaks_and_empty_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    run = lambda: jobs.watch_exports(spark, str(folder), "erp", str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    (folder / "a.csv").write_text(HEADER + 'C1,P1,"Ann\nLee",4.5,N,Done\nC2,P2,"Bo ""the"", x",3,N,Done\n')
    (folder / "none.csv").write_text("")
    (folder / "head.csv").write_text(HEADER)
    run()
    (folder / "b.csv").write_text(HEADER + "C9,P2,Bo,3,N,Done\nC3,P3,Cy,1,N,Done\nC3,P3,Cy,1,N,Done\n")
    run()
    stored = spark.read.parquet(str(tmp_path / "out/records"))
    assert sorted((r.source_record_id, r.raw_file_reference) for r in stored.collect()) == [("P1", "a.csv"), ("P2", "a.csv"), ("P3", "b.csv")]
    ledger = {r.file_name: r for r in spark.read.parquet(str(tmp_path / "out/ledger")).collect()}
    assert {n: (r.rows_processed, r.status) for n, r in ledger.items()} == {
        "a.csv": (2, "COMPLETED"), "b.csv": (3, "COMPLETED"), "head.csv": (0, "COMPLETED"), "none.csv": (0, "FAILED: Empty file")}
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 0


@pytest.mark.parametrize("run", [1, 3, 40, 10_000])
def test_records_of_split_files(spark, tmp_path, run):
    rng = random.Random(run)
    texts = ["plain", 'in "quotes"', "two\nlines", "a,b", '"', '""', "\n", 'x"y', "", "end\n", "\n\n\n" + "long " * 30, 'q,\n"z', "é", "\n,\n\"\n"]
    expected = []
    for k in range(3):
        rows = [["id", "name", "note"]] + [[f"{k}-{i}", rng.choice(texts), rng.choice(texts)] for i in range(120)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\r\n" if k == 1 else "\n").writerows(rows)
        (tmp_path / f"f{k}.csv").write_bytes(out.getvalue().encode())
        expected += [(f"f{k}.csv", i == 0, r) for i, r in enumerate(rows)]
    (tmp_path / "unclosed.csv").write_text('id,name,note\n1,"never closed\n\nto the end')
    (tmp_path / "blank.csv").write_text("\n \n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = records.csv_records(spark, str(tmp_path), run).collect()
        typed = files.read_csv(spark, [str(tmp_path / f"f{k}.csv") for k in range(3)], "note string, id string", file_column="f").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parsed = [(r.name, r["first"], next(csv.reader(io.StringIO(r.record, newline="")))) for r in got if r.name[0] == "f"]
    assert sorted(parsed) == sorted(expected)
    assert [r.record for r in got if r.name == "unclosed.csv" and not r["first"]] == ['1,"never closed\n\nto the end']
    assert sorted((r.f, r.id, r.note or "") for r in typed) == sorted((f, r[0], r[2]) for f, first, r in expected if not first)


def test_stray_quotes_are_characters(spark, tmp_path):
    text = 'id,name\n1,5" pipe\n2,"a"b\n3, "spaced\n4,x""y\n5,"in, ""q""\nnext"\n'
    (tmp_path / "a.csv").write_text(text)
    got = [r.record for r in records.csv_records(spark, str(tmp_path / "a.csv"), 2).collect() if not r["first"]]
    expected = list(csv.reader(io.StringIO(text)))[1:]
    assert sorted(got) == sorted(['1,5" pipe', '2,"a"b', '3, "spaced', '4,x""y', '5,"in, ""q""\nnext"']) and len(expected) == 5


def test_two_records_with_a_line_break(spark, tmp_path):
    (tmp_path / "crm.csv").write_text('project_id,customer_name,system_size_kw\nP1,"Ann\nLee",4.5\nP2,Bo,5\n')
    df = files.read_csv(spark, str(tmp_path / "crm.csv"), schemas.SOURCE_FILES["crm"])
    assert sorted((r.project_id, r.customer_name, r.system_size_kw, r._corrupt_record) for r in df.collect()) == [
        ("P1", "Ann\nLee", 4.5, None), ("P2", "Bo", 5.0, None)]


def test_cases_of_a_shard_stay_apart(spark, tmp_path):
    rng = random.Random(4)
    rows = case_events(rng, 90)
    batches = [sorted(rows, key=lambda r: r[1])[a:b] for a, b in ((0, 45), (45, len(rows)))]
    got = []
    for shards in (1, 3):
        stream = arrive(spark, tmp_path / f"in{shards}", batches, EVENTS)
        jobs.run_to_files(case_replay.case_updates(stream, shards=shards), str(tmp_path / f"out{shards}"), str(tmp_path / f"progress{shards}"), "update")
        out = spark.read.parquet(str(tmp_path / f"out{shards}/b*"))
        last = out.where("kind = 'state'").groupBy("case_id").agg(F.max_by(F.struct("status", "moves", "created_at"), "batch").alias("s"))
        got.append((sorted(map(str, last.collect())), sorted(map(str, out.where("kind = 'sla_breach'").drop("batch").collect()))))
    assert got[0] == got[1] and len(got[0][0]) == len({r[0] for r in rows})
