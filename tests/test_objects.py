import glob
import gzip
import random
from datetime import datetime

from helpers import envelope_rows
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.operators import offsets
from ripplelog.operators.decode import decode_envelope, encode
from ripplelog.plans import catalog
from ripplelog.sinks import objects as sink
from ripplelog.sinks.objects import pack, restore, write_backup, write_lake
from ripplelog.sources.lake import backup, backup_runs, lake, ordered_lines
from ripplelog.sources.log import log_batch

# Seconds around the end of a leap day, 2028-02-29.
MIDNIGHT = 1835481600


def messages(spark, values, partition=2, first=10):
    rows = [(S.TOPIC_VALIDATED, partition, first + n, value.encode()) for n, value in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")


def lines_of(path):
    with gzip.open(path, "rt", encoding="utf-8") as file:
        return file.read().splitlines()


def test_backup_is_verbatim_and_ordered(spark, tmp_path):
    values = ['{"a":"x, \\"q\\"", "ü":1}', '{ "spaces" : "kept" }'] + [f'{{"n":{n}}}' for n in range(50)]
    write_backup(messages(spark, values).orderBy(F.rand(1)), str(tmp_path), rows=1000)
    files = glob.glob(f"{tmp_path}/raw/topic={S.TOPIC_VALIDATED}/p=2/rng=*/*.gz")
    assert len(files) == 1
    assert f"rng={10:020d}-{61:020d}" in files[0]
    assert lines_of(files[0]) == values


def test_large_batch_becomes_bounded_objects(spark, tmp_path):
    values = [f'{{"n":{n}}}' for n in range(95)]
    write_backup(messages(spark, values, first=0), str(tmp_path), rows=10)
    files = sorted(glob.glob(f"{tmp_path}/raw/topic=*/p=2/rng=*/*.gz"))
    assert [len(lines_of(file)) for file in files] == [10] * 9 + [5]
    assert [line for file in files for line in lines_of(file)] == values
    assert f"rng={90:020d}-{94:020d}" in files[-1]


def test_empty_batch_writes_nothing(spark, tmp_path):
    write_backup(messages(spark, ["{}"]).where("false"), str(tmp_path))
    assert glob.glob(f"{tmp_path}/raw/topic=*") == []


def test_midnight_split(spark, tmp_path):
    times = [MIDNIGHT, MIDNIGHT - 1, MIDNIGHT + 86_399, MIDNIGHT - 2, MIDNIGHT + 86_400]
    rows = [(f"x{n}", "ptwiki", "Mar", "ana", False, time) for n, time in enumerate(times)]
    events = envelope_rows(spark, rows).withColumn("offset", F.col("offset") + 300)
    write_lake(events, str(tmp_path))
    days = sorted(glob.glob(f"{tmp_path}/lake/dt=*/p=0/rng=*"))
    assert [day.split("/lake/")[1] for day in days] == [
        f"dt=2028-02-29/p=0/rng={301:020d}-{303:020d}",
        f"dt=2028-03-01/p=0/rng={300:020d}-{302:020d}",
        f"dt=2028-03-02/p=0/rng={304:020d}-{304:020d}",
    ]
    assert [r.event_id for r in spark.read.parquet(days[0]).collect()] == ["x1", "x3"]


def test_times_beyond_the_calendar_share_its_last_day(spark, tmp_path):
    rows = [("a", "w", "t", "u", False, 253_402_300_799), ("b", "w", "t", "u", False, 1_700_000_000_000)]
    write_lake(envelope_rows(spark, rows), str(tmp_path))
    assert [str(r.dt) for r in lake(spark, str(tmp_path)).collect()] == ["9999-12-31"] * 2


def test_lake_round_trip_and_rewrite(spark, tmp_path):
    rows = [
        ("p1", "svwiki", "Å/ä ö", "Nils", True, 77),
        ("p2", "", "=\t'\"", "", False, 0),
        ("p3", "ptwiki", "a b", "x=y", False, 86_399),
    ]
    events = envelope_rows(spark, rows)
    for _ in range(2):
        write_lake(events, str(tmp_path))
    back = lake(spark, str(tmp_path))
    want = sorted(map(tuple, events.select(S.ENVELOPE_COLUMNS).collect()))
    assert sorted(map(tuple, back.select(S.ENVELOPE_COLUMNS).collect())) == want
    assert dict(back.dtypes)["dt"] == "date" and dict(back.dtypes)["p"] == "int"
    pruned = back.where("dt = DATE'1970-01-01'").select("wiki")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<wiki:string>" in plan
    assert pruned.count() == 3
    assert back.where("dt = DATE'1970-01-02'").count() == 0


def test_restore_keeps_every_line(spark, tmp_path):
    values = ['{"wiki":"w","title":"t"}', "not json", '{"wiki":"w"}', '{"title":5,"wiki":"w"}', "", '{"wiki":"w","title":"t"}']
    write_backup(messages(spark, values), str(tmp_path / "backup"))
    restore(spark, str(tmp_path / "backup"), str(tmp_path / "log"))
    log = log_batch(spark, str(tmp_path / "log")).collect()
    assert sorted(bytes(r.value).decode() for r in log) == sorted(values)
    assert sorted(str(r.key and bytes(r.key)) for r in log) == ["None"] * 4 + [str(b"w:t")] * 2


def test_objects_of_interleaved_batches_do_not_overlap(spark, tmp_path):
    """Batches that hold every third block of offsets, written in any order, restore in order."""
    values = [f'{{"wiki":"w","title":"t","n":{n}}}' for n in range(90)]
    whole = messages(spark, values, first=0)
    for part in (2, 0, 1):
        write_backup(whole.where(F.floor(F.col("offset") / 5) % 3 == part), str(tmp_path / "backup"), rows=40)
    labels = sorted(f.split("rng=")[1].split("/")[0] for f in glob.glob(f"{tmp_path}/backup/raw/topic=*/p=2/rng=*/*.gz"))
    ends = [tuple(map(int, label.split("-"))) for label in labels]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    restore(spark, str(tmp_path / "backup"), str(tmp_path / "log"))
    log = log_batch(spark, str(tmp_path / "log")).orderBy("offset").collect()
    assert [bytes(r.value).decode() for r in log] == values


def objects(root):
    return sorted(glob.glob(f"{root}/raw/topic=*/p=*/rng=*/*.gz"))


def test_objects_of_a_log_with_gaps_are_packed(spark, tmp_path):
    """As many objects as rows need, however many offsets are missing; the manifest has all runs."""
    values = [f"v{n}" for n in range(3000)]
    kept = messages(spark, values, first=0).where((F.col("offset") % 7 != 3) & (F.col("offset") % 11 > 1))
    kept = kept.union(kept.withColumn("partition", F.lit(4)).where("offset % 100 < 9"))
    sizes = {r.partition: r.n for r in kept.groupBy("partition").agg(F.count("*").alias("n")).collect()}
    for _ in range(2):  # a retried batch replaces its objects
        write_backup(kept, str(tmp_path), rows=640)
        found = objects(tmp_path)
        assert len(found) == sum(-(-n // 640) for n in sizes.values())
    lines = [lines_of(f) for f in found]
    assert sorted(len(x) for x in lines)[-1] <= 640 + 10
    assert sorted(x for y in lines for x in y) == sorted(r.value.decode() for r in kept.collect())
    runs = backup_runs(spark, str(tmp_path))
    held = {(r.p, n) for r in runs.collect() for n in range(r.lo, r.hi + 1)}
    assert held == {(r.partition, r.offset) for r in kept.collect()}
    assert runs.agg(F.sum("rows")).first()[0] == len(held)
    dense = messages(spark, values, partition=5, first=0)
    write_backup(dense, str(tmp_path / "dense"), rows=640)
    assert [f.split("rng=")[1].split("/")[0] for f in objects(tmp_path / "dense")] == [
        f"{a:020d}-{min(a + 639, 2999):020d}" for a in range(0, 3000, 640)
    ]


def test_batches_out_of_order_on_a_log_with_gaps_restore_in_order(spark, tmp_path):
    rng = random.Random(5)
    whole = messages(spark, [f'{{"wiki":"w","title":"t","n":{n}}}' for n in range(1200)], first=0)
    whole = whole.where("offset % 13 != 5").withColumn("batch", F.floor(F.col("offset") / 40) % 4)
    whole = whole.withColumn("batch", F.when(F.col("offset") > 900, 5 + F.col("offset") % 2).otherwise(F.col("batch")))
    order = [0, 1, 2, 3, 5, 6]
    rng.shuffle(order)
    for number in order:
        write_backup(whole.where(F.col("batch") == number).drop("batch"), str(tmp_path / "backup"), rows=100)
    assert len(objects(tmp_path / "backup")) <= 1200 // 100 + len(order)
    write_backup(messages(spark, ["x", "y"], partition=3), str(tmp_path / "backup"))
    lines = ordered_lines(spark, str(tmp_path / "backup")).orderBy("p", "at", "seq")
    want = [r.value.decode() for r in whole.orderBy("offset").collect()]
    assert [r.value for r in lines.collect()] == [*want, "x", "y"]
    restore(spark, str(tmp_path / "backup"), str(tmp_path / "log"))
    log = log_batch(spark, str(tmp_path / "log")).where("key IS NOT NULL").orderBy("offset").collect()
    assert [bytes(r.value).decode() for r in log] == want


def test_restore_gives_the_same_log(spark, tmp_path):
    rows = [(f"e{n}", "enwiki", f"T{n % 5}", "u", n % 2 == 0, n + 1) for n in range(60)]
    events = envelope_rows(spark, rows)
    values = events.select("topic", "partition", "offset", encode(*S.ENVELOPE_COLUMNS).cast("binary").alias("value"))
    write_backup(values, str(tmp_path / "backup"), rows=16)
    columns = backup(spark, str(tmp_path / "backup")).columns
    assert set(columns) == {*S.ENVELOPE_COLUMNS, "topic", "p"}
    assert backup(spark, str(tmp_path / "backup"), S.ENVELOPE).where("bot").count() == 30
    restore(spark, str(tmp_path / "backup"), str(tmp_path / "log"))
    log = log_batch(spark, str(tmp_path / "log"), S.TOPIC_VALIDATED)
    stored = {bytes(r.value) for r in log.collect()}
    assert stored == {bytes(r.value) for r in values.collect()}
    back = decode_envelope(log, "key", "partition", "offset").orderBy("partition", "offset").collect()
    by_page = {}
    for row in back:
        assert bytes(row.key).decode() == f"{row.wiki}:{row.title}"
        by_page.setdefault(row.title, []).append(row.occurred_at)
    assert len(back) == 60 and all(times == sorted(times) for times in by_page.values())


def test_a_large_object_is_written_by_bounded_tasks_and_restored_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "TASK_ROWS", (10, 50))
    values = [f'{{"n":{n}}}' for n in range(1000)]
    write_backup(messages(spark, values).orderBy(F.rand(3)), str(tmp_path), rows=640)
    for folder in glob.glob(f"{tmp_path}/raw/topic=*/p=2/rng=*"):
        files = [lines_of(file) for file in sorted(glob.glob(f"{folder}/*.gz"))]
        first = int(folder.split("rng=")[1].split("-")[0]) - 10
        assert len(files) > 5 and max(map(len, files)) <= 60
        assert sum(files, []) == values[first : first + sum(map(len, files))]
    restore(spark, str(tmp_path), str(tmp_path / "log"))
    rows = log_batch(spark, str(tmp_path / "log"), S.TOPIC_VALIDATED).orderBy("partition", "offset").collect()
    got = [(r.partition, int(r.value[5:-1])) for r in rows]  # without keys, lines go by their values
    assert got == sorted(got) and sorted(n for _, n in got) == list(range(1000))


def test_stretches_of_objects_of_several_files_restore_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "TASK_ROWS", (10, 20))
    rows = messages(spark, [f'{{"n":{n}}}' for n in range(400)], first=0)
    for late in (1, 0):  # the later half of each hundred offsets is written first
        write_backup(rows.where((F.col("offset") % 100 >= 50) == F.lit(bool(late))), str(tmp_path), rows=128)
    assert max(len(glob.glob(f"{x}/*.gz")) for x in glob.glob(f"{tmp_path}/raw/topic=*/p=2/rng=*")) > 1
    got = ordered_lines(spark, str(tmp_path)).orderBy("at", "file", "seq").select("value").collect()
    assert [r.value for r in got] == [f'{{"n":{n}}}' for n in range(400)]


def test_offset_runs_are_found_by_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(offsets, "TASK_ROWS", (10, 50))
    log = messages(spark, ["x"] * 3000, first=0).where("offset % 7 < 5")
    runs = offsets.offset_runs(log, 40)
    assert runs.rdd.getNumPartitions() >= 40  # one, when Spark sizes them by their bytes
    got = sorted((r.piece, r.lo, r.hi, r.rows) for r in runs.collect())
    assert sum(r[3] for r in got) == log.count() and all(hi - lo + 1 == rows for _, lo, hi, rows in got)
    assert {(lo // 40 * 40, hi // 40 * 40) for _, lo, hi, _ in got} == {(piece, piece) for piece, *_ in got}


def test_objects_begin_and_end_where_their_offsets_do(spark):
    rng = random.Random(5)
    have = sorted({n for n in range(6000) if n < 1500 or rng.random() < (0.99 if n < 4000 else 0.6)} - set(range(4500, 4600)))
    rows = [(S.TOPIC_VALIDATED, p, n) for p in (0, 4) for n in have if p == 0 or n % 3]
    runs = pack(spark.createDataFrame(rows, "topic string, partition int, offset bigint"), 640).collect()
    for p in (0, 4):
        own, objects = [n for _, part, n in rows if part == p], {}
        for n in own:
            ahead = sum(1 for m in own if m < n // 10 * 10)
            objects.setdefault(ahead // 640, []).append(n)
        want = set()
        for held in objects.values():
            ends = [n for n in held if n + 1 not in held]
            want.add((held[0], ends[0], held[-1]))
        assert {(r.start, r.first, r.last) for r in runs if r.partition == p} == want
        assert sum(r.rows for r in runs if r.partition == p) == len(own)


def test_a_log_that_is_written_twice_is_made_once(spark, tmp_path, monkeypatch):
    events = [(n, n % 7, "edit", datetime(2024, 1, 1)) for n in range(60)]
    table = spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz")
    table.write.parquet(f"{tmp_path}/events.parquet")
    kept, write = [], catalog.write_backup
    monkeypatch.setattr(catalog, "write_backup", lambda batch, *how: kept.append(batch.is_cached) or write(batch, *how))
    lines = catalog.registered()["backup_rewritten"](spark, str(tmp_path)).collect()
    assert kept == [True, True]
    assert sum(r.lines for r in lines) == catalog.registered()["validated_envelopes"](spark, str(tmp_path)).count()


def test_a_lake_of_scattered_days_is_packed_by_pieces_not_by_runs(spark, tmp_path, monkeypatch):
    """No two neighbouring offsets are of one day, so there are as many runs as rows."""
    staged, stage = [], sink._stage
    monkeypatch.setattr(sink, "_stage", lambda packed, *how: staged.append(packed.count()) or stage(packed, *how))
    rows = [(f"x{n}", "ptwiki", "Mar", "ana", False, MIDNIGHT - n % 2) for n in range(300)]
    assert write_lake(envelope_rows(spark, rows), str(tmp_path), rows=64 * 50) == 2
    assert staged == [12]  # stretches of 50 offsets, of two days
    back = lake(spark, str(tmp_path))
    assert sorted(r.event_id for r in back.collect()) == sorted(row[0] for row in rows)
    names = sorted(path.rpartition("rng=")[2] for path in glob.glob(f"{tmp_path}/lake/dt=*/p=0/rng=*"))
    assert names == [f"{0:020d}-{298:020d}", f"{1:020d}-{299:020d}"]


def test_lake_objects_of_a_day_take_a_bounded_number_of_rows(spark, tmp_path):
    rows = [(f"x{n}", "ptwiki", "Mar", "ana", False, MIDNIGHT - n % 2) for n in range(400)]
    assert write_lake(envelope_rows(spark, rows), str(tmp_path), rows=64) == 8
    names = [path.rpartition("rng=")[2] for path in sorted(glob.glob(f"{tmp_path}/lake/dt=2028-02-29/p=0/rng=*"))]
    assert names == [f"{a:020d}-{z:020d}" for a, z in ((1, 127), (129, 255), (257, 383), (385, 399))]
