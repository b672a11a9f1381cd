import json
import os
import random
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from textpulse.__main__ import main
from textpulse.config import DEFAULT
from textpulse.operators.insights import complaint_counts, number_batches, prompt_batches
from textpulse.operators.monthly import monthly_sentiment
from textpulse.plans.batch import run, run_landing
from textpulse.plans.deep import run_deep
from textpulse.session import release, stage, work_dir
from textpulse.sources import keyed, ledger, runs, sinks
from textpulse.sources.items import read_items, read_processed_csv
from textpulse.streaming import incremental as stream, state

RUN = datetime(2024, 6, 1, tzinfo=timezone.utc)


def _items(n, start=0, body="the doctor was terrible and i hated it, call John at 555-123-4567"):
    return [{"id": f"p{i}", "title": f"post {i} of the clinic, \"quoted\"", "body": body,
             "createdAt": 1704067200 + i * 86400, "upVotes": 5, "downVotes": 1, "subredditName": "s",
             "comments": [{"id": f"c{i}", "body": "i loved the program, my wife is happy so we stay",
                           "createdAt": "2024-02-01T00:00:00Z", "replies": []}]} for i in range(start, start + n)]


def _land(folder, items, name="a.json"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(map(json.dumps, items)))
    return str(folder)


def test_full_run_writes_every_output(spark, tmp_path):
    landing, out = _land(tmp_path / "in", _items(30)), str(tmp_path / "out")
    result = run(spark, read_items(spark, landing), out, run_ts=RUN)
    assert result.success and result.records == 60 and result.stage_counts["rows_in"] == 60
    table = spark.read.parquet(f"{out}/{sinks.MAIN}.parquet")
    assert table.count() == 60 and "pii_spans" not in table.columns
    again = {r.id: r for r in read_processed_csv(spark, f"{out}/{sinks.MAIN}.csv").collect()}
    for row in table.collect():  # CSV has no empty strings
        want = {c: None if v == "" else v for c, v in row.asDict().items()}
        assert {c: again[row.id][c] for c in table.columns} == {**want, "year_month": str(row.year_month)}
    read = lambda name: spark.read.csv(f"{out}/{name}.csv", header=True)
    assert read(sinks.MONTHLY).count() == 2
    assert read(sinks.NEGATIVE).columns == ["keyword", "tfidf_score", "frequency", "category"]
    assert read(sinks.AUDIT).count() > 30 and read(sinks.TOPICS).count() > 0
    meta = spark.read.json(f"{out}/{sinks.METADATA}.json").first()
    assert meta.statistics.pii_redacted_count == 30 and meta.run_timestamp_pacific.endswith("-07:00")
    assert runs.last_run_timestamp(spark, out) == RUN
    history = runs.run_history(spark, out).collect()
    assert [(h.success, h.records_processed, h.error) for h in history] == [(True, 60, None)]


def test_too_little_input_keeps_outputs_and_mark(spark, tmp_path):
    out = str(tmp_path / "out")
    assert run(spark, read_items(spark, _land(tmp_path / "in", _items(30))), out, run_ts=RUN, csv=False).success
    later = _land(tmp_path / "in2", _items(4, 200) + _items(30))
    result = run(spark, read_items(spark, later), out, incremental=True, csv=False)
    assert not result.success and "at least 10" in result.error
    assert spark.read.parquet(f"{out}/{sinks.MAIN}.parquet").count() == 60
    assert runs.last_run_timestamp(spark, out) == RUN
    assert sorted(h.success for h in runs.run_history(spark, out).collect()) == [False, True]


def test_incremental_run_keeps_later_messages(spark, tmp_path):
    out = str(tmp_path / "out")
    assert runs.last_run_timestamp(spark, out) is None
    assert run(spark, read_items(spark, _land(tmp_path / "in", _items(30))), out, run_ts=RUN, csv=False,
               settings=replace(DEFAULT, enable_topics=False)).success
    result = run(spark, read_items(spark, _land(tmp_path / "in2", _items(60, 140))), out, incremental=True,
                 run_ts=datetime(2024, 9, 1, tzinfo=timezone.utc), csv=False,
                 settings=replace(DEFAULT, enable_topics=False))
    # Days 140 to 199 after New Year: those strictly after June 1st are kept, comments are older.
    assert result.success and result.records == sum(1704067200 + i * 86400 > RUN.timestamp() for i in range(140, 200))


def test_empty_tables_keep_their_header(spark, tmp_path):
    out = str(tmp_path / "out")
    landing = _land(tmp_path / "in", _items(12, body="a fine day at the clinic in the city of towns"))
    assert run(spark, read_items(spark, landing), out, run_ts=RUN, csv=False).success
    for name, first in ((sinks.AUDIT, "post_id"), (sinks.TOPICS, "topic_id"), (sinks.NEGATIVE, "keyword")):
        table = spark.read.csv(f"{out}/{name}.csv", header=True)
        assert table.columns[0] == first and table.isEmpty()


def test_drop_raw(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "a", "a", "me", "2024-01")],
                               "id string, text string, original_text string, clean_text string, author string, year_month string")
    sinks.write_main(df, str(tmp_path), csv=False, drop_raw=True)
    assert set(spark.read.parquet(f"{tmp_path}/{sinks.MAIN}.parquet").columns) == {"id", "year_month"}


def test_deep_run(spark, tmp_path):
    def client():
        import json

        def ask(prompt):
            ids = [line.split(": ")[1] for line in prompt.split("\n") if line.startswith("POST_ID: ")]
            if "p3" in ids:
                raise RuntimeError("request failed")
            found = [{"post_id": i, "primary_complaint": "money", "severity": 3} for i in ids]
            return "```json\n" + json.dumps(found) + "\n```"
        return ask

    df = spark.createDataFrame([(f"p{i}", -0.9 + i / 1000, "text") for i in range(25)],
                               "id string, sentiment_score double, clean_text string")
    found = run_deep(spark, df, str(tmp_path), client, n=25)
    assert found.count() == 15  # the first batch of ten failed
    assert complaint_counts(found).first()["count"] == 15
    assert spark.read.csv(f"{tmp_path}/{sinks.INSIGHTS}.csv", header=True).count() == 15
    failed = spark.read.csv(f"{tmp_path}/{sinks.FAILURES}.csv", header=True).collect()
    assert [(r.batch, r.error) for r in failed] == [("0", "RuntimeError: request failed")]
    none = run_deep(spark, df, str(tmp_path / "none"), client, threshold=-2.0)
    assert none.isEmpty() and not os.path.exists(tmp_path / "none")


@pytest.mark.parametrize("columns", [("clean_text", "text"), ("text",), ("redacted_text",), ("redacted_text", "text"), ()])
def test_prompts_take_the_text_there_is(spark, columns):
    rows = spark.createDataFrame([("p", -0.9)], "id string, sentiment_score double")
    for c in columns:
        rows = rows.withColumn(c, F.lit(c if c != "clean_text" else None))
    prompt = prompt_batches(number_batches(rows)).first().prompt
    assert "TEXT: " + ("text" if "text" in columns else "".join(columns)) + "\n" in prompt


def test_main_output_is_replaced_when_whole(spark, tmp_path, monkeypatch):
    row = lambda i: spark.createDataFrame([(i, "2024-01")], "id string, year_month string")
    ids = lambda kind: sorted(r.id for r in getattr(spark.read, kind)(f"{tmp_path}/{sinks.MAIN}.{kind}", **({"header": True} if kind == "csv" else {})).collect())
    sinks.write_main(row("old"), str(tmp_path))
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "write_csv", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.write_main(row("new"), str(tmp_path))
    assert ids("parquet") == ids("csv") == ["old"]
    sinks.write_main(row("new"), str(tmp_path))
    assert ids("parquet") == ids("csv") == ["new"] and sorted(os.listdir(tmp_path)) == [f"{sinks.MAIN}.csv", f"{sinks.MAIN}.parquet"]


def test_file_hashes(spark, tmp_path):
    import hashlib
    (tmp_path / "a.bin").write_bytes(b"abc")
    assert runs.file_md5(spark, str(tmp_path)).first().md5 == hashlib.md5(b"abc").hexdigest()
    assert runs.file_md5(spark, str(tmp_path / "missing")).first().md5 == ""


def test_files_larger_than_a_binary_row_are_hashed(spark, tmp_path, monkeypatch):
    import hashlib, random
    rng = random.Random(3)
    noise, text = rng.randbytes(300_000), ("word, wort\r\n\n" * 20_000).encode()
    files = {"noise.bin": noise, "ends.txt": text, "bare.txt": text + b"end", "mark.csv": b"\xef\xbb\xbf" + text, "zero.img": bytes(200_000), "one.json": b"[" + b"7" * 200_000,
             "high.bin": bytes([200]) * 200_000, "holes.bin": bytes(100_000) + noise, "seps.txt": b"\n" * 150_000, "packed.gz": noise[:90_000], "odd [1] {b} 50%*?.x": noise[:-1],
             "small.bin": b"abc"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(runs, "WHOLE", 80_000, raising=False)
    settings = {"spark.sql.sources.binaryFile.maxLength": "100000", "spark.sql.files.maxPartitionBytes": "60000"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = runs.file_md5(spark, str(tmp_path)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {os.path.basename(r.path): (r.length, r.md5) for r in got} == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in files.items()}
    assert len(got) == len(files)


def test_equal_versions_merge_alike_in_any_order(spark, tmp_path):
    schema = "id string, timestamp string, year_month string, _version long, text string"
    found = set()
    for turn, texts in enumerate((("x", "y"), ("y", "x"))):
        target = str(tmp_path / str(turn))
        for t in texts:
            keyed.merge(spark, spark.createDataFrame([("a", "1", "2024-01", 1, t)], schema), target)
        found.add(keyed.read(spark, target).first().text)
    assert len(found) == 1


def test_job_entry_streams_and_backfills(spark, tmp_path):
    landing, out = _land(tmp_path / "in", _items(20)), str(tmp_path / "out")
    assert main(["--items", landing, "--out", out, "--stream", "--drop-raw"]) == 0
    table = keyed.read(spark, f"{out}/{sinks.STREAMED}")
    assert runs.run_history(spark, out).first().records_processed == 40 and runs.last_run_timestamp(spark, out)
    assert table.count() == 40 and not {"text", "original_text", "author"} & set(table.columns)
    recent = [dict(i, createdAt=int(datetime.now().timestamp()) - 86400, comments=[]) for i in _items(12, 50)]
    assert main(["--items", _land(tmp_path / "in", recent, "b.json"), "--out", out, "--backfill-only", "--drop-raw"]) == 0
    table = spark.read.parquet(f"{out}/{sinks.MAIN}.parquet")
    assert table.count() == 12 and "text" not in table.columns  # older messages lie before the cut


def test_runs_leave_no_staged_tables(spark, tmp_path):
    before = set(os.listdir(work_dir(spark)))
    assert run(spark, read_items(spark, _land(tmp_path / "in", _items(12))), str(tmp_path / "out"), run_ts=RUN, csv=False,
               settings=replace(DEFAULT, enable_topics=False)).success
    keyed.merge(spark, spark.createDataFrame([("a", "1", "2024-01", 1)], "id string, timestamp string, year_month string, _version int"),
                str(tmp_path / "t"))
    assert not {n for n in set(os.listdir(work_dir(spark))) - before if n.startswith(("run-", "merge-"))}


def test_staged_tables_go_when_they_are_released(spark):
    release(spark)
    before = set(os.listdir(work_dir(spark)))  # others may use the folder, too
    table = stage(spark.range(5))
    assert table.count() == 5 and len(set(os.listdir(work_dir(spark))) - before) == 1
    release(spark)
    assert not set(os.listdir(work_dir(spark))) - before


def test_dry_run(capsys):
    assert main(["--dry-run"]) == 0 and "settings valid" in capsys.readouterr().out


def test_stream_equals_batch_and_merges_new_versions(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    _land(landing, _items(20))
    go = lambda: stream.start_incremental(spark, str(landing), target, checkpoint).awaitTermination()
    go()
    read = lambda: keyed.read(spark, target)
    assert read().count() == 40
    go()  # nothing new
    assert read().count() == 40
    changed = _items(25, 15, body="the doctor moved, a quiet day at the clinic for us all")
    for item in changed:
        item["createdAt"] += 40 * 86400 if item["id"] == "p16" else 0
    _land(landing, changed, "b.json")
    go()
    rows = {r.id: r for r in read().collect()}
    assert len(rows) == read().count() == 80
    assert rows["p15"]._version > rows["p14"]._version and "quiet" in rows["p15"].text
    assert str(rows["p16"].year_month) == "2024-02"  # moved to another month, once
    # A new checkpoint reads every file again: the newest one still wins.
    _land(landing, _items(1, 15, body="the doctor came back to the clinic and all of us were glad"), "c.json")
    checkpoint = str(tmp_path / "check2")
    go()
    rows = {r.id: r for r in read().collect()}
    assert len(rows) == read().count() == 80
    assert "glad" in rows["p15"].text and "quiet" in rows["p16"].text and "terrible" in rows["p14"].text


def test_stream_duplicates(spark, tmp_path):
    schema = "id string, timestamp timestamp"
    landing, out = tmp_path / "in", str(tmp_path / "out")
    rows = lambda ids, year=2024: [{"id": i, "timestamp": f"{year}-01-01T00:00:00Z"} for i in ids]

    def go():
        source = spark.readStream.schema(schema).json(str(landing))
        (stream.drop_seen(source).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination())

    _land(landing, rows("aab"))
    go()
    _land(landing, rows("bc"), "b.json")
    go()
    _land(landing, rows("abd", 2019), "late.json")  # a new message with an old time is not lost
    go()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


VERSIONED = "id string, timestamp string, year_month string, _version int"


@pytest.mark.parametrize("emptied", [True, False])
def test_merge_leaves_no_stale_month(spark, tmp_path, emptied):
    target = str(tmp_path / "t")
    rows = lambda data: spark.createDataFrame(data, VERSIONED)
    keyed.merge(spark, rows([("a", "1", "2024-01", 1), ("b", "1", "2024-01" if not emptied else "2024-02", 1)]), target)
    keyed.merge(spark, rows([("a", "2", "2024-03", 2)]), target)
    assert sorted((r.id, r.year_month) for r in keyed.read(spark, target).collect()) == [
        ("a", "2024-03"), ("b", "2024-02" if emptied else "2024-01")]


def test_merge_reads_only_what_it_touches(spark, tmp_path, monkeypatch):
    target, draw, want = str(tmp_path / "t"), random.Random(3), {}

    def merge(rows):
        for row in rows:
            want[row[0]] = max(row, want.get(row[0], row), key=lambda r: (r[3], r[1]))
        return keyed.merge(spark, spark.createDataFrame(rows, VERSIONED), target, buckets=8)

    merge([(f"i{i}", "000", f"2024-0{1 + i % 6}", 1) for i in range(300)])
    seen = []
    cells = keyed._cells
    monkeypatch.setattr(keyed, "_cells", lambda *args: seen.append(cells(*args)) or seen[-1])
    done = merge([("i7", "001", "2024-06", 2), ("new", "001", "2024-06", 2)])
    # Month of the old i7, and month of both rows, in at most two buckets.
    assert done.buckets and len(done.buckets) <= 2 and done.read <= {(m, b) for m in ("2024-02", "2024-06") for b in done.buckets}
    files = [tuple(f.split("/")[-3:-1]) for f in seen[0].inputFiles()]
    assert files and {(m[3:], int(b[3:])) for m, b in files} == done.read
    for k in range(4):
        merge([(f"i{draw.randrange(320)}", f"{100 + 25 * k + j}", f"2024-0{draw.randint(1, 7)}", draw.randint(0, 4)) for j in range(25)])
    assert sorted(tuple(r) for r in keyed.read(spark, target).collect()) == sorted(want.values())
    months = {"2024-02", "2024-03"}
    assert sorted(tuple(r) for r in keyed.read(spark, target, months).collect()) == sorted(r for r in want.values() if r[2] in months)
    used = {"/".join(f.split("/")[:2]) for n in keyed.snapshots(spark, target)
            for f in keyed.Snapshot.of(open(f"{target}/manifest/{n}").read()).folders()}
    assert {f"{kind}/{n}" for kind in ("data", "index") for n in os.listdir(f"{target}/{kind}")} == used and len(keyed.snapshots(spark, target)) == 2


def test_a_merge_that_fails_leaves_the_old_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    rows = lambda data: spark.createDataFrame(data, VERSIONED)
    keyed.merge(spark, rows([("a", "1", "2024-01", 1), ("b", "1", "2024-01", 1)]), target)
    reader = keyed.read(spark, target)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(keyed, "switch", fail)
        with pytest.raises(OSError, match="lost"):
            keyed.merge(spark, rows([("a", "2", "2024-02", 2)]), target)
    assert sorted((r.id, r.year_month) for r in keyed.read(spark, target).collect()) == [("a", "2024-01"), ("b", "2024-01")]
    keyed.merge(spark, rows([("a", "2", "2024-02", 2)]), target)
    assert sorted((r.id, r.year_month) for r in keyed.read(spark, target).collect()) == [("a", "2024-02"), ("b", "2024-01")]
    assert reader.count() == 2  # a reader that began before the merge
    with pytest.raises(FileExistsError):
        keyed.switch(spark, target, keyed.snapshot(spark, target))
    with pytest.raises(ValueError, match="no table"):
        keyed.read(spark, str(tmp_path / "none"))


def test_second_run_reads_only_new_files(spark, tmp_path):
    landing, out = _land(tmp_path / "in", _items(30)), str(tmp_path / "out")
    plain = replace(DEFAULT, enable_topics=False)
    go = lambda **more: run_landing(spark, landing, out, plain, incremental=True, csv=False, **more)
    assert ledger.pending(spark, str(tmp_path / "none"), out).count() == 0
    assert go(run_ts=RUN).records == 60
    assert [r.path.split("/")[-1] for r in ledger.taken(spark, out).collect()] == ["a.json"]
    assert not go().success  # nothing landed
    _land(tmp_path / "in", _items(12, 200), "b.json")
    pending = ledger.pending(spark, landing, out)
    assert [r.path.split("/")[-1] for r in pending.collect()] == ["b.json"]
    read = read_items(spark, [r.path for r in pending.collect()])
    assert [f.split("/")[-1] for f in read.inputFiles()] == ["b.json"]
    # Comments are older than the first run: they are kept where late messages are wanted.
    later = datetime(2024, 12, 1, tzinfo=timezone.utc)
    result = go(run_ts=later, late=True, merge=True)
    assert result.success and result.records == 24
    assert keyed.read(spark, f"{out}/{sinks.STREAMED}").count() == 24
    assert ledger.taken(spark, out).count() == 2
    _land(tmp_path / "in", _items(3, 300), "c.json")
    assert "at least 10" in go(late=True).error  # too little: taken in together with what lands next
    _land(tmp_path / "in", _items(20, 290), "d.json")
    result = go(run_ts=later, late=True, merge=True)
    assert result.records == 40 and keyed.read(spark, f"{out}/{sinks.STREAMED}").count() == 24 + 40
    assert spark.read.parquet(f"{out}/{sinks.MAIN}.parquet").count() == 24 + 40  # outputs of the whole merged table


def test_monthly_state_of_batches_equals_one(spark, tmp_path, monkeypatch):
    draw, path = random.Random(8), str(tmp_path / "state")
    rows = [(str(i), f"2024-{1 + i % 14:02d}" if i % 14 < 12 else None, None if i % 9 == 0 else round(draw.uniform(-1, 1), 6),
             draw.choice(["Positive", "Negative", "Neutral", None]), i % 3 == 0, i % 5 == 0) for i in range(500)]
    frame = lambda own: spark.createDataFrame(own, "id string, year_month string, sentiment_score double, sentiment_label string, "
                                                   "mentions_oregon boolean, mentions_partner boolean")
    near = lambda df: [tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.orderBy("year_month").collect()]
    assert state.monthly_series(spark, path).isEmpty()
    assert state.add_batch(spark, frame(rows[:200]), path, 0)
    with monkeypatch.context() as broken:
        broken.setattr(state, "write_text", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.add_batch(spark, frame(rows[200:]), path, 1)
    assert near(state.monthly_series(spark, path)) == near(monthly_sentiment(frame(rows[:200])))
    assert state.add_batch(spark, frame(rows[200:450]), path, 1) and not state.add_batch(spark, frame(rows[200:450]), path, 1)
    assert state.add_batch(spark, frame(rows[450:]), path, 7)
    assert near(state.monthly_series(spark, path)) == near(monthly_sentiment(frame(rows)))
    assert len([n for n in os.listdir(path) if n.startswith("state-")]) == 2


def test_second_run_lands_files_in_several_tasks(spark, tmp_path, monkeypatch):
    from registry import queries
    rows = [(i, f"title {i}\nfirst. second {i}", "en", "s", 20) for i in range(48)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries.data, "table", lambda spark, sf, name: spark.read.parquet(f"{sf}/{name}.parquet").repartition(4))
    read, files = queries.item_source.read_items, []
    monkeypatch.setattr(queries.item_source, "read_items", lambda spark, path, *more: files.extend(path) or read(spark, path, *more))
    out = queries.landing_ledger(spark, str(tmp_path)).collect()
    assert {r.id for r in out if r.type == "Post"} == {str(i) for i in range(48) if i % 4 == 3 or i % 4 == 1 and i % 3 == 0} and len(out) == 48
    landed = [f.split("/")[-2] for f in files]
    assert landed.count("part=3") > 1 and landed.count("part=1") > 1 and set(landed) == {"part=1", "part=3"}
