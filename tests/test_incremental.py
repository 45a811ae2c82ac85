"""Incremental loads: each landed file exactly once across restarts (S1),
resumable batch append skips loaded keys (A10), refresh equals batch (S2)."""

import os

import pytest

from pyspark.sql import functions as F

from tenurekit.operators.panel import build_longitudinal
from tenurekit.operators.rules import rules_frame
from tenurekit.sources.landing import resumable_append
from tenurekit.streaming import incremental as I

SCHEMA = "player string, year int, league string, split string, _line long"
RULES = [("LEC", "exact", 1, "EU"), ("__DEFAULT__", "default", 2, "Unknown")]


def _rows(start, n, year):
    return [(f"p{i % 7}", year, "LEC" if i % 5 == 0 else "Academy", "Spring", start + i) for i in range(n)]


def test_stream_exactly_once_across_restarts(spark):
    base = I.scratch_dir(spark, "t-ingest")
    landing, history, ckpt = (os.path.join(base, x) for x in ("landing", "history", "ckpt"))
    spark.createDataFrame(_rows(0, 20, 2019), SCHEMA).write.parquet(os.path.join(landing, "a"))
    schema = spark.createDataFrame([], SCHEMA).schema
    I.run_ingest(spark, landing, schema, history, ckpt, bucket_by=("player", 4))
    assert I.read_history(spark, history).count() == 20
    # restart with nothing new: no rows added
    I.run_ingest(spark, landing, schema, history, ckpt, bucket_by=("player", 4))
    assert I.read_history(spark, history).count() == 20
    # a new file: only it is processed
    spark.createDataFrame(_rows(100, 5, 2020), SCHEMA).write.parquet(os.path.join(landing, "b"))
    I.run_ingest(spark, landing, schema, history, ckpt, bucket_by=("player", 4))
    h = I.read_history(spark, history)
    assert h.count() == 25 and h.select("_line").distinct().count() == 25


def test_refresh_equals_batch_with_late_data(spark):
    base = I.scratch_dir(spark, "t-refresh")
    landing, history, panel, ckpt = (os.path.join(base, x) for x in ("landing", "history", "panel", "ckpt"))
    late_first = _rows(0, 30, 2021) + _rows(30, 10, 2022)
    early = _rows(40, 15, 2018)          # an earlier season arriving last moves debuts
    spark.createDataFrame(late_first, SCHEMA).write.parquet(os.path.join(landing, "c0"))
    spark.createDataFrame(early, SCHEMA).write.parquet(os.path.join(landing, "c1"))
    rules = rules_frame(spark, RULES)
    cb = I.panel_refresher(spark, history, panel, rules, entity="player", period="year", n_buckets=4,
                           tiebreak="_line")
    schema = spark.createDataFrame([], SCHEMA).schema
    I.run_ingest(spark, landing, schema, history, ckpt, on_batch=cb, max_files_per_trigger=1,
                 bucket_by=("player", 4))
    got = sorted(map(tuple, I.read_panel(spark, panel).collect()))
    batch = build_longitudinal(spark.createDataFrame(late_first + early, SCHEMA), rules, None, tiebreak="_line")
    assert got == sorted(map(tuple, batch.collect()))


def test_resumable_append_skips_loaded_keys(spark):
    base = I.scratch_dir(spark, "t-resume")
    target = os.path.join(base, "t")
    first = spark.createDataFrame([(2019, "LEC", 1), (2019, "LCS", 2)], "season int, league string, v int")
    resumable_append(spark, first, None, ["season", "league"], target)
    again = spark.createDataFrame([(2019, "LEC", 9), (2020, "LEC", 3)], "season int, league string, v int")
    done = spark.read.parquet(target).select("season", "league")
    resumable_append(spark, again, done, ["season", "league"], target)
    got = sorted(map(tuple, spark.read.parquet(target).collect()))
    assert got == [(2019, "LCS", 2), (2019, "LEC", 1), (2020, "LEC", 3)]


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_second_run_rewrites_only_touched_buckets(spark):
    base = I.scratch_dir(spark, "t-touch")
    landing, history, panel, ckpt = (os.path.join(base, x) for x in ("landing", "history", "panel", "ckpt"))
    first = [(f"p{i}", 2019, "Academy", "Spring", i) for i in range(60)]
    newer = [("p3", 2023, "LEC", "Spring", 900)]  # a new newest period
    schema = spark.createDataFrame([], SCHEMA).schema
    rules = rules_frame(spark, RULES)

    def run():  # every run has a callback of its own, as after a restart
        cb = I.panel_refresher(spark, history, panel, rules, entity="player", period="year", n_buckets=8, tiebreak="_line")
        I.run_ingest(spark, landing, schema, history, ckpt, on_batch=cb, bucket_by=("player", 8))
    spark.createDataFrame(first, SCHEMA).write.parquet(os.path.join(landing, "a"))
    run()
    before = _files(panel)
    spark.createDataFrame(newer, SCHEMA).write.parquet(os.path.join(landing, "b"))
    run()
    after = _files(panel)
    gone = {os.path.basename(os.path.dirname(f)) for f in before - after}
    assert len(gone) == 1 and {os.path.basename(os.path.dirname(f)) for f in after - before} == gone and len(before & after) > 0
    got = sorted(map(str, I.read_panel(spark, panel).collect()))
    batch = build_longitudinal(spark.createDataFrame(first + newer, SCHEMA), rules, None, tiebreak="_line")
    assert I.read_panel(spark, panel).columns == batch.columns
    assert got == sorted(map(str, batch.collect()))
    assert not any(r.censored for r in I.read_panel(spark, panel).collect())  # 2019 is long past now


def test_other_number_of_buckets_is_an_error(spark):
    base = I.scratch_dir(spark, "t-buckets")
    history, panel = os.path.join(base, "h"), os.path.join(base, "p")
    I.panel_refresher(spark, history, panel, rules_frame(spark, RULES), entity="player", period="year", n_buckets=4)
    with pytest.raises(ValueError):
        I.panel_refresher(spark, history, panel, rules_frame(spark, RULES), entity="player", period="year", n_buckets=8)
    with pytest.raises(ValueError):
        I.run_ingest(spark, base, spark.createDataFrame([], SCHEMA).schema, history, os.path.join(base, "c"), bucket_by=("player", 8))


def test_jsonl_quarantine(spark):
    base = I.scratch_dir(spark, "t-jsonl")
    landing, history, bad, ckpt = (os.path.join(base, x) for x in ("landing", "history", "bad", "ckpt"))
    lines = ['{"player": "a", "year": 2019}', '{"player": "b", "year": "x"}', '{"player": "c"', "[1, 2]", "null", "", "  ", '{"year": 2020}', '{"player": "d", "extra": 1}', '"text"']
    schema = spark.createDataFrame([], "player string, year int").schema
    spark.createDataFrame([(x,) for x in lines], "v string").write.text(os.path.join(landing, "a"))
    run = lambda: I.run_ingest_jsonl(spark, landing, schema, history, bad, ckpt, required=("player",), bucket_by=("player", 2))
    run()
    run()  # nothing twice
    assert sorted(map(tuple, I.read_history(spark, history).collect()), key=str) == [("a", 2019), ("d", None)]
    q = spark.read.parquet(bad)
    assert sorted((r.raw, r.reason) for r in q.collect()) == sorted(
        [(x, "not readable under the schema") for x in ('{"player": "b", "year": "x"}', '{"player": "c"', "[1, 2]", "null", '"text"')] + [('{"year": 2020}', "no player")])
    assert all("/landing/a/" in r.file for r in q.collect())
    spark.createDataFrame([('{"player": "e", "year": 1}',)], "v string").write.text(os.path.join(landing, "b"))
    run()
    assert I.read_history(spark, history).count() == 3 and spark.read.parquet(bad).count() == 6


def _replay(spark, name, batches, n_buckets=4, rules=RULES, **kw):
    """Each batch landed and taken in by itself; gives history, panel and a way to go on."""
    base = I.scratch_dir(spark, name)
    landing, history, panel, ckpt = (os.path.join(base, x) for x in ("landing", "history", "panel", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def take(rows, name, rules=rules):
        spark.createDataFrame(rows, SCHEMA).write.parquet(os.path.join(landing, name))
        cb = I.panel_refresher(spark, history, panel, rules_frame(spark, rules), entity="player", period="year", n_buckets=n_buckets, tiebreak="_line", **kw)
        I.run_ingest(spark, landing, schema, history, ckpt, on_batch=cb, bucket_by=("player", n_buckets))
    for i, rows in enumerate(batches):
        take(rows, f"b{i}")
    return history, panel, take


def _read(spark, panel):
    return sorted(map(str, I.read_panel(spark, panel).collect()))


def _batch(spark, rows, rules=RULES, **kw):
    return sorted(map(str, build_longitudinal(spark.createDataFrame(rows, SCHEMA), rules_frame(spark, rules), None, tiebreak="_line", **kw).collect()))


MIXED = [_rows(0, 30, 2021) + _rows(30, 10, 2022) + [(None, 2020, "LEC", "Spring", 500), ("n", None, None, None, 501)],
         _rows(40, 15, 2018) + [("p1", 2021, None, "Summer", 600)],  # an earlier season, late
         [("p2", 2017, "LEC", "Winter", 700), ("new", 2023, "Academy", None, 701)],
         [("n", 2019, "Academy", "Spring", 800), (None, None, "Academy", None, 801)]]


@pytest.mark.parametrize("null_skipping", [False, True])
def test_waiting_rows_read_as_one_panel_and_no_old_row_is_read_again(spark, monkeypatch, null_skipping):
    monkeypatch.setattr(I, "FOLD_BYTES", 0)
    read = []
    original = I.build_longitudinal
    monkeypatch.setattr(I, "build_longitudinal", lambda rows, *a, **k: read.append(rows.count()) or original(rows, *a, **k))
    kw = dict(null_skipping=null_skipping)
    _, panel, take = _replay(spark, "t-wait", MIXED[:1], **kw)
    rows = list(MIXED[0])
    for i, more in enumerate(MIXED[1:]):
        take(more, f"more{i}")
        rows += more
        assert _read(spark, panel) == _batch(spark, rows, **kw)
    assert read == [len(b) for b in MIXED]
    assert I._waiting(spark, panel)
    monkeypatch.setattr(I, "FOLD_FILES", 1)
    last = [(f"p{i}", 2024, "LEC", "Spring", 900 + i) for i in range(7)] + [("n", 2024, "LEC", "Spring", 950), ("new", 2024, "LEC", "Spring", 951), (None, 2024, "LEC", "Spring", 952)]
    take(last, "last")
    assert not I._waiting(spark, panel) and _read(spark, panel) == _batch(spark, rows + last, **kw)


def test_panel_is_built_anew_where_it_cannot_go_on(spark, monkeypatch):
    monkeypatch.setattr(I, "FOLD_BYTES", 0)
    history, panel, take = _replay(spark, "t-anew", MIXED[:2])
    rows = MIXED[0] + MIXED[1]
    again = spark.createDataFrame(MIXED[1], SCHEMA)
    cb = I.panel_refresher(spark, history, panel, rules_frame(spark, RULES), entity="player", period="year", n_buckets=4, tiebreak="_line")
    cb(again, 1)  # a replayed batch
    assert _read(spark, panel) == _batch(spark, rows) and not I._waiting(spark, panel)
    I._keep_state(spark, panel, None)  # as a fold that was cut off leaves it
    take(MIXED[2], "c")
    assert _read(spark, panel) == _batch(spark, rows + MIXED[2])
    other = [("Academy", "exact", 1, "AC"), ("__DEFAULT__", "default", 2, "Unknown")]
    take(MIXED[3], "d", rules=other)
    assert _read(spark, panel) == _batch(spark, rows + MIXED[2] + MIXED[3], rules=other)


def test_an_empty_first_batch(spark):
    history, panel, take = _replay(spark, "t-empty", [])
    cb = I.panel_refresher(spark, history, panel, rules_frame(spark, RULES), entity="player", period="year", n_buckets=4, tiebreak="_line")
    I._write_epoch(spark.createDataFrame(MIXED[0], SCHEMA).limit(0), os.path.join(history, "_epoch=0"), None)
    cb(spark.createDataFrame([], SCHEMA), 0)
    cb(spark.createDataFrame(MIXED[0], SCHEMA), 1)
    assert _read(spark, panel) == _batch(spark, MIXED[0])
