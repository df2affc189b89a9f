"""SQL runner, strict validation, streaming replay."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException

from lakefold import schemas as S
from lakefold.operators.validate import Rule, availability_rules, split_valid, strict, validate
from lakefold.plans.jobs import run_flight_pipeline
from lakefold.plans.sqlrun import run_sql, run_sql_report
from lakefold.storage.table import ArchiveTable
from lakefold.streaming.ingest import ingest_stream
from tests.conftest import SF, sample_record


def test_run_sql_blank_and_errors(spark):
    with pytest.raises(ValueError):
        run_sql(spark, "   ")
    rep = run_sql_report(spark, "SELECT count(*) AS n FROM orders", {"orders": f"{SF}/orders.parquet"})
    assert rep["rows"] == 1 and "seconds" in rep
    bad = run_sql_report(spark, "SELECT * FROM delta_scan('s3://x/availability') LIMIT 10")
    assert "error" in bad


def test_sql_report_returns_rows_in_order_and_errors_of_shown_columns(spark, scratch):
    rep = run_sql_report(spark, "SELECT id, id AS id, null AS nothing, interval 1 day AS d FROM range(1000) ORDER BY id DESC", limit=3)
    assert rep["columns"] == ["id", "id", "nothing", "d"] and rep["rows"] == 1000 and rep["truncated"]
    assert [r[:3] for r in rep["data"]] == [[999, 999, None], [998, 998, None], [997, 997, None]]
    # Only the shown column fails: a count of the rows would not notice.
    bad = run_sql_report(spark, "SELECT id, assert_true(id < 5) AS checked FROM range(10)")
    assert "assert_true" in bad["error"].lower() or "is not true" in bad["error"]
    none = run_sql_report(spark, "SELECT 1 AS x WHERE false")
    assert (none["rows"], none["data"], none["truncated"]) == (0, [], False)
    t = ArchiveTable(spark, scratch + "/t")
    t.save(spark.range(4).toDF("k"), "merge", ["k"])
    assert run_sql_report(spark, "SELECT sum(k) AS s FROM stored", {"stored": t})["data"] == [[6]]


def test_validation_rules_and_strict(spark, wide_rows):
    rows = [*wide_rows, sample_record(3, YMileageCost=""), sample_record(4, Route=None), sample_record(5, YAvailable=None),
            sample_record(6, ParsedDate="soon"), sample_record(7, ID=None, WRemainingSeats=None)]
    checked = validate(spark.createDataFrame(rows, S.AVAILABILITY_RECORD), availability_rules())
    ok, rejects = split_valid(checked)
    assert sorted(r.ID for r in ok.collect()) == ["rec0", "rec1", "rec3"]
    got = {r.Date: list(r._reasons) for r in rejects.collect()}
    assert got["2031-07-03"] == ["value:Source"] and got["2031-07-06"] == ["missing:YAvailable"] and got["2031-07-07"] == ["type:ParsedDate"]
    assert got["2031-07-05"] == [f"missing:Route.{f.name}" for f in S.ROUTE.fields]
    assert got["2031-07-08"] == ["missing:ID", "missing:WRemainingSeats"]
    typed = validate(spark.createDataFrame([("x",), (None,)], "n string"), [Rule("n", required=True, dtype=S.T.IntegerType())])
    assert sorted(tuple(r._reasons) for r in typed.collect()) == [("missing:n",), ("type:n",)]
    with pytest.raises(PySparkException):
        strict(checked).select("Date").collect()  # whatever columns are kept
    assert strict(validate(ok, availability_rules())).select("ID").count() == 3


def _land(path, pages):
    import os

    os.makedirs(path, exist_ok=True)
    for i, p in enumerate(pages):
        name = f"{path}/page-{i:03d}.json"
        with open(name, "w") as f:
            f.write((p if isinstance(p, str) else json.dumps(p)) + "\n")
        os.utime(name, (1_700_000_000 + 60 * i, 1_700_000_000 + 60 * i))  # arrival order


def _rec(i, cost, **changed):
    return sample_record(i, YMileageCost=cost, **changed)


def _page(cursor, records, more):
    return {"data": records, "count": len(records), "hasMore": more, "cursor": cursor}


KEYED = {"keys": ["ID"], "partition_by": ["Source"], "ingestion_ts": dt.datetime(2031, 1, 1, tzinfo=dt.timezone.utc)}


def _state(spark, table):
    return {r.ID: r.YMileageCost for r in ArchiveTable(spark, table).current().collect()}


def test_stream_replay_is_idempotent(spark, scratch):
    landed, table = scratch + "/landed", scratch + "/t"
    _land(landed, [_page(0, [_rec(1, "100"), _rec(2, "200")], True), _page(1, [_rec(2, "250"), _rec(3, "300")], False)])
    st = ingest_stream(spark, landed, table, scratch + "/ckpt", files_per_batch=1, **KEYED)
    assert st["batches"] == 2 and st["rows_inserted"] == 3 and st["rejects"] == 0
    got = _state(spark, table)
    assert got == {"rec1": "100", "rec2": "250", "rec3": "300"}
    assert ingest_stream(spark, landed, table, scratch + "/ckpt", files_per_batch=1, **KEYED)["batches"] == 0
    # Checkpoint lost: the stream reads everything again and changes nothing.
    again = ingest_stream(spark, landed, table, scratch + "/ckpt2", files_per_batch=1, **KEYED)
    assert again["batches"] == 2 and again["rows_written"] == 0 and _state(spark, table) == got


def test_streams_and_batches_keep_each_others_rows(spark, scratch):
    table = scratch + "/t"
    for k in range(3):
        _land(f"{scratch}/landed{k}", [_page(0, [_rec(2 * k, "1"), _rec(2 * k + 1, "2")], False)])
    run_flight_pipeline(spark, f"{scratch}/landed0", table, **KEYED)
    for k in (1, 2):
        ingest_stream(spark, f"{scratch}/landed{k}", table, f"{scratch}/ckpt{k}", **KEYED)
    assert sorted(_state(spark, table)) == [f"rec{i}" for i in range(6)]


CHAINS = {
    "run=0/program=a": [_page(0, [_rec(0, "1")], False), _page(1, [_rec(1, "1")], False)],
    "run=0/program=b": [_page(0, [_rec(2, "1")], True), _page(1_000_000, [_rec(3, "1")], True), _page(2_000_000, [_rec(4, "1")], False)],
    "run=0/program=c": [_page(0, [_rec(5, "1")], True), _page(1, [], True), _page(2, [_rec(6, "1")], False)],
    "run=1/program=b": [_page(0, [_rec(2, "9")], True), "{\"data\": [oops", _page(5, [_rec(7, "1")], True)],
}


@pytest.mark.parametrize("max_pages, want", [(None, "02345 7"), (1, "025"), (0, "")])
def test_page_chains_of_runs_and_programs(spark, scratch, max_pages, want):
    for name, pages in CHAINS.items():
        _land(f"{scratch}/landed/{name}", pages)
    want = {f"rec{c}": "9" if c == "2" else "1" for c in want if c != " "}
    batch = run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", max_pages=max_pages, **KEYED)
    assert _state(spark, scratch + "/t") == want
    assert batch["rejects"] == 1 and batch["no_data"] == (not want)
    assert batch["pages_fetched"] == {None: 7, 1: 4, 0: 0}[max_pages]
    stream = ingest_stream(spark, scratch + "/landed", scratch + "/s", scratch + "/ckpt", files_per_batch=1, max_pages=max_pages, **KEYED)
    assert _state(spark, scratch + "/s") == want and stream["rejects"] == 1


def test_flight_pipeline_keeps_rejects_and_default_layout(spark, scratch):
    landed = scratch + "/landed"
    _land(landed, [_page(0, [_rec(1, "100"), _rec(9, "1", Source="nosuch")], False)])
    st = run_flight_pipeline(spark, landed, scratch + "/t", rejects_path=scratch + "/rejects")
    assert st["rows_inserted"] == 1 and st["rejects"] == 1 and st["api_records"] == 2
    r = spark.read.parquet(scratch + "/rejects").collect()[0]
    assert r.ID == "rec9" and list(r._reasons) == ["value:Source"]
    t = ArchiveTable(spark, scratch + "/t")
    assert t.info()["metadata"]["partition_by"] == S.FLIGHT_PARTITIONS and t.info()["metadata"]["keys"] == S.FLIGHT_KEYS


def test_landed_pages_are_compressed_in_bounded_files_and_read_back(spark, scratch, monkeypatch):
    from lakefold.plans import jobs

    monkeypatch.setattr(jobs, "_PAGES_A_FILE", 2, raising=False)
    records = spark.createDataFrame([_rec(i, str(i), Source="united") for i in range(9)], S.AVAILABILITY_RECORD)
    jobs.land_pages(records, scratch + "/landed", page_size=1)
    files = [f for _, _, names in os.walk(scratch + "/landed") for f in names if f.startswith("part-")]
    pages = jobs.read_landed_pages(spark, scratch + "/landed")
    assert all(f.endswith(".json.gz") for f in files) and len(files) >= pages.count() / 2
    assert sum(len(r.data) for r in pages.collect()) == 9
    assert run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", **KEYED)["rows_inserted"] == 9


def test_pages_become_rows_and_are_not_cached_whole(spark, scratch, monkeypatch):
    """Empty and unreadable pages are a row each; nothing stays cached while the batch is saved."""
    from pyspark.sql import DataFrame

    from lakefold.plans import jobs

    def refuse(self, *a):
        raise AssertionError("cached")

    _land(scratch + "/landed/run=3/program=a", [_page(0, [_rec(1, "1"), _rec(2, "2")], True), _page(1, [], True), "{\"data\": [oops"])
    rows = jobs.page_rows(jobs.read_landed_pages(spark, scratch + "/landed")).collect()
    assert sorted((r._pos, r.ID, r.n_records, r._told) for r in rows if r._pos is not None) == [(0, "rec1", 2, None), (1, "rec2", 2, None)]
    assert [r._told for r in rows if r._pos is None and r._raw] == [["corrupt:page"]] and len(rows) == 4
    monkeypatch.setattr(DataFrame, "persist", refuse)
    st = run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", **KEYED)
    assert (st["rows_inserted"], st["rejects"], st["pages_fetched"]) == (2, 1, 1)


def test_pages_land_and_merge_in_slices(spark, scratch, monkeypatch):
    """Slices hold all records once; cursors stay 0, 1, ... and only a program's last page says so."""
    from lakefold.plans import jobs
    from lakefold.storage import table

    monkeypatch.setattr(jobs, "_SLICE_RECORDS", 10)
    monkeypatch.setattr(table, "_SLICE_ROWS", 8)
    records = spark.createDataFrame([_rec(i, str(i), Source=("united", "alaska")[i % 2]) for i in range(30)], S.AVAILABILITY_RECORD)
    asked = []

    def part(k, n):
        asked.append((k, n))
        return records.filter(jobs.derive.slice_of("ID", n) == k)

    jobs.land_pages(records, scratch + "/landed", page_size=5, part=part)
    assert asked == [(0, 3), (1, 3), (2, 3)]
    pages = jobs.read_landed_pages(spark, scratch + "/landed").collect()
    for program in ("united", "alaska"):
        own = sorted((p.cursor, p.hasMore) for p in pages if p.program == program)
        assert [c for c, _ in own] == sorted({c for c, _ in own}) and [more for _, more in own] == [True] * (len(own) - 1) + [False]
    assert sorted(r.ID for p in pages for r in p.data) == sorted(f"rec{i}" for i in range(30))
    st = run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", **KEYED)
    assert (st["rows_inserted"], st["rows_written"], st["api_records"]) == (30, 30, 30)
    assert sorted(_state(spark, scratch + "/t")) == sorted(f"rec{i}" for i in range(30))
    again = run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", **KEYED)
    assert (again["rows_unchanged"], again["rows_written"]) == (30, 0)


def test_fold_reads_the_batch_in_place(spark, scratch):
    """Only keys, order and hash are shuffled, and a record that stands twice
    at one page and place (of two programs) is taken once."""
    from lakefold.plans import jobs

    page = [_page(0, [_rec(1, "1"), _rec(2, "2")], True), _page(1, [_rec(1, "9")], False)]
    for program in "ab":
        _land(f"{scratch}/landed/run=0/program={program}", page)
    rows = jobs.placed(jobs.scratch_table(jobs.page_rows(jobs.read_landed_pages(spark, scratch + "/landed")), "pages"))
    batch, told, rejects, facts = jobs.flight_batch(rows, keys=["ID"])
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan
    assert sorted((r.ID, r.YMileageCost) for r in batch.collect()) == [("rec1", "9"), ("rec2", "2")]
    assert sorted(r[S.CONTENT_HASH] for r in batch.collect()) == sorted(r[S.CONTENT_HASH] for r in told.collect())
    assert rejects.count() == 0 and facts.count() == 4


def test_shuffled_files_go_when_a_query_ends(spark, scratch):
    from lakefold.session import shuffles_end_with_queries

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = local.getAllBlocks().size()
    with shuffles_end_with_queries(spark):
        spark.range(1000).repartition(3).write.parquet(scratch + "/a")
        assert local.getAllBlocks().size() <= held
    assert spark.conf.get(name, None) == before


def test_changed_rows_are_read_in_parts_of_whole_files(spark, scratch, monkeypatch):
    """However many parts there are, a stored file belongs to one of them; landing reads its input few times."""
    from pyspark.sql import functions as F

    from lakefold.functions.hashing import add_metadata
    from lakefold.operators.merge import ACTION
    from lakefold.operators.shape import flatten_availability
    from lakefold.plans import jobs

    monkeypatch.setattr(jobs, "_SLICE_RECORDS", 2)
    monkeypatch.setattr(jobs, "_ROWS_A_FILE", 2)
    records = spark.createDataFrame([_rec(i, str(i), Source="united") for i in range(30)], S.AVAILABILITY_RECORD)
    asked = []
    jobs.land_pages(records, scratch + "/landed", page_size=1, part=lambda k, n: asked.append(n) or records.filter(jobs.derive.slice_of("ID", n) == k))
    assert asked == [8] * 8
    rows = jobs.placed(jobs.scratch_table(jobs.page_rows(jobs.read_landed_pages(spark, scratch + "/landed")), "pages", 2))
    flights, latest, _, _ = jobs.folded(rows, keys=["ID"])
    hashes = {r.ID: r[S.CONTENT_HASH] for r in add_metadata(flatten_availability(records)).collect()}
    assert {r.ID: r[S.CONTENT_HASH] for r in flights.collect()} == hashes  # made once, when pages are parsed
    changed = latest.withColumn(ACTION, F.when(F.col("ID") == "rec3", "update").otherwise("insert")).filter("ID != 'rec4'")
    parts = [p.collect() for p in jobs.marked_rows(flights, changed)]
    assert len(parts) >= 15 and all(parts)
    assert sorted(r.ID for p in parts for r in p) == sorted(set(hashes) - {"rec4"})
    assert [r.ID for p in parts for r in p if r[ACTION] == "update"] == ["rec3"]
    files = {r.ID: r._file for r in flights.select("ID", "_file").collect()}
    of = [{files[r.ID] for r in p} for p in parts]
    assert sum(map(len, of)) == len(set().union(*of))
    st = run_flight_pipeline(spark, scratch + "/landed", scratch + "/t", **KEYED)
    assert (st["rows_inserted"], st["rows_written"]) == (30, 30)
    assert {r.ID: r[S.CONTENT_HASH] for r in ArchiveTable(spark, scratch + "/t").current(["ID", S.CONTENT_HASH]).collect()} == hashes
