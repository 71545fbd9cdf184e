"""Queue intake as an available-now file stream, and the whole job writing partitioned output."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from caseload.plans import job
from caseload.plans.job import run_requests, serve_queue
from caseload.sources.sinks import drop_superseded, manifest, read_extracts, write_extracts
from caseload.sources.testdata import mapped_dataset
from caseload.streaming import intake
from caseload.streaming.intake import drain_queue, quarantined, read_requests, request_table

from .conftest import SF_SMALL


def _write(folder, name, params):
    (folder / name).write_text(params if isinstance(params, str) else json.dumps(params))


def _collector(seen):
    return lambda batch: seen.extend(sorted(r["params_path"].rsplit("/", 1)[1] for r in batch.select("params_path").collect()))


def test_queue_is_read_once_per_file_version(spark, tmp_path):
    queue, ledger, seen = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    for i in range(3):
        _write(queue, f"r{i}.json", {"dataset": f"NATION_{i}", "start_year": 2000})
    assert drain_queue(spark, str(queue), str(ledger), _collector(seen)) == 3
    _write(queue, "r3.json", {"dataset": "NATION_3", "start_year": 2000})
    assert drain_queue(spark, str(queue), str(ledger), _collector(seen)) == 1
    assert drain_queue(spark, str(queue), str(ledger), _collector(seen)) == 0
    assert seen == ["r0.json", "r1.json", "r2.json", "r3.json"]


def test_resubmitted_and_old_files_are_served(spark, tmp_path):
    queue, ledger, seen = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    _write(queue, "a.json", {"dataset": "NATION_1"})
    drain_queue(spark, str(queue), str(ledger), _collector(seen))
    _write(queue, "a.json", {"dataset": "NATION_2"})  # same path, new content
    _write(queue, "old.json", {"dataset": "NATION_3"})
    past = (queue / "old.json").stat().st_mtime - 20 * 86400
    os.utime(queue / "old.json", (past, past))
    assert drain_queue(spark, str(queue), str(ledger), _collector(seen)) == 2
    assert seen == ["a.json", "a.json", "old.json"]


def test_served_files_are_removed_in_the_same_drain(spark, tmp_path):
    queue, ledger, archive, seen = tmp_path / "queue", tmp_path / "ledger", tmp_path / "archive", []
    queue.mkdir()
    for name in ("r0.json", "r 1.json"):
        _write(queue, name, {"dataset": name})
    drain_queue(spark, str(queue), str(ledger), _collector(seen), clean_source="archive", archive_dir=str(archive))
    assert len(seen) == 2 and [p for p in queue.iterdir() if not p.name.startswith(".")] == []
    assert sorted(p.name[17:] for p in archive.iterdir() if not p.name.startswith(".")) == ["r 1.json", "r0.json"]
    _write(queue, "r2.json", {"dataset": "x"})
    drain_queue(spark, str(queue), str(ledger), _collector(seen), clean_source="delete")
    assert len(seen) == 3 and not (queue / "r2.json").exists()


def test_a_file_that_changes_while_it_is_served_stays(spark, tmp_path):
    queue, ledger, seen = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    _write(queue, "a.json", {"dataset": "first"})

    def slow(batch):
        seen.extend(r["params_text"] for r in batch.collect())
        if len(seen) == 1:
            _write(queue, "a.json", {"dataset": "second"})

    drain_queue(spark, str(queue), str(ledger), slow, clean_source="delete")
    assert (queue / "a.json").exists() and len(seen) == 1
    drain_queue(spark, str(queue), str(ledger), slow, clean_source="delete")
    assert [json.loads(t)["dataset"] for t in seen] == ["first", "second"] and not (queue / "a.json").exists()


def test_request_table_types_and_stamp(spark, tmp_path):
    queue = tmp_path / "q"
    queue.mkdir()
    _write(queue, "a.json", {"app_version": "v1", "dataset": "NATION_3", "scenario": "s", "seed": 7,
                             "start_year": 2000, "nested": {"x": 1}})
    r = request_table(read_requests(spark, str(queue))).first()
    assert r["metadata"]["create_datetime"] == r["create_datetime"]
    assert (r["code"], r["fyear"], r["seed"], r["scenario"]) == ("NATION_3", 2000, 7, "s")
    assert len(r["create_datetime"]) == 15 and r["create_datetime"][8] == "_"
    assert "nested" not in r["metadata"] and r["metadata"]["seed"] == "7"
    assert r["sample_rate"] == 0.01  # national default when the params give none


def test_serve_queue_end_to_end(spark, tmp_path):
    queue, out, ckpt, bad = tmp_path / "queue", tmp_path / "out", tmp_path / "ckpt", tmp_path / "bad"
    queue.mkdir()
    for code in ("NATION_3", "NATION_8"):
        _write(queue, f"{code}.json", {"app_version": "v9", "dataset": code, "scenario": "base", "seed": 1,
                                       "start_year": 2000})
    _write(queue, "broken.json", "{not json")
    _write(queue, "no_year.json", {"app_version": "v9", "dataset": "NATION_1", "scenario": "base"})
    data = mapped_dataset(spark, SF_SMALL)
    serve_queue(spark, data, str(queue), str(out), str(ckpt), "provider", quarantine_path=str(bad),
                kinds=["op", "inequalities"], factor_years=(1999, 2000))
    op = spark.read.parquet(str(out / "op"))
    assert set(r["run_dataset"] for r in op.select("run_dataset").distinct().collect()) == {"NATION_3", "NATION_8"}
    assert op.where("run_dataset = 'NATION_3'").count() == data.table("op").where(
        "dataset = 'NATION_3' AND fyear = 2000").count()
    reasons = sorted(r["reason"] for r in spark.read.parquet(str(bad)).collect())
    assert reasons == ["missing or invalid start_year", "not valid JSON"]
    runs = spark.read.json(str(out / "_runs"))
    assert runs.count() == 2


def test_write_extracts_replaces_only_touched_partitions(spark, tmp_path):
    from caseload.sources.sinks import write_extracts

    out = str(tmp_path / "out")
    first = spark.createDataFrame(
        [("v1", "A", "s", "t1", "q", 1), ("v1", "B", "s", "t1", "q", 2)],
        "app_version string, run_dataset string, scenario string, create_datetime string, request_id string, x int")
    write_extracts(first, out)
    write_extracts(spark.createDataFrame([("v1", "A", "s", "t1", "q", 10)], first.schema), out)
    got = sorted((r["run_dataset"], r["x"]) for r in spark.read.parquet(out).collect())
    assert got == [("A", 10), ("B", 2)]


def test_cached_releases(spark):
    from caseload.sources.dataset import cached

    df = spark.range(10)
    with cached(df) as kept:
        assert kept.is_cached
        assert kept.count() == 10
    assert not df.is_cached


def test_requests_with_the_same_labels_and_second_do_not_replace_each_other(spark, tmp_path):
    queue, out, bad = tmp_path / "queue", tmp_path / "out", tmp_path / "out" / "_quarantine"
    queue.mkdir()
    data = mapped_dataset(spark, SF_SMALL)
    params = {"app_version": "v1", "dataset": "NATION_3", "scenario": "s", "start_year": 2000}
    for name, more in (("a.json", {"x": 1}), ("b.json", {"x": 2})):
        _write(queue, name, params | more)
        os.utime(queue / name, (1_700_000_000, 1_700_000_000))
        serve_queue(spark, data, str(queue), str(out), str(tmp_path / "ledger"), "provider", kinds=["inequalities"])
    assert spark.read.json(str(out / "_runs")).count() == 2
    assert spark.read.parquet(str(out / "inequalities")).select("request_id").distinct().count() == 2
    # labels are required, and bad requests are kept without being asked to
    _write(queue, "c.json", {k: v for k, v in params.items() if k != "app_version"})
    serve_queue(spark, data, str(queue), str(out), str(tmp_path / "ledger"), "provider", kinds=["inequalities"], clean_source="delete")
    assert [r["reason"] for r in spark.read.parquet(str(bad)).collect()] == ["missing or invalid app_version"]


def test_command_line_serves_the_queue(spark, tmp_path):
    from bench import prepare
    from caseload.__main__ import main

    data_dir, queue, out = tmp_path / "data", tmp_path / "queue", tmp_path / "out"
    prepare(spark, SF_SMALL, str(data_dir))
    queue.mkdir()
    _write(queue, "r.json", {"app_version": "v1", "dataset": "AFRICA", "scenario": "s", "seed": 3, "start_year": 2000})
    main(["serve", "--level", "region", "--data", str(data_dir), "--queue", str(queue), "--out", str(out),
          "--ledger", str(tmp_path / "ledger"), "--table", f"hsa_activity_tables_national={data_dir}/hsa_activity_tables_icb"])
    op = spark.read.parquet(str(out / "op"))
    assert op.count() > 0 and {"rn", "attendances", "run_dataset"} <= set(op.columns)
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith(("_", ".")) or p.name == "_runs") == sorted(
        ["_runs", "aae", "birth_factors", "demographic_factors", "hsa_activity", "inequalities", "op"])


def test_replayed_batch_rewrites_the_same_output(spark, tmp_path):
    """A batch processed again (e.g. after a driver failure before the ledger entry) is a new attempt at the
    same requests: readers see one of them."""
    queue, out = tmp_path / "queue", tmp_path / "out"
    queue.mkdir()
    _write(queue, "a.json", {"app_version": "v1", "dataset": "NATION_3", "scenario": "s", "start_year": 2000})
    data = mapped_dataset(spark, SF_SMALL)
    for attempt in range(2):  # a fresh checkpoint each time replays the same files
        serve_queue(spark, data, str(queue), str(out), str(tmp_path / f"ckpt{attempt}"), "provider",
                    kinds=["inequalities"], quarantine_path=str(tmp_path / "bad"))
        first = read_extracts(spark, str(out), "inequalities")
        if attempt == 0:
            rows_once = first.count()
    assert first.count() == rows_once > 0
    assert first.select("create_datetime").distinct().count() == 1


def test_national_queue_run_scales_by_the_default_rate(spark, tmp_path):
    queue, out = tmp_path / "queue", tmp_path / "out"
    queue.mkdir()
    _write(queue, "n.json", {"app_version": "v1", "dataset": "NATIONAL", "scenario": "s", "seed": 5, "start_year": 2024})
    data = mapped_dataset(spark, SF_SMALL)
    serve_queue(spark, data, str(queue), str(out), str(tmp_path / "ckpt"), "national", kinds=["aae"])
    got = spark.read.parquet(str(out / "aae")).agg(F.sum("arrivals")).first()[0]
    want = data.table("aae").where("fyear = 2024").agg(F.sum("arrivals")).first()[0] * 0.01
    assert abs(got - want) < 1e-9


def test_write_extracts_rebalances_by_run(spark):
    from caseload.sources.sinks import RUN_PARTITIONS, rebalanced

    df = spark.range(100).selectExpr("'v' AS app_version", "CAST(id % 3 AS STRING) AS run_dataset",
                                     "'s' AS scenario", "'t' AS create_datetime", "'r' AS request_id", "id")
    plan = rebalanced(df, RUN_PARTITIONS)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_failed_batch_stays_queued_and_is_served_on_restart(spark, tmp_path):
    queue, ckpt = tmp_path / "queue", tmp_path / "ckpt"
    queue.mkdir()
    _write(queue, "a.json", {"dataset": "NATION_3", "start_year": 2000})
    seen, attempts = [], []

    def flaky(batch):
        attempts.append(1)
        if len(attempts) == 1:
            raise RuntimeError("lost the job mid-batch")
        seen.extend(r["params_path"] for r in batch.select("params_path").collect())

    with pytest.raises(RuntimeError):
        drain_queue(spark, str(queue), str(ckpt), flaky, clean_source="delete")
    assert seen == [] and (queue / "a.json").exists()  # not committed: still queued
    drain_queue(spark, str(queue), str(ckpt), flaky, clean_source="delete")
    assert len(seen) == 1 and seen[0].endswith("a.json")


def test_full_run_shares_the_cohort_between_strategy_tables(spark, tmp_path):
    from caseload.plans.batch import extract_all
    from caseload.plans.job import run_requests

    reqs = spark.createDataFrame(
        [("a", "NATION_3", 2000, "v1", "s", "t1", 1, 0.5, None, "p")],
        "request_id string, code string, fyear int, app_version string, scenario string, "
        "create_datetime string, seed long, sample_rate double, metadata map<string,string>, params_path string")
    data = mapped_dataset(spark, SF_SMALL)
    kinds = run_requests(data, reqs, "provider", str(tmp_path / "out"), full=True)
    assert {"ip", "strategies_activity_avoidance", "strategies_efficiencies"} <= set(kinds)
    for kind in ("strategies_activity_avoidance", "strategies_efficiencies"):
        written = read_extracts(spark, str(tmp_path / "out"), kind).drop(
            "app_version", "run_dataset", "scenario", "create_datetime")
        direct = extract_all(data, reqs.select("request_id", "code", "fyear"), kind, "provider")
        assert written.count() == direct.count() > 0
        assert sorted(written.columns) == sorted(direct.columns)


# --- the queue as a stream of versions ----------------------------------------------------------------

def test_empty_and_undecodable_files_are_seen_once(spark, tmp_path):
    queue, ledger, seen = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    (queue / "empty.json").touch()
    (queue / "latin 1.json").write_bytes('{"dataset": "Zürich"}'.encode("latin-1"))
    (queue / "_hidden.json").write_text("{}")
    (queue / "sub").mkdir()
    (queue / "sub" / "inner.json").write_text("{}")
    reasons = {}

    def handle(raw):
        seen.extend(r["params_path"].rsplit("/", 1)[1] for r in raw.collect())
        reasons.update({r["params_path"].rsplit("/", 1)[1]: r["reason"] for r in quarantined(raw).collect()})

    assert drain_queue(spark, str(queue), str(ledger), handle) == 2
    assert sorted(seen) == ["empty.json", "latin%201.json"]
    assert reasons == {"empty.json": "empty file", "latin%201.json": "not valid JSON"}
    assert drain_queue(spark, str(queue), str(ledger), handle, clean_source="delete") == 0
    assert sorted(p.name for p in queue.iterdir() if not p.name.startswith(".")) == ["_hidden.json", "sub"]
    assert drain_queue(spark, str(tmp_path / "none"), str(tmp_path / "other"), handle) == 0


def test_a_batch_that_dies_is_served_again_as_it_was(spark, tmp_path):
    """Same versions, ids and stamps, though the file has changed since and another has come."""
    queue, ledger, attempts = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    _write(queue, "a.json", {"dataset": "one"})

    def dies(raw):
        attempts.append({(r["request_id"], r["taken_at"], r["params_text"]) for r in raw.collect()})
        if len(attempts) == 1:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        drain_queue(spark, str(queue), str(ledger), dies)
    _write(queue, "a.json", {"dataset": "two"})
    _write(queue, "b.json", {"dataset": "three"})
    assert drain_queue(spark, str(queue), str(ledger), dies) == 3
    assert attempts[1] == attempts[0]  # the batch that died, then the rest
    assert {json.loads(t)["dataset"] for _, _, t in set().union(*attempts)} == {"one", "two", "three"}


def test_removal_that_dies_half_way_hides_no_version(spark, tmp_path, monkeypatch):
    queue, ledger, seen = tmp_path / "queue", tmp_path / "ledger", []
    queue.mkdir()
    for k in range(4):
        _write(queue, f"f{k}.json", {"dataset": k})
    served = _collector(seen)

    def changed(raw):  # a file that changes before it is set aside is another version, not served yet
        served(raw)
        if len(seen) == 4:
            _write(queue, "f2.json", {"dataset": "changed"})

    def dies(*_args):
        raise RuntimeError("lost between the renames and the check")

    with monkeypatch.context() as patch:
        patch.setattr(intake, "_settle", dies)
        with pytest.raises(RuntimeError):
            drain_queue(spark, str(queue), str(ledger), changed, clean_source="delete")
    assert not (queue / "f0.json").exists() and not (queue / "f2.json").exists()  # set aside
    _write(queue, "f2.json", {"dataset": "newest"})  # and a third version comes to its place
    drain_queue(spark, str(queue), str(ledger), changed, clean_source="delete")
    assert len(seen) == 6 and seen.count("f2.json") == 2 and sum(name.endswith("-f2.json") for name in seen) == 1
    assert [p.name for p in queue.iterdir() if not p.name.startswith(".")] == []
    assert list((ledger / "removals").iterdir()) == [] or all(p.name.startswith(".") for p in (ledger / "removals").iterdir())


def test_removal_starts_no_job_per_file(spark, tmp_path):
    def jobs(files):
        queue, ledger = tmp_path / f"queue{files}", tmp_path / f"ledger{files}"
        queue.mkdir()
        for k in range(files):
            _write(queue, f"f{k}.json", {"dataset": k})
        spark.sparkContext.setJobGroup(f"drain{files}", "")
        assert drain_queue(spark, str(queue), str(ledger), lambda raw: None, clean_source="delete") == files
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"drain{files}"))

    assert jobs(60) <= jobs(20) + 4  # a result is read a partition at a time


# --- runs that appear whole -----------------------------------------------------------------------------

def _requests(spark, *ids, code="NATION_3", year=2000):
    return spark.createDataFrame(
        [(i, code, year, "v1", "s", "t1", 1, 0.5, {"scenario": "s"}, "p") for i in ids],
        "request_id string, code string, fyear int, app_version string, scenario string, "
        "create_datetime string, seed long, sample_rate double, metadata map<string,string>, params_path string")


def test_a_run_that_dies_between_two_kinds_stays_invisible(spark, tmp_path, monkeypatch):
    out, data, kinds = str(tmp_path / "out"), mapped_dataset(spark, SF_SMALL), ["op", "inequalities"]
    run_requests(data, _requests(spark, "a"), "provider", out, kinds=kinds)
    before = {k: sorted(map(str, read_extracts(spark, out, k).collect())) for k in kinds}
    written = []

    def dies(df, path, **options):
        if written:
            raise RuntimeError("lost between two kinds")
        written.append(path)
        write_extracts(df, path, **options)

    with monkeypatch.context() as patch:
        patch.setattr(job, "write_extracts", dies)
        with pytest.raises(RuntimeError):
            run_requests(data, _requests(spark, "a", "b", code="NATION_7"), "provider", out, kinds=kinds)
    assert spark.read.parquet(f"{out}/op").select("attempt").distinct().count() == 2  # it has written
    assert {k: sorted(map(str, read_extracts(spark, out, k).collect())) for k in kinds} == before
    run_requests(data, _requests(spark, "a", "b", code="NATION_7"), "provider", out, kinds=kinds)
    for kind in kinds:
        got = read_extracts(spark, out, kind).groupBy("request_id", "run_dataset").count().collect()
        assert sorted((r["request_id"], r["run_dataset"]) for r in got) == [("a", "NATION_7"), ("b", "NATION_7")]
    assert len(drop_superseded(spark, out)) == 1 and manifest(spark, out).count() == 3
    assert read_extracts(spark, out, "op").select("request_id").distinct().count() == 2


def test_a_rerun_without_rows_leaves_nothing_of_the_old_one(spark, tmp_path):
    out, data = str(tmp_path / "out"), mapped_dataset(spark, SF_SMALL)
    run_requests(data, _requests(spark, "a", "b"), "provider", out, kinds=["op"])
    assert read_extracts(spark, out, "op").select("request_id").distinct().count() == 2
    run_requests(data, _requests(spark, "a", code="NO SUCH PROVIDER"), "provider", out, kinds=["op"])
    assert {r["request_id"] for r in read_extracts(spark, out, "op").collect()} == {"b"}
    run_requests(data, _requests(spark, "b", code="NO SUCH PROVIDER"), "provider", out, kinds=["op", "inequalities"])
    assert read_extracts(spark, out, "op").count() == 0
    assert read_extracts(spark, out, "inequalities").count() == 0
    with pytest.raises(ValueError):
        read_extracts(spark, out, "aae")


def test_one_document_per_run_holds_the_params(spark, tmp_path):
    queue, out = tmp_path / "queue", tmp_path / "out"
    queue.mkdir()
    params = {f"NATION_{k}": {"app_version": "v1", "dataset": f"NATION_{k}", "scenario": "s", "start_year": 2000, "seed": k,
                              "demand": {"growth": [1.5, None, {"a": "ü"}], "on": True}, "list": [], "text": "x\ny"} for k in (3, 7)}
    for name, p in params.items():
        _write(queue, f"{name}.json", p)
    serve_queue(spark, mapped_dataset(spark, SF_SMALL), str(queue), str(out), str(tmp_path / "ledger"), "provider", kinds=["inequalities"])
    documents = list((out / "_runs").rglob("*.json.gz"))
    assert len(documents) == 2
    for path in documents:
        run = json.loads(gzip.decompress(path.read_bytes()))  # the whole file is one document
        assert run["params"] == params[run["params"]["dataset"]] and run["metadata"]["scenario"] == "s"
        assert f"create_datetime={run['metadata']['create_datetime']}" in str(path)


def test_files_in_name_order_hold_a_run_in_order(spark, tmp_path):
    labels = [f"concat('{x}', left(string(id), 0)) {c}" for x, c in
              (("v", "app_version"), ("s", "scenario"), ("t", "create_datetime"), ("r", "request_id"))]
    runs = spark.range(40_000).selectExpr(*labels, "if(id % 3 = 0, 'small', 'large') run_dataset",
                                          "concat('v', hash(id) % 5) variant", "cast(hash(id, 1) % 90 as int) age", "id")
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_extracts(runs.repartition(7), str(tmp_path / "out"), order_by=["variant", "age"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    import pyarrow.parquet as pq

    for folder in (tmp_path / "out").rglob("request_id=r"):
        files = sorted(folder.glob("*.parquet"))
        rows = [r for f in files for r in zip(*(pq.ParquetFile(f).read().column(c).to_pylist() for c in ("variant", "age")))]
        assert rows == sorted(rows) and len(rows) in (13_334, 26_666)
        assert len(files) > 1 or len(rows) < 20_000
