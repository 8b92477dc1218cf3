import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from edge_rows import CUSTOMERS, ORDERS, row_set, rows, write_sources
from orderloom import __main__ as cli
from orderloom.plans import job
from orderloom.plans.checks import check_report
from orderloom.plans.job import PublishBlocked, claim_commit, expire_runs, run_pipeline
from orderloom.plans.lease import LEASE_SECONDS, Lease, reclaimable
from orderloom.plans.reports import monthly_order_trend, product_sales
from orderloom.plans.star import first_orders, with_amount
from orderloom.sources.csv_files import read_csv_sources
from orderloom.sources.mart import (
    MartNotBuilt,
    current_run,
    read_commits,
    read_issues,
    read_report,
    read_run_log,
    read_star,
    run_folder,
)

TABLE_ROWS = {"DimCategory": 3, "DimCustomer": 3, "DimProduct": 4, "DimDate": 6, "FactOrder": 6}


def staged(spark, folder, **texts):
    folder.mkdir(exist_ok=True)
    return read_csv_sources(spark, *write_sources(folder, **texts))


def counts(star):
    return {name: table.count() for name, table in star.items()}


def test_run_and_rerun(spark, tmp_path):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    first = run_pipeline(spark, source, root)
    assert first.source_rows == {"customers": 4, "products": 5, "orders": 9}
    assert first.table_rows == TABLE_ROWS == counts(read_star(spark, root))
    second = run_pipeline(spark, source, root)
    assert current_run(spark, root) == second.run_id > first.run_id
    assert second.table_rows == TABLE_ROWS == counts(read_star(spark, root))
    logged = read_run_log(spark, root).where(F.col("run_id") == first.run_id)
    assert {r["table_name"]: r["row_count"] for r in logged.collect()} == {**first.source_rows, **TABLE_ROWS}
    assert read_issues(spark, root).count() == 10
    assert read_report(spark, root).count() == 19
    assert row_set(read_report(spark, root)) == row_set(
        check_report(spark, read_star(spark, root), read_issues(spark, root))
    )
    assert not (tmp_path / "mart" / f"run={second.run_id}" / "staged").exists()


def test_many_orders_are_ranked_slice_by_slice(spark, tmp_path, monkeypatch):
    """No shuffle holds them all, and the staged orders are gone before prices are looked up."""
    source = staged(spark, tmp_path / "in")
    whole = run_pipeline(spark, source, str(tmp_path / "whole"))
    sizes, left = [], []

    def ranked(orders):
        sizes.append(orders.count())
        return first_orders(orders)

    def priced(*args):
        left.append({path.name for path in (tmp_path / "mart").glob("run=*/staged/*")})
        return with_amount(*args)

    monkeypatch.setattr(job, "first_orders", ranked)
    monkeypatch.setattr(job, "with_amount", priced)
    monkeypatch.setattr(job, "ORDERS_AT_ONCE", 2)
    sliced = run_pipeline(spark, source, str(tmp_path / "mart"))
    assert len(sizes) == 5 and sum(sizes) == 9 and max(sizes) < 9
    assert left == [{"customers", "products", "first_orders"}]
    assert sliced.table_rows == whole.table_rows == TABLE_ROWS
    for name, table in sliced.star(spark).items():
        assert row_set(table) == row_set(whole.star(spark).table(name)), name
    kept = run_pipeline(spark, source, str(tmp_path / "mart"), keep_staged=True)
    folder = tmp_path / "mart" / f"run={kept.run_id}" / "staged"
    assert {path.name for path in folder.iterdir()} == {"customers", "products", "orders"}


def test_shuffles_of_a_run_are_gone_when_it_ends(spark, tmp_path):
    source = staged(spark, tmp_path / "in")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    for _ in range(3):  # of what ran before this test
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
    before, setting = shuffles(), spark.conf.get(job.SHUFFLES_GO)
    run_pipeline(spark, source, str(tmp_path / "mart"))
    assert shuffles() <= before
    assert spark.conf.get(job.SHUFFLES_GO) == setting == "false"


def test_tables_are_written_small(spark, tmp_path):
    result = run_pipeline(spark, staged(spark, tmp_path / "in"), str(tmp_path / "mart"))
    for name in ("FactOrder", "DimProduct", "dq_issues"):
        file = next((tmp_path / "mart" / f"run={result.run_id}" / name).glob("*.parquet"))
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_unbuilt_mart(spark, tmp_path):
    with pytest.raises(MartNotBuilt, match="run the pipeline first"):
        read_star(spark, str(tmp_path / "none"))


def test_failed_gate_keeps_the_previous_run(spark, tmp_path):
    root = str(tmp_path / "mart")
    good = run_pipeline(spark, staged(spark, tmp_path / "a"), root)
    nameless = CUSTOMERS + "9,,Nobody,n@x.test,Oslo,2020-01-01\n"
    with pytest.raises(PublishBlocked, match="null DimCustomer.FullName: 1"):
        run_pipeline(spark, staged(spark, tmp_path / "b", customers=nameless), root)
    keyless = ORDERS + ",1,1,1,2021-03-01,UPI,Delivered,2021-03-02\n"
    with pytest.raises(PublishBlocked, match="null FactOrder.OrderKey: 1"):
        run_pipeline(spark, staged(spark, tmp_path / "c", orders=keyless), root)
    assert current_run(spark, root) == good.run_id
    assert not list((tmp_path / "mart").glob("run=*/staged"))
    assert len(list((tmp_path / "mart").glob("run=*/dq_issues"))) == 3
    assert counts(read_star(spark, root)) == TABLE_ROWS


def test_required_checks(spark, tmp_path):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    with pytest.raises(PublishBlocked, match="CK-7 .*: 1"):
        run_pipeline(spark, source, root, fail_on=["CK-7", "CK-14"])
    with pytest.raises(MartNotBuilt):
        read_star(spark, root)
    with pytest.raises(ValueError, match="CK-99"):
        run_pipeline(spark, source, root, fail_on=["CK-99"])
    assert run_pipeline(spark, source, root, fail_on=["CK-1", "CK-14"]).table_rows == TABLE_ROWS


def test_empty_tables_are_not_published(spark, tmp_path):
    root = str(tmp_path / "mart")
    good = run_pipeline(spark, staged(spark, tmp_path / "a"), root)
    undated = staged(spark, tmp_path / "b", orders=ORDERS.splitlines()[0] + "\n10,1,1,2,soon,UPI,Shipped,\n")
    with pytest.raises(PublishBlocked, match="CK-6"):
        run_pipeline(spark, undated, root)
    assert current_run(spark, root) == good.run_id
    allowed = run_pipeline(spark, undated, root, allow_empty=True)
    assert allowed.table_rows["FactOrder"] == 0
    assert current_run(spark, root) == allowed.run_id


def test_broken_lines_and_rejected_cells_are_reported(spark, tmp_path):
    dirty = ORDERS + "20,1,1,2.5,2021-01-05,UPI,Shipped,x\n21,1,1,1,2021-01-06,UPI,Shipped,x,EXTRA,FIELDS\n"
    result = run_pipeline(spark, staged(spark, tmp_path / "in", orders=dirty), str(tmp_path / "mart"))
    found = result.issues(spark).where("rule IN ('DQ-6', 'DQ-7')").select("rule", "key", "message")
    assert row_set(found) == [
        ("DQ-6", 20, "Cells that do not fit their type: quantity '2.5'"),
        ("DQ-7", 21, "Wrong number of fields: 21,1,1,1,2021-01-06,UPI,Shipped,x,EXTRA,FIELDS"),
    ]
    logged = result.report(spark).where("check = 'CK-19'").select("violations")
    assert rows(logged) == [(12,)]


def test_the_run_published_last_is_current(spark, tmp_path, monkeypatch):
    """The sequence of commits decides, not the ids; a folder that holds no lease or mark stays."""
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    for name in ("b", "c", "a"):
        monkeypatch.setattr(job, "new_run_id", lambda name=name: name)
        run_pipeline(spark, source, root)
    assert current_run(spark, root) == "a"
    assert row_set(read_commits(spark, root)) == [(1, "b"), (2, "c"), (3, "a")]
    (tmp_path / "mart" / "run=0" / "staged").mkdir(parents=True)
    assert expire_runs(spark, root, keep=2) == ["b"]
    assert expire_runs(spark, root, keep=1) == ["c"]
    monkeypatch.undo()
    run_pipeline(spark, source, root)
    assert expire_runs(spark, root, keep=1) == ["a"]
    assert (tmp_path / "mart" / "run=0").exists()


@pytest.mark.parametrize("first", ["inner", "outer"])
def test_runs_that_overlap(spark, tmp_path, monkeypatch, first):
    """A run inside another's time is published before it, or is the one that is published last."""
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    publish = job._Run.publish
    inner = []

    def overlapped(run):
        monkeypatch.setattr(job._Run, "publish", publish)
        if first == "outer":
            result = publish(run)
        inner.append(run_pipeline(spark, source, root))
        # The outer run has not ended, so its folder is safe whatever its place.
        assert run.run_id not in expire_runs(spark, root, keep=1)
        return result if first == "outer" else publish(run)

    monkeypatch.setattr(job._Run, "publish", overlapped)
    outer = run_pipeline(spark, source, root)
    order = [inner[0], outer] if first == "inner" else [outer, inner[0]]
    assert [run.sequence for run in order] == [1, 2]
    assert current_run(spark, root) == order[1].run_id
    assert expire_runs(spark, root, keep=1) == [order[0].run_id]
    assert counts(read_star(spark, root)) == TABLE_ROWS


def test_one_number_goes_to_one_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    assert claim_commit(spark, root, "x") == 1
    # Another driver that saw the same numbers, and one that died before it wrote its name.
    monkeypatch.setattr(job.files, "names", lambda spark, folder: [])
    assert claim_commit(spark, root, "y") == 2
    monkeypatch.undo()
    (tmp_path / "mart" / "commits" / f"{3:012d}").write_text("")
    assert claim_commit(spark, root, "z") == 4
    assert current_run(spark, root) == "z"
    assert row_set(read_commits(spark, root)) == [(1, "x"), (2, "y"), (4, "z")]


def test_a_dead_run_is_reclaimed_when_its_lease_has_lapsed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")

    def dies(run, *_):
        run.lease._over.set()  # the driver is gone: nothing renews the lease, nothing marks the end
        monkeypatch.setattr(run, "end", lambda: None)
        raise KeyboardInterrupt

    monkeypatch.setattr(job, "build_tables", dies)
    for name in ("old", "fresh"):
        monkeypatch.setattr(job, "new_run_id", lambda name=name: name)
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, source, root, keep_staged=True)
    monkeypatch.undo()
    current = run_pipeline(spark, source, root)
    assert expire_runs(spark, root, keep=1) == []
    lease = tmp_path / "mart" / "run=old" / "_lease"
    os.utime(lease, (0, lease.stat().st_mtime - 2.1 * LEASE_SECONDS))
    assert expire_runs(spark, root, keep=1) == ["old"]
    assert {p.name for p in (tmp_path / "mart").glob("run=*")} == {"run=fresh", f"run={current.run_id}"}


def test_a_lease_is_renewed_and_a_run_without_it_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    lease = Lease(spark, str(tmp_path / "leased"), 0.8)
    time.sleep(2)
    assert lease.held()
    lease.release()
    assert not lease.held() and not reclaimable(spark, str(tmp_path / "leased"))
    publish = job._Run.publish

    def stalled(run):
        os.utime(tmp_path / "mart" / f"run={run.run_id}" / "_lease", (0, 0))
        return publish(run)

    monkeypatch.setattr(job._Run, "publish", stalled)
    with pytest.raises(PublishBlocked, match="lease"):
        run_pipeline(spark, source, root)
    with pytest.raises(MartNotBuilt):
        current_run(spark, root)


def test_fact_by_year_reads_the_same(spark, tmp_path):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    plain = run_pipeline(spark, source, root)
    yearly = run_pipeline(spark, source, root, fact_by_year=True)
    assert yearly.table_rows == TABLE_ROWS
    for report in (monthly_order_trend, product_sales):
        assert rows(report(yearly.star(spark))) == rows(report(plain.star(spark)))
    assert (tmp_path / "mart" / f"run={yearly.run_id}" / "FactOrder" / "order_year=2021").exists()


def test_expire_keeps_the_latest_runs(spark, tmp_path):
    root = str(tmp_path / "mart")
    source = staged(spark, tmp_path / "in")
    with pytest.raises(PublishBlocked):
        run_pipeline(spark, source, root, fail_on=(check for check in ["CK-19"]))
    runs = [run_pipeline(spark, source, root).run_id for _ in range(3)]
    expired = expire_runs(spark, root, keep=2)
    assert len(expired) == 2 and expired[1] == runs[0]
    folders = {path.name for path in (tmp_path / "mart").glob("run=*")}
    assert folders == {f"run={run}" for run in runs[1:]}
    assert run_folder(root, runs[0]).endswith(f"run={runs[0]}")
    assert counts(read_star(spark, root)) == TABLE_ROWS
    with pytest.raises(ValueError):
        expire_runs(spark, root, keep=0)


def test_command_line(spark, tmp_path, capsys):
    customers, products, orders = write_sources(tmp_path)
    args = ["--customers", customers, "--products", products, "--orders", orders]
    args += ["--root", str(tmp_path / "mart")]
    assert cli.main([*args, "--fail-on", "all"]) == 1
    assert "CK-19" in capsys.readouterr().err
    assert cli.main([*args, "--fail-on", "CK-14"]) == 0
    assert "FactOrder\t6" in capsys.readouterr().out
