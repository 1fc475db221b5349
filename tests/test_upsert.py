from decimal import Decimal

import pytest
from helpers import day, rows

from finmarts.sources import files, versions
from finmarts.operators.upsert import merge_rows, recent_rows, upsert_table

FACT = "id bigint, d date, amount decimal(18,2)"


def fact(spark, *data):
    return spark.createDataFrame([(i, day(d) if d else None, Decimal(a)) for i, d, a in data], FACT)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "fact")


def stored(spark, path):
    return rows(versions.read(spark, path), "id", "d", "amount")


def test_first_run_is_a_full_build(spark, path):
    source = fact(spark, (1, "2024-01-01", "1.00"), (2, "2024-03-01", "2.00"))
    upsert_table(source, path, "id", "d", ["d", "id"])
    assert stored(spark, path) == rows(source)


def test_lookback_changes_and_moves(spark, path):
    upsert_table(
        fact(
            spark,
            (1, "2024-01-10", "1.00"),
            (2, "2024-02-10", "2.00"),
            (3, "2024-02-28", "3.00"),
            (4, "2024-03-01", "4.00"),
            (9, "2023-12-05", "9.00"),
        ),
        path, "id", "d",
    )
    source = fact(
        spark,
        (1, "2024-01-10", "100.00"),  # older than three days: not picked up
        (2, "2024-03-02", "2.50"),  # moved to March: February copy goes
        (3, "2024-02-28", "3.50"),  # late change inside the window
        (4, "2024-03-01", "4.00"),
        (5, "2024-03-05", "5.00"),  # new
        (9, "2024-03-04", "9.50"),  # moved out of December, which becomes empty
    )
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(
        fact(
            spark,
            (1, "2024-01-10", "1.00"), (2, "2024-03-02", "2.50"), (3, "2024-02-28", "3.50"),
            (4, "2024-03-01", "4.00"), (5, "2024-03-05", "5.00"), (9, "2024-03-04", "9.50"),
        )
    )
    # a rerun changes nothing
    before = stored(spark, path)
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == before


def test_increments_equal_the_full_build(spark, path):
    everything = [(i, f"2024-0{1 + i // 20}-{1 + i % 20:02d}", f"{i}.00") for i in range(80)]
    for upto in (30, 55, 80):
        upsert_table(fact(spark, *everything[:upto]), path, "id", "d")
    assert stored(spark, path) == rows(fact(spark, *everything))


def test_merge_keeps_what_the_batch_does_not_hold(spark):
    target = fact(spark, (1, "2024-01-01", "1.00"), (2, "2024-01-02", "2.00"))
    batch = fact(spark, (2, "2024-01-03", "2.20"), (3, "2024-01-03", "3.00"))
    assert [r[0] for r in rows(merge_rows(target, batch, ["id"]))] == [1, 2, 3]


def test_empty_target_takes_every_row(spark):
    source = fact(spark, (1, "2024-01-01", "1.00"), (2, "2024-03-01", "2.00"))
    assert recent_rows(source, None, "d").count() == 2
    assert recent_rows(source, day("2024-03-03"), "d").count() == 1


@pytest.fixture(params=["true", "false"])
def success_files(request, spark):
    """Runs a test with and without the files that mark a job's end."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", request.param)
    yield
    conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_batches_add_up(spark, path, success_files):
    upsert_table(fact(spark, (1, "2024-01-01", "1.00")), path, "id", "d", lookback=None)
    upsert_table(fact(spark, (2, "2024-01-02", "2.00")), path, "id", "d", lookback=None)
    assert [r[0] for r in stored(spark, path)] == [1, 2]


@pytest.mark.parametrize("dies", ["before data", "after data", "before the manifest"])
def test_a_run_that_dies_changes_nothing(spark, path, monkeypatch, dies, success_files):
    old = fact(spark, (1, "2024-02-10", "1.00"), (2, "2024-03-01", "2.00"))
    upsert_table(old, path, "id", "d")
    source = fact(spark, (1, "2024-03-02", "1.50"), (2, "2024-03-01", "2.00"), (3, "2024-04-20", "3.00"))
    write_folder = versions.write_folder

    def die(*args):
        if dies == "after data":
            write_folder(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if dies == "before the manifest":
            m.setattr(versions, "commit", die)
        else:
            m.setattr(versions, "write_folder", die)
        with pytest.raises(RuntimeError):
            upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(old)
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(source)


def test_a_reader_sees_one_state(spark, path, monkeypatch):
    old = fact(spark, (1, "2024-02-10", "1.00"), (2, "2024-03-01", "2.00"))
    upsert_table(old, path, "id", "d")
    source = fact(spark, (1, "2024-03-02", "1.50"), (2, "2024-03-01", "2.20"), (3, "2024-04-20", "3.00"))
    before = versions.read(spark, path)
    seen = []
    commit = versions.commit
    monkeypatch.setattr(versions, "commit", lambda *a, **k: seen.append(stored(spark, path)) or commit(*a, **k))
    upsert_table(source, path, "id", "d")
    assert seen == [rows(old)]  # all new files lie there, the old table is in force
    assert stored(spark, path) == rows(source)
    assert rows(before, "id", "d", "amount") == rows(old)  # a reader that had begun goes on with its state


def test_untouched_months_keep_their_files(spark, path):
    upsert_table(fact(spark, (1, "2024-01-10", "1.00"), (2, "2024-02-10", "2.00"), (3, "2024-03-01", "3.00")), path, "id", "d")
    first = versions.manifest(spark, path)
    state = upsert_table(fact(spark, (3, "2024-03-01", "3.30"), (4, "2024-04-01", "4.00")), path, "id", "d")
    assert versions.changed(first.folders, state.folders) == [202403, 202404]
    assert state.folders[202401] == first.folders[202401]
    assert versions.changed({}, first.folders) == [202401, 202402, 202403]


def test_the_later_of_two_writers_fails(spark, path):
    upsert_table(fact(spark, (1, "2024-01-10", "1.00")), path, "id", "d")
    base = versions.manifest(spark, path)
    upsert_table(fact(spark, (2, "2024-01-11", "2.00")), path, "id", "d")
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit(spark, path, base.schema, base.by, base.folders, base)
    assert [r[0] for r in stored(spark, path)] == [1, 2]


def test_old_states_go_and_folders_in_use_stay(spark, path):
    for i in range(7):
        upsert_table(fact(spark, (i, "2024-01-10", "1.00"), (50 + i, f"2024-0{i + 1}-11", "1.00")), path, "id", "d", lookback=None)
    assert len([n for n in files.names(spark, f"{path}/_manifests") if n[0].isdigit()]) == versions.KEPT
    assert len(stored(spark, path)) == 14
    folders = [n for n in files.names(spark, path) if n.startswith("_state=")]
    assert set(folders) >= set(versions.manifest(spark, path).folders.values())
    assert not [n for n in files.names(spark, path) if n.startswith("_batch")]


def test_first_run_without_rows(spark, path):
    upsert_table(fact(spark), path, "id", "d")
    source = fact(spark, (1, "2024-01-01", "1.00"))
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(source)


def test_first_run_that_died(spark, path, tmp_path):
    half = tmp_path / "fact" / "_state=00000001-dead" / "ym=202401"
    fact(spark, (7, "2024-01-05", "7.00")).write.parquet(str(half))
    source = fact(spark, (1, "2024-01-01", "1.00"))
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(source)


def test_files_of_others_are_not_overwritten(spark, path, tmp_path):
    fact(spark, (7, "2024-01-05", "7.00")).write.parquet(str(tmp_path / "fact" / "ym=202401"))
    with pytest.raises(FileExistsError):
        upsert_table(fact(spark, (1, "2024-01-01", "1.00")), path, "id", "d")
    assert spark.read.parquet(path).count() == 1


def test_rows_without_a_date(spark, path):
    upsert_table(fact(spark, (1, None, "1.00"), (2, "2024-03-01", "2.00"), (3, None, "3.00")), path, "id", "d")
    source = fact(spark, (1, "2024-03-02", "1.10"), (2, "2024-03-01", "2.00"), (3, None, "3.30"), (4, None, "4.00"))
    upsert_table(source, path, "id", "d")
    assert stored(spark, path) == rows(source)


def test_a_source_with_months_is_pruned(spark, tmp_path):
    from finmarts.sources.sinks import write_table

    source = fact(spark, (1, "2024-01-01", "1.00"), (2, "2024-03-01", "2.00"), (3, None, "3.00"))
    write_table(source, str(tmp_path / "clean"), "d")
    recent = recent_rows(versions.read(spark, str(tmp_path / "clean")), day("2024-03-02"), "d")
    assert [r[0] for r in rows(recent, "id")] == [2, 3]
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "ym" in scan.split("PartitionFilters: [")[1].split("]")[0]
