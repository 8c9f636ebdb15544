"""Staged loads and repeatable appends: each is killed between its steps, and the next one finishes or undoes it."""

import pytest
from pyspark.sql import functions as F

from sluice.operators.survey import run_selection_job
from sluice.session import scratch_path, scratch_table
from sluice.sinks import staged
from sluice.sinks.staged import (LoadCheckFailed, LoadTakenOver, append_run, recover_load, recover_run, run_ledger, run_tag,
                                 staged_load, table_location)
from sluice.sinks.tables import write_table
from sluice.sources.catalog import read_table

SCHEMA = "id int, val string, part string"
OLD = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "o'c=\\/% é")]
NEW = [(5, "e", "y"), (6, "f", "z"), (7, "g", None), (8, "h", "o'c=\\/% é")]


class Killed(BaseException):
    """Stands for a driver that is gone: nothing catches it."""


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, table):
    return sorted((tuple(r) for r in read_table(spark, table).select("id", "val", "part").collect()), key=repr)


def same(got, want):
    return got == sorted(want, key=repr)


def make(spark, kind, old=OLD):
    name = scratch_table(spark, "sl_staged")
    write_table(frame(spark, old), name, [] if kind == "flat" else ["part"], "append",
                path=scratch_path(spark, "table") if kind == "external" else None)
    return name


def files_beside(spark, table):
    parent = table_location(spark, table).rsplit("/", 1)[0]
    base = staged._parent_and_name(table_location(spark, table))[1]
    return [n for n in staged._Store(spark, parent).names(parent) if base in n]


KINDS = ["managed", "external", "flat"]


@pytest.mark.parametrize("kind", KINDS)
def test_load_replaces_all_rows(spark, kind):
    t = make(spark, kind)
    assert staged_load(frame(spark, NEW), t) == 4
    assert same(rows(spark, t), NEW)
    assert len(files_beside(spark, t)) == 1  # the old folder and the manifests are gone
    write_table(frame(spark, OLD), t, mode="append")
    assert same(rows(spark, t), NEW + OLD)
    assert staged_load(read_table(spark, t).where("id < 3"), t) == 2  # from the table itself
    assert same(rows(spark, t), OLD[:2])
    assert staged_load(frame(spark, []), t) == 0
    assert rows(spark, t) == []


@pytest.mark.parametrize("kind,step,after", [("managed", s, a) for s in ("begin", "stage", "check", "commit", "swap", "clean") for a in (False, True)]
                         + [("flat", s, True) for s in ("stage", "commit", "swap")] + [("external", "commit", True)])
def test_load_killed_between_steps(spark, monkeypatch, kind, step, after):
    t = make(spark, kind)
    real = getattr(staged._Load, step)

    def dies(self, *a, **kw):
        if after:
            real(self, *a, **kw)
        raise Killed
    monkeypatch.setattr(staged._Load, step, dies)
    with pytest.raises(Killed):
        staged_load(frame(spark, NEW), t)
    monkeypatch.undo()
    decided = (step, after) in {("commit", True), ("swap", False), ("swap", True), ("clean", False), ("clean", True)}
    if not decided:
        assert same(rows(spark, t), OLD)  # readers still see the old rows
    state = recover_load(spark, t)
    assert same(rows(spark, t), NEW if decided else OLD)
    assert state == (None if (step, after) in {("begin", False), ("clean", True)} else "finished" if decided else "undone")
    assert len(files_beside(spark, t)) == 1 and recover_load(spark, t) is None
    staged_load(frame(spark, NEW[:1]), t)
    assert same(rows(spark, t), NEW[:1])


def test_load_killed_between_partitions(spark, monkeypatch):
    """Half of the partitions are swapped: the next load finishes the rest."""
    t = make(spark, "managed")
    real, calls = spark.sql, []

    def sql(text, *a, **kw):
        if text.startswith("ALTER TABLE"):
            calls.append(text)
            if len(calls) == 3:
                raise Killed
        return real(text, *a, **kw)
    monkeypatch.setattr(spark, "sql", sql, raising=False)
    with pytest.raises(Killed):
        staged_load(frame(spark, NEW), t)
    monkeypatch.undo()
    assert recover_load(spark, t) == "finished"
    assert same(rows(spark, t), NEW)


def test_next_load_recovers_by_itself(spark, monkeypatch):
    t = make(spark, "managed")
    monkeypatch.setattr(staged._Load, "swap", lambda self, plan: (_ for _ in ()).throw(Killed))
    with pytest.raises(Killed):
        staged_load(frame(spark, NEW), t)
    monkeypatch.undo()
    assert staged_load(read_table(spark, t).select("id", F.upper("val"), "part"), t) == 4
    assert len(rows(spark, t)) == 4


@pytest.mark.parametrize("kind", KINDS)
def test_failed_load_leaves_the_old_rows(spark, kind):
    t = make(spark, kind)
    bad = frame(spark, NEW).withColumn("val", F.raise_error(F.lit("lost source")).cast("string"))
    with pytest.raises(Exception, match="lost source"):
        write_table(bad, t, mode="truncate_load")
    assert same(rows(spark, t), OLD) and len(files_beside(spark, t)) == 1
    with pytest.raises(LoadCheckFailed):
        write_table(frame(spark, NEW), t, mode="truncate_load", check=lambda df: df.count() > 4)
    assert same(rows(spark, t), OLD)
    told = []
    write_table(frame(spark, NEW), t, mode="truncate_load", check=lambda df: df.count() == 4, written=told.append)
    assert told == [4] and same(rows(spark, t), NEW)


def test_count_check(spark, monkeypatch):
    t = make(spark, "flat")
    real = staged._Load.stage
    monkeypatch.setattr(staged._Load, "stage", lambda self, plan, df: real(self, plan, df) + 1)
    with pytest.raises(LoadCheckFailed):
        staged_load(frame(spark, NEW), t)
    assert same(rows(spark, t), OLD)


def test_load_taken_over(spark, monkeypatch):
    """A second writer takes the first for dead; the first fails at its commit and mixes nothing in."""
    t = make(spark, "managed")
    real, inner = staged._Load.check, []

    def check(self, plan, written, user):
        real(self, plan, written, user)
        if not inner:
            inner.append(1)
            assert staged_load(frame(spark, NEW), t) == 4
    monkeypatch.setattr(staged._Load, "check", check)
    with pytest.raises((LoadTakenOver, Exception)):
        staged_load(frame(spark, OLD[:1]), t)
    assert same(rows(spark, t), NEW)


# --- runs ---------------------------------------------------------------------------------

A, B = {"survey": "RUN_4100", "run_date": "20221125"}, {"survey": "RUN_4100", "run_date": "20221126"}


@pytest.mark.parametrize("kind", KINDS)
def test_a_repeated_run_replaces_its_own_rows(spark, kind):
    t = make(spark, kind)
    assert append_run(frame(spark, NEW), t, A) == 4
    assert append_run(frame(spark, [(20, "n", "x")]), t, B) == 1
    assert append_run(frame(spark, [*NEW[:2], (9, "i", "w")]), t, A) == 3
    assert same(rows(spark, t), [*OLD, *NEW[:2], (9, "i", "w"), (20, "n", "x")])
    ledger = {r.run["run_date"]: r.rows for r in run_ledger(spark, t).collect()}
    assert ledger == {"20221125": 3, "20221126": 1}
    assert append_run(frame(spark, []), t, A) == 0
    assert same(rows(spark, t), [*OLD, (20, "n", "x")])


@pytest.mark.parametrize("kind,step,after", [("managed", s, a) for s in ("begin", "stage", "check", "commit", "swap", "enter", "clean")
                                             for a in (False, True)] + [("flat", s, True) for s in ("stage", "commit", "swap")])
def test_run_killed_between_steps(spark, monkeypatch, kind, step, after):
    t = make(spark, kind)
    append_run(frame(spark, [(50, "first", "x")]), t, A)
    real = getattr(staged._Run, step)

    def dies(self, *a, **kw):
        if after:
            real(self, *a, **kw)
        raise Killed
    monkeypatch.setattr(staged._Run, step, dies)
    with pytest.raises(Killed):
        append_run(frame(spark, NEW), t, A)
    monkeypatch.undo()
    decided = (step, after) == ("commit", True) or step in ("swap", "enter", "clean")
    if not decided:
        assert same(rows(spark, t), [*OLD, (50, "first", "x")])
    recover_run(spark, t, A)
    assert same(rows(spark, t), [*OLD, *NEW] if decided else [*OLD, (50, "first", "x")])
    append_run(frame(spark, NEW), t, A)  # the repeated run gives the rows of one run
    assert same(rows(spark, t), [*OLD, *NEW])
    assert [(r.run, r.rows) for r in run_ledger(spark, t).collect()] == [(A, 4)]
    location = table_location(spark, t)
    assert not [n for n in staged._Store(spark, location).names(location) if n.startswith("_stage")]


def test_run_killed_between_moves(spark, monkeypatch):
    t = make(spark, "managed")
    append_run(frame(spark, [(50, "first", "x")]), t, A)
    real, moved = staged._Store.rename, []

    def rename(self, a, b):
        if "/run_" in b:
            moved.append(b)
            if len(moved) == 2:
                raise Killed
        real(self, a, b)
    monkeypatch.setattr(staged._Store, "rename", rename)
    with pytest.raises(Killed):
        append_run(frame(spark, NEW), t, A)
    monkeypatch.undo()
    append_run(frame(spark, NEW), t, B)  # another run does not care
    assert recover_run(spark, t, A) == "finished"
    assert same(rows(spark, t), [*OLD, *NEW, *NEW])


def test_runs_after_a_staged_load(spark):
    """Partitions then lie where the load put them; a run's files go there."""
    t = make(spark, "external")
    staged_load(frame(spark, NEW), t)
    append_run(frame(spark, OLD), t, A)
    append_run(frame(spark, OLD), t, A)
    assert same(rows(spark, t), [*OLD, *NEW])
    staged_load(frame(spark, NEW), t)
    assert same(rows(spark, t), NEW) and run_ledger(spark, t).count() == 0


def test_failed_run_leaves_the_table(spark):
    t = make(spark, "managed")
    append_run(frame(spark, NEW), t, A)
    with pytest.raises(LoadCheckFailed):
        append_run(frame(spark, OLD), t, A, check=lambda df: False)
    with pytest.raises(ValueError):
        append_run(frame(spark, OLD), t, {})
    with pytest.raises(ValueError):
        write_table(frame(spark, OLD), t, mode="overwrite", run=A)
    assert same(rows(spark, t), [*OLD, *NEW])


def test_run_tags_differ():
    keys = [A, B, {"survey": "RUN 4100", "run_date": "20221125"}, {"survey": "RUN.4100", "run_date": "20221125"},
            {"a": "b-c"}, {"a": "b", "b": "c"}]
    assert len({run_tag(k) for k in keys}) == len(keys)
    assert run_tag(A) == run_tag(dict(reversed(A.items())))


def test_selection_job_may_be_repeated(spark):
    t = scratch_table(spark, "sl_job")
    picked = frame(spark, NEW).withColumn("year_month", F.lit("202211")).drop("part")
    for _ in range(2):
        got = run_selection_job(picked, t, survey="RUN_4100", run_date="20221125", path=scratch_path(spark, "table")).first()
        assert (got.amount, got.status) == (4, "Completed")
        assert read_table(spark, t).count() == 4
    run_selection_job(picked.limit(1), t, survey="RUN_4201", run_date="20221125")
    assert read_table(spark, t).count() == 5
