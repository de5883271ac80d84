"""The funnel kept load by load against full builds, and the store it is kept in."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import crm
from checks.queries import Crm
from funnelry.operators import counters, snapshots
from funnelry.plans import gold, increments, silver
from funnelry.sources.tables import stored
from funnelry.sources.versions import Conflict, Store
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"


# --- store ----------------------------------------------------------------------------


def put(store, rows, schema="k string, v long", name="t", buckets=5):
    change = store.begin()
    df = store.spark.createDataFrame(rows, schema)
    change.create(name, df.schema, ["k"], buckets)
    change.replace(name, df, change.touched(name, df))
    return change


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_change_is_seen_as_a_whole_or_not_at_all(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.manifest().version == 0 and store.versions() == []
    first = put(store, [("a", 1), ("b", 2), (None, 3)])
    assert store.versions() == []  # written, not committed
    first.commit({"x": 0})
    assert rows_of(store.read("t")) == [("a", 1), ("b", 2), (None, 3)]
    killed = put(store, [("a", 9)])
    assert list(Path(tmp_path, "s", "data", killed.id).rglob("*.parquet"))
    assert rows_of(store.read("t")) == [("a", 1), ("b", 2), (None, 3)]
    assert store.manifest().applied == {"x": 0}
    put(store, [("c", 4)], name="u").commit()
    assert not Path(tmp_path, "s", "data", killed.id).exists()  # vacuumed with the next commit
    assert rows_of(store.read("t")) == [("a", 1), ("b", 2), (None, 3)]


def test_two_writers_cannot_both_commit(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    put(store, [("a", 1)]).commit()
    one, two = put(store, [("a", 2)]), put(store, [("a", 3)])
    one.commit()
    with pytest.raises(Conflict):
        two.commit()
    assert rows_of(store.read("t")) == [("a", 2)]


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    put(store, [(f"k{i}", i) for i in range(200)], buckets=8).commit()
    before = store.manifest().tables["t"].files
    incoming = spark.createDataFrame([("k7", 1000)], "k string, v long")
    change = store.begin()
    touched = change.touched("t", incoming)
    assert len(touched) == 1 and len(before) == 8
    opened = {f.rsplit("/", 1)[1] for f in change.read("t", touched).inputFiles()}
    assert opened == {f.rsplit("/", 1)[1] for b in touched for f in before[b]}
    counters.merge_latest(change, "t", incoming, ["k"], ["v"])
    change.commit()
    after = store.manifest().tables["t"].files
    assert {b for b in after if after[b] != before[b]} == touched
    assert rows_of(store.read("t")) == rows_of(
        spark.createDataFrame([(f"k{i}", 1000 if i == 7 else i) for i in range(200)], "k string, v long")
    )


def test_old_versions_go_after_the_next_commit(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(4):
        put(store, [("a", i)]).commit()
    assert store.versions() == [3, 4]
    assert rows_of(store.read("t", version=3)) == [("a", 2)]
    assert len(list(Path(tmp_path, "s", "data").rglob("*.parquet"))) == 2


def test_rows_must_belong_to_the_replaced_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    change = put(store, [("a", 1)])
    with pytest.raises(ValueError, match="not to be replaced"):
        change.replace("t", spark.createDataFrame([("a", 1)], "k string, v long"), [99])
    with pytest.raises(ValueError, match="another layout"):
        change.create("t", spark.range(1).schema, ["id"], 5)


# --- counters -------------------------------------------------------------------------


def test_counts_take_and_give_back(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rng = random.Random(1)
    held: list[tuple] = []
    for _ in range(4):
        come = [(rng.choice(["a", "b", None]), rng.choice("xyz"), rng.randint(0, 9)) for _ in range(6)]
        go = [held.pop(rng.randrange(len(held))) for _ in range(min(len(held), 4))]
        held += come
        rows = [(*r, 1) for r in come] + [(*r[:2], -r[2], -1) for r in go]
        df = spark.createDataFrame(rows, "g string, m string, v long, n long")
        change = store.begin()
        change.create("members", df.schema, ["g", "m"], 3)
        touched = counters.apply_counts(change, "members", df)
        counts = {"n": F.col("n"), "v": F.col("v"), "members": (F.col("n") > 0).cast("bigint")}
        delta = counters.difference(touched, ["g"], counts)
        change.create("groups", delta.schema, ["g"], 3)
        counters.apply_counts(change, "groups", delta)
        change.commit()
    expected = []
    for g in {r[0] for r in held}:
        mine = [r for r in held if r[0] == g]
        expected.append((g, len(mine), sum(r[2] for r in mine), len({r[1] for r in mine})))
    assert rows_of(store.read("groups").select("g", "n", "v", "members")) == sorted(expected, key=repr)


def test_taking_back_what_was_not_added_raises(spark, tmp_path):
    change = Store(spark, str(tmp_path / "s")).begin()
    df = spark.createDataFrame([("a", -1)], "k string, n long")
    change.create("t", df.schema, ["k"], 2)
    with pytest.raises(Exception, match="below zero"):
        counters.apply_counts(change, "t", df)


def test_merged_rows_are_read_from_the_files_written_for_them(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    put(store, [(f"k{i}", i) for i in range(40)]).commit()
    change = store.begin()
    incoming = spark.createDataFrame([("k7", 1000), ("new", 1)], "k string, v long")
    merged, touched = counters.merge_latest(change, "t", incoming, ["k"], ["v"])
    written = {f for b in touched for f in change.tables["t"].files.get(b, ())}
    # Nothing else was stored on the way: the history is written once.
    assert {f.rsplit("/", 1)[1] for f in merged.inputFiles()} == {f.rsplit("/", 1)[1] for f in written}
    rows = dict(rows_of(merged))
    assert rows["k7"] == 1000 and rows["new"] == 1


def test_versions_that_go_and_come(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    schema = "k string, v long, x string"
    change = put(store, [("a", 1, "a1"), ("b", 5, "b5"), ("c", None, "c"), (None, 1, "n1"), ("d", 2, "d2")], schema)
    change.commit()
    change = store.begin()
    # Newer, older, after none, without key, the same again, new and three times over.
    rows = [("a", 2, "a2"), ("b", 4, "b4"), ("c", 0, "c0"), (None, 2, "n2"), ("d", 2, "d2")]
    rows += [("e", i, f"e{i}") for i in (1, 3, 2)]
    incoming = spark.createDataFrame(rows, schema)
    moved = counters.moved_latest(change, "t", incoming, ["k"], ["v"])
    found = sorted((r.sign, r.x) for r in moved.collect())
    assert found == [(-1, "a1"), (-1, "c"), (-1, "n1"), (1, "a2"), (1, "c0"), (1, "e3"), (1, "n2")]
    change.commit()
    assert sorted(r.x for r in store.read("t").collect()) == ["a2", "b5", "c0", "d2", "e3", "n2"]


def test_a_table_without_files_is_known_to_be_empty(spark, tmp_path):
    change = Store(spark, str(tmp_path / "s")).begin()
    schema = "k string, at timestamp_ntz, amount decimal(38,2), s struct<x:int>"
    change.create("t", spark.createDataFrame([], schema).schema, ["k"], 3)
    none = change.read("t")
    assert none.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert none.rdd.getNumPartitions() <= 1 and none.count() == 0
    some = spark.createDataFrame([("a", None, None, None)], schema)
    assert "Union" not in plan_of(none.unionByName(some))


def test_counts_come_as_they_are_and_are_not_stored_first(spark, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(counters, "stored", lambda df, name: names.append(name) or stored(df, name))
    store = Store(spark, str(tmp_path / "s"))
    schema = "k string, n long, v long"
    for rows in ([("a", 1, 2), ("a", 1, 3), (None, 1, 4)], [("a", -1, -3), ("b", 1, 1), ("b", -1, -1), (None, -1, -4)]):
        df = spark.createDataFrame(rows, schema)
        change = store.begin()
        change.create("t", df.schema, ["k"], 4)
        touched = counters.apply_counts(change, "t", df)
        found = sorted((r.k or "", r.old.n, r.new.n, r.new.v) for r in touched.collect())
        change.commit()
    assert found == [("", 1, 0, 0), ("a", 2, 1, 2), ("b", 0, 0, 0)]
    assert rows_of(store.read("t")) == [("a", 1, 2)]
    assert names == ["t", "t"]  # the merged counts of each change, nothing else


# --- loads ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def full(spark):
    c = Crm(spark, SF)
    reports = {
        "rpt_inbound_setter": c.inbound(c.stored_paths),
        "rpt_outbound_setter": c.outbound(c.stored_paths),
        "rpt_closer": c.closer(c.stored_paths),
        "rpt_objections_faced": c.objections(c.stored_paths),
    }
    return c, {n: rows_of(df) for n, df in reports.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_loads_in_any_order_equal_a_full_build(spark, tmp_path, full, seed):
    c, expected = full
    loads = [(d, stored(raw, "day")) for d, raw in crm.daily_loads(spark, SF, days=4)]
    random.Random(seed).shuffle(loads)
    store = Store(spark, str(tmp_path / "s"))
    for batch, (_, raw) in enumerate([*loads, loads[0]]):  # one load comes again
        assert increments.apply_activities(store, raw, batch, c.seeds, buckets=4)
        assert not increments.apply_activities(store, raw, batch, c.seeds, buckets=4)
    for batch, load in enumerate(crm.LOADS):
        users = c.raw("close_crm_users_raw").where(F.col("load_date") == load.date())
        increments.apply_users(store, users, batch, buckets=2)
    for name in increments.REPORTS:
        found = increments.read_report(store, name)
        assert rows_of(found.select(*found.columns)) == expected[name], name
    paths = store.read("fact_lead_funnel").drop("unit")
    assert rows_of(paths) == rows_of(c.stored_paths)


def test_a_load_reads_and_moves_only_what_it_touches(spark, tmp_path, full):
    c, _ = full
    store = Store(spark, str(tmp_path / "s"))
    increments.apply_activities(store, c.raw("lead_activities_raw"), 0, c.seeds, buckets=16)
    before = store.manifest().tables
    one = c.raw("lead_activities_raw").where("source_row_number = 3").limit(1)
    increments.apply_activities(store, one, 1, c.seeds, buckets=16)
    after = store.manifest().tables
    for name in ("events", "fact_lead_funnel", "activity_heads"):
        changed = [b for b in after[name].files if after[name].files[b] != before[name].files.get(b)]
        assert len(changed) <= 1, name
    # The row was there already: no path moves, and so no lead or call of a report.
    for name in ("outbound_leads", "objection_members"):
        assert after[name].files == before[name].files, name


def test_other_mapping_tables_need_a_full_build(spark, tmp_path, full):
    c, _ = full
    store = Store(spark, str(tmp_path / "s"))
    raw = c.raw("lead_activities_raw").limit(5)
    increments.apply_activities(store, raw, 0, c.seeds, buckets=2)
    version = store.manifest().version
    other = c.seeds | {"custom_field_map": c.field_map.limit(3)}
    with pytest.raises(increments.ReferenceChanged):
        increments.apply_activities(store, raw, 1, other, buckets=2)
    assert store.manifest().version == version


def test_a_load_killed_midway_leaves_everything_as_it_was(spark, tmp_path, full, monkeypatch):
    c, _ = full
    store = Store(spark, str(tmp_path / "s"))
    first, second = [raw for _, raw in crm.daily_loads(spark, SF, days=2)]
    increments.apply_activities(store, first, 0, c.seeds, buckets=4)
    was = {n: rows_of(increments.read_report(store, n)) for n in increments.REPORTS}
    monkeypatch.setattr(increments, "_objections", lambda *x: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        increments.apply_activities(store, second, 1, c.seeds, buckets=4)
    assert {n: rows_of(increments.read_report(store, n)) for n in increments.REPORTS} == was
    monkeypatch.undo()
    assert increments.apply_activities(store, second, 1, c.seeds, buckets=4)


def test_snapshots_are_compared_where_they_differ(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    schema = "k string, at int, v string"
    before = [(f"k{i}", 1, "x") for i in range(300)] + [(None, 1, "n"), ("k1", 0, "old"), ("k1", 0, "old")]
    after = [(k, at, "y" if k == "k7" else v) for k, at, v in before if k != "k9"] + [("new", 1, "z"), (None, 2, "m")]
    for name, rows in (("before", before), ("after", after), ("again", before[::-1])):
        df = spark.createDataFrame(rows, schema)
        snapshots.keep_snapshot(store, name, df, ["k"], ["v"], ["at"], buckets=64)
    assert snapshots.differing_buckets(store, "before", "again") == set()
    assert snapshots.snapshot_changes(store, "before", "again", ["at"]).count() == 0
    buckets = snapshots.differing_buckets(store, "before", "after")
    assert 1 <= len(buckets) <= 4
    changes = snapshots.snapshot_changes(store, "before", "after", ["at"])
    expected = {("k7", "update"), ("k9", "missing"), ("new", "insert"), (None, "update")}
    assert set(map(tuple, changes.collect())) == expected
    tables = store.manifest().tables
    allowed = {f.rsplit("/", 1)[1] for n in ("before", "after") for b in buckets for f in tables[n].files.get(b, ())}
    assert {f.rsplit("/", 1)[1] for f in changes.inputFiles()} <= allowed
    # A row more of the same content is a difference, though no change of its key.
    more = spark.createDataFrame([*before, ("k1", 0, "old")], schema)
    snapshots.keep_snapshot(store, "more", more, ["k"], ["v"], ["at"], buckets=64)
    assert len(snapshots.differing_buckets(store, "before", "more")) == 1
    assert snapshots.snapshot_changes(store, "before", "more", ["at"]).count() == 0
