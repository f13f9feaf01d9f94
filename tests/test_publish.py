"""A driver that is lost between any two steps of a publish."""

from pathlib import Path

import pytest

from loadstone import load
from loadstone.sinks import publish, tables
from loadstone.sinks.tables import resolve_table
from loadstone.storage import qualified

OLD, NEW = ["1þa", "2þb"], ["3þc", "4þd", "5þe"]


class Lost(BaseException):
    pass


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE publish_test LOCATION '{tmp_path}/db'")
    yield "publish_test"
    spark.sql("DROP DATABASE publish_test CASCADE")


def lost_at(monkeypatch, n):
    """The names of the steps that were reached; the driver ends at the n-th."""
    reached = []

    def step(done):
        reached.append(done)
        if len(reached) == n + 1:
            raise Lost

    monkeypatch.setattr(publish, "step", step)
    return reached


def rows(df):
    return sorted(r["id"] for r in df.select("id").collect())


def listed(spark, database):
    return sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r["isTemporary"])


SAME = "id:INT64,note"
STEPS = {
    "replace": ("table written", "location noted", "location switched", "old location handed over"),
    "replace typed": ("table written", "marked complete", "old renamed", "new renamed"),
    "append": ("table written", "journal written", "old files deleted", "new files moved"),
    "adopt": ("parts adopted", "location noted", "location switched", "old location handed over"),
    "adopt append": ("parts adopted", "table written", "journal written", "old files deleted", "new files moved"),
    "first": ("table written", "renamed"),
    "parts": ("parts written", "journal written", "old files deleted", "new files moved"),
    "external": ("parts written", "journal written", "old files deleted", "new files moved", "external table made", "marked complete", "old renamed", "new renamed"),
}
# The step from which on recovery leads to the new state.
DECIDES = {"replace": 2, "replace typed": 2, "append": 1, "adopt": 2, "adopt append": 2, "first": 1, "parts": 1, "external": 1}


@pytest.mark.parametrize("kind,n", [(k, n) for k, steps in STEPS.items() for n in range(len(steps))])
def test_lost_driver(spark, text, database, tmp_path, monkeypatch, kind, n):
    table, path = f"{database}.t", str(tmp_path / "parts")
    old, new = text(*OLD), text(*NEW)
    options = {"schema": SAME, "mode": "append" if "append" in kind else "replace"}
    if kind == "replace typed":  # inferred, and numbers now
        new, options["autodetect"] = text("3þ1", "4þ2", "5þ3"), True
    if kind == "append":
        options["error_limit"] = 5
    if kind in ("parts", "external"):
        options["path"] = path
    if kind == "external":
        options["external"] = True
    if "adopt" in kind:
        options |= {"path": path, "adopt": True}
    target = None if kind == "parts" else table
    if kind != "first":
        load(spark, old, target, **{k: v for k, v in options.items() if k in ("path", "external")}, schema=SAME)
        if "adopt" in kind:
            tables.delete_files(spark, path)
    reached = lost_at(monkeypatch, n)
    with pytest.raises(Lost):
        load(spark, new, target, **options)
    assert tuple(reached) == STEPS[kind][: n + 1]
    monkeypatch.undo()
    if kind in ("replace", "adopt"):
        # Readers who know of no recovery.
        assert rows(spark.table(table)) == ([1, 2] if n < 2 else [3, 4, 5])
    if kind != "parts":
        publish.recover_table(spark, resolve_table(table))
    publish.recover_parts(spark, path)
    before, after = ([] if kind == "first" else [1, 2]), [1, 2, 3, 4, 5] if "append" in kind else [3, 4, 5]
    expected = after if n >= DECIDES[kind] else before
    if kind == "parts":
        found = rows(spark.read.orc(path))
    else:
        found = rows(spark.table(table)) if spark.catalog.tableExists(table) else []
        assert listed(spark, database) == (["t"] if expected else [])
        folders = [p for p in Path(tmp_path / "db").glob("t*")]
        assert len(folders) <= 1
        if expected and kind != "external":
            assert publish.location(spark, resolve_table(table)) == qualified(spark, str(folders[0]))
    assert found == expected
    if kind in ("parts", "external"):
        assert not list(Path(path).glob("_new*")) and not list(Path(path).glob("*journal*"))
    # The next load finds nothing in its way.
    load(spark, new, target, **(options | {"mode": "replace"}))
    assert rows(spark.read.orc(path) if kind == "parts" else spark.table(table)) == [3, 4, 5]


def test_adopted_parts_are_written_once(spark, text, database, tmp_path):
    path, table = tmp_path / "parts", f"{database}.t"
    load(spark, text(*OLD), table, path=str(path), schema=SAME, adopt=True)
    home = publish.location(spark, resolve_table(table)).removeprefix("file:")
    first = {p.name: p.stat().st_ino for p in Path(home).glob("part-*")}
    assert first and not list(path.glob("*"))
    load(spark, text(*NEW), table, path=str(path), schema=SAME, adopt=True, mode="append")
    now = {p.name: p.stat().st_ino for p in Path(home).glob("part-*")}
    assert first.items() < now.items() and rows(spark.table(table)) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="adopted"):
        load(spark, text(*OLD), path=str(path), schema=SAME, adopt=True)


def test_parts_of_another_schema_are_not_adopted(spark, text, database, tmp_path):
    path = str(tmp_path / "parts")
    load(spark, text(*OLD), path=path, schema=SAME)
    fields = spark.createDataFrame([], "id string, note string").schema
    with pytest.raises(ValueError, match="parts under"):
        tables.adopt_table(spark, path, fields, resolve_table(f"{database}.t"), "replace")
    assert rows(spark.read.orc(path)) == [1, 2] and listed(spark, database) == []


def test_other_tables_are_left_alone(spark, text, database):
    other = f"{database}.t__loadstone_new_backup"
    load(spark, text(*OLD), other, schema=SAME)
    load(spark, text(*OLD), f"{database}.t_new_0123456789ab", schema=SAME)
    load(spark, text(*NEW), f"{database}.t", schema=SAME, mode="replace")
    assert listed(spark, database) == ["t", "t__loadstone_new_backup", "t_new_0123456789ab"]


def test_append_to_a_table_of_another_kind(spark, text, database):
    spark.sql(f"CREATE TABLE {database}.t (note STRING, id BIGINT) USING parquet")
    load(spark, text(*OLD, "xþy"), f"{database}.t", mode="append", schema="", error_limit=5)
    assert listed(spark, database) == ["t"]
    spark.sql(f"CREATE TABLE {database}.o (note STRING, id BIGINT) USING orc")
    load(spark, text("aþ1", "bþ2", "cþx"), f"{database}.o", mode="append", error_limit=5)
    assert rows(spark.table(f"{database}.o")) == [1, 2] and listed(spark, database) == ["o", "t"]


def test_properties_outlive_a_replace(spark, text, database):
    load(spark, text(*OLD), f"{database}.t", schema=SAME)
    spark.sql(f"ALTER TABLE {database}.t SET TBLPROPERTIES ('team' = 'me')")
    load(spark, text(*NEW), f"{database}.t", schema=SAME, mode="replace")
    assert publish.properties(spark, resolve_table(f"{database}.t"))["team"] == "me"
    assert rows(spark.table(f"{database}.t")) == [3, 4, 5]
