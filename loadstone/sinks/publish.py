"""Publishing: switches from an old table or folder to a new one that a lost driver
cannot leave half done.

Everything new is complete, and checked, before it takes the place of anything. What then
happens is a row of small steps on the catalog or on file names, of which one decides: what
is found before it is the old state, what is found behind it leads to the new one. The load
that comes next, or :func:`recover_table` and :func:`recover_parts`, undoes or finishes what
a driver left behind; a table or folder is published to by one load at a time.

* A table of the same layout: its location is set to the new folder. Readers see the old
  table or the new one at any time. Then the old folder goes.
* Another layout: the old table is renamed, the new one takes its name. Between the two
  there is no table of that name until recovery, and both are still there.
* Files of a folder, or files added to a table: a journal beside them, made complete by one
  rename, names what is to be deleted and where new files come from; it is worked through
  as often as it takes.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from loadstone import storage
from loadstone.names import TableName, sql_text, table_exists

_FRESH, _OLD = "__loadstone_new_", "__loadstone_old_"
_REPLACES, _PREVIOUS = "loadstone.replaces", "loadstone.previous"
_JOURNAL = "_loadstone-journal-"


def step(done: str) -> None:
    """Called between the steps of a switch; tests end the driver here."""


# Tables


def fresh_name(name: TableName) -> TableName:
    """A new name beside ``name`` for a table that is to take its place."""
    return replace(name, table=f"{name.table}{_FRESH}{uuid.uuid4().hex[:12]}")


def drop_table(spark: SparkSession, name: TableName) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def described(spark: SparkSession, name: TableName) -> dict[str, str]:
    """Type, Provider, Location and the like of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :] if r["col_name"]}


def location(spark: SparkSession, name: TableName) -> str:
    return storage.qualified(spark, described(spark, name)["Location"])


def properties(spark: SparkSession, name: TableName) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def swap_in(spark: SparkSession, fresh: TableName, name: TableName) -> None:
    """``fresh`` takes the name, and the place, of ``name``."""
    if not table_exists(spark, name):
        _rename(spark, fresh, name)
        step("renamed")
    elif _same_layout(spark, fresh, name):
        _switch_location(spark, fresh, name)
    else:
        _switch_names(spark, fresh, name)


def _same_layout(spark: SparkSession, a: TableName, b: TableName) -> bool:
    kinds = [described(spark, x) for x in (a, b)]
    native = all(k.get("Type") == "MANAGED" and k.get("Provider") == "orc" for k in kinds)
    plain = not any("Partition Provider" in k or k.get("Num Buckets") for k in kinds)
    return native and plain and spark.table(str(a)).schema == spark.table(str(b)).schema


def _switch_location(spark: SparkSession, fresh: TableName, name: TableName) -> None:
    old, new = location(spark, name), location(spark, fresh)
    _set_property(spark, fresh, _PREVIOUS, old)
    step("location noted")
    _set_location(spark, name, new)
    step("location switched")
    _drop_switched(spark, fresh, old)


def _drop_switched(spark: SparkSession, fresh: TableName, old: str) -> None:
    # With the old folder as its own, the table that is left over takes it along.
    _set_location(spark, fresh, old)
    step("old location handed over")
    drop_table(spark, fresh)


def _switch_names(spark: SparkSession, fresh: TableName, name: TableName) -> None:
    old = replace(name, table=f"{name.table}{_OLD}{uuid.uuid4().hex[:12]}")
    _set_property(spark, fresh, _REPLACES, name.table)
    step("marked complete")
    _rename(spark, name, old)
    step("old renamed")
    _take_name(spark, fresh, name)
    step("new renamed")
    drop_table(spark, old)


def _take_name(spark: SparkSession, fresh: TableName, name: TableName) -> None:
    _rename(spark, fresh, name)
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{_REPLACES}')")


def _rename(spark: SparkSession, name: TableName, to: TableName) -> None:
    # A new name lies in the catalog of the old one.
    spark.sql(f"ALTER TABLE {name} RENAME TO {replace(to, catalog=None)}")


def _set_property(spark: SparkSession, name: TableName, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = {sql_text(value)})")


def _set_location(spark: SparkSession, name: TableName, path: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_text(path)}")


def recover_table(spark: SparkSession, name: TableName) -> None:
    """Finish or undo what an earlier publish of the table left behind."""
    fresh, old = _left_over(spark, name, _FRESH), _left_over(spark, name, _OLD)
    there = table_exists(spark, name)
    if not there:
        complete = [x for x in fresh if _REPLACES in properties(spark, x)]
        if complete:
            _take_name(spark, complete[0], name)
            fresh.remove(complete[0])
            there = True
        elif old:
            _rename(spark, old[0], name)
            old, there = old[1:], True
    changed = there and recover_parts(spark, location(spark, name))
    for table in fresh:
        previous = properties(spark, table).get(_PREVIOUS)
        if previous and there and location(spark, table) == location(spark, name):
            _drop_switched(spark, table, previous)
        else:
            drop_table(spark, table)
    for table in old:
        drop_table(spark, table)
    if there and (changed or fresh or old):
        spark.catalog.refreshTable(str(name))


def _left_over(spark: SparkSession, name: TableName, mark: str) -> list[TableName]:
    """Tables beside ``name`` that a publish of it has made."""
    where = ".".join(f"`{p}`" for p in (name.catalog, name.database) if p)
    if where and not spark.catalog.databaseExists(where):
        return []
    stem = re.sub("[^A-Za-z0-9_]", "*", name.table)
    listed = spark.sql(f"SHOW TABLES {'IN ' + where if where else ''} LIKE '{stem}{mark}*'").collect()
    pattern = re.compile(re.escape(name.table + mark) + "[0-9a-f]{12}", re.IGNORECASE)
    return [
        replace(name, table=r["tableName"])
        for r in listed
        if not r["isTemporary"] and pattern.fullmatch(r["tableName"])
    ]


# Files


def replace_files(spark: SparkSession, fresh: str, path: str) -> None:
    """The files under ``fresh`` take the place of those directly under ``path``."""
    _begin(spark, path, fresh, storage.file_names(spark, path))


def add_files(spark: SparkSession, fresh: str, path: str) -> None:
    """The files under ``fresh`` join those under ``path``."""
    _begin(spark, path, fresh, [])


def _begin(spark: SparkSession, path: str, fresh: str, old: list[str]) -> None:
    journal = f"{path.rstrip('/')}/{_JOURNAL}{uuid.uuid4().hex}"
    fresh = storage.qualified(spark, fresh)
    storage.write_whole(spark, journal, json.dumps({"from": fresh, "delete": old}))
    step("journal written")
    _finish(spark, path, journal)


def _finish(spark: SparkSession, path: str, journal: str) -> None:
    todo = json.loads(storage.read_whole(spark, journal))
    storage.delete_named(spark, path, todo["delete"])
    step("old files deleted")
    storage.move_files(spark, todo["from"], path)
    step("new files moved")
    storage.delete_tree(spark, todo["from"])
    storage.delete_tree(spark, journal)


def recover_parts(spark: SparkSession, path: str) -> bool:
    """Work through the journals under ``path``, and delete new parts without one; whether
    there were journals."""
    names = storage.hidden_names(spark, path)
    for name in names:
        if name.startswith(_JOURNAL):
            _finish(spark, path, f"{path.rstrip('/')}/{name}")
    for name in names:
        if re.fullmatch(r"_(new|probe)-[0-9a-f]{32}|\._loadstone-journal-.*", name):
            storage.delete_tree(spark, f"{path.rstrip('/')}/{name}")
    return any(name.startswith(_JOURNAL) for name in names)


def fresh_folder(path: str) -> str:
    """A folder below ``path`` for new parts, under a name that readers skip."""
    return f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"


def adopt_parts(spark: SparkSession, path: str, schema, fresh: TableName, options: dict[str, str]) -> bool:
    """A native table ``fresh`` that owns the ORC parts under ``path``: they are moved, not
    written again. False, and nothing done, if its folder lies in another file system."""
    found = spark.read.orc(path).schema
    kind = lambda s: [(f.name.lower(), f.dataType) for f in s.fields]
    if kind(found) != kind(schema):
        raise ValueError(f"the parts under {path} hold {found.simpleString()}, not {schema.simpleString()}")
    spark.catalog.createTable(str(fresh), source="orc", schema=schema, **options)
    home = location(spark, fresh)
    if storage.file_system(spark, home) != storage.file_system(spark, path):
        drop_table(spark, fresh)
        return False
    try:
        storage.move_files(spark, path, home)
        step("parts adopted")
    except Exception:
        storage.move_files(spark, home, path)
        drop_table(spark, fresh)
        raise
    storage.delete_files(spark, path, keep_folders=True)
    spark.catalog.refreshTable(str(fresh))
    return True


def append_table(spark: SparkSession, fresh: TableName, name: TableName) -> bool:
    """The files of ``fresh`` become files of ``name``; False if they do not fit as they are."""
    a, b = (spark.table(str(x)).schema for x in (fresh, name))
    kind = lambda s: sorted((f.name.lower(), f.dataType.simpleString()) for f in s.fields)
    kinds = described(spark, name)
    plain = kinds.get("Provider") == "orc" and "Partition Provider" not in kinds and not kinds.get("Num Buckets")
    home, target = location(spark, fresh), location(spark, name)
    if not plain or kind(a) != kind(b) or storage.file_system(spark, home) != storage.file_system(spark, target):
        return False
    add_files(spark, home, target)
    spark.catalog.refreshTable(str(name))
    return True

