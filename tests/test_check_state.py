"""Carried checks equal a recount of all loads, and older loads are not read."""

from __future__ import annotations

from pathlib import Path

import pytest

from vaultspan.operators import quality as q
from vaultspan.plans.check_state import CheckState, Growing

CHECKS = [
    q.unique("child", "k"), q.unique("child", "id"), q.unique("child", "note"), q.required("child", "k"),
    q.references("child", "code", "codes", "code"), q.references("child", "up", "parent", "k"), q.unique("parent", "k"),
]
CARRIED = [c for c in CHECKS if c.rule is None]
CHILD, PARENT = "k string, id bigint, note string, code string, up string", "k string, id bigint"


class State:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.growing = {t: Growing.at(spark, f"{root}/{t}", "k", "id") for t in ("child", "parent")}
        self.loads, self.seen, self.codes = [], {"child": [], "parent": []}, []

    def load(self, name):
        if name == "codes":
            return self.spark.createDataFrame([(c,) for c in self.codes], "code string")
        return self.growing[name].store.read(self.loads)

    def run(self, child, parent, codes, checks=CHECKS):
        attempt, parts = f"a{len(self.loads)}", {}
        for name, rows, schema in (("child", child, CHILD), ("parent", parent, PARENT)):
            parts[name] = self.growing[name].store.write(attempt, self.spark.createDataFrame(rows, schema))
            self.growing[name].index.add(attempt, parts[name])
            self.seen[name] += rows
        earlier, self.loads = self.loads, [*self.loads, attempt]
        self.codes += codes
        return CheckState(self.spark, self.root, checks, self.growing).carry(attempt, earlier, parts, self.load)

    def recounted(self, checks=CARRIED):
        """The same checks over all rows met so far, without the stored loads."""
        whole = {"child": self.spark.createDataFrame(self.seen["child"], CHILD), "parent": self.spark.createDataFrame(self.seen["parent"], PARENT)}
        load = lambda name: whole.get(name) or self.load(name)
        found = {(r["table_name"], r["column_name"], r["check"]): r["failures"] for r in q.run_checks(checks, load).collect()}
        return {c.name: found[c.table, c.column, c.kind] for c in checks}

    def spoil(self, table, attempt):
        for file in Path(self.root, table, f"load={attempt}").glob("*.parquet"):
            file.write_bytes(b"not to be read again")


@pytest.fixture
def state(spark, tmp_path):
    return State(spark, tmp_path)


def rows(start, count, **changes):
    made = [dict(k=f"K{i:04d}", id=i, note=f"n{i}", code="A", up="P1") | changes for i in range(start, start + count)]
    return [tuple(r.values()) for r in made]


def test_three_loads_without_repeats_leave_older_loads_alone(state):
    checks = [c for c in CHECKS if c.column != "note"]
    carried = [c for c in checks if c.rule is None]
    first = state.run(rows(1, 9) + rows(10, 3, code="B") + rows(13, 2, up="P7"), [("P1", 1)], ["A"], checks)
    assert first == state.recounted(carried) and sum(first.values()) == 5
    state.spoil("child", "a0"), state.spoil("parent", "a0")
    second = state.run(rows(15, 7, up="P2") + rows(22, 1, code="C", up="P2"), [("P2", 2)], ["B"], checks)
    assert second == state.recounted(carried) and sum(second.values()) == 3
    state.spoil("child", "a1"), state.spoil("parent", "a1")
    third = state.run(rows(23, 5, up="P3") + rows(23, 1, up="P3"), [("P7", 3), ("P3", 4)], [], checks)
    assert third == state.recounted(carried) and sum(third.values()) == 3  # key and id repeated, code C


def test_repeats_across_loads_nulls_and_empty_parts(state):
    assert state.run([], [], []) == dict.fromkeys([c.name for c in CARRIED], 0)
    parts = [
        (rows(1, 4) + [(None, None, None, None, None)] * 2, [("P1", 1)], ["A"]),
        (rows(3, 4, note="n1") + [(None, None, None, "Z", "P9")], [("P1", 1)], []),
        ([], [], ["Z"]),
        (rows(1, 1) + rows(40, 2), [("P9", 2)], []),
    ]
    for part in parts:
        assert state.run(*part) == state.recounted()
    final = state.recounted()
    assert [final[c.name] for c in CARRIED] == [3, 3, 1, 0, 0, 1]


def test_a_load_without_state_or_index_is_counted_whole(spark, state):
    state.run(rows(1, 4), [("P1", 1)], ["A"])
    old = State(spark, state.root + "-old")
    for name, part, schema in (("child", rows(1, 3, code="B"), CHILD), ("parent", [("P1", 1)], PARENT)):
        old.growing[name].store.write("a0", spark.createDataFrame(part, schema))
        old.seen[name] += part
    old.loads = ["a0"]
    for part in (rows(2, 2), rows(2, 1)):
        assert old.run(part, [], ["A"]) == old.recounted()
    more = [*CHECKS, q.references("child", "note", "codes", "code")]  # a check declared later
    assert old.run([], [], [], more) == old.recounted([c for c in more if c.rule is None])
