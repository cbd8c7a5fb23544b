"""Loads into a table with rules."""

import pytest

from tallywork.plans.storage import new_folder
from tallywork.sources import CheckedTable
from tallywork.sources.tables import Check, ForeignKey, Unique

SCHEMA = "id bigint, name string, boss bigint, team string"
RULES = (
    Check("people", "name not null", "name IS NOT NULL"),
    Check("people", "id positive", "id > 0"),
    Unique("people", "id"),
    Unique("people", "name"),
    ForeignKey("people", "boss", "people", "id"),
    ForeignKey("people", "team", "teams", "code"),
    Check("teams", "not about people", "code <> ''"),
)


@pytest.fixture
def people(spark):
    return CheckedTable(spark, new_folder(spark, "people"), "people", RULES, schema=SCHEMA, buckets=4)


@pytest.fixture
def teams(frame):
    return {"teams": frame([("a",), ("b",), (None,)], "code string")}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def broken_of(table):
    return sorted((r["id"], r["name"], sorted(r["broken"])) for r in table.quarantine().collect())


def test_good_and_broken_rows_part(frame, people, teams):
    assert people.read().collect() == [] and people.quarantine().collect() == []
    first = [(1, "Ann", None, "a"), (2, "Bob", 1, None), (3, "Cy", 99, "b"), (-4, None, 1, "x")]
    assert people.append(frame(first, SCHEMA), teams) == (2, 2)
    assert rows_of(people.read()) == [(1, "Ann", None, "a"), (2, "Bob", 1, None)]
    assert broken_of(people) == [
        (-4, None, ["id positive", "name not null", "team in teams"]),
        (3, "Cy", ["boss in people"]),
    ]
    # known keys, keys twice in the load, a column less; a boss of the load itself
    second = [(2, "Zed", 1), (5, "Dee", 6), (6, "Eve", 2), (6, "Fay", 2), (7, "Ann", 1), (None, "Gus", 1), (None, "Hal", 1)]
    good, broken = people.append(frame(second, "id bigint, name string, boss bigint"), teams)
    assert (good, broken) == (4, 3)
    found = rows_of(people.read())
    assert len(found) == 6 and (5, "Dee", 6, None) in found and (None, "Gus", 1, None) in found
    assert len([r for r in found if r[0] == 6]) == 1
    later = broken_of(people)[2:]
    assert {tuple(r[2]) for r in broken_of(people) if r[0] in (2, 6)} == {("id unique",)}
    assert (7, "Ann", ["name unique"]) in later


def test_a_broken_first_row_does_not_keep_the_next_one_out(frame, people, teams):
    rows = [(1, "Ann", 42, "a"), (1, "Ann", None, "a"), (1, "Ann", None, "a")]
    assert people.append(frame(rows, SCHEMA).coalesce(1), teams) == (1, 2)
    assert rows_of(people.read()) == [(1, "Ann", None, "a")]
    assert broken_of(people) == [(1, "Ann", ["boss in people"]), (1, "Ann", ["id unique", "name unique"])]


def test_a_load_is_judged_again_after_another_one(spark, frame, people, teams):
    other = CheckedTable(spark, people._data.removesuffix("/data"), "people", RULES, schema=SCHEMA, buckets=4)
    create, left = people._records.create, [1]

    def late(number, record):
        if left:
            left.pop()
            other.append(frame([(1, "Zoe", None, "a")], SCHEMA), teams)
        return create(number, record)

    people._records.create = late
    assert people.append(frame([(1, "Ann", None, "a"), (2, "Bob", 1, "a")], SCHEMA), teams) == (1, 1)
    assert rows_of(people.read()) == [(1, "Zoe", None, "a"), (2, "Bob", 1, "a")]


def test_many_rows_of_one_key(frame, people, teams):
    rows = [(7, f"n{i}", None, "a") for i in range(300)] + [(100 + i, f"m{i}", 7, "b") for i in range(300)]
    assert people.append(frame(rows, SCHEMA), teams) == (301, 299)


def test_compaction(frame, people, teams):
    for i in range(1, 4):
        people.append(frame([(i, f"n{i}", None, "a"), (i, None, None, "a")], SCHEMA), teams)
    rows, broken = rows_of(people.read()), broken_of(people)
    files = len(people.read().inputFiles())
    assert people.compact() == 3 and people.compact() == 1
    assert rows_of(people.read()) == rows and broken_of(people) == broken
    people.forget()
    assert rows_of(people.read()) == rows and len(people.read().inputFiles()) <= files
    assert people._records.numbers() == [4]
    assert people.append(frame([(1, "again", None, "a")], SCHEMA), teams) == (0, 1)


def test_wrong_columns_and_rules(spark, frame, people, teams):
    with pytest.raises(ValueError, match="other"):
        people.append(frame([(1, 2)], "id bigint, other int"), teams)
    with pytest.raises(ValueError, match="unique"):
        CheckedTable(spark, "x", "teams", RULES, schema="code string")
