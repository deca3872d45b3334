"""Rank pairing by increments, beside the pairing of all rows."""

import random
from datetime import datetime, timedelta

import pytest

from spinmart.operators.pairing import pair_nth
from spinmart.sinks.paired import PairedMart

HOUR = [datetime(2024, 1, 1) + timedelta(hours=k) for k in range(6)]
LEFT, RIGHT = "uid string, game long, at long, note string", "uid string, game long, won_at long, prize double"
KEYS = ["uid", "game"]


def streams(late: bool):
    """Three hours of credits and wins: a NULL user, ties, equal rows, one user with a third of all rows."""
    pick = random.Random(3)
    hours = []
    for hour in range(3):
        def some(n, other):
            time = (lambda: pick.randint(0, 300)) if late else (lambda: 100 * hour + pick.randint(0, 60))
            user = lambda: pick.choice(["a", "a", "b", "c", "d", None, f"u{pick.randint(0, 9)}"])
            return [(user(), pick.choice([1, 2, None]), pick.choice([time(), time(), time(), None]) if late else time(), other())
                    for _ in range(n)]
        hours.append((some(60, lambda: pick.choice(["x", "y", None])), some(45, lambda: pick.choice([1.0, None]))))
    hours[1][0].extend(hours[1][0][:5])
    return hours


def new_mart(spark, folder, buckets=4, limit=1_000_000):
    empty = [spark.createDataFrame([], form).schema for form in (LEFT, RIGHT)]
    return PairedMart(spark, str(folder / "mart"), *empty, KEYS, ["at"], ["won_at"], buckets, limit)


def full(spark, hours):
    left, right = ([r for hour in hours for r in hour[side]] for side in (0, 1))
    return pair_nth(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), KEYS, ["at"], ["won_at"])


COLUMNS = ["uid", "game", "at", "note", "rn", "won_at", "prize"]


@pytest.mark.parametrize(("late", "order", "limit"), [(False, (0, 1, 2), 1_000_000), (True, (0, 1, 2), 20), (False, (0, 2, 1), 1_000_000)])
def test_increments_equal_the_whole(spark, rows, tmp_path, late, order, limit):
    hours, mart = streams(late), new_mart(spark, tmp_path, limit=limit)
    for i, k in enumerate(order):
        left, right = (spark.createDataFrame(hours[k][side], form) for side, form in ((0, LEFT), (1, RIGHT)))
        mart.load(left, right, HOUR[k], HOUR[k + 1], holes=True)
        if i:
            assert rows(mart.read(), *COLUMNS) == rows(full(spark, [hours[j] for j in order[:i + 1]]), *COLUMNS)
    assert mart.table.intervals() == [(HOUR[0], HOUR[3])]
    before = rows(mart.read(2), *COLUMNS)
    # Late rows rewrite their buckets, so only increments in order are sure to leave several folders.
    made = mart.compact(2)
    assert made >= (4 if late or order != (0, 1, 2) else 5) and mart.compact(2) == made
    assert rows(mart.read(), *COLUMNS) == rows(full(spark, hours), *COLUMNS) and rows(mart.read(2), *COLUMNS) == before


def test_only_touched_groups_are_read(spark, rows, tmp_path, monkeypatch):
    mart, read = new_mart(spark, tmp_path, buckets=16), []
    first = [(f"u{i}", 1, k, "x") for i in range(40) for k in range(5)]
    mart.load(spark.createDataFrame(first, LEFT), spark.createDataFrame([(f"u{i}", 1, 1, 2.0) for i in range(40)], RIGHT),
              HOUR[0], HOUR[1])
    whole = mart._rows
    monkeypatch.setattr(mart, "_rows", lambda v, kind, g: read.append((kind, whole(v, kind, g).count())) or whole(v, kind, g))
    places = lambda v: {(bytes.fromhex(r.part).decode(), r.path) for r in mart.table.places(v).collect()}

    old = places(2)
    mart.load(spark.createDataFrame([("u7", 1, 9, "y")], LEFT), spark.createDataFrame([("u7", 1, 9, 3.0)], RIGHT), HOUR[1], HOUR[2])
    new = places(3)
    # One bucket's open rows and state; paired rows are added to, none is read.
    assert {kind for kind, _ in read} == {"open", "state"} and all(n < 160 / 2 for _, n in read)
    gone = {part for part, _ in old - new}
    assert len(gone) == 2 and {p.split("-")[0] for p in gone} == {"open", "state"}
    assert sum(part.startswith("paired") for part, _ in new) == sum(part.startswith("paired") for part, _ in old) + 1

    read.clear()
    mart.load(spark.createDataFrame([("u7", 1, 0, "late")], LEFT), spark.createDataFrame([], RIGHT), HOUR[2], HOUR[3])
    assert "paired" in {kind for kind, _ in read}
    want = pair_nth(
        spark.createDataFrame([*first, ("u7", 1, 9, "y"), ("u7", 1, 0, "late")], LEFT),
        spark.createDataFrame([*((f"u{i}", 1, 1, 2.0) for i in range(40)), ("u7", 1, 9, 3.0)], RIGHT), KEYS, ["at"], ["won_at"])
    assert rows(mart.read(), *COLUMNS) == rows(want, *COLUMNS)


def test_intervals_are_loaded_once(spark, rows, tmp_path):
    mart = new_mart(spark, tmp_path)
    none = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    mart.load(*none, HOUR[0], HOUR[1])
    assert rows(mart.read()) == []
    for lo, hi in ((0, 1), (0, 2), (1, 1), (3, 4)):
        with pytest.raises(ValueError):
            mart.load(*none, HOUR[lo], HOUR[hi])
    one = spark.createDataFrame([("a", 1, 1, "x")], LEFT), none[1]
    mart.load(*one, HOUR[1], HOUR[2])
    assert rows(mart.read(), *COLUMNS) == [("a", 1, 1, "x", 1, None, None)]


def test_a_load_that_stops_changes_nothing(spark, rows, tmp_path, monkeypatch):
    mart = new_mart(spark, tmp_path)
    left, right = spark.createDataFrame([("a", 1, 1, "x")], LEFT), spark.createDataFrame([("a", 1, 1, 1.0)], RIGHT)
    mart.load(left, right, HOUR[0], HOUR[1])
    with monkeypatch.context() as patch:
        patch.setattr(mart.table, "_switch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            mart.load(left, right, HOUR[1], HOUR[2])
    assert len(rows(mart.read())) == 1 and mart.table.intervals() == [(HOUR[0], HOUR[1])]
    mart.load(left, right, HOUR[1], HOUR[2])
    assert [r[4] for r in rows(mart.read(), *COLUMNS)] == [1, 2]
