"""A target with versions and a record of loaded intervals."""

from datetime import datetime, timedelta

import pytest

from spinmart.sinks.versions import VersionedTable, gaps, merged
from spinmart.sources.changes import LoadConfig

DAY = [datetime(2024, 1, 1) + timedelta(days=k) for k in range(9)]
FORM = "id long, value double, updated_at timestamp_ntz, created_at timestamp_ntz, kind string"
CONFIG = LoadConfig.for_source("postgres", "shop", "items")


def row(i, value, updated, created, kind="a"):
    return (i, value, DAY[updated], DAY[created], kind)


OLD = [row(1, 1.0, 0, 0), row(2, 2.0, 0, 0, "b/=%"), row(3, 3.0, 0, 0, None), row(None, 4.0, 0, 0, "c")]
NEW = [row(1, 1.5, 2, 0), row(2, 2.0, 0, 0, "b/=%"), row(3, 3.5, 3, 0, None), row(4, 9.0, 2, 2, "a"), row(5, 5.0, 4, 4, "d")]


@pytest.fixture
def target(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "items"), "kind")
    made.create(spark.createDataFrame(OLD, FORM), [(DAY[0], DAY[1])])
    return made


def test_intervals():
    assert merged([(3, 5), (1, 2), (2, 3), (8, 8), (7, 9), (4, 6)]) == [(1, 6), (7, 9)]
    assert gaps([(1, 2), (4, 5), (2, 3), (9, 10)]) == [(3, 4), (5, 9)] and gaps([]) == [] == merged([])


def test_versions_stay_as_they_were(spark, target, rows):
    source = spark.createDataFrame(NEW, FORM)
    before = target.read()
    assert target.load(source, CONFIG, DAY[1], DAY[3]) == 2 and target.load(source, CONFIG, DAY[3], DAY[5]) == 3
    last = [NEW[0], OLD[1], NEW[2], NEW[3], NEW[4], OLD[3]]
    second = [NEW[0], OLD[1], OLD[2], NEW[3], OLD[3]]
    same = lambda df, want: rows(df) == rows(spark.createDataFrame(want, FORM))
    assert same(before, OLD) and same(target.read(1), OLD) and same(target.read(2), second) and same(target.read(), last)
    # Untouched partitions keep their folder, touched ones have a new one.
    one, two = ({r.part: r.path for r in target.places(v).collect()} for v in (1, 2))
    assert {p for p in one if one[p] != two[p]} == {"61"} and one.keys() == two.keys()
    assert target.load(source, CONFIG, DAY[1], DAY[5]) == 4 and same(target.read(), last)


def test_a_load_that_stops_before_the_switch_changes_nothing(spark, target, rows, monkeypatch):
    source = spark.createDataFrame(NEW, FORM)
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            target.load(source, CONFIG, DAY[1], DAY[5])
    assert target.versions() == [1] and target.intervals() == [(DAY[0], DAY[1])]
    assert rows(target.read()) == rows(spark.createDataFrame(OLD, FORM))
    assert target.load(source, CONFIG, DAY[1], DAY[5]) == 2 and target.read().count() == 6


def test_a_load_that_another_one_overtook_is_refused(spark, target, monkeypatch):
    source = spark.createDataFrame(NEW, FORM)
    switch = VersionedTable._switch

    def overtaken(self, aside, version):
        monkeypatch.setattr(VersionedTable, "_switch", switch)
        self.load(source, CONFIG, DAY[1], DAY[2])
        switch(self, aside, version)

    monkeypatch.setattr(VersionedTable, "_switch", overtaken)
    with pytest.raises(RuntimeError):
        target.load(source, CONFIG, DAY[1], DAY[5])
    assert target.versions() == [1, 2] and target.intervals() == [(DAY[0], DAY[2])]


def test_gaps_are_refused_or_proposed(spark, target):
    source = spark.createDataFrame(NEW, FORM)
    with pytest.raises(ValueError):
        target.load(source, CONFIG, DAY[2], DAY[3])
    target.load(source, CONFIG, DAY[2], DAY[3], holes=True)
    assert target.next_interval(DAY[5]) == (DAY[1], DAY[2])
    target.load(source, CONFIG, *target.next_interval(DAY[5]))
    assert target.intervals() == [(DAY[0], DAY[3])] and target.next_interval(DAY[5]) == (DAY[3], DAY[5])
    target.load(source, CONFIG, *target.next_interval(DAY[5]))
    assert target.next_interval(DAY[5]) is None
    assert target.load(source.limit(0), CONFIG, DAY[5], DAY[6]) == 5 and target.read().count() == 6
