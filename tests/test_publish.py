"""Versions of published tables: whole, or as before."""

import pytest

from tripmart.plans.publish import Conflict, Published
from tripmart.workspace import new_path


@pytest.fixture
def place(spark):
    return Published(spark, new_path(spark, "published"))


def writer(spark, **tables):
    def write(folder):
        for name, values in tables.items():
            spark.createDataFrame([(v,) for v in values], "v int").write.parquet(f"{folder}/{name}")
        return {name: len(values) for name, values in tables.items()}

    return write


def values(place, name, number=None):
    return sorted(r.v for r in place.read(name, number).collect())


def test_versions_follow_each_other(spark, place):
    assert place.version().number == 0
    place.update(writer(spark, a=[1, 2], b=[3]))
    second = place.update(writer(spark, a=[4]))
    assert second.number == 2 and second.rows == {"a": 1, "b": 1}
    assert values(place, "a") == [4] and values(place, "b") == [3]
    assert values(place, "a", 1) == [1, 2]
    third = place.update(writer(spark), without=("b",))
    assert set(third.paths) == {"a"} and place.version() == third


def test_a_job_that_dies_leaves_what_was_there(spark, place):
    place.update(writer(spark, a=[1], b=[2]))

    def dies(folder):
        writer(spark, a=[9])(folder)
        raise RuntimeError("killed between two tables")

    with pytest.raises(RuntimeError):
        place.update(dies)
    assert place.version().number == 1 and values(place, "a") == [1] and values(place, "b") == [2]
    assert place.clean() == 1 and values(place, "a") == [1]


def test_of_two_who_began_alike_one_is_refused(spark, place):
    place.update(writer(spark, a=[1]))
    one, other = place.begin(), place.begin()
    rows_one, rows_other = writer(spark, a=[2])(one), writer(spark, a=[3])(other)
    place.publish(one, rows_one, after=1)
    with pytest.raises(Conflict):
        place.publish(other, rows_other, after=1)
    assert values(place, "a") == [2] and place.version().number == 2


def test_a_taken_name_is_never_overwritten(spark, place, monkeypatch):
    """Even if nobody saw the other version when publishing began."""
    place.update(writer(spark, a=[1]))
    folder = place.begin()
    rows = writer(spark, a=[5])(folder)
    monkeypatch.setattr(place, "_numbers", lambda: [])
    with pytest.raises(Conflict):
        place.publish(folder, rows, after=0)
    monkeypatch.undo()
    assert values(place, "a") == [1]


def test_cleaning_keeps_what_later_versions_carry_over(spark, place):
    place.update(writer(spark, a=[1], b=[2]))
    for i in range(3):
        place.update(writer(spark, a=[10 + i]))
    assert place.clean(keep=1) == 2
    assert values(place, "a") == [12] and values(place, "b") == [2] and place.version().number == 4
