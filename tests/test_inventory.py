"""The file inventory: versions, content store, concurrent updates."""

import pytest

from tallgrass.sources.inventory import ConcurrentUpdateError, Inventory


def names(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "file_name string")


def files(spark, **contents):
    return spark.createDataFrame([(k, v) for k, v in contents.items()], "file_name string, content binary")


def changes(df):
    return {r["file_name"]: r["change"] for r in df.collect()}


def test_versions_follow_what_arrives_and_is_listed(spark, scratch):
    inv = Inventory(spark, scratch)
    assert inv.version() == 0 and inv.held().count() == 0 and inv.content().count() == 0
    got = inv.update(names(spark, "a", "b", "never", None), files(spark, a=b"1", b=b"2", unlisted=b"9"))
    assert changes(got) == {"a": "new", "b": "new"}
    got = inv.update(names(spark, "a", "b", "c"), files(spark, b=b"3", c=b"1", a=b"1"))
    assert changes(got) == {"a": "same", "b": "changed", "c": "new"}
    got = inv.update(names(spark, "c"))
    assert changes(got) == {"a": "removed", "b": "removed", "c": "same"}
    assert inv.version() == 3
    assert {r["file_name"]: r["since"] for r in inv.held(2).collect()} == {"a": 1, "b": 2, "c": 2}
    # earlier versions keep their contents; equal contents are stored once
    assert {r["file_name"]: bytes(r["content"]) for r in inv.content(2).collect()} == {"a": b"1", "b": b"3", "c": b"1"}
    assert {r["file_name"]: bytes(r["content"]) for r in inv.content(1).collect()} == {"a": b"1", "b": b"2"}
    stored = spark.read.parquet(f"{scratch}/content")
    assert stored.count() == 3


def test_the_last_of_several_arrivals_counts(spark, scratch):
    inv = Inventory(spark, scratch)
    arrived = spark.createDataFrame([("a", b"old", 1), ("a", b"new", 2)], "file_name string, content binary, arrived_at int")
    inv.update(names(spark, "a"), arrived)
    assert bytes(inv.content().first()["content"]) == b"new"


def test_an_update_behind_another_is_refused(spark, scratch, monkeypatch):
    inv, other = Inventory(spark, scratch), Inventory(spark, scratch)
    inv.update(names(spark, "a"), files(spark, a=b"1"))
    monkeypatch.setattr(other, "version", lambda: 0)
    with pytest.raises(ConcurrentUpdateError):
        other.update(names(spark, "b"), files(spark, b=b"2"))
    assert [r["file_name"] for r in inv.held().collect()] == ["a"]
