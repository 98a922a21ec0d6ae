"""Registrations without SQL run at the sizes of the reference."""

from tidemark.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def test_depth_sweep_covers_every_depth(spark):
    assert sorted(r["max_depth"] for r in catalogue.QUERIES["m13_depth_sweep"](spark, FOLDER).collect()) == list(range(2, 25))


def test_nested_segments_cover_three_to_ten(spark):
    columns = catalogue.QUERIES["c2_nested_segments"](spark, FOLDER).columns
    assert [c for c in columns if c.startswith("labels_")] == [f"labels_{k}" for k in range(3, 11)]
