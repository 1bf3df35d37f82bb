"""A paged source ends at its first short page."""

import os

import pytest

from tripmart.session import scratch_dir
from tripmart.sources import pages


def land(root, sizes):
    os.makedirs(root, exist_ok=True)
    for number, n in sizes.items():
        with open(f"{root}/page_{number}.json", "w") as f:
            f.write("".join(f'{{"id": {number * 100 + i}}}\n' for i in range(n)))


@pytest.mark.parametrize("sizes,first,want,start", [
    ({1: 5, 2: 5, 3: 2, 4: 5}, 1, [1, 2, 3], 3),          # a short page is the last; the one after it is not read
    ({1: 5, 2: 5}, 1, [1, 2], 3),                         # all full: goes on after them
    ({1: 5, 2: 0, 3: 5}, 1, [1], 2),                      # an empty page
    ({1: 5, 3: 5}, 1, [1], 2), ({2: 5, 3: 5}, 1, [], 1),  # a page that has not landed
    ({1: 5, 2: 5, 3: 1}, 2, [2, 3], 3), ({1: 0}, 1, [], 1), ({9: 5, 10: 5, 11: 3}, 9, [9, 10, 11], 11)])
def test_the_end_of_a_source(spark, sizes, first, want, start):
    root = scratch_dir(spark, "t-pages").removeprefix("file:")
    land(root, sizes)
    rows, after = pages.read_pages(spark, root, spark.createDataFrame([], "id long").schema, 5, first)
    assert sorted({r.page for r in rows.collect()}) == want and after == start
    assert rows.count() == sum(sizes[p] for p in want)


def test_a_run_goes_on_where_the_last_ended(spark):
    root = scratch_dir(spark, "t-pages").removeprefix("file:")
    schema = spark.createDataFrame([], "id long").schema
    land(root, {1: 5, 2: 3})
    _, start = pages.read_pages(spark, root, schema, 5)
    land(root, {2: 5, 3: 5, 4: 1})
    rows, after = pages.read_pages(spark, root, schema, 5, start)
    assert sorted({r.page for r in rows.collect()}) == [2, 3, 4] and after == 4
