"""Type-2 histories against a plain re-computation, in any order of loads."""

import random

import pytest

from strata.operators.history import CURRENT, FROM, TO, merge_history
from tests.conftest import rows

SCHEMA = "k int, at int, v string"


def intervals(loads, compare=False):
    """What the loads should give: the newest load's version of each key and time, in time order."""
    best = {}
    for number, load in enumerate(loads):
        for k, at, v in load:
            old = best.get((k, at))
            if old is None or (number, v is not None, v or "") >= old[:3]:
                best[k, at] = (number, v is not None, v or "", v)
    out = []
    for key in {k for k, _ in best}:
        times = sorted((t for k, t in best if k == key), key=lambda t: (t is not None, t or 0))
        kept = []
        for t in times:
            v = best[key, t][3]
            if not compare or not kept or kept[-1][1] != v:
                kept.append((t, v))
        for i, (t, v) in enumerate(kept):
            until = kept[i + 1][0] if i + 1 < len(kept) else None
            out.append((key, t, v, until, i + 1 == len(kept)))
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def after(spark, loads, **more):
    held = None
    for load in loads:
        held = merge_history(held, spark.createDataFrame(load, SCHEMA).repartition(3), ["K"], "at", **more)
    return rows(held, "k", FROM, "v", TO, CURRENT)


def test_late_and_equal_versions_split_and_replace(spark):
    loads = [[(1, 10, "a"), (1, 30, "c"), (2, 5, "x"), (None, 1, "n")], [(1, 20, "b"), (1, 30, "C"), (1, 30, "B")], [(None, 0, "m"), (3, None, "z")]]
    got = after(spark, loads)
    assert got == intervals(loads)
    assert (1, 20, "b", 30, False) in got and (1, 30, "C", None, True) in got and (2, 5, "x", None, True) in got


def test_random_loads_have_no_overlaps_and_replays_change_nothing(spark):
    rng = random.Random(3)
    loads = [[(rng.randrange(6), rng.randrange(12), rng.choice("abc")) for _ in range(25)] for _ in range(3)]
    got = after(spark, loads)
    assert got == intervals(loads) == after(spark, [*loads, loads[-1]])
    by_key = {}
    for k, start, _, until, current in got:
        by_key.setdefault(k, []).append((start, until, current))
    for spans in by_key.values():
        spans.sort()
        assert [s[1] for s in spans[:-1]] == [s[0] for s in spans[1:]] and [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]


def test_equal_neighbours_are_one_version_if_asked(spark):
    load = [(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a"), (2, 1, None)]
    assert after(spark, [load], compare="v") == intervals([load], compare=True)


def test_untouched_keys_are_not_sorted_again_and_empty_loads_change_nothing(spark):
    first = [(i, 1, "a") for i in range(5)]
    assert after(spark, [first, []]) == intervals([first])
    assert after(spark, [[]]) == []
    with pytest.raises(ValueError):
        merge_history(None, spark.createDataFrame(first, SCHEMA), ["missing"], "at")
