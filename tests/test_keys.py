"""Keys that don't collide, over loads and links."""

import pytest

from strata.functions.hashing import collision_free_keys, key_base, link_keys, probed
from tests.conftest import rows

BITS = 6


def given(loads, base):
    """Keys as they should be given out, one load after the other."""
    keys, held = {}, {}
    for load in loads:
        for n in sorted({n for n in load if n is not None and n not in keys}):
            place = held.get(base[n], 0)
            keys[n] = base[n] + place * (1 << BITS)
            held[base[n]] = place + 1
    return sorted(keys.items())


@pytest.mark.parametrize("small", [True, False])
def test_keys_are_unique_stable_and_found_by_links(spark, small):
    loads = [[*range(0, 200, 3), None, 3, 3], [*range(0, 200, 2)], [*range(200)], [7, 8]]
    base = dict(rows(spark.range(200).select("id", key_base("id", bits=BITS).alias("b"))))
    known = None
    for i, load in enumerate(loads):
        df = spark.createDataFrame([(n,) for n in load], "n bigint").repartition(3)
        fresh = collision_free_keys(df, "n", known, BITS)
        known = fresh if known is None else known.unionByName(fresh)
        got = rows(known.select("natural", "key"))
        assert got == sorted(given(loads[: i + 1], base), key=lambda r: [(v is not None, str(v)) for v in r])
    found = dict(got)
    assert len(set(found.values())) == 200
    assert {n for n, k in found.items() if k == base[n]} == {n for n, k in found.items() if k < 1 << BITS}
    facts = spark.createDataFrame([(n, n) for n in range(200)] + [(None, -1)], "n bigint, id int")
    linked = link_keys(facts, "n", "the_key", probed(known, BITS), small, BITS)
    assert {r["n"]: r["the_key"] for r in linked.collect()} == {**found, None: None}


def test_no_rows(spark):
    assert collision_free_keys(spark.createDataFrame([], "n bigint"), "n").count() == 0
