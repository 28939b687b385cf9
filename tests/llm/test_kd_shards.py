"""K-d tree shards: the law, gapless slots, and the cuts against a plain version."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import kd_shards
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def held(rows, docs):
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_query_makes_equal_bytes(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op5_kd_shards"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    sizes = held(rows, docs)
    mean, longest = sum(sizes.values()) / 24, max(len((t or "").encode()) for t in docs.values())
    assert set(sizes) == set(range(24)) and max(sizes.values()) - mean < longest and mean - min(sizes.values()) < longest


def test_hot_source_copies_and_odd_rows(spark):
    rng = random.Random(6)
    docs = {d: rng.choice(["same text", "w" * rng.randrange(1, 60)]) for d in range(3000)} | {5000: None, 5001: ""}
    rows = [(d, t, rng.choice(["hot", "hot", None, f"s{d % 9}"]), "en", None if d % 5 else d, d) for d, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, shard long")
    sizes = held(kd_shards.kd_shards(df, shards=7).collect(), docs)
    mean = sum(sizes.values()) / 7
    assert len(sizes) == 7 and max(abs(s - mean) for s in sizes.values()) < 200
    by_target = held(kd_shards.kd_shards(df, target_bytes=5000).collect(), docs)
    assert max(by_target.values()) < 5400


def test_empty_one_row_null_and_repeated_keys(spark):
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    assert kd_shards.kd_shards(spark.createDataFrame([], schema), shards=24).count() == 0
    rows = [(None, "a", None, None, None), (1, "b", "s", "x", 1), (1, "b", "s", "x", 1)]
    got = kd_shards.kd_shards(spark.createDataFrame(rows, schema), shards=4).collect()
    assert len(got) == 3
    assert kd_shards.kd_shards(spark.createDataFrame(rows[:1], schema), shards=4).count() == 1


def plain_tree(rows, first, shards, out):
    """The tree over (k, size, at, tie) by sorting each node along its widest dimension."""
    if shards == 1:
        out.update({r[0]: first for r in rows})
        return
    half, left, right = shards // 2, [], rows
    if rows:
        widths = [max(r[2][d] for r in rows) - min(r[2][d] for r in rows) for d in range(len(rows[0][2]))]
        d = widths.index(max(widths))
        place = {r[0]: (r[2][d] << (kd_shards.KEY_BITS - kd_shards.STEPS)) | r[3] for r in rows}
        weight = Counter()
        for r in rows:
            weight[place[r[0]]] += r[1]
        target, below = sum(r[1] for r in rows) * half / shards, 0
        for key in sorted(weight):
            if below + weight[key] >= target:
                break
            below += weight[key]
        cut = key + (below + weight[key] - target < target - below)
        left, right = [r for r in rows if place[r[0]] < cut], [r for r in rows if place[r[0]] >= cut]
    plain_tree(left, first, half, out)
    plain_tree(right, first + half, shards - half, out)


@pytest.mark.parametrize("shards", [1, 2, 7, 24])
def test_assignment_is_that_of_a_plain_tree(spark, monkeypatch, shards):
    monkeypatch.setattr(kd_shards, "TOLERANCE", -1.0)
    monkeypatch.setattr(kd_shards, "BIN_BITS", 9)
    rng = random.Random(shards)
    top = 1 << kd_shards.STEPS
    rows = [
        (k, rng.choice([8, 8, 500, rng.randrange(8, 3000)]), [rng.choice([5, rng.randrange(top)]), rng.randrange(top // 2), 7], rng.randrange(1 << 30))
        for k in range(300)
    ]
    rows += [(300 + i, 100, [5, 5, 7], 1 << 20) for i in range(20)]  # these agree in all
    want: dict[int, int] = {}
    plain_tree(rows, 0, shards, want)
    df = spark.createDataFrame([(*r, 0) for r in rows], "k long, size long, at array<long>, tie long, node int").repartition(3)
    assert {r["k"]: r["shard"] for r in kd_shards.assign(df, shards).collect()} == want
