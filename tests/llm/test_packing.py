from __future__ import annotations

import random
from collections import defaultdict
from itertools import product

from tideglass.llm.packing import closest, fill, pack


def slow_closest(room, left):
    best = 0
    for ks in product(*(range(k + 1) for k in left.values())):
        s = sum(n * k for n, k in zip(left, ks))
        if best < s <= room:
            best = s
    return best


def test_closest_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        left = {n: r.randint(0, 3) for n in sorted(r.sample(range(1, 40), 5))}
        room = r.randint(0, 80)
        chosen = closest(room, sorted(n for n in left if left[n]), left)
        assert sum(n * k for n, k in chosen) == slow_closest(room, left) and all(0 < k <= left[n] for n, k in chosen)


def test_fill_places_every_item_once():
    r = random.Random(2)
    counts = {n: r.randint(0, 30) for n in range(1, 101)}
    placed, containers = defaultdict(int), 0
    for pattern, times in fill(counts, 100):
        assert sum(n * k for n, k in pattern) <= 100
        containers += times
        for n, k in pattern:
            placed[n] += k * times
    assert dict(placed) == {n: k for n, k in counts.items() if k}
    total = sum(n * k for n, k in counts.items())
    assert containers <= 1.04 * total / 100  # half of the items fill more than half a container
    assert list(fill({}, 10)) == []


def check(rows, sizes, capacity):
    load, pieces = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r.container_id] += r.n_tokens
        pieces[r.doc_id].append((r.piece, r.first_token, r.n_tokens))
        assert r.container_id is not None
    assert max(load.values(), default=0) <= capacity
    for k, n in sizes.items():
        got = sorted(pieces[k])
        assert sum(x[2] for x in got) == (n or 0) and [x[1] for x in got] == [i * capacity for i in range(len(got))]
        assert len(got) == max(1, -(-(n or 0) // capacity))
    return load


def test_pack(spark):
    r = random.Random(3)
    sizes = {i: r.choice([0, None, 1, 5, 10, 100, 101, 250]) if r.random() < 0.3 else r.randint(1, 60) for i in range(500)}
    df = spark.createDataFrame(list(sizes.items()), "doc_id bigint, n_tokens bigint").selectExpr("*", "1 AS shard", "2 AS piece")
    load = check(pack(df, capacity=100).collect(), sizes, 100)
    total = sum(n or 0 for n in sizes.values())
    assert total / 100 / len([x for x in load.values() if x]) > 0.97
    assert pack(df.limit(0)).collect() == []


def test_many_shards_and_equal_keys(spark, monkeypatch):
    from tideglass.llm import packing

    monkeypatch.setattr(packing, "SHARD_CONTAINERS", 4)
    df = spark.createDataFrame([(7, 30)] * 200, "doc_id bigint, n_tokens bigint")
    rows = pack(df, capacity=100).collect()
    load = defaultdict(int)
    for r in rows:
        load[r.container_id] += r.n_tokens
    assert len(rows) == 200 and max(load.values()) <= 100 and len({c >> 32 for c in load}) > 1


def test_documents(spark, small):
    from tideglass.llm.encode import token_counts
    from tideglass.llm.queries import p9_containers
    from tideglass.sources.tables import table

    sizes = {r.doc_id: r.n_tokens for r in token_counts(table(spark, small, "documents")).collect()}
    check(p9_containers(spark, small).collect(), sizes, 2048)
