import random
import zlib
from collections import Counter, defaultdict

import pytest

from tierline.llm import bfd_sharding as bs


def brute(sizes, capacity, most=None):
    """Group after group into the tightest bin: [(size, bin)], or None."""
    room, out = [], []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            if most is not None and len(room) == most:
                return None
            room.append(max(capacity, s))
            i = len(room) - 1
        room[i] -= s
        out.append((s, i))
    return out


def runs(sizes):
    return [list(x) for x in zip(*sorted(Counter(sizes).items(), reverse=True))] if sizes else ([], [])


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_equal_sizes_pack_as_group_after_group(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 8, 13, 40, 41, 90]) if seed % 2 else rng.randint(1, 100) for _ in range(400)]
    for capacity in (100, 137, 500):
        got = Counter((s, j) for s, a, b, j in bs.best_fit(*runs(sizes), capacity) for _ in range(a, b))
        assert got == Counter(brute(sizes, capacity))


def test_pieces_cover_each_place_once():
    sizes = [50] * 7 + [20] * 30 + [3] * 100 + [1000]
    for pieces in (bs.best_fit(*runs(sizes), 120), bs.even(*runs(sizes), 5)):
        places = defaultdict(list)
        for s, a, b, _ in pieces:
            places[s] += range(a, b)
        assert {s: sorted(p) for s, p in places.items()} == {s: list(range(n)) for s, n in Counter(sizes).items()}


def test_tree_gives_the_tightest():
    rng = random.Random(2)
    tree, held = bs.Remaining(), []
    for shard in range(500):
        held.append((rng.randint(0, 300), shard))
        tree.add(*held[-1])
    for _ in range(800):
        size = rng.randint(0, 320)
        want = min((h for h in held if h[0] >= size), default=None)
        assert tree.take_tightest(size) == want
        if want:
            held.remove(want)
            if rng.random() < 0.5:
                held.append((rng.randint(0, 300), want[1]))
                tree.add(*held[-1])


def test_even_shards():
    rng = random.Random(5)
    sizes = [rng.randint(1, 400) for _ in range(3000)]
    load = Counter()
    for s, a, b, j in bs.even(*runs(sizes), 16):
        load[j] += s * (b - a)
    assert sorted(load) == list(range(16)) and max(load.values()) - min(load.values()) <= 16 * 8


def test_a_group_of_a_third_is_a_shard_alone_and_the_others_even():
    sizes = [100_000] + [10_000] + [100] * 2000
    load = Counter()
    for s, a, b, j in bs.even(*runs(sizes), 16):
        load[j] += s * (b - a)
    rest = sorted(load.values())[:-1]
    assert max(load.values()) == 100_000 and len(rest) == 15 and rest[-1] - rest[0] <= 200


def check(rows, got, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))


def test_rows_groups_and_slots(spark, make):
    rng = random.Random(7)
    rows = [(i, "é" * rng.randint(0, 40) + str(rng.randint(0, 60))) for i in range(300)]
    rows += [(i % 3, "same text") for i in range(150)] + [(None, None), (None, None), (None, ""), (9, "x" * 3000), (9, "x" * 3000)]
    got = bs.pack(make(rows), shards=4).collect()
    check(rows, got, 4)
    by_text = defaultdict(set)
    text = defaultdict(set)
    for i, t in rows:
        text[i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())].add(t)
    for r in got:
        kinds = text[r["doc_id"], r["size"], r["text_crc32"]]
        if len(kinds) == 1:
            by_text[next(iter(kinds))].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    groups = Counter()
    for _, t in rows:
        groups[t] += len((t or "").encode()) + 1
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    want = Counter()
    for s, a, b, j in bs.even(*runs(list(groups.values())), 4):
        want[j] += s * (b - a)
    assert load == want


def test_fixed_capacity_opens_the_shards_of_a_plain_packing(spark, make):
    rng = random.Random(8)
    rows = [(i, "a" * rng.randint(0, 90) + str(i)) for i in range(200)]
    got = bs.pack(make(rows), capacity=500).collect()
    want = brute([len(t) + 1 for _, t in rows], 500)
    check(rows, got, 1 + max(j for _, j in want))
    assert Counter((r["size"], r["shard"]) for r in got) == Counter(want)


def test_small_parts_rank_as_one(spark, make, monkeypatch):
    monkeypatch.setattr(bs, "PART_BITS", 2)
    rows = [(i, "equal size %03d" % (i % 90)) for i in range(200)]
    got = bs.pack(make(rows), shards=3).collect()
    check(rows, got, 3)
    assert {r["group_size"] for r in got} == {45, 30}


def test_empty_table_and_clashing_columns(spark, make):
    assert bs.pack(make([])).collect() == []
    rows = [(i, f"t{i}") for i in range(20)]
    got = bs.pack(make(rows, more="size long, key string, row int, shard int, slot int", value=None), shards=2).collect()
    check(rows, got, 2)
    check([(1, None)], bs.pack(make([(1, None)])).collect(), 16)
