import random

import xxhash

from tierline.llm import simhash_bktree as sb
from tierline.llm.components import connected_components


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, radius):
    """value -> least value reachable"""
    left, out = set(fps), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= radius}
            left -= near
            group |= near
            todo += near
        out |= {x: min(group) for x in group}
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_equal_the_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 5000):
        text = "  ".join(rng.choice(["Ab", "c", "é", "dd,"]) for _ in range(n))
        assert sb.fingerprint(text.encode()) == brute_fp(text)


def test_bk_tree_finds_what_a_scan_finds():
    rng = random.Random(2)
    values = [rng.getrandbits(16) for _ in range(300)]
    tree = sb.BKTree()
    for v in values:
        tree.add(v)
    for d, c in enumerate(tree.children):
        assert all((tree.values[d] ^ tree.values[k]).bit_count() == e for e, k in c.items())
    for v in values[:60]:
        assert sorted(tree.search(v, 2)) == sorted(x for x in values if (x ^ v).bit_count() <= 2)


def test_links_connect_what_a_scan_connects(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base) | {0}
    for b in base:
        for _ in range(rng.randint(0, 25)):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            values.add(x)
    hot = base[0]
    values |= {hot ^ (1 << i) for i in range(64)}
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long").repartition(4)
    for radius, size in ((2, 4096), (2, 5), (1, 7)):
        edges = sb.links(fps, radius, size)
        roots = {r.node: r.root for r in connected_components(edges).collect()}
        want = brute_groups(values, radius)
        groups = {}
        for v in values:
            groups.setdefault(want[v], set()).add(roots.get(signed(v), signed(v)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_chain_a_star_and_ties(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}


def test_documents(make):
    text = " ".join(f"w{i}" for i in range(400))
    docs = [(10, text), (4, text), (7, text.upper()), (3, "something else entirely here"), (20, None), (21, ""), (22, " \n"),
            (3, "something else entirely here"), (30, text.replace("w7 ", "v7 ")), (None, text)]
    frame = make(docs, more="fp long, component_id long, fingerprint string, root int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in sb.near_duplicates(frame).collect()), key=repr)
    fps = {brute_fp(t) for _, t in docs}
    group = brute_groups(fps, 2)
    least = {}
    for d, t in docs:
        if d is not None:
            g = group[brute_fp(t)]
            least[g] = min(d, least.get(g, d))
    assert got == sorted(((d, f"{brute_fp(t):016x}", least[group[brute_fp(t)]]) for d, t in docs), key=repr)
    kept = sb.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_empty_and_only_null_ids(make):
    assert sb.near_duplicates(make(["a"]).limit(0)).count() == 0
    kept = sb.keep_first(make([(None, "a b c d"), (None, "a b c d")]))
    assert kept.count() == 1


def test_keep_first_decides_by_row_not_by_id(make):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    docs = make([(None, a), (None, b), (None, b), (3, c), (5, c), (5, d), (None, d), (7, e), (7, a)],
                more="row long, _row_number int, root int, first int")
    kept = sb.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(7, a), (None, b), (3, c), (5, d), (7, e)], key=repr)


def test_no_group_grows_with_its_shard(spark):
    rng = random.Random(7)
    values = {rng.getrandbits(40) << 24 for _ in range(1200)}  # all in one shard of the lowest band
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    groups = sb.placed(fps, 2, 10).groupBy("band", "part", "tree", "chunk", "member").count()
    assert groups.filter("band = 0").agg({"tree": "max"}).first()[0] > 100
    assert max(r["count"] for r in groups.collect()) < 2 * sb.VISITING_TREES * 10
    near = sorted(values)[:100]
    near = {v ^ (1 << b) for v, b in zip(near, range(24, 64))} | values
    fps = spark.createDataFrame([(signed(v),) for v in near], "fp long")
    roots = {r.node: r.root for r in connected_components(sb.links(fps, 2, 10)).collect()}
    want = brute_groups(near, 2)
    pairs = {(want[v], roots.get(signed(v), signed(v))) for v in near}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) < len(near)
