"""Fork resolution against a walk over parents."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chainlake.operators import forks

SCHEMA = "chain string, number bigint, hash string, parent_hash string, kafka_offset bigint"


def expected(blocks):
    """By hand: the tip of each tree of disputed blocks, then all blocks that don't lead to it."""
    out = []
    for chain in sorted({b[0] for b in blocks}):
        latest = {}
        for _, number, own, parent, offset in sorted((b for b in blocks if b[0] == chain and None not in b[1:3]), key=lambda b: b[4]):
            latest[(own, number)] = (parent, offset)
        heights = {}
        for own, number in latest:
            heights.setdefault(number, set()).add(own)
        several = {n for n, found in heights.items() if len(found) > 1}
        nodes = {k: v for k, v in latest.items() if k[1] in several or k[1] - 1 in several}

        def up(node):
            return (nodes[node][0], node[1] - 1)

        trees = {}
        for node in nodes:
            root = up(node)
            while root in nodes:
                root = up(root)
            trees.setdefault(root, []).append(node)
        for members in trees.values():
            keep = max(members, key=lambda n: (n[1], nodes[n][1], n[0]))
            holding = set()
            while keep in nodes:
                holding.add(keep)
                keep = up(keep)
            branches = {}
            for node in members:
                if node not in holding:
                    first = node
                    while up(first) in nodes and up(first) not in holding:
                        first = up(first)
                    branches.setdefault(first, []).append(node)
            for first, found in branches.items():
                ancestor = up(first)
                found.sort(key=lambda n: (n[1], n[0]))
                out.append((chain, first[0], ancestor[1], ancestor[0], ancestor in latest, max(n for _, n in found) - ancestor[1], len(found), [h for h, _ in found]))
    return sorted(out, key=repr)


def grown(seed, chains=2, length=60):
    """Chains with branches that leave the trunk or one another, some at the head, some blocks
    missing, some delivered twice."""
    rnd = random.Random(seed)
    blocks, offset = [], 0
    for c in range(chains):
        tips = [(0, f"g{c}")]
        blocks.append((f"c{c}", 0, f"g{c}", None, offset))
        for step in range(length):
            number, above = rnd.choice(tips[-3:]) if rnd.random() < 0.3 else max(tips)
            own = f"h{c}-{number + 1}-{step}"
            offset += 1
            tips.append((number + 1, own))
            if rnd.random() > 0.03:
                blocks.append((f"c{c}", number + 1, own, above, offset))
            if rnd.random() < 0.1:
                blocks.append((f"c{c}", number + 1, own, above, offset + 1000))
    return blocks


@pytest.mark.parametrize("seed", range(4))
def test_forks(spark, seed):
    blocks = grown(seed)
    got = forks.forks(spark.createDataFrame(blocks, SCHEMA).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(blocks)


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    """A branch of 50 blocks on a chain of 400 takes seven rounds to resolve, not fifty."""
    rounds = []
    plain = forks.doubled
    monkeypatch.setattr(forks, "doubled", lambda *a: rounds.append(1) or plain(*a))
    trunk = [("c", n, f"t{n}", f"t{n - 1}", n) for n in range(400)]
    branch = [("c", n, f"b{n}", "t199" if n == 200 else f"b{n - 1}", 1000 + n) for n in range(200, 250)]
    got = forks.forks(spark.createDataFrame(trunk + branch, SCHEMA)).collect()
    assert [(r.first_hash, r.ancestor_number, r.ancestor_hash, r.depth, r.orphans) for r in got] == [("b200", 199, "t199", 50, 50)]
    assert got[0].orphaned == [f"b{n}" for n in range(200, 250)]
    assert len(rounds) <= 2 * (math.ceil(math.log2(52)) + 1)


def test_no_forks(spark):
    """Empty tables, rows without height or hash, repeated rows and a single chain have none."""
    rows = [("c", n, f"t{n}", f"t{n - 1}", n) for n in range(5)] * 2 + [("c", None, "x", "y", 7), ("c", 3, None, "t2", 8), (None, 1, "a", None, 9)]
    assert forks.forks(spark.createDataFrame(rows, SCHEMA)).count() == 0
    assert forks.forks(spark.createDataFrame([], SCHEMA)).count() == 0
    tie = [("c", 1, "a", "z", 1), ("c", 1, "b", "z", 2)]
    got = forks.forks(spark.createDataFrame(tie, SCHEMA).withColumn("extra", F.lit(1))).collect()
    assert [(r.first_hash, r.ancestor_known) for r in got] == [("a", False)]


def test_rounds_take_disputed_blocks_and_numbers_only(spark, monkeypatch):
    """Of a chain of 400 blocks with a branch of three, delivered twice, blocks far from the branch are
    neither grouped nor stored, and no round moves a hash."""
    grouped, moved = [], []
    known, plain = forks.known_blocks, forks.doubled
    monkeypatch.setattr(forks, "known_blocks", lambda b: grouped.append(b.count()) or known(b))
    monkeypatch.setattr(forks, "doubled", lambda nodes, *a: moved.append({n for n, t in nodes.dtypes if "string" in t}) or plain(nodes, *a))
    trunk = [("c", n, f"t{n}", f"t{n - 1}", n) for n in range(400)]
    branch = [("c", n, f"b{n}", "t199" if n == 200 else f"b{n - 1}", 1000 + n) for n in range(200, 203)] * 2
    got = forks.forks(spark.createDataFrame(trunk + branch, SCHEMA)).collect()
    assert [(r.first_hash, r.ancestor_number, r.ancestor_hash, r.ancestor_known, r.depth, r.orphaned) for r in got] == [
        ("b200", 199, "t199", True, 3, ["b200", "b201", "b202"])]
    # Heights 199 to 203, three of them with the branch's two deliveries.
    assert grouped == [5 + 6]
    assert moved and all(m == {"chain"} for m in moved)
