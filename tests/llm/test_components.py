"""Connected components, held to a plain version."""

from __future__ import annotations

import random

import numpy as np
import pytest

from labelloom.llm.components import components, forest


def plain(links):
    least = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def cases():
    rnd = random.Random(3)
    path = list(range(0, 900, 3))
    rnd.shuffle(path)
    return {
        "path": list(zip(path, path[1:], strict=False)),
        "star": [(7, k) for k in range(200)] + [(k, 7) for k in range(50)],
        "loops": [(1, 1), (2, 2), (2, 3), (3, 2)],
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)],
        "far": [(1 << 62, -5), (-5, 9), (12, 1 << 62), (40, 41)],
    }


@pytest.mark.parametrize("kind", cases())
def test_forest(kind):
    links = [(a, b) for a, b in cases()[kind] if a != b]
    u, v = forest(*np.array(links, dtype=np.int64).T)
    least = plain(links)
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {x: r for x, r in least.items() if x != r}


@pytest.mark.parametrize("kind", cases())
@pytest.mark.parametrize("block", [2, 1 << 20])
def test_components(spark, kind, block):
    """Also where no task has more than a few edges to contract."""
    links = cases()[kind]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(5), block).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == plain(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
