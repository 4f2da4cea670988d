"""The radius search gives the fingerprints it finds."""

from __future__ import annotations

import random

from martlet.llm import simhash


def test_links_of_near_copies(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(4):
        base = [f"w{rng.randrange(3000)}" for _ in range(120)]
        for k in range(6):  # from the base itself to five words changed
            texts.append(" ".join(f"edit{k}x{i}" if i % 20 < 1 and i < 20 * k else w for i, w in enumerate(base)))
    texts.append(texts[0])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = simhash.compare_and_link(docs, 2).collect()
    distance = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    linked = set()
    for r in rows:
        if r.doc_id % 2:
            assert r.within_radius is None and r.n_within_radius is None
            continue
        near = {(distance(r.fingerprint, x.fingerprint), x.fingerprint) for x in rows}
        near = sorted(x for x in near if x[0] <= simhash.RADIUS)
        assert r.within_radius == ",".join(f"{f}:{d}" for d, f in near)
        assert r.n_within_radius == sum(x.fingerprint in {f for _, f in near} for x in rows)
        linked |= {d for d, _ in near}
    assert max(linked) > 3
    assert simhash.compare_edits(docs).columns[-1] == "n_within_radius"


def test_shares_of_the_radius_lose_no_pair():
    masks = simhash.block_masks()
    assert sum(share + 1 for _, share in masks) == simhash.RADIUS + 1
    assert sum(m for m, _ in masks) == 2**64 - 1
