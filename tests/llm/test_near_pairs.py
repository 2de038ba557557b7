"""Near-dedup in large groups: few pairs are made, and no link is lost."""
import random

import numpy as np

from lagwise.llm import near


def _edited(rng, base, edits):
    words = list(base)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_parities_never_exceed_the_difference():
    rng = random.Random(3)
    base = [f"t{rng.randrange(3000)}" for _ in range(400)]
    for edits in (0, 1, 5, 20, 80, 300):
        a, b = near.shingles(" ".join(base)), near.shingles(_edited(rng, base, edits))
        differ = len(np.setxor1d(a, b))
        apart = sum(int(x).bit_count() for x in (near.parity(a) ^ near.parity(b)).view(np.uint64))
        assert apart <= differ
        assert apart >= 0.4 * differ


def test_pairs_of_a_large_group_stay_few(spark, monkeypatch):
    """2,000 copies, each with few enough edits to be linked to the base and mostly not to each other."""
    rng = random.Random(5)
    base = [f"t{rng.randrange(3000)}" for _ in range(220)]
    n = 2000
    texts = [(0, " ".join(base))] + [(k, _edited(rng, base, rng.randrange(3, 12))) for k in range(1, n)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    made = []
    candidates = near._candidates

    def counted(pairs, classes):
        made.append(pairs.count())
        return candidates(pairs, classes)

    monkeypatch.setattr(near, "_candidates", counted)
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df).collect()}
    assert made[0] <= 40 * n and made[1] <= n
    sets = [near.shingles(t) for _, t in texts]
    # Components of all links, by a matrix of intersection sizes.
    grams = {g: i for i, g in enumerate(np.unique(np.concatenate(sets)))}
    has = np.zeros((n, len(grams)), dtype=np.float32)
    for k, s in enumerate(sets):
        has[k, [grams[g] for g in s]] = 1
    both, size = has @ has.T, has.sum(axis=1)
    linked = 100 * both >= near.SIMILARITY * (size[:, None] + size[None, :] - both)
    label = np.arange(n)
    while True:
        low = np.where(linked, label[None, :], n).min(axis=1)
        if (low == label).all():
            break
        label = low
    assert got == dict(enumerate(label.tolist()))
