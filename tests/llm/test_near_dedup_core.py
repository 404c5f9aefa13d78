"""Near copies around a common core, most of them too far from it and from each other to be linked."""

import random

import numpy as np

from lodestep.llm import near_dedup


def around_a_core(n):
    """The core under id 0 and ``n`` texts with 4 to 14 of its 150 words replaced, some of them copied with another word replaced."""
    draw = random.Random(5)
    core = [f"core{i}" for i in range(150)]
    rows = [(0, " ".join(core))]
    for i in range(1, n):
        words = list(core) if i % 3 else rows[draw.randrange(len(rows))][1].split()
        for place in draw.sample(range(150), draw.randrange(4, 15) if i % 3 else 1):
            words[place] = f"other{i}x{place}"
        rows.append((i, " ".join(words)))
    return rows


def test_texts_around_a_core(spark, docs_of, monkeypatch):
    rows = around_a_core(300)
    sets = [set(near_dedup.shingle_hashes(text).tolist()) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            shared = len(one & sets[j])
            if 100 * shared >= 75 * (len(one) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a

    branched, stored = [], near_dedup.stored

    def watched(table, label="table", *more):
        kept = stored(table, label, *more)
        if label == "branches":
            branched.append(kept.count())
        return kept

    monkeypatch.setattr(near_dedup, "stored", watched)
    got = near_dedup.near_duplicates(docs_of([(i, text, None, None) for i, text in rows])).collect()
    assert {row["doc_id"]: row["component_id"] for row in got} == {i: find(i) for i in range(len(rows))}
    assert sum(branched) <= 20 * len(rows)


def test_prefixes_lose_no_pair():
    draw = random.Random(9)
    texts = [set(draw.sample(range(60), draw.randrange(1, 50))) for _ in range(150)]
    texts += [one ^ set(draw.sample(range(60), draw.randrange(0, 8))) for one in texts]
    texts = [one for one in texts if one]
    held = np.bincount([token for one in texts for token in one], minlength=60)
    n = [[len(one) for one in texts if token in one] or [0] for token in range(60)]
    nodes = []
    for one in texts:
        tokens = np.array(sorted((t for t in one if held[t] > 1), key=lambda t: (held[t], t)), np.int64)
        low, high = (np.array([f(n[t]) for t in tokens], np.int64) for f in (min, max))
        nodes.append({(min(own, other), max(own, other), t) for own, other, chosen in near_dedup.prefixes(len(one), tokens, low, high, 75)
                      for t in chosen.tolist()})
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(texts[i] & texts[j]) >= 75 * len(texts[i] | texts[j])]
    assert len(pairs) > 50
    assert all(nodes[i] & nodes[j] for i, j in pairs)
