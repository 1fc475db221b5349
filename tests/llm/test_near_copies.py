import collections
import itertools
import random

import numpy as np
import odd
from finmarts.llm import near_copies, quality, simhash


def brute_similarity(a, b, width=5):
    x, y = ({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def variants():
    """Random texts of 60 to 300 words with copies of which 1 to 12 words are changed."""
    rng = random.Random(5)
    texts = []
    for n in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(words))
        for _ in range(2):
            other = list(words)
            for i in rng.sample(range(len(words)), rng.randint(1, 12)):
                other[i] = f"new{rng.randrange(5000)}"
            texts.append(" ".join(other))
    return texts


def brute_groups(texts):
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    bands = collections.Counter()
    for base in range(0, len(texts), 3):  # texts of different triples share next to nothing
        for i, j in itertools.combinations(range(base, base + 3), 2):
            s = brute_similarity(texts[i], texts[j])
            bands[min(int(s * 20), 19)] += 1
            if s >= 0.8:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))], bands


def test_groups_match_brute_force_at_every_similarity(spark):
    texts = variants()
    expected, bands = brute_groups(texts)
    assert min(bands[k] for k in (15, 16, 17, 18)) >= 10
    rows = [(i, t, "en", "host", len(t), *odd.rows()[0][5:]) for i, t in enumerate(texts)]
    docs = odd.documents(spark, rows)
    for hot in (1, 512):
        found = {r.doc_id: r.component_id for r in near_copies.classes(docs, hot=hot).collect()}
        assert [found[i] for i in range(len(texts))] == expected


def test_a_hot_bucket_loses_no_pair(spark):
    """3,000 nodes of one bucket that share no other key: every pair with enough equal bytes comes out."""
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 256, (3000, near_copies.HASHES), np.uint8)
    for i in range(0, 3000, 3):  # the second and third differ from the first in 20 to 60 bytes
        for j in (i + 1, i + 2):
            places = rng.choice(near_copies.HASHES, rng.integers(20, 61), replace=False)
            sketches[j] = sketches[i]
            sketches[j, places] += rng.integers(1, 256, len(places), np.uint8)
    expected = set()
    for i in range(3000):
        equal = (sketches[i + 1 :] == sketches[i]).sum(axis=1)
        expected |= {(i, i + 1 + int(j)) for j in np.flatnonzero(equal >= near_copies.LEAST_EQUAL)}
    assert 500 < len(expected) < 3000
    rows = [(n, 7, s.tobytes()) for n, s in enumerate(sketches)]
    entries = spark.createDataFrame(rows, "node long, key long, sketch binary").cache()
    groups = spark.createDataFrame([], "node long, root long")
    for hot in (100, 5000):
        found = near_copies.across_groups(entries, groups, hot).collect()
        assert {(r.a, r.b) for r in found} == expected


def test_a_large_group_gives_no_row_a_pair(spark):
    """400 nodes near to one another, no two in a group: rows in proportion to the nodes, not to their 80,000 pairs."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, near_copies.HASHES, np.uint8)
    rows = []
    for n in range(400):
        own = base.copy()
        own[rng.choice(near_copies.HASHES, 15, replace=False)] += np.uint8(1)
        rows += [(n, key, own.tobytes()) for key in (7, 8)]
    entries = spark.createDataFrame(rows, "node long, key long, sketch binary").cache()
    groups = spark.createDataFrame([], "node long, root long")
    for hot in (100, 5000):
        found = near_copies.across_groups(entries, groups, hot).collect()
        assert len(found) < near_copies.PARTS * 400 * near_copies.CROWD / 2 and {r.b for r in found if r.crowd} == set(range(400))
    assert len(found) == 800 and {r.a for r in found} == {0}  # the same crowd in both buckets


def test_links_connect_what_all_pairs_do():
    """Crowds whose sets are similar in chains: the groups are those of comparing every pair."""
    rng = np.random.default_rng(6)
    for trial in range(30):
        own = np.arange(100, dtype=np.uint64)
        sets = []
        for n in range(60):
            own = own.copy()
            places = rng.choice(100, rng.integers(4, 16), replace=False)
            own[places] = rng.integers(1000, 1 << 40, len(places))
            sets.append(np.unique(own))
        order = rng.permutation(60)
        sets = [sets[i] for i in order]
        group = np.where(rng.random(60) < 0.3, rng.integers(0, 5, 60), np.arange(60))

        def roots(pairs):
            root = group.copy()
            for i, j in pairs:
                root[root == root[i]] = root[j]
            return {frozenset(np.flatnonzero(root == r).tolist()) for r in set(root.tolist())}

        every = [(i, j) for i, j in itertools.combinations(range(60), 2) if near_copies.similarity(sets[i], sets[j]) >= 0.8]
        found = near_copies.links(sets, group, 0.8)
        assert roots(found) == roots(every) and len(found) < 60
        assert set(map(frozenset, found)) <= set(map(frozenset, every))


def test_crowds_are_settled_by_whole_texts(spark):
    """Copies of two articles with one or two words changed each, in a chain; every pair is compared by brute force."""
    rng = random.Random(8)
    texts = []
    for n in range(2):
        words = [f"a{n}w{i}" for i in range(100)]
        for _ in range(40):
            other = list(words)
            for i in rng.sample(range(0, 100, 12), rng.randint(1, 4)):
                other[i] = f"new{rng.randrange(3)}"
            texts.append(" ".join(other))
    root = list(range(80))
    for i, j in itertools.combinations(range(80), 2):
        if brute_similarity(texts[i], texts[j]) >= 0.8:
            root = [root[i] if r == root[j] else r for r in root]
    least = {r: min(i for i in range(80) if root[i] == r) for r in root}
    assert 2 < len(least) < 70
    # two crowds that share a node, the second in two buckets
    crowds = spark.createDataFrame([(0, i) for i in range(50)] + [(45, i) for i in range(45, 80)] * 2, "a long, b long")
    groups = spark.createDataFrame([], "node long, root long")
    table = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    found = near_copies.settled(crowds, groups, table).collect()
    joined = list(range(80))
    for r in found:
        joined = [joined[r.a] if x == joined[r.b] else x for x in joined]
    assert [min(i for i in range(80) if joined[i] == x) for x in joined] == [least[r] for r in root]
    assert len(found) == 80 - len(least)


def test_near_copies_are_no_boilerplate_for_the_pipeline(spark):
    """30 copies of an article, each with one other line, among 20 documents that share a true boilerplate line."""
    lines = [" ".join(f"story{i}w{j}" for j in range(20)) for i in range(10)]
    rows = [(n, "\n".join([*lines, f"advert{n} number{n}"]), "en", "host", 1, *odd.rows()[0][5:]) for n in range(30)]
    notice = "Click 7 to accept things"
    for n in range(100, 120):
        own = " ".join(f"own{chr(97 + n - 100)}x{i}" for i in range(80))
        rows.append((n, f"{notice}\n{own}", "en", "host", 1, *odd.rows()[0][5:]))
    docs = odd.documents(spark, rows)
    out = {r.doc_id: r.text for r in quality.cleaned(docs).collect()}
    assert set(out) == {r[0] for r in rows}
    assert all(out[n].split("\n")[:10] == lines for n in range(30))
    assert not any(notice in text for text in out.values())
    assert quality.quality(docs).where("kept and doc_id < 30").count() == 0  # the query's SQL counts distinct texts
    # the next stage joins by fingerprints: most of the copies go, no other document does
    left = {r.doc_id for r in simhash.one_of_each(quality.cleaned(docs)).collect()}
    assert left >= {0, *range(100, 120)} and len(left) < 30
