import itertools
import random

import numpy as np
import odd
import xxhash
from finmarts.llm import simhash
from hypothesis import given, strategies as st


def brute_fingerprint(text, width=3):
    w = odd.lower_words(text)
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    votes = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(prints, radius):
    """The smallest id that links lead to, by repeated minima."""
    ids = [i for i, _ in prints]
    least = {n: (i if i is not None else simhash.NO_ID) for n, i in enumerate(ids)}
    near = [(a, b) for a, b in itertools.combinations(range(len(ids)), 2) if (prints[a][1] ^ prints[b][1]).bit_count() <= radius]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            m = min(least[a], least[b])
            if m != least[a] or m != least[b]:
                least[a] = least[b] = m
                changed = True
    return [None if v == simhash.NO_ID else v for v in least.values()]


def test_components_match_brute_force(spark):
    docs = odd.documents(spark)
    prints = [(r[0], brute_fingerprint(r[1])) for r in odd.rows()]
    expected = sorted(zip([p[0] for p in prints], [simhash.signed(p[1]) for p in prints], brute_components(prints, 3)), key=repr)
    found = simhash.components(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == expected


def test_links_join_all_pairs_and_no_others(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(60)}
    prints |= {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fingerprint long")
    whole = brute_components(list(zip(range(len(prints)), prints)), 3)
    for hot in (2, 2048):
        edges = [(a % 2**64, b % 2**64) for a, b in simhash.links(frame, 3, hot).collect()]
        place = {p: i for i, p in enumerate(prints)}
        root = list(range(len(prints)))
        for _ in range(len(prints)):
            for a, b in edges:
                m = min(root[place[a]], root[place[b]])
                root[place[a]] = root[place[b]] = m
        assert root == whole


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_some_mask_hides_any_three_positions(value, flips):
    other = value ^ sum(1 << f for f in flips)
    assert any(value & m == other & m for m in simhash.covering_masks(list(range(64)), 3))


FAR = 0xFF << 40


def test_bucket_links_are_connected_within_the_radius():
    members = np.array([0, 1, 3, 7, 15, FAR, FAR | 1], dtype=np.uint64)
    links = simhash.local_links(members, 1)
    assert {frozenset(e) for e in links} == {frozenset((0, x)) for x in (1, 3, 7, 15)} | {frozenset((FAR, FAR | 1))}


def test_one_of_each(spark):
    docs = odd.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 14 in ids and 6 in ids and 7 not in ids
    assert ids.count(3) == 1 and 4 not in ids and 5 not in ids  # texts without words are alike
    assert simhash.one_of_each(odd.documents(spark, [])).count() == 0


def test_one_of_each_against_brute_force(spark):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    texts = []
    for _ in range(60):
        changed = list(base) if rng.random() < 0.7 else [f"v{rng.randint(0, 999)}" for _ in range(100)]
        for _ in range(rng.randint(0, 2)):
            changed[rng.randrange(len(changed))] = "other"
        texts.append(" ".join(changed))
    prints = [simhash.fingerprint(t.encode().split()) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:  # smallest id reachable over links of three bits
        root = [min(root[j] for j in range(len(texts)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert 1 < len(set(root)) < len(texts)
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == set(root)
