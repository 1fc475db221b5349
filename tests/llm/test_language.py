import os
import collections
import math
import zlib

import numpy as np
import odd
from finmarts.llm import suffix_tree as st
from finmarts.llm.common import table


def held(doc_id, modulus=7, remainder=2):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % modulus == remainder


def base(rows):
    texts = [[*odd.lower_words(t), "\0end"] for _, t in rows]
    counts = collections.Counter(w for (i, _), t in zip(rows, texts) if not held(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        ((i, held(i), len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
         for (i, _), t in zip(rows, texts)), key=repr,
    )


def found(docs):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in docs), key=repr)


def test_base_of_odd_documents(spark):
    scores = st.language_scores(odd.documents(spark)).collect()
    assert found(scores) == base(odd.TEXTS)
    assert all(-1e6 < r.score < 0 for r in scores)


def test_nothing_and_only_held_out(spark):
    assert st.language_scores(odd.documents(spark, [])).count() == 0
    out = next(i for i in range(100) if held(i))
    row = next(r for r in odd.rows() if r[0] == 14)
    only = st.language_scores(odd.documents(spark, [(out, *row[1:])])).collect()
    assert found(only) == base([(out, row[1])])


def test_model_beats_the_base_on_training_texts_and_follows_repeats(spark):
    docs = table(spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "documents")
    scores = st.language_scores(docs).collect()
    trained = [r for r in scores if not r.held_out]
    assert sum(r.score for r in trained) > sum(r.base_score for r in trained)


def brute_grams(texts, depth):
    """Counts of (context, last byte first, and symbol) as bytes."""
    counts = collections.Counter()
    for words in texts:
        data = b"\0" * depth + b" ".join([*words, st.END])
        for i in range(depth, len(data)):
            counts[data[i - depth : i][::-1] + data[i : i + 1]] += 1
    return counts


def as_bytes(gram, depth):
    return int(gram).to_bytes(depth + 1, "big")


def test_symbols_and_counts_match_brute_force(spark):
    texts = [odd.lower_words(t) for _, t in odd.TEXTS]
    encoded = [[w.encode() for w in t] for t in texts]
    keys, sizes = st.symbols(encoded, 3)
    assert collections.Counter(as_bytes(k, 3) for k in keys) == brute_grams(encoded, 3)
    assert sizes.tolist() == [sum(len(w) + 1 for w in t) + 1 for t in encoded]
    docs = odd.documents(spark).selectExpr("cast(0 as long) block", "false held_out", "coalesce(text, '') text")
    rows = st.block_counts(docs.coalesce(1), 3).collect()
    assert {as_bytes(r.gram, 3): r.n for r in rows if r.gram is not None} == brute_grams(encoded, 3)
    assert {r.word: r.n for r in rows if r.gram is None} == collections.Counter(w for t in encoded for w in t)


def brute_tree(counts, depth, divergence):
    """Kept contexts, each with the symbols after it, by the definition."""
    after = collections.defaultdict(collections.Counter)
    for gram, n in counts.items():
        for k in range(depth + 1):
            after[gram[:k]][gram[-1]] += n
    kept = set()
    for context, seen in after.items():
        total = sum(seen.values())
        if total < st.LEAST_COUNT:
            continue
        shorter = after[context[:-1]]
        all_shorter = sum(shorter.values())
        gain = sum(n * math.log(n / total / (shorter[s] / all_shorter)) for s, n in seen.items())
        if len(context) < 2 or gain >= divergence:
            kept |= {context[:k] for k in range(len(context) + 1)}
    return {c: after[c] for c in kept if sum(after[c].values()) >= st.LEAST_COUNT}


def brute_score(tree, words, depth):
    data = b"\0" * depth + b" ".join([*words, st.END])
    score = 0.0
    for i in range(depth, len(data)):
        before, p = data[i - depth : i][::-1], 1 / st.SYMBOLS
        for k in range(depth + 1):
            seen = tree.get(before[:k])
            if seen is not None:
                escape = st.ESCAPE * len(seen)
                p = (seen[data[i]] + escape * p) / (sum(seen.values()) + escape)
        score += math.log10(p)
    return score


def brute_scores(rows, depth, divergence):
    encoded = [(i, [w.encode() for w in odd.lower_words(t)]) for i, t in rows]
    tree = brute_tree(brute_grams([w for i, w in encoded if not held(i)], depth), depth, divergence)
    return tree, sorted(((i, round(brute_score(tree, w, depth), 6)) for i, w in encoded), key=repr)


def scores_of(docs, **settings):
    return sorted(((r.doc_id, round(r.score, 6)) for r in st.language_scores(docs, **settings).collect()), key=repr)


def test_scores_match_brute_force(spark, monkeypatch):
    for depth, divergence in ((2, 1.0), (4, 2.0), (5, 0.5)):
        assert scores_of(odd.documents(spark), depth=depth, divergence=divergence) == brute_scores(odd.TEXTS, depth, divergence)[1]
    docs = table(spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "documents").limit(40).collect()
    rows = [(r.doc_id, r.text) for r in docs]
    given = spark.createDataFrame(docs).repartition(3)
    tree, expected = brute_scores(rows, st.DEPTH, st.DIVERGENCE)
    assert scores_of(given) == expected
    # the levels between the shortest and the longest contexts are pruned, not all kept
    assert {len(c) for c in tree} == set(range(st.DEPTH + 1))
    # many blocks, and groups cut inside a task, give the same scores
    monkeypatch.setattr(st, "BLOCK_BYTES", 5000)
    assert scores_of(given) == expected


def test_groups_of_grams_are_cut_between_pairs_of_bytes(spark):
    texts = [odd.lower_words(t) for _, t in odd.TEXTS]
    grams, n = np.unique(st.symbols([[w.encode() for w in t] for t in texts], 4)[0], return_counts=True)
    pairs = np.zeros((256, 256))
    np.add.at(pairs, (grams >> 32, grams & 255), n)
    whole = dict(zip(grams.tolist(), np.log10(st.probabilities(grams, n, pairs, 4, 2.0)[0])))
    df = spark.createDataFrame([(g, c) for g, c in zip(grams.tolist(), n.tolist())], "gram long, n long")
    # the tasks import the module anew, so that its limit is handed over
    cut = {r.gram: r.log for r in st.gram_scores(df, pairs, 4, 2.0, chunk=10).collect()}
    assert cut.keys() == whole.keys() and all(abs(cut[g] - whole[g]) < 1e-12 for g in whole)


def test_distributions_sum_to_one():
    texts = [[w.encode() for w in odd.lower_words(t)] for _, t in odd.TEXTS]
    grams, n = np.unique(st.symbols(texts, 3)[0], return_counts=True)
    pairs = np.zeros((256, 256))
    np.add.at(pairs, (grams >> 24, grams & 255), n)
    contexts = np.unique(grams >> 8)[:20]
    every = np.unique(np.concatenate([((c << 8) + np.arange(256)) for c in contexts] + [grams]))
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, grams)] = n
    p, kept = st.probabilities(every, counts, pairs, 3, 1.0)
    assert len(kept[1])
    for c in contexts:
        assert abs(p[every >> 8 == c].sum() - 1) < 0.01
