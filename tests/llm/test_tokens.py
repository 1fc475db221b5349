import collections

import numpy as np
import odd
import pytest
from finmarts.llm import packing, token_files as tf
from finmarts.llm.encoding import Encoder, tokenizer_path
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
TRICKY = [
    "", " ", "\n", "a\nb", "a \nb", " a", "a ", "a  b", "\ta b\r\n", "it's  's don't I'LL", "a b", "x\x00y z", "a\x1cb c",
    "<|endoftext|> a <|endoftext|>b", "é ́x", "ΣΣ ς", "9 99 9a", "　x y", "zero​width a b",
]


def ids(path, texts):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 2], "<u4") for e in found]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_parts_are_encoded_like_the_whole(path):
    encoder = Encoder(path)
    texts = [t or "" for _, t in odd.TEXTS] + TRICKY
    for _ in range(2):  # the second time from memory
        assert [np.append(np.frombuffer(b, "<u4"), 2).tolist() for b in encoder.encode(texts)] == [i.tolist() for i in ids(path, texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sX9. \n\té́ "), max_size=20), min_size=1, max_size=4))
def test_any_text(texts):
    for path in (BYTES, WORDS):
        encoder = Encoder(path) if path not in CACHE else CACHE[path]
        CACHE[path] = encoder
        assert encoder.encode(texts) == encoder._whole(texts)


CACHE: dict = {}


@given(st.lists(st.integers(0, 2**20 - 1), max_size=50), st.integers(1, 32))
def test_packing_of_bits_round_trips(values, bits):
    wanted = np.array([v % (1 << bits) for v in values], "<u4")
    data = tf.pack(wanted, bits)
    assert len(data) == (len(values) * bits + 7) // 8
    assert tf.unpack(data, len(values), bits).tolist() == wanted.tolist()


def test_bits_for_a_vocabulary():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_shard_reads_any_range(tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tf, "BLOCK", 7)
    docs = [(5, np.arange(20, dtype="<u4")), (None, np.empty(0, "<u4")), (9, np.arange(500, 503, dtype="<u4"))]
    path = str(tmp_path / "x.ids")
    writer = tf.ShardWriter(pa.OSFile(path, "wb"), 10)
    for doc_id, part in docs:
        writer.add(doc_id, part)
    assert writer.close() == {"docs": 3, "ids": 23, "blocks": 4, "bits": 10}
    shard = tf.Shard(pa.OSFile(path, "rb"))
    whole = np.concatenate([p for _, p in docs])
    for a in range(24):
        for b in range(a, 24):
            assert shard.ids(a, b).tolist() == whole[a:b].tolist()
    for at_once in (1, 5, 100):
        assert [(d, s, p.tolist()) for d, s, p in shard.documents(at_once)] == [(5, 0, [*range(20)]), (None, 20, []), (9, 20, [500, 501, 502])]
    with pytest.raises(ValueError):
        tf.Shard(pa.BufferReader(b"0" * 40))


def test_token_files_of_odd_documents(spark):
    manifest = tf.write_token_files(odd.documents(spark), BYTES, 2)
    found = sorted(tf.read_token_files(manifest).collect(), key=lambda r: r.start)
    expected = collections.Counter((i, e.tobytes()) for (i, t), e in zip(odd.TEXTS, ids(BYTES, [t for _, t in odd.TEXTS])))
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in found) == expected
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    known = [r.doc_id for r in found if r.doc_id is not None]
    assert known == sorted(known)
    whole = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in found])
    assert tf.token_range(manifest, 100, 4000).tolist() == whole[100:4000].tolist()


def test_token_files_of_nothing(spark):
    assert tf.read_token_files(tf.write_token_files(odd.documents(spark, []), BYTES, 2)).count() == 0


def check_pieces(pieces, texts, capacity):
    expected = collections.Counter((i, e.tobytes()) for (i, _), e in zip(texts, ids(WORDS, [t for _, t in texts])))
    sequences = collections.defaultdict(list)
    cut = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length, p.sequence_tokens))
        cut[p.doc_id, p.doc_tokens].append(p)
        assert p.length > 0 and p.length * 4 == len(p.ids)
    for parts in sequences.values():
        at = 0
        for offset, length, whole in sorted(parts):
            assert offset == at
            at += length
        assert at == whole and at <= capacity and (at == capacity or at & (at - 1) == 0)
    single = {k: v for k, v in cut.items() if sum(p.length for p in v) == k[1]}
    for (doc_id, _), parts in single.items():
        data = b"".join(bytes(p.ids) for p in sorted(parts, key=lambda p: p.start))
        assert expected[doc_id, data] >= 1
    assert sum(p.length for p in pieces) == sum(len(d) // 4 * n for (_, d), n in expected.items())


@pytest.mark.parametrize("capacity, group", [(4096, 128), (64, 4), (1, 3)])
def test_packing_of_odd_documents(spark, capacity, group):
    pieces = packing.pack_documents(odd.documents(spark), WORDS, 2, capacity, group).collect()
    check_pieces(pieces, odd.TEXTS, capacity)


def test_packing_of_nothing(spark):
    assert packing.pack_documents(odd.documents(spark, []), WORDS, 2).count() == 0


def test_costs_are_balanced():
    lengths = [1000, 900, 800, 700, 300, 200, 100, 96]
    pieces = packing.pack_lengths(lengths, [2048, 2048])
    spent = [sum(packing.cost(n) for _, _, n, s, _ in pieces if s == seq) for seq in (0, 1)]
    assert abs(spent[0] - spent[1]) < 0.1 * max(spent)
    assert {(d, s) for d, s, *_ in pieces if d == 0} == {(0, 0)}
