import os
import collections

import corpus_pipeline
import odd
import pytest
from finmarts.llm import mixing, quality, superkmers
from finmarts.llm.common import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_are_the_dealt_ones_and_keep_the_columns(spark):
    assert list(STAGES) == ["quality_rules", "near_dedup", "substring_dedup", "mix_sources", "pack"]
    docs = table(spark, SF, "documents")
    for name, stage in list(STAGES.items())[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_quality_keeps_clean_documents_and_takes_frequent_lines_out(spark):
    def text(n):
        return "\n".join([f"Click 7 to accept {n % 10} things", " ".join(f"w{chr(97 + n)}x{i}" for i in range(80))])

    rows = [(n, text(n), "en", "host", 1, *odd.rows()[0][5:]) for n in range(30)]
    rows += [(100, "short text", "en", "host", 1, *odd.rows()[0][5:])]
    out = {r.doc_id: r for r in STAGES["quality_rules"](spark, odd.documents(spark, rows), SF).collect()}
    assert set(out) == set(range(30))
    assert all(r.text == text(n).split("\n")[1] and r.n_chars == len(r.text) for n, r in out.items())


def test_copies_of_a_clean_document_are_no_boilerplate(spark):
    story = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(5))
    rows = [(n, story, "en", "host", 1, *odd.rows()[0][5:]) for n in range(40)]
    assert quality.quality(odd.documents(spark, rows)).where("kept").count() == 40


def test_depleted_documents_go(spark):
    lines = [" ".join(f"common{i}w{j}" for j in range(30)) for i in range(2)]
    rows = [(n, "\n".join([*lines, f"own {n} words"]), "en", None, 1, *odd.rows()[0][5:]) for n in range(20)]
    verdicts = quality.quality(odd.documents(spark, rows)).collect()
    assert all(not r.kept and not r.base_failed and r.n_removed_words == 60 for r in verdicts)


def test_substring_stage(spark):
    docs = odd.documents(spark)
    out = STAGES["substring_dedup"](spark, docs, SF)
    by_id = collections.defaultdict(list)
    for r in out.collect():
        by_id[r.doc_id].append(r)
    assert by_id[10][0].text == "start end" and by_id[11][0].text == "other beginning"
    assert [r.text for r in by_id[1]] == ["", ""] and by_id[3][0].text is None
    assert by_id[12][0].text == "" and by_id[14][0].text == odd.TEXTS[16][1]
    assert superkmers.removed_from(odd.documents(spark, [])).count() == 0


@pytest.mark.parametrize("shard_words", [1 << 20, 500])
def test_mix_takes_whole_quotas(spark, shard_words):
    placed = mixing.positions(table(spark, SF, "documents")).drop("text").cache()
    mixed = mixing.mix(placed, block_words=256, shard_words=shard_words).collect()
    words, shards = collections.Counter(), collections.defaultdict(set)
    for r in mixed:
        words[r.source_key] += r.length
        shards[r.source_key, r.epoch, r.block].add(r.shard)
    for r in placed.select("source_key", "target").distinct().collect():
        assert words[r.source_key] == int(r.target)
    assert all(len(s) == 1 for s in shards.values())
    per_shard = collections.Counter(next(iter(s)) for s in shards.values())
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    assert len(per_shard) > 1 or shard_words > 500
    for shard in per_shard:
        assert sorted(r.position for r in mixed if r.shard == shard) == list(range(sum(r.shard == shard for r in mixed)))


def test_targets_never_exceed_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 30, "d": 5, "": 700}
    sources = spark.createDataFrame([(k, k == "", v) for k, v in sizes.items()], "source_key string, source_null boolean, source_size long")
    found = {r.source_key: r.target for r in mixing.source_targets(sources).collect()}
    weights = dict(zip(["a", "b", "c", "d", ""], [3, 1, 2, 3, 1]))
    left, open_, expected = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:  # share, cap, share the excess again
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        above = {k for k in open_ if share[k] > 2 * sizes[k]}
        expected |= {k: min(share[k], 2 * sizes[k]) for k in open_}
        if not above:
            break
        left -= sum(2 * sizes[k] for k in above)
        open_ -= above
    assert {k: round(v, 6) for k, v in found.items()} == {k: round(v, 6) for k, v in expected.items()}


def test_mixed_documents_of_odd_rows(spark):
    docs = odd.documents(spark)
    out = STAGES["mix_sources"](spark, docs, SF).collect()
    taken = sum(len(odd.words(r.text)) for r in out)
    assert abs(taken - 1.5 * sum(len(odd.words(t)) for _, t in odd.TEXTS)) < 5
    assert all(r.size == "s" and r.row == "r" and r.target == "t" for r in out)
    assert STAGES["mix_sources"](spark, odd.documents(spark, []), SF).count() == 0


def test_whole_pipeline_on_odd_and_empty_documents(spark, tmp_path):
    for name, some in (("odd", odd.rows()), ("empty", [])):
        folder = tmp_path / name
        odd.documents(spark, some).write.parquet(str(folder / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() >= 0
