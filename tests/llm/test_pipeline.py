"""The pipeline, stage by stage and as a whole, against plain Python."""

import os
import sys

import pytest
import sentencepiece

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline as CP
import test_decontaminate
import test_ngram_join
import test_quality_rules
from ledgerlens.llm import quality_rules, sentencepiece_codec
from test_line_spread import BLANK

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out, folder = [], tmp_path_factory.mktemp("stages")
    for k, (name, f) in enumerate(CP.STAGES):
        result = f(spark, docs, D)
        path = str(folder / str(k))
        result.write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def texts(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert len({k for k, _ in rows}) == len(rows)
    return dict(rows)


def test_columns_and_order(stages, spark):
    assert [n for n, _ in CP.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding"]
    for before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] and before.dtypes == after.dtypes


def test_quality_stage(stages, spark):
    before, after = map(texts, stages[0])
    verdicts, cutoffs = quality_rules.quality_verdicts(stages[0][0], spark.read.parquet(f"{D}/labels.parquet"))
    rejected = {r.doc_id for r in verdicts.where("NOT base_failed AND NOT kept").collect()}
    assert set(after) == {k for k, t in before.items() if not test_quality_rules.brute(t)[5]} - rejected
    assert all(after[k] == before[k] for k in after)
    assert not rejected or cutoffs.count()


def test_line_stage(stages):
    before, after = stages[1]
    rows = [(r.doc_id, r.source, r.text) for r in before.collect()]
    sites, first = {}, {}
    for k, site, text in rows:
        for line in text.split("\n"):
            if not BLANK.fullmatch(line):
                sites.setdefault(line, set()).add(site)
                first[line] = min(first.get(line, k), k)
    want = {}
    for k, _, text in rows:
        stay = [x for x in text.split("\n") if BLANK.fullmatch(x) or len(sites[x]) < 10 or first[x] == k]
        if any(not BLANK.fullmatch(x) for x in stay):
            want[k] = "\n".join(stay)
    assert texts(after) == want
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.text != dict((k, t) for k, _, t in rows)[r.doc_id])


def test_near_copy_stage(stages):
    before, after = map(texts, stages[2])
    assert after == {k: before[k] for k, n, comp, _ in test_ngram_join.brute(list(before.items())) if k == comp}
    assert len(after) < len(before)


def test_decontamination_stage(stages, spark):
    before, after = map(texts, stages[3])
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    hit = {d for d, *_ in test_decontaminate.brute(list(before.items()), items)}
    assert hit and after == {k: t for k, t in before.items() if k not in hit}


def test_encoding_stage_and_whole_run(stages, spark):
    before, after = texts(stages[4][0]), {r.doc_id: r for r in stages[4][1].collect()}
    own = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    assert set(after) == set(before)
    assert all(r.token_ids == own.encode(before[k]) and r.round_trip and r.parity for k, r in after.items())
    whole = {r.doc_id: r.token_ids for r in CP.run(spark, D).collect()}
    assert whole == {k: r.token_ids for k, r in after.items()}


def test_nulls_repeats_and_clashing_columns_go_through(spark, tmp_path):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (None, text + " thirteen fourteen"), (2, None), (3, ""), (4, text.replace("one", "other") + " " + " ".join("w%d" % i for i in range(40)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept_id int, kept int")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, (_, f) in enumerate(CP.STAGES):
        out = f(spark, docs, str(tmp_path))
        if k < 4:
            assert out.dtypes == docs.dtypes and out.where("kept <> 2").count() == 0
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert sorted((r.doc_id for r in out.collect()), key=str) == [4, None]  # 1 and the null id are near copies


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{D}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert CP.run(spark, str(tmp_path)).count() == 0


def test_near_copy_stage_leaves_no_shuffle_files(spark):
    """What its jobs deal goes with them, also where rows are there twice; the same documents stay."""
    import time

    rows = test_ngram_join.near_rows(500, 300, 7)
    docs = spark.createDataFrame([*rows, *rows[:3]], "doc_id long, text string").repartition(4).checkpoint()
    before = test_ngram_join.shuffle_bytes(spark)
    out = CP.near_copies(spark, docs, D)
    for _ in range(40):  # files go in the background
        left = sum(n for name, n in test_ngram_join.shuffle_bytes(spark).items() if name not in before)
        if left < 60_000:
            break
        time.sleep(0.5)
    assert left < 60_000, left
    assert sorted(r.doc_id for r in out.collect()) == sorted({k for _, _, k, _ in test_ngram_join.brute(rows)})
