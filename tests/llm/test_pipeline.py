"""The pipeline's stages against planted cases and brute force on small tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalith.llm import pii, simhash, toxicity

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = (text or "").encode().translate(simhash.LOWER_ASCII).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Outputs of all stages over sf0.01 with planted documents."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.where("n_chars BETWEEN 1500 AND 3000").orderBy("doc_id").limit(40).collect()
    rng = random.Random(4)
    planted = []
    for k, r in enumerate(base):
        words = r.text.split(" ")
        planted.append((100_000 + k, r.text))
        words[rng.randrange(len(words))] = "changed"
        planted.append((200_000 + k, " ".join(words)))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(20).collect()
    fresh = lambda: " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(7)) for _ in range(80))
    planted += [(300_000 + k, f"{fresh()} {r.text} {fresh()}") for k, r in enumerate(items)]
    planted += [(400_000 + k, f"{fresh()} you idiot. What a stupid clown you are. {fresh()} idiot") for k in range(10)]
    planted += [(500_000, None), (500_001, ""), (500_002, f"{fresh()} a.b@mail.example.com {fresh()} 10.1.2.3"), (None, fresh()), (None, None)]
    more = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select(*more.columns).union(more).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], str(folder)).write.parquet(f"{folder}/{name}.parquet")
        out.append(spark.read.parquet(f"{folder}/{name}.parquet"))
    return out, base, items, str(folder)


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_all_but_the_last_return_documents(stages):
    out = stages[0]
    assert all(df.schema == out[0].schema for df in out[1:-1])


def test_toxic_documents_go(spark, stages):
    out, _, _, folder = stages
    gone = ids(out[0]) - ids(out[1])
    assert sum(400_000 <= i < 400_010 for i in gone) >= 9
    model = toxicity.train_on(out[0], spark.read.parquet(f"{folder}/labels.parquet"))
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(out[0], model).collect()}
    assert gone == {i for i, s in scored.items() if s >= toxicity.THRESHOLD and i is not None}


def test_one_of_each_group_stays(stages):
    out, base, _, _ = stages
    before, after = {r.doc_id: r.text for r in out[1].collect()}, {r.doc_id: r.text for r in out[2].collect()}
    for k, r in enumerate(base):
        group = [i for i in (r.doc_id, 100_000 + k, 200_000 + k) if i in before]
        assert not group or sum(i in after for i in group) <= 1
    assert len({t for i, t in after.items() if i is not None}) == len([i for i in after if i is not None])
    # whoever went has a near copy among the others, by exact comparison
    texts = {i: shingles(t) for i, t in before.items() if i is not None}
    for i in set(texts) - set(after):
        assert any(len(texts[i] & s) / len(texts[i] | s) >= 0.8 for j, s in texts.items() if j != i), i
    assert out[2].where("doc_id IS NULL").count() == out[1].where("doc_id IS NULL").count()


def test_leaks_go_and_others_stay(stages):
    out = stages[0]
    gone = ids(out[2]) - ids(out[3])
    assert {i for i in ids(out[2]) if i and 300_000 <= i < 300_020} <= gone
    assert not {500_002, 500_001, 500_000} & gone


def test_personal_data_is_replaced(stages):
    out = stages[0]
    before, after = {r.doc_id: r for r in out[3].collect()}, {r.doc_id: r for r in out[4].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not pii.pattern_spans((r.text or "").encode()) or "<" in r.text
        if not pii.pattern_spans((before[i].text or "").encode()):
            assert r.text == before[i].text or "<" in r.text
        if r.text != before[i].text:
            assert r.n_chars == len(r.text)
    if 500_002 in after:
        assert "<EMAIL>" in after[500_002].text and "<IP>" in after[500_002].text


def test_packing_places_all(stages):
    out = stages[0]
    assert ids(out[5]) == ids(out[4])
    assert out[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).where("n <> m OR n > 2048").count() == 0


def test_run_gives_the_stages_rows(spark, stages):
    out, _, _, folder = stages
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(str, out[5].select("doc_id", "start", "ids_crc32").collect()))


def test_empty_documents(spark, stages):
    docs, folder = stages[0][0].where("doc_id = -1"), stages[3]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
