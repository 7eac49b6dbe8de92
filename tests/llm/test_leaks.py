"""Edited copies of test items, however often they are copied."""

from stratalith.llm.decontamination import find_contamination


def found(spark, item, copy, n):
    rows = [(k, f"before {k} it stands {copy} and after it {k}") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    return {r.doc_id: r.score for r in find_contamination(docs, items).collect()}


def test_many_copies_of_an_edited_item(spark):
    item = [f"word{k}" for k in range(15)]
    copy = " ".join("changed" if k in (5, 9, 13) else w for k, w in enumerate(item))
    assert found(spark, item, copy, 30) == dict.fromkeys(range(30), 21 / 30)


def test_each_fourth_word_changed(spark):
    item = [f"word{k}" for k in range(40)]
    copy = " ".join("changed" if k % 4 == 3 else w for k, w in enumerate(item))
    assert set(found(spark, item, copy, 3)) == {0, 1, 2}


def test_texts_of_one_item_id_are_items_of_their_own(spark):
    short, long = [f"a{k}" for k in range(10)], [f"b{k}" for k in range(30)]
    docs = spark.createDataFrame([(1, "x " + " ".join(short) + " y"), (2, " ".join(long)), (3, " ".join(short + long)), (4, "none of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(short)), (1, " ".join(long)), (1, " ".join(long)), (2, "")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.score) for r in find_contamination(docs, items).collect()) == [(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)]
