"""Rows that share a doc_id: their texts are signed, linked and dropped each by itself."""

from conftest import rows

from tillwise.llm import bag_minhash


def text(name, changed=None):
    return " ".join("changed" if i == changed else f"{name}{i}" for i in range(120))


def test_unlike_texts_of_one_id_keep_their_links_and_rows(spark):
    made = [
        (1, text("a"), "x"), (1, text("b"), "y"), (2, text("a", 40), "z"), (3, text("b", 70), "z"), (4, text("c"), "z"),
        (4, text("c"), "w"), (5, "", "e"), (5, "", "f"), (5, text("d"), "g"), (6, text("d"), "h"), (None, text("a"), "n"),
    ]
    docs = spark.createDataFrame(made, "doc_id long, text string, _key string")
    assert rows(bag_minhash.near_classes(docs)) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 5), (5, 5), (5, 5), (6, 5), (None, None)], key=repr
    )
    stays = bag_minhash.drop_near_duplicates(docs)
    assert stays.schema == docs.schema
    got = sorted((r.doc_id, r.text) for r in stays.where("doc_id IS NOT NULL").collect())
    assert got == sorted([(1, text("a")), (1, text("b")), (4, text("c")), (5, ""), (5, text("d"))])
    assert stays.where("doc_id IS NULL").count() == 1
