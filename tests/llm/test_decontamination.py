"""Decontamination where an item repeats itself, stands twice, or is made of numbers."""

from __future__ import annotations

from test_native import BROKEN, CHANGED, ITEM

from probity.llm import decontamination

FILLER = "some words that no benchmark holds, quite a few of them. "


def kinds(spark, documents, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.contaminated(documents(list(enumerate(texts)), clash=True), bench).collect()
    return sorted((r.doc_id, r.item_id, r.kind) for r in got)


def test_each_occurrence_is_judged_by_itself(spark, documents):
    twice = "Tom has 5 apples in the bag and Ann has 7 apples in the bag"
    other = CHANGED.replace("Maria", "Carla").replace("45", "31")
    texts = [
        FILLER + twice + " " + FILLER,
        FILLER + ITEM + " " + FILLER + CHANGED,
        CHANGED + " " + FILLER + other,
        BROKEN + " " + FILLER + CHANGED,
        BROKEN + " " + FILLER + BROKEN,
        FILLER + ITEM.replace("7 pears", "7 quite ripe pears") + " " + CHANGED,
    ]
    assert kinds(spark, documents, texts, [twice, ITEM]) == [
        (0, 0, "exact"),
        (1, 1, "exact"),
        (2, 1, "changed"),
        (3, 1, "changed"),
        (5, 1, "exact"),
    ]


def test_exact_copies_of_slots_short_items_and_other_case(spark, documents):
    items = ["What is 12 + 7 * 3 - 5?", "x = 3", "2 4 8 16 32 64", ITEM, "On 3 May 1999 Anna paid 12.50 dollars", "", None, "42"]
    texts = [
        f"{FILLER}What is 12 + 7 * 3 - 5? {FILLER}",
        f"{FILLER}What is 13 + 8 * 4 - 6? {FILLER}",
        "so X = 3 it is",
        "x = 3",
        "x = 4 or y = 3",
        f"{FILLER}2, 4, 8, 16, 32, 64 {FILLER}",
        f"{FILLER}2, 4, 8, 16, 33, 65 {FILLER}",
        ITEM.title(),
        ITEM.upper() + " " + FILLER,
        "paid: on 3 may 1999 anna paid 12.50 dollars",
        "42.",
        "420 142",
    ]
    assert kinds(spark, documents, texts, items) == [
        (0, 0, "exact"),
        (2, 1, "exact"),
        (3, 1, "exact"),
        (5, 2, "exact"),
        (7, 3, "exact"),
        (8, 3, "exact"),
        (9, 4, "exact"),
        (10, 7, "exact"),
    ]
