import random

from millrace.llm import templates
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes

ITEMS = "item_id long, text string"
ASKED = "Then Sue bought {} {} of fresh green pears and sold {} {} of them to {} before noon today."


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["same_values"] for r in templates.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}


def test_query_finds_every_planted_item_and_nothing_else(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    want = {(d, i) for d, x in docs.items() for i, y in items.items() if y in (x or "")}
    rows = QUERIES["op6_decontamination"](spark, FOLDER).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    assert all(r["same_values"] and templates.COVERED * r["n_windows"] <= r["n_hits"] <= r["n_windows"] for r in rows)


def test_other_numbers_names_and_units_are_met_if_consistent(spark):
    items = [(1, ASKED.format(5, "kg", 3, "lb", "Mary")), (2, ASKED.format(5, "kg", 5, "kg", "Mary"))]
    docs = [
        (10, "Before. " + ASKED.format(17.5, "tons", 4, "oz", "Bob") + " After."),
        (11, ASKED.format(9, "kg", 9, "kg", "Ann")),
        (12, ASKED.format(5, "kg", 3, "lb", "Mary")),
        (13, "Then Sue sold nothing at all to anybody before noon today, or so they say."),
    ]
    # 10 has two different numbers where item 2 has one twice; 11 one where item 1 has two
    assert found(spark, docs, items) == {(10, 1): False, (11, 2): False, (12, 1): True}


def test_short_items_and_items_that_are_too_short(spark):
    items = [(1, "what is the boiling point of lead"), (2, "one two three four"), (3, "5 kg 7 lb 9 oz 3 g 4 m 8 s 1 h")]
    docs = [(10, "Q: What is the boiling point of lead? A: high"), (11, "one two three four five"), (12, "6 kg 7 lb 9 oz 3 g 4 m 8 s 1 h"), (13, "the boiling point of lead")]
    assert set(found(spark, docs, items)) <= {(10, 1)}
    lower = [(10, "q: what is the boiling point of lead? A: high")]
    assert set(found(spark, lower, items)) == {(10, 1)}


SOLD = "{0} has {2} apples. {0} gives {3} to {1}. {1} eats {4} and sells the rest at the market. How many did {1} sell?"


def test_names_that_open_sentences_and_other_case(spark):
    items = [(1, SOLD.format("Tom", "Mary", 15, 4, 2)), (2, "What is the boiling point of lead")]
    docs = [
        (10, SOLD.format("Lucy", "Peter", 23, 9, 5)), (11, SOLD.format("Tom", "Mary", 15, 4, 2).lower()), (12, SOLD.format("Tom", "Mary", 15, 4, 2).upper()),
        (13, "So they asked, What is the boiling point of lead?"), (14, "so: what is the boiling point of lead"), (15, "The boiling point of lead is what it is"),
    ]
    assert set(found(spark, docs, items)) == {(10, 1), (11, 1), (12, 1), (13, 2), (14, 2)}


def test_parts_of_items_and_edited_items(spark):
    pick = random.Random(2)
    words = [["".join(pick.choice("abcdefghij") for _ in range(7)) for _ in range(n)] for n in (59, 38, 15)]
    edited = [[*words[0][20:53]], [w if k not in (13, 26) else "other" for k, w in enumerate(words[1])], [w if k != 7 else "other" for k, w in enumerate(words[2])]]
    docs = [(10 + k, "before it " + " ".join(w) + " and after") for k, w in enumerate(edited)] + [(20, " ".join(words[0][:25])), (21, " ".join(words[2][:6]))]
    assert set(found(spark, docs, [(k, " ".join(w)) for k, w in enumerate(words)])) == {(10, 0), (11, 1), (12, 2)}


def test_items_rich_in_numbers_match_word_for_word(spark):
    items = [(3, "5 kg 7 lb 9 oz 3 g 4 m 8 s 1 h")]
    docs = [(10, "Take 5 kg 7 lb 9 oz 3 g 4 m 8 s 1 h of it"), (11, "6 kg 2 lb 1 oz 7 g 9 m 3 s 2 h")]
    assert found(spark, docs, items) == {(10, 3): True}


def test_the_filter_passes_all_that_it_was_built_from(spark):
    pick = random.Random(7)
    hashes = [pick.randint(-(2**63), 2**63 - 1) for _ in range(500)]
    bits = templates.bit_filter(spark.createDataFrame([(h,) for h in hashes], "h long"))
    assert len(bits) == templates.FILTER_BITS
    assert all(bits[(h % 2**64) % templates.FILTER_BITS] for h in hashes) and bits.sum() <= 500
    assert not templates.bit_filter(spark.createDataFrame([], "h long")).any()


def test_odd_rows_clashing_names_and_empty_tables(spark):
    docs = with_clashes(documents(spark, ODD))
    items = spark.createDataFrame([(1, None), (None, "word " * 30), (2, ""), (3, "word " * 30), (3, "word " * 30)], ITEMS)
    assert [(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items).collect()] == [(906, 3)]
    assert templates.contaminated(docs.limit(0), items).count() == 0
    assert templates.contaminated(docs, items.limit(0)).count() == 0
