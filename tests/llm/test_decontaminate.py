from wordloom.llm import decontaminate

QUESTION = "A train leaves Paris at 3 pm and travels 120 km in 3 hours to reach Berlin, how fast is it?"
FOX = "the quick brown fox jumps over the lazy dog every single day"
OTHER = "A train leaves London at 5 pm and travels 99 km in {} hours to reach Madrid, how fast is it?"


def benchmark(spark):
    rows = [(1, QUESTION), (1, QUESTION), (2, "short item"), (3, None), (4, FOX)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_leaks_and_slots(spark, docs_of):
    docs = docs_of(
        [
            (1, "Before it. " + OTHER.format(5), "s"),
            (2, OTHER.format(7), "s"),  # 3 would stand for 5 and for 7
            (3, QUESTION.replace("leaves", "LEAVES").replace("?", ""), "s"),
            (None, f"x {FOX} y", "s"),
            (None, f"x {FOX} y", "s"),
            (4, None, None),
            (5, "", "s"),
            (6, "a short item alone", "s"),
            (7, f"{QUESTION} {FOX}", "s"),
            (7, "the same id without anything", "s"),
        ]
    )
    got = decontaminate.leaks(docs, benchmark(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 1), (None, 4), (7, 1), (7, 4)}
    assert {r.doc_id: r.n_changed for r in got if r.item_id == 1} == {1: 4, 3: 0, 7: 0}
    left = decontaminate.drop_leaks(docs, benchmark(spark))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 6, 7]


def test_shuffled_join_gives_the_same(spark, docs_of, monkeypatch):
    docs = docs_of([(1, FOX * 300, "s"), (2, FOX, "s"), (3, "other words only in this text here", "s")])
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert {r.doc_id for r in decontaminate.leaks(docs, benchmark(spark)).collect()} == {1, 2}


def test_empty_tables(spark, docs_of):
    assert decontaminate.leaks(docs_of([]), benchmark(spark)).count() == 0
    nothing = benchmark(spark).where("false")
    assert decontaminate.leaks(docs_of([(1, FOX, "s")]), nothing).count() == 0
    assert decontaminate.drop_leaks(docs_of([(1, FOX, "s")]), nothing).count() == 1


APPLES = "Anna has 3 apples. Tom has 5 apples. How many do they have?"
GIVEN = "How many apples does Anna give to Tom?"


def test_names_that_begin_sentences_and_other_case(spark, docs_of):
    items = spark.createDataFrame([(1, APPLES), (2, GIVEN), (3, "What is the capital? Where is the port?")], "item_id bigint, text string")
    docs = docs_of(
        [
            (1, "Bob has 7 apples. Eve has 9 apples. How many do they have?", "s"),
            (2, GIVEN.lower(), "s"),
            (3, APPLES.upper(), "s"),
            (4, "Bob has 7 apples. Bob has 9 apples.\nHow many do they have?", "s"),
            (5, "Paris is the capital. Here is the port.", "s"),  # what and where are no names
            (6, "Some ask what it has here, where it is and how they do.", "s"),
            (7, "Bob has 7 apples. Eve has 9 apples. What do they eat?", "s"),
            (None, "Bob has 7 apples. Eve has 9 apples. How many do they have?", "s"),
        ]
    )
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, items).collect()}
    assert {k for k in got} == {(1, 1), (2, 2), (3, 1), (4, 1), (None, 1)}
    assert got[1, 1].n_covered == 13 and got[1, 1].n_changed == 4 and got[2, 2].n_changed == 0
