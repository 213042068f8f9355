import pytest
from pyspark.sql import functions as F

from mailframe.llm import decontam

QUESTION = "A farmer called Peter sells 12 apples to Maria for 3 euros each. How many euros does Peter get when Maria pays with 50 euros?"
CHANGED = "A farmer called Anton sells 15 apples to Clara for 4 euros each. How many euros does Anton get when Clara pays with 90 euros?"
MIXED = "A farmer called Anton sells 15 apples to Clara for 4 euros each. How many euros does Bruno get when Clara pays with 90 euros?"
FILLER = "nothing of this has to do with any test at all and it goes on for a while without numbers or names in it."


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(7, QUESTION), (8, "short item of five words"), (9, None), (10, ""), (11, "1 2 3 4 5 6 7 8 9")], "item_id bigint, text string")


def _leaks(docs, items):
    return {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(docs, items).collect()}


def test_copies_and_reparameterised_questions(documents, items):
    docs = documents(
        [(1, QUESTION), (2, f"{FILLER} {CHANGED} {FILLER}"), (3, MIXED), (4, FILLER), (5, "before it a short item of five words after"), (6, QUESTION.upper())]
    )
    got = _leaks(docs, items)
    assert {(1, 7), (2, 7), (5, 8)} <= set(got)
    assert got[1, 7]["changed_slots"] == 0 and got[2, 7]["changed_slots"] > 3
    assert not any(d == 4 for d, _ in got)
    # One name that stands for two values: the question as a whole is not consistent, but the run up to the second value is a leak.
    assert got[3, 7]["windows"] < got[3, 7]["item_windows"]


def test_template_types(spark):
    row = spark.createDataFrame([("It cost 1,250.5 usd and Mary Ann paid 20 km later",)], "t string")
    marks = row.select(decontam.marked(F.col("t"))).first()[0]
    assert marks.replace("\x01", "N:").replace("\x02", "P:").replace("\x03", "U:") == "it cost N:1_250_5 U:usd and P:mary P:ann paid N:20 U:km later"


def test_edge_rows(documents, items, clashing, spark):
    rows = [(1, None), (2, ""), (3, QUESTION), (3, QUESTION), (None, QUESTION), (4, (FILLER + " ") * 2000 + QUESTION), (5, "1 2 3 4 5 6 7 8 9")]
    got = decontam.report(clashing(documents(rows)), items)
    leaked = sorted(((r["doc_id"] or 0), r["leaked"], r["n_items"]) for r in got.collect())
    # an item of numbers is found by its values
    assert leaked == [(0, True, 1), (1, False, 0), (2, False, 0), (3, True, 1), (3, True, 1), (4, True, 1), (5, True, 1)]
    assert decontam.report(documents(rows).limit(0), items).count() == 0
    assert not any(r["leaked"] for r in decontam.report(documents(rows), items.limit(0)).collect())


def test_copies_in_other_case_wrapping_and_surroundings(documents, items):
    wrapped = QUESTION.replace(" ", "\n")
    docs = [(1, QUESTION.upper()), (2, wrapped), (3, QUESTION.replace(" ", "  ")), (4, QUESTION.lower()), (5, f"as was said, {QUESTION}"), (6, FILLER.upper())]
    assert {d for d, i in _leaks(documents(docs), items) if i == 7} == {1, 2, 3, 4, 5}
    short = items.sparkSession.createDataFrame([(1, "Where does the river Rhine end its course?")], "item_id bigint, text string")  # 8 tokens
    assert set(_leaks(documents([(1, "he asked, Where does the river Rhine end its course?")]), short)) == {(1, 1)}


def test_windows_of_few_words_match_by_their_values(documents, spark):
    items = spark.createDataFrame([(1, "12 + 7 = 19 , 19 * 3 = 57 ; 57 - 8 = 49"), (2, "Rhine 1815"), (3, "Is 5 kg more than 3 kg or 4 kg ?")], "item_id bigint, text string")
    rows = [(1, "so 12 + 7 = 19 , 19 * 3 = 57 ; 57 - 8 = 49 it is"), (2, "so 12 + 7 = 19 , 19 * 3 = 57 ; 57 - 8 = 48 it is"), (3, "the RHINE 1815 flood")]
    rows += [(4, "the Rhine 1816 flood"), (5, "is 5 kg more than 3 kg or 4 kg")]
    assert {k: r["changed_slots"] for k, r in _leaks(documents(rows), items).items()} == {(1, 1): 0, (3, 2): 0, (5, 3): 0}


def test_a_conflict_does_not_hide_consistent_windows(documents, spark):
    item = f"{QUESTION} Then Peter drives 20 km home and is glad that all of it went so well today."
    other = item.replace("Then Peter", "Then Bruno")  # 17 and more consistent windows on either side
    items = spark.createDataFrame([(1, item), (2, "Peter met Anna and Peter left")], "item_id bigint, text string")
    rows = [(1, other), (2, other.replace("12 apples", "15 apples")), (3, "so Karl met Lena and Otto left")]
    got = _leaks(documents(rows), items)
    assert set(got) == {(1, 1), (2, 1)}
    assert got[1, 1]["changed_slots"] == 0 and got[1, 1]["windows"] < got[1, 1]["item_windows"] and got[2, 1]["changed_slots"] == 1


def test_a_full_filter_changes_nothing(documents, items, monkeypatch):
    docs = documents([(1, QUESTION), (2, CHANGED), (4, FILLER), (5, "1 2 3 4 5 6 7 8 9")])
    want = set(_leaks(docs, items))
    monkeypatch.setattr(decontam, "FILTER_SLOTS", 2)
    assert set(_leaks(docs, items)) == want


def test_rows_that_share_an_id_are_judged_apart(documents, items, clashing):
    half = QUESTION.split()
    docs = clashing(documents([(None, QUESTION), (None, FILLER), (3, QUESTION), (3, FILLER), (4, " ".join(half[:11])), (4, " ".join(half[11:13])), (5, None), (5, "")]))
    got = sorted(((r["doc_id"] or 0), r["leaked"]) for r in decontam.report(docs, items).collect())
    assert got == [(0, False), (0, True), (3, False), (3, True), (4, False), (4, False), (5, False), (5, False)]
    left = decontam.without_leaks(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:7]) for r in left.collect()) == [(0, "nothing"), (3, "nothing"), (4, "A farme"), (4, "euros e"), (5, ""), (5, "")]


def test_the_longest_consistent_run(spark):
    def run(*hits):
        rows = [(i + 1, list(pairs)) for i, pairs in enumerate(hits)]
        frame = spark.createDataFrame([(rows,)], "hits array<struct<pos:int,pairs:array<struct<i:string,d:string>>>>")
        best = frame.select(decontam._longest_run(F.col("hits")).alias("b")).first()["b"]
        return best["windows"], [tuple(p) for p in best["pairs"]]

    ax, ay, bz = ("a", "x"), ("a", "y"), ("b", "z")
    assert run([ax], [ax, bz], [bz], [ay], [ay]) == (3, [ax, bz])
    assert run([ax], [ay], [ay, bz], [bz]) == (3, [ay, bz])
    assert run([ax, ay], [ax], []) == (2, [ax])
    assert run([ax], [ay]) == (1, [ax])
    assert run([], []) == (2, [])


def test_only_native_operators(documents, items):
    plan = decontam.report(documents([(1, QUESTION)]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
