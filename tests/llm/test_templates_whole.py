"""Leaks that the queries find beyond the strict template rules."""

from test_templates import QUESTION

from regionledger.llm import templates

DENSE = "Ann Lee beat Bob Ray 6-3 6-4 in Rome Italy on 12 May 2011 before Tim Fox beat Max Orr 7-5 6-2 in Oslo Norway on 3 June 2012"


def leaking(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = templates.matches(d, b, whole=True)
    marked = {r.doc_id: r["items"] for r in templates.mark(d, found).collect()}
    left = sorted(r.doc_id for r in templates.clean(d, b, whole=True).collect())
    assert left == sorted(i for i, x in marked.items() if not x)
    return [marked[i] for i in range(len(docs))]


def test_copies_are_found_in_any_case_and_at_any_literal_share(spark):
    docs = [
        "so " + DENSE + " .", DENSE.lower(), "so " + QUESTION.lower(), QUESTION.upper(), DENSE.replace("Ann", "Eve").replace("12", "14"),
        QUESTION.replace("Tom has", "Lisa has", 1), "Tim Fox beat Max Orr", "Eve Lee beat Kim Ray 6-1 6-0 in Bonn Germany on 1 July 2010 before it",
    ]
    assert leaking(spark, docs, [DENSE, QUESTION]) == [[0], [0], [1], [1], [0], [], [], []]


def test_values_of_other_lengths_shift_nothing(spark):
    longer = QUESTION.replace("Tom", "Mary Ann").replace("12", "twenty five")
    docs = [
        "so " + longer, QUESTION.replace("Tom", "Lisa").replace("12", "twenty five").replace("Anna", "Mary Ann"),
        "we ask what is the capital city of New York today?", longer.replace("Mary Ann", "Lisa", 1), "Mary Ann sees twenty five apples",
        QUESTION.replace("7 km", "two hundred miles").replace("5 ", "1 000 ").replace("Tom", "Mary Ann Lee"),
    ]
    assert leaking(spark, docs, [QUESTION, "What is the capital city of Paris today?"]) == [[0], [0], [1], [], [], [0]]


HOURS = "If a train that leaves at noon runs for 1 hour and another runs for 3 hours how far apart are both of them then?"


def test_only_names_map_one_to_one(spark):
    docs = [
        QUESTION.replace("5 ", "4 ").replace("12 ", "4 "), HOURS.replace("1 hour", "2 hours").replace("3 hours", "5 hours"),
        HOURS.replace("1 hour", "1 minute").replace("3 hours", "3 days"), QUESTION.replace("Tom", "Lisa").replace("Anna", "Lisa"),
        QUESTION.replace("Tom", "Lisa").replace("5 ", "4 ").replace("12 ", "4 ").replace("3 ", "4 ").replace("7 ", "4 "),
    ]
    assert leaking(spark, docs, [QUESTION, HOURS]) == [[0], [1], [1], [], [0]]
    back = HOURS.replace("1 hour", "2 hours").replace("3 hours", "1 hour")
    assert leaking(spark, [HOURS], [back]) == [[0]]


def test_a_few_long_values_are_no_template(spark):
    item = "United Nations Security Council Report of the Royal Geographic Society London and Big River Valley Trust"
    assert leaking(spark, ["so Tom of the North and South went", "so " + item.lower()], [item]) == [[], [0]]
