"""Contradictions read a question once, and blocks of any size give the same pairs."""

import random

import pytest

from tallyforge.operators import joins as J


@pytest.fixture(scope="module")
def qa(spark):
    dice = random.Random(5)
    things = ["pipes", "cables", "boxes", "valves", "pumps", "gauges"]
    rows = []
    for i in range(160):
        who = dice.choice(["ACME ", "BOLTCO ", "", "", ""])
        items = " ".join(sorted(dice.sample(things, dice.choice([4, 5]))))
        extra = dice.choice(["", " after 100 hours", " after 200 hours"])
        rows.append((i, f"Did {who}ship {items} northward yesterday{extra}?", dice.choice(["Yes, they went.", "No order was logged.", "I cannot see that from here."]), i % 7 == 0))
    return spark.createDataFrame(rows, "line long, question string, answer string, marked boolean").repartition(3).localCheckpoint()


@pytest.mark.parametrize("most", [0, 3])
def test_large_blocks_give_the_same_contradictions(qa, most):
    want = sorted(map(tuple, J.contradictions(qa, most=10_000).collect()))
    assert len(want) > 100 and sorted(map(tuple, J.contradictions(qa, most=most).collect())) == want


@pytest.mark.parametrize("most", [0, 3])
def test_large_blocks_give_the_same_divergent_pairs(qa, most):
    want = J.divergent_grounding(qa, most=10_000).first().pairs
    assert want > 100 and J.divergent_grounding(qa, most=most).first().pairs == want


@pytest.mark.parametrize("operator", [J.contradictions, J.divergent_grounding, J.contradiction_report])
def test_texts_are_read_once(qa, operator):
    """What is compared comes from files, so no join evaluates the texts again."""
    plan = operator(qa)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "FileScan" in plan


def test_an_asked_question_counts_as_often_as_it_is_asked(spark):
    """A name in one question that many rows ask is common; it names no subject then."""
    rows = [(i, "Did ACME ship pipes?", f"Yes, {i}.", False) for i in range(50)] + [(100 + i, f"Did B{chr(65 + i)}CO ship pipes?", "No order was logged.", False) for i in range(9)] + [(200, None, "Yes.", False)]
    got = J.contradiction_rows(spark.createDataFrame(rows, "line long, question string, answer string, marked boolean")).collect()
    assert {r.subject for r in got if r.line < 100} == {""} and {r.subject for r in got if r.line == 100} == {"baco"} and len([r for r in got if r.line == 200]) == 1
