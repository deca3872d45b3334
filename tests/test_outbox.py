from collections import Counter

import pytest

from spinmart.plans.level_outbox import level_outbox, level_outbox_all_pairs, recipients_with_level
from spinmart.sources.schemas import RECIPIENT_LEVELS, RECIPIENTS, ROLES

PEOPLE = [("a@x", 1), ("b@x", 2), ("c@x", 3), ("d@x", 0), ("e@x", None), ("", 1), (None, 2), ("f@x", 1)]
SUBJECT, GOOD, BAD = "Thông báo kết quả", "Thành công", "Thất bại"


def test_strict_messages(spark, rows):
    got = level_outbox(spark.createDataFrame(PEOPLE, RECIPIENT_LEVELS))
    assert rows(got) == [("a@x", SUBJECT, GOOD), ("b@x", SUBJECT, BAD), ("f@x", SUBJECT, GOOD)]


def test_lenient_messages_reach_everyone(spark):
    got = level_outbox(spark.createDataFrame(PEOPLE, RECIPIENT_LEVELS), strict=False).collect()
    assert [r.body for r in got] == [f"<p>{GOOD if level == 1 else BAD}</p>" for _, level in PEOPLE]
    assert [r.recipient for r in got] == [email for email, _ in PEOPLE]


def test_all_pairs_with_counts_equal_the_nested_loops(spark):
    got = level_outbox_all_pairs(spark.createDataFrame(PEOPLE, RECIPIENT_LEVELS)).collect()
    want = Counter()
    for email, _ in PEOPLE:
        for _, level in PEOPLE:
            body = {1: GOOD, 2: BAD}.get(level)
            if email and level and body:
                want[(email, SUBJECT, body)] += 1
    assert {(r.recipient, r.subject, r.body): r.copies for r in got} == dict(want)


@pytest.mark.parametrize("limit", [1, 1000, None])
def test_sheets_merge_on_id(spark, rows, limit):
    people = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (None, "n@x")], RECIPIENTS)
    roles = spark.createDataFrame([(1, 2), (1, 1), (9, 1)], ROLES)
    assert rows(recipients_with_level(people, roles, limit), "email", "level") == [
        ("a@x", 1), ("a@x", 2), ("b@x", None), ("n@x", None)]
