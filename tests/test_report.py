from datetime import date, datetime

import pandas as pd
import pytest

from spinmart.plans import report
from spinmart.sources import schemas

PATTERN = "alpha|beta"


def at(day, hour=12):
    return datetime(2024, 1, day, hour)


MESSAGES = [
    (1, "say ALPHA now", "user", at(5, 0)), (1, "beta", "user", datetime(2024, 1, 5, 23, 59, 59)),
    (1, "alphabet", "user", at(6, 0)), (2, "beta", "user", at(6)), (3, "alpha", "user", at(6)),
    (4, "alpha", "user", at(5)), (5, "alpha", "user", at(5)),
    (1, "alpha", "assistant", at(5)), (1, "gamma", "user", at(5)), (1, None, "user", at(5)),
    (1, "alpha", "user", at(7, 0)), (1, "alpha", "user", at(4)), (2, "beta", "user", at(9)), (1, "alpha", "user", None),
]
# Conversation 4 is unknown; the user of 5 is unknown; 1 and 3 belong to the same user.
CONVERSATIONS = [(1, 10), (2, 20), (3, 10), (5, 50)]
USERS = [(10, "ann@x"), (20, "bob@long.example"), (30, "cy@x")]


@pytest.fixture(scope="module")
def chat(spark):
    return (spark.createDataFrame(MESSAGES, schemas.CHAT_MESSAGES),
            spark.createDataFrame(CONVERSATIONS, schemas.CHAT_CONVERSATIONS),
            spark.createDataFrame(USERS, schemas.CHAT_USERS), PATTERN)


EXPECTED = [("ann@x", 4), (None, 2), ("bob@long.example", 1)]


def test_both_days_count(spark, chat):
    got = report.most_asked_first(report.agent_report(*chat, date(2024, 1, 5), date(2024, 1, 6)))
    assert list(map(tuple, got.collect())) == EXPECTED


def test_half_open_leaves_the_end_day_out(chat, rows):
    got = report.agent_report(*chat, date(2024, 1, 5), date(2024, 1, 6), half_open=True)
    assert rows(got) == [("ann@x", 2), (None, 2)]


def test_total_with_and_without_rows(chat):
    agents = report.agent_report(*chat, date(2024, 1, 5), date(2024, 1, 6))
    assert [tuple(r) for r in report.report_total(agents).collect()] == [(7,)]
    nobody = report.agent_report(*chat, date(2020, 1, 5), date(2020, 1, 6))
    assert [tuple(r) for r in report.report_total(nobody).collect()] == [(0,)]


def test_rollup_tells_the_total_from_the_missing_agent(chat, rows):
    got = report.report_with_total(*chat, date(2024, 1, 5), date(2024, 1, 6))
    assert rows(got) == [("ann@x", 4, 0), ("bob@long.example", 1, 0), (None, 2, 0), (None, 7, 1)]


def test_day_filter_is_pushed_to_the_scan(spark, chat, tmp_path, plan_of):
    path = str(tmp_path / "m")
    chat[0].write.parquet(path)
    df = report.asked(spark.read.parquet(path), PATTERN, date(2024, 1, 5), date(2024, 1, 6))
    plan = plan_of(df)
    assert "GreaterThanOrEqual(created_at,2024-01-05T00:00)" in plan and "LessThan(created_at,2024-01-07T00:00)" in plan


@pytest.mark.parametrize("half_open", [False, True])
def test_backfill_equals_one_run_per_day(chat, half_open):
    got = report.report_backfill(*chat, date(2024, 1, 3), date(2024, 1, 8), half_open).collect()
    want = set()
    for number in range(3, 9):
        single = report.agent_report(*chat, date(2024, 1, number), date(2024, 1, number + 1), half_open)
        want |= {(date(2024, 1, number), *r) for r in single.collect()}
    assert {(r.run_date, r.email, r.n_questions) for r in got} == want and len(got) == len(want)


def expected_text(agents, total, day):
    frame = pd.DataFrame(agents, columns=["email_agent", "so_luot_hoi_bot"])
    return (f"<b>Dear team CSKH,</b>\n{' ' * 16}\nData gửi thông tin số lượng check bot ngày {day}: <b>{total}</b>\n"
            f"{' ' * 16}\n<pre>{frame.to_string(index=False)}</pre>")


def test_message_reads_like_a_printed_table(chat):
    agents = report.agent_report(*chat, date(2024, 1, 5), date(2024, 1, 6))
    got = report.report_message(agents, date(2024, 1, 6)).collect()
    assert [tuple(r) for r in got] == [(0, expected_text(EXPECTED, 7, "2024-01-06"))]


@pytest.mark.parametrize("agents", [
    [("a@x", 3), ("b@x", 3)], [("a", 1)], [("someone.with.a.long.name@x", 12345678901234567)], [],
])
def test_message_widths(spark, agents):
    df = spark.createDataFrame(agents, "email string, n_questions bigint")
    got = report.report_message(df, date(2024, 1, 6)).collect()
    assert [r.body for r in got] == [expected_text(agents, sum(n for _, n in agents), "2024-01-06")]


def test_long_report_is_one_message_unless_asked_otherwise(spark):
    agents = [(f"agent{n:04d}@x", 9_000 - n) for n in range(1_500)]
    df = spark.createDataFrame(agents[::-1], "email string, n_questions bigint")
    (row,) = report.report_message(df, date(2024, 1, 6)).collect()
    assert row.body == expected_text(agents, sum(n for _, n in agents), "2024-01-06")
    _, lines = report.report_lines(df)
    assert [r.line.split()[0] for r in lines.orderBy("pos").collect()] == [name for name, _ in agents]


def test_long_report_goes_on_in_parts(spark):
    agents = [(f"agent{n:02d}@x", 100 - n) for n in range(25)]
    df = spark.createDataFrame(agents[::-1], "email string, n_questions bigint")
    parts = report.report_message(df, date(2024, 1, 6), 10)
    bodies = [r.body for r in report.report_outbox(parts, "chat").collect()]
    lines = [body.split("<pre>")[1].removesuffix("</pre>").split("\n")[1:] for body in bodies]
    assert [len(part) for part in lines] == [10, 10, 5]
    assert [line.split()[0] for part in lines for line in part] == [name for name, _ in agents]


def test_daily_note_writes_the_day_first(spark):
    days = spark.createDataFrame([(date(2025, 5, 14),)], "day date")
    assert "check bot ngày 14/05/2025\n" in report.daily_note(days, "day").collect()[0].body
