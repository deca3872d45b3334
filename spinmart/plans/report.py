"""Chatbot usage per agent, for one data interval or for many intervals in one job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.functions.texts import matches_any
from spinmart.operators.ranking import rank_within
from spinmart.operators.staging import stage

# Column titles and wording of the message.
AGENT_TITLE, COUNT_TITLE = "email_agent", "so_luot_hoi_bot"
INDENT = " " * 16
GREETING = f"<b>Dear team CSKH,</b>\n{INDENT}\nData gửi thông tin số lượng check bot ngày %s"
HEADING = f"{GREETING}: <b>%s</b>\n{INDENT}\n<pre>"
CLOSING = "</pre>"
DAILY_NOTE = f"{GREETING}\n{INDENT}\n<b>xincamon!</b>"
MISSING_AGENT = "None"
EMPTY_TABLE = f"Empty DataFrame\nColumns: [{AGENT_TITLE}, {COUNT_TITLE}]\nIndex: []"


def asked(messages: DataFrame, pattern: str, start: date, end: date, half_open: bool = False,
          role: str = "user") -> DataFrame:
    """Messages of a role that match the pattern, from day ``start`` to day ``end``.

    Both days count, so neighbouring runs share a day; ``half_open`` leaves the end day out.
    """
    last = end - timedelta(days=1) if half_open else end
    return messages.where(
        (F.col("role") == role)
        & F.to_date("created_at").between(F.lit(start), F.lit(last))
        & matches_any(F.col("content"), pattern)
    )


def with_agent(counts: DataFrame, conversations: DataFrame, users: DataFrame, *more: str) -> DataFrame:
    """Counts per agent address; questions without a conversation or user stay under NULL.

    Counts are summed per user before the address is looked up, so a busy user is one row by then.
    """
    owners = conversations.select(F.col("id").alias("conversation_id"), "user_id")
    per_user = (
        counts.join(owners, "conversation_id", "left")
        .groupBy("user_id", *more).agg(F.sum("_n").alias("_n"))
    )
    return per_user.join(users.select(F.col("id").alias("user_id"), "email"), "user_id", "left")


def _per_conversation(rows: DataFrame, *more: str) -> DataFrame:
    # Counting before the joins keeps a busy conversation from being one large join key.
    return rows.groupBy("conversation_id", *more).agg(F.count(F.lit(1)).alias("_n"))


def _questions() -> Column:
    return F.sum("_n").alias("n_questions")


def agent_report(messages: DataFrame, conversations: DataFrame, users: DataFrame, pattern: str,
                 start: date, end: date, half_open: bool = False) -> DataFrame:
    """(email, n_questions) of one data interval."""
    counts = _per_conversation(asked(messages, pattern, start, end, half_open))
    return with_agent(counts, conversations, users).groupBy("email").agg(_questions())


def most_asked_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("n_questions"), F.asc_nulls_last("email"))


def report_total(report: DataFrame) -> DataFrame:
    """The one-row total of a report; 0 for an empty one."""
    return report.agg(F.coalesce(F.sum("n_questions"), F.lit(0)).alias("n_questions"))


def report_with_total(messages: DataFrame, conversations: DataFrame, users: DataFrame, pattern: str,
                      start: date, end: date, half_open: bool = False) -> DataFrame:
    """Agents and total from one pass: ``is_total`` tells the total from the agent NULL."""
    counts = _per_conversation(asked(messages, pattern, start, end, half_open))
    return (
        with_agent(counts, conversations, users).rollup("email")
        .agg(_questions(), F.grouping("email").cast("int").alias("is_total"))
    )


def report_backfill(messages: DataFrame, conversations: DataFrame, users: DataFrame, pattern: str,
                    first_run: date, last_run: date, half_open: bool = False) -> DataFrame:
    """(run_date, email, n_questions) for every run day of a range, in one job.

    A run starting on day ``d`` covers ``d`` and ``d + 1``, so a day's counts go to two runs. The
    copies are made after counting.
    """
    rows = asked(messages, pattern, first_run, last_run + timedelta(days=1), half_open)
    counts = _per_conversation(rows.withColumn("_day", F.to_date("created_at")), "_day")
    per_day = with_agent(counts, conversations, users, "_day")
    runs = F.array("_day") if half_open else F.array("_day", F.date_sub("_day", 1))
    return (
        per_day.select("email", "_n", F.explode(runs).alias("run_date"))
        .where(F.col("run_date").between(F.lit(first_run), F.lit(last_run)))
        .groupBy("run_date", "email").agg(_questions())
    )


def _table(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, lines): one row of total, agents and column widths; the agents with their line of the table."""
    agents = stage(report.select("email", "n_questions"), "agents")
    name, count = F.coalesce("email", F.lit(MISSING_AGENT)), F.col("n_questions").cast("string")
    # A count column is set one space wider than its title, as number columns are.
    summary = agents.agg(
        F.coalesce(F.sum("n_questions"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("n_agents"),
        F.greatest(F.max(F.length(name)), F.lit(len(AGENT_TITLE))).alias("name_width"),
        F.greatest(F.max(F.length(count)), F.lit(len(COUNT_TITLE) + 1)).alias("count_width"),
    )
    line = F.concat(F.lpad(name, summary.select("name_width").scalar(), F.lit(" ")), F.lit(" "),
                    F.lpad(count, summary.select("count_width").scalar(), F.lit(" ")))
    return summary, agents.withColumn("line", line)


def report_lines(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, lines): the right-aligned table of a report as rows (pos, line), of any length.

    The summary is one row: total, agents, and the widths of the two columns.
    """
    summary, agents = _table(report)
    ranked = rank_within(agents, [], [F.desc("n_questions"), F.asc_nulls_last("email")], "pos")
    return summary, ranked.select("pos", "line")


def report_message(report: DataFrame, day: date, agents_per_message: int | None = None) -> DataFrame:
    """(part, body): the report as one message text with a right-aligned table.

    A caller whose service limits the length of a message can ask for parts of ``agents_per_message`` agents
    each, all with heading and total. ``report_lines`` has the table as rows.
    """
    titles = F.concat(
        F.expr(f"lpad('{AGENT_TITLE}', name_width)"), F.lit(" "), F.expr(f"lpad('{COUNT_TITLE}', count_width)"))

    def body(lines: Column) -> Column:
        return F.concat(
            F.format_string(HEADING, F.lit(day.isoformat()), F.col("total").cast("string")),
            F.when(F.col("n_agents") == 0, F.lit(EMPTY_TABLE)).otherwise(F.concat(titles, F.lit("\n"), lines)),
            F.lit(CLOSING),
        ).alias("body")

    if agents_per_message is None:  # one message, whose lines are put in order where they are joined
        summary, agents = _table(report)
        joined = agents.agg(F.expr(
            "listagg(line, '\n') WITHIN GROUP (ORDER BY n_questions DESC, email ASC NULLS LAST)").alias("lines"))
        return summary.select(F.lit(0).cast("long").alias("part"), body(joined.scalar()))
    summary, lines = report_lines(report)
    last_part = F.greatest(F.ceil(F.col("n_agents") / agents_per_message).cast("long") - 1, F.lit(0).cast("long"))
    tables = lines.groupBy(F.floor((F.col("pos") - 1) / agents_per_message).cast("long").alias("part")).agg(
        F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY pos)").alias("lines"))
    return (
        summary.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last_part)))
        .join(tables, "part", "left").select("part", body(F.col("lines")))
    )


def report_outbox(messages: DataFrame, chat: str) -> DataFrame:
    """The parts of a report as rows to deliver to one chat, in order."""
    return messages.orderBy("part").select(
        F.lit(chat).alias("recipient"), F.lit(None).cast("string").alias("subject"), "body")


def daily_note(days: DataFrame, day: str) -> DataFrame:
    """A short note per row of ``days``, its date written day first."""
    return days.select(day, F.format_string(DAILY_NOTE, F.date_format(day, "dd/MM/yyyy")).alias("body"))
