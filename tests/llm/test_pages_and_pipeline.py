"""URL filters, WARC audit, decontamination, the pipeline, and the registered queries beside their SQL."""

import importlib
import random
from collections import Counter
from pathlib import Path

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from spinmart.llm import bpe, decontamination, url_filters, warc
from spinmart.llm.queries import LLM_QUERIES, LLM_SQL

SMALL = Path("/root/testdata/sf0.001")
PAGE = "page_id long, url string, html string"


def bag(rows):
    return Counter(tuple(r) for r in rows)


# ---------------------------------------------------------------- URL filters

def judge_one(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:] if rest[end:end + 1] == "/" else ""
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, kind) for kind, h, p in url_filters.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if host + path in listed else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG", "http://a.example.org/es/1", "http://example.org/en/1?x=://y",
        "http://badexample.org/es/", "http://x.com/fr/#t", "http://x.com/de", "http://x.com/de/", "https://ÀB.net/p?q",
        "http://a.net?://b.com/de/", "http://org/", "a://b://c/d", "http://x.net/a\nb", "http://casino-win.net/p"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate([*URLS, URLS[5]])] + [(None, URLS[-1], "x")], PAGE)
    listed = {"casino-win.net/p", "a.net", "x.com/de/", "not in the corpus"}
    got = url_filters.judge_urls(pages.withColumns({"_key": F.lit(1), "host": F.lit(2)}),
                                 spark.createDataFrame([(k,) for k in listed] * 2, "key string"))
    want = [(i, *judge_one(u, listed)) for i, u in enumerate([*URLS, URLS[5]])] + [(None, *judge_one(URLS[-1], listed))]
    assert bag(got.collect()) == bag(want)


@pytest.mark.parametrize("limit", [url_filters.CONSTANT_BYTES, 0])
@pytest.mark.parametrize("shard_keys", [url_filters.SHARD_KEYS, 100])
def test_cascade_is_exact(spark, limit, shard_keys, monkeypatch):
    """As a constant and shard by shard, in one shard and in several."""
    monkeypatch.setattr(url_filters, "SHARD_KEYS", shard_keys)
    keys = spark.range(6_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    listed = keys.where("id % 11 = 3").select("key")
    cascade = url_filters.Cascade(listed.unionByName(spark.createDataFrame([("foreign",), (None,)], "key string")),
                                  keys.select("key").unionByName(keys.select("key")))
    assert len(cascade.levels) > 1
    got = cascade.add_membership(keys, "key", "found", limit)
    assert got.where(F.col("found") != (F.col("id") % 11 == 3)).count() == 0
    if limit:
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
        assert "Join" not in plan and "Python" not in plan


def test_cascade_of_nothing_and_of_everything(spark):
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    none = url_filters.Cascade(keys.where("false"), keys)
    assert {tuple(r) for r in none.add_membership(keys, "key", "f").collect()} == {("a", False), ("b", False), (None, False)}
    everything = url_filters.Cascade(keys, keys)
    assert {r.f for r in everything.add_membership(keys.where("key IS NOT NULL"), "key", "f").collect()} == {True}
    empty = spark.createDataFrame([], PAGE)
    assert url_filters.judge_urls(empty, keys).count() == 0


# ---------------------------------------------------------------- WARC

def archive_of(spark, rows):
    return spark.createDataFrame(rows, "file long, place int, record string")


def test_audit_finds_every_fault(spark):
    pick = random.Random(2)
    rows = [(f, p, "x" * pick.randint(0, 40) + f"{f}-{p}") for f in range(3) for p in range(700 if f else 3)]
    second = {(f, p): r for f, p, r in rows}
    want = set()
    for f, p, kind in [(0, 1, "content"), (1, 0, "length"), (1, 699, "missing"), (2, 15, "content"), (2, 16, "content"),
                       (2, 256, "missing"), (2, 900, "extra"), (7, 0, "extra")]:
        if kind == "content":
            second[f, p] = "?" + second[f, p][1:]
        elif kind == "length":
            second[f, p] += "!"
        elif kind == "missing":
            del second[f, p]
        else:
            second[f, p] = "new"
        start = sum(len(r) for g, q, r in rows if g == f and q < p)
        size = next((len(r) for g, q, r in rows if (g, q) == (f, p)), None)
        want.add((f, p, None if size is None else start, None if size is None else start + size, kind))
    got = warc.audit(archive_of(spark, rows), archive_of(spark, [(f, p, r) for (f, p), r in second.items()]))
    assert {tuple(r) for r in got.collect()} == want
    assert warc.audit(archive_of(spark, rows), archive_of(spark, rows[::-1])).count() == 0
    assert warc.audit(archive_of(spark, []), archive_of(spark, [])).count() == 0


def test_records_read_back(spark, tmp_path):
    pages = [(1, "http://a/b", "<p>é\r\n\r\nx</p>"), (2, None, None), (None, "http://c\r\nd", ""), (2, "http://a/b", "y" * 90_000),
             (2, "http://a/b", "y" * 90_000)]
    spark.createDataFrame(pages, PAGE).withColumn("record", F.lit("clash")).coalesce(1).write.parquet(str(tmp_path / "p"))
    archive = warc.lay_out(spark.read.parquet(str(tmp_path / "p")))
    got = [tuple(r) for r in warc.read_records(archive).orderBy("file", "place").select("url", "html").collect()]
    assert got == [((u or "").replace("\r", "%0D").replace("\n", "%0A"), h or "") for _, u, h in pages]
    assert archive.select("file", "place").distinct().count() == len(pages)


# ---------------------------------------------------------------- decontamination

ITEMS = [
    (1, "A train leaves Boston at 9 and travels 120 miles in 2 hours before it meets Anna at the old station."),
    (2, "In how many ways can Peter put 12 red balls and 7 blue balls into 3 boxes so that no box stays empty?"),
    (3, "too short"), (4, None), (5, ""), (6, "Name the capital city of France now"),
    (7, "If Tom pays Tom 5 dollars and then Sue pays Tom 5 dollars how many dollars has Tom got now?"),
]
CASES = [
    (10, "Some words first. " + ITEMS[0][1] + " And some after.", {(1, "verbatim")}),
    (11, "intro text " + ITEMS[0][1].replace("Boston", "Denver").replace("120", "450").replace("Anna", "Bob"),
     {(1, "reparameterised")}),
    (12, ITEMS[1][1].lower().replace("peter", "Peter"), {(2, "verbatim")}),
    (13, ITEMS[1][1].replace("12", "20").replace("Peter", "Maria").replace("boxes", "crates"), {(2, "reparameterised")}),
    (14, "A train of thought leaves nothing at all behind in 2 hours.", set()),
    (15, None, set()), (16, "", set()), (17, "too short", set()),
    (18, "Name the capital city of France now", {(6, "verbatim")}),
    (19, "If Jim pays Jim 8 euros and then Ann pays Jim 8 euros how many euros has Jim got now?", {(7, "reparameterised")}),
    # The same name in the item stands for two names here: another question.
    (20, "If Jim pays Bob 8 euros and then Ann pays Joe 9 euros how many pounds has Max got now?", set()),
    (21, (ITEMS[0][1] + " ") * 300, {(1, "verbatim")}),
    (None, ITEMS[0][1], {(1, "verbatim")}), (10, "Some words first. " + ITEMS[0][1] + " And some after.", {(1, "verbatim")}),
]


def test_planted_questions(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in CASES], "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("item_id", "hash", "place", "text_hash", "slots")})
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.find_leaks(docs, bench)
    assert {(r.doc_id, r.item_id, r.kind) for r in got.collect()} == {(i, *hit) for i, _, hits in CASES for hit in hits}
    assert got.count() == len({(i, t) for i, t, hits in CASES for _ in hits})
    kept = decontamination.drop_leaks(docs, bench)
    assert bag(kept.select("doc_id", "text").collect()) == bag((i, t) for i, t, hits in CASES if not hits)
    assert kept.columns == docs.columns
    assert decontamination.find_leaks(docs.where("false"), bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("false")).count() == 0


def leaks_of(spark, items, texts):
    """(place of the text, place of the item, kind) of the leaks."""
    got = decontamination.find_leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                     spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id, r.kind) for r in got.collect()}


HEAVY = ["What is 12 + 7 - 3 * 45 / 9 + 6 - 2 + 8 - 4 * 11 + 30 / 5?",
         "Find the sum of 12, 15, 18, 21, 24, 27, 30, 33 and 36 and then divide it by 9.",
         "Then Ann gave Bob 5 pounds 3 ounces, Sue 7 pounds and Joe 9 ounces."]


def test_items_of_many_placeholders(spark):
    """Copied verbatim they are found, and with other values if enough literals are left."""
    other = HEAVY[1].replace("12,", "40,").replace("9.", "7.")
    texts = [f"So here we go again. {t} That was all of it." for t in HEAVY] + [
        other, "Prices were 4 pounds 8 ounces, Max 3 pounds and Tim 2 ounces. What is 3 + 4 - 5 * 6 / 7 + 8 - 9 + 1 - 2 * 3 + 4 / 5?"]
    assert leaks_of(spark, HEAVY, texts) == {(k, k, "verbatim") for k in range(3)} | {(3, 1, "reparameterised")}


def test_copies_in_other_case(spark):
    """Whole items in lower, upper and title case, also beyond ASCII, and in lower case with other numbers."""
    items = [ITEMS[0][1], ITEMS[1][1], "Frau Groß und Herr Älter teilen 36 Äpfel aus Österreich mit Jürgen, wie viele bekommt jeder?"]
    texts = [case(f"So here we go. {t} And on.") for t in items for case in (str.lower, str.upper, str.title)]
    values = [items[0].lower().replace("120", "450"), items[1].lower().replace("12 red", "20 red")]
    assert leaks_of(spark, items, texts + values) == {(k, k // 3, "verbatim") for k in range(9)} | {
        (9, 0, "reparameterised"), (10, 1, "reparameterised")}


SHORT = "A baker sells 3 loaves and 5 rolls to each guest every morning."
LONG = "In the spring a farmer from Texas walks 12 miles each day with Anna to reach the market and buy seeds."


def test_values_that_meet_and_values_of_more_words(spark):
    """Two values may become the same, one may not become two; a value may have another number of words."""
    items = [SHORT, LONG, "We know that Tom gives Tom 5 coins and then asks Tom whether 5 coins are enough."]
    texts = [SHORT.replace("3", "4").replace("5", "4"), SHORT.replace("3", "4").replace("5", "9"),
             LONG.replace("Texas", "New Mexico").replace("Anna", "Mary Ann"), LONG.replace("12", "three hundred"),
             LONG.replace("12", "30").replace("Texas", "New South Wales"),
             items[2].replace("Tom", "Ann", 1).replace("Tom", "Joe", 1).replace("5", "7", 1)]
    assert leaks_of(spark, items, texts) == {(k, 0, "reparameterised") for k in (0, 1)} | {
        (k, 1, "reparameterised") for k in (2, 3, 4)}
    # And with more words in the item.
    assert leaks_of(spark, texts[2:4], [LONG]) == {(0, 0, "reparameterised"), (0, 1, "reparameterised")}


def test_leaks_of_the_small_tables(spark, rows_small):
    """Items are pasted whole: the documents that hold the item's text are found, and no others."""
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = decontamination.find_leaks(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, k) for i, t in rows_small for k, item in items if item in t}


# ---------------------------------------------------------------- pipeline and queries

def test_pipeline(spark, rows_small):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    rows = [r for r in rows_small if not any(brute.failed(brute.quality(r[1])))]
    rows = [(i, b"\n".join(kept).decode()) for (i, _), (_, kept) in zip(rows, brute.dropped_lines(rows))]
    rows.sort()
    roots, _ = brute.components(rows)
    rows = [r for k, r in enumerate(rows) if roots[k] == k]
    items = [r[0] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect()]
    rows = [r for r in rows if not any(item in r[1] for item in items)]
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {i: (np.array(own.encode_ordinary(t), "<u4").tobytes(), brute.sha(t.encode())) for i, t in rows}
    got = corpus_pipeline.run(spark, str(SMALL)).collect()
    assert {r.doc_id: (bytes(r.ids), r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_pipeline_stages_on_no_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, str(SMALL))
        assert out.count() == 0
        if name != "bpe":
            assert out.columns == list(corpus_pipeline.COLUMNS)


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    answer = con.execute(LLM_SQL[name])
    columns = [c[0] for c in answer.description]
    got = LLM_QUERIES[name](spark, str(SMALL))
    assert sorted(got.columns) == sorted(columns)
    assert bag(got.select(*columns).collect()) == bag(answer.fetchall())


def test_all_queries_are_registered():
    names = importlib.import_module("__spark_entry__").queries()
    assert {n.split("_")[0] for n in LLM_QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert LLM_QUERIES.keys() <= names.keys() and "pipeline" in names
