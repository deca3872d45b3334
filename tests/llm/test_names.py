"""Columns of a table named like those that an operator uses inside."""

import public_tokenizers
import pytest

from spinmart.llm.bpe import encode_texts
from spinmart.llm.decontamination import drop_leaks
from spinmart.llm.jaccard_join import keep_one
from spinmart.llm.line_dedup import drop_common_lines
from spinmart.llm.names import step_aside
from spinmart.llm.quality_rules import BY_WINDOW, MEASURES, keep_good
from spinmart.llm.url_filters import Cascade

PROSE = " ".join(f"word{i} stands here" for i in range(40))


def clashing(spark, names, rows=((1, PROSE), (2, "short"), (3, PROSE), (4, None))):
    own = [f"concat('{name}', doc_id) AS `{name}`" for name in names]
    return spark.createDataFrame(list(rows), "doc_id long, text string").selectExpr("doc_id", *own, "text")


def check(out, names, ids):
    assert sorted(r.doc_id for r in out.collect()) == ids
    assert all(r[name] == f"{name}{r.doc_id}" for r in out.collect() for name in names)


def test_step_aside(spark):
    df, own = step_aside(spark.range(1).selectExpr("id", "1 AS _ID", "2 AS _own__ID", "3 AS a"), ["_id"])
    assert df.columns == ["id", "__own__ID", "_own__ID", "a"] and own == {"__own__ID": "_ID"}
    assert df.withColumnsRenamed(own).columns == ["id", "_ID", "_own__ID", "a"]


def test_stages_keep_clashing_columns(spark):
    names = [*MEASURES, BY_WINDOW, "FAIL_BITS"]
    check(keep_good(clashing(spark, names)), names, [1, 3])
    names = ["_id", "_hash", "_own__id"]
    check(keep_one(clashing(spark, names)), names, [1, 2, 4])
    names = ["_leak", "_hash"]
    items = spark.createDataFrame([("i", " ".join(PROSE.split()[3:30]))], "item_id string, text string")
    check(drop_leaks(clashing(spark, names), items), names, [2, 4])


def test_line_dedup_and_bpe_replace_what_they_make(spark):
    out = drop_common_lines(clashing(spark, ["_block", "n_lines"]))
    assert {(r.doc_id, r._block, r.n_lines) for r in out.collect()} == {(i, f"_block{i}", 1) for i in (1, 2, 3, 4)}
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = clashing(spark, ["ids", "n_tokens", "decoded"])
    out = encode_texts(docs, path, public_tokenizers.PATTERN, carry=docs.columns, decoded=True).where("doc_id = 2").first()
    assert out.text == "short" and bytes(out.decoded) == b"short" and out.n_tokens == len(out.ids) // 4
    out = encode_texts(docs, path, public_tokenizers.PATTERN, carry=docs.columns).where("doc_id = 2").first()
    assert out.decoded == "decoded2"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_cascade_keeps_clashing_columns(spark, limit):
    keys = spark.range(400).selectExpr("concat('k', id) AS key")
    cascade = Cascade(keys.where("key LIKE '%7'"), keys)
    rows = keys.selectExpr("key AS _shard", "length(key) AS _words0", "5 AS words", "0 AS listed")
    out = cascade.add_membership(rows, "_shard", "listed", limit).collect()
    assert len(out) == 400 and all(r.listed == r._shard.endswith("7") and r._words0 == len(r._shard) and r.words == 5 for r in out)
