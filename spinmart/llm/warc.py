"""WARC records of web pages and a Merkle audit between two replicas.

``lay_out`` writes pages as WARC records, numbered within files. ``audit`` hashes the records of both replicas
and, over ordered ranges of ``FAN_OUT`` places, the hashes and lengths below into trees. It compares the
roots of the files and goes down only where nodes differ, to the damaged records and their byte offsets. Neither replica's
records are moved: only hashes and lengths are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinmart.operators.staging import stage

FILE_RECORDS = 1024
FAN_OUT = 16
LEVELS = 3  # 1024 records: 64, 4, 1 nodes; files may be longer, their last level then has more than one root
DATE = "1970-01-01T00:00:00Z"


def record_of(page_id: Column, url: Column, html: Column, date: str = DATE) -> Column:
    """A WARC/1.1 resource record; a NULL url or page is empty, line breaks in a url are escaped."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def lay_out(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``file``, ``place``, ``page_id`` and ``record``. Rows keep the order of the scan; a file has up to
    ``FILE_RECORDS`` records of one partition, so nothing is shuffled and no file grows with a repeated row.
    ``pages`` must be a scan or a staged table, whose partitions are the same each time they are read."""
    row = F.monotonically_increasing_id()
    placed = pages.select("page_id", "url", "html", row.alias("_row"))
    within = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(
        (F.shiftright("_row", 33) * (1 << 23) + F.floor(within / FILE_RECORDS)).cast("long").alias("file"),
        (within % FILE_RECORDS).cast("int").alias("place"), "page_id",
        record_of(F.col("page_id"), F.col("url"), F.col("html"), date).alias("record"))


def read_records(archive: DataFrame) -> DataFrame:
    """``file``, ``place``, ``url`` and ``html`` of laid-out records."""
    head_end = F.instr("record", "\r\n\r\n")
    return archive.select(
        "file", "place", F.regexp_extract("record", "WARC-Target-URI: ([^\r\n]*)", 1).alias("url"),
        F.expr(f"substring(record, {4} + instr(record, '\\r\\n\\r\\n'), "
               "length(record) - 7 - instr(record, '\\r\\n\\r\\n'))").alias("html")).where(head_end > 0)


def leaves(archive: DataFrame) -> DataFrame:
    """``file``, ``place``, ``length`` and ``hash`` of every record."""
    return archive.select("file", "place", F.octet_length("record").cast("long").alias("length"),
                          F.sha2("record", 256).alias("hash"))


def level_above(nodes: DataFrame) -> DataFrame:
    """Nodes over ordered ranges of ``FAN_OUT`` nodes."""
    below = F.array_sort(F.collect_list(F.struct("place", "length", "hash")))
    text = F.concat_ws(";", F.transform(below, lambda x: F.concat_ws(":", x["place"], x["length"], x["hash"])))
    return nodes.groupBy("file", F.floor(F.col("place") / FAN_OUT).cast("int").alias("above")).agg(
        F.sum("length").alias("length"), F.sha2(text, 256).alias("hash")).withColumnRenamed("above", "place")


def differing(first: DataFrame, second: DataFrame) -> DataFrame:
    """Places whose nodes differ or are missing on one side."""
    a = first.select("file", "place", F.col("length").alias("length_a"), F.col("hash").alias("hash_a"))
    b = second.select("file", "place", F.col("length").alias("length_b"), F.col("hash").alias("hash_b"))
    return a.join(b, ["file", "place"], "full").where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Damaged records: ``file``, ``place``, ``start``, ``end``, ``fault``, byte range as in the first replica.

    Both have columns ``file``, ``place`` (from 0 within the file, once each) and ``record``. ``fault`` is "missing" or
    "extra" in the second replica, "length" if the lengths differ, else "content". The range of an extra record is NULL. A
    NULL record counts as missing. Equal replicas, or two empty ones, give no rows.
    """
    tree_a = [stage(leaves(first.where("record IS NOT NULL")), "warc-a")]
    tree_b = [stage(leaves(second.where("record IS NOT NULL")), "warc-b")]
    for _ in range(LEVELS):
        tree_a.append(stage(level_above(tree_a[-1]), "warc-a"))
        tree_b.append(stage(level_above(tree_b[-1]), "warc-b"))
    wrong = differing(tree_a[-1], tree_b[-1])
    for level in range(LEVELS - 1, -1, -1):
        parents = wrong.select("file", F.col("place").alias("_above"))
        below = [t[level].withColumn("_above", F.floor(F.col("place") / FAN_OUT).cast("int")).join(
            parents, ["file", "_above"], "left_semi") for t in (tree_a, tree_b)]
        wrong = stage(differing(*below), "warc-differ")
    # Offsets of files with damage only: a file's records are few, the running sum stays in one small group.
    order = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tree_a[0].join(wrong.select("file").distinct(), "file", "left_semi").select(
        "file", "place", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("start"))
    fault = (F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra")
             .when(F.col("length_a") != F.col("length_b"), "length").otherwise("content"))
    return wrong.join(offsets, ["file", "place"], "left").select(
        "file", "place", "start", (F.col("start") + F.col("length_a")).alias("end"), fault.alias("fault"))


def damaged(archive: DataFrame) -> DataFrame:
    """A replica with faults by page id: every 97th record has a byte changed, every 211th is cut short, every 499th lost."""
    page, record = F.col("page_id"), F.col("record")
    return archive.where(F.coalesce(page % 499 != 3, F.lit(True))).withColumn(
        "record", F.when(page % 211 == 5, F.substring(record, 1, F.length(record) - 9))
        .when(page % 97 == 7, F.concat(F.substring(record, 1, F.length(record) - 5), F.lit("?"),
                                       F.substring(record, F.length(record) - 3, F.lit(4)))).otherwise(record))


def op9_warc_audit(spark, sf_dir: str) -> DataFrame:
    """All pages as WARC records, against a replica with known faults."""
    archive = lay_out(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    found = audit(archive, damaged(archive))
    ids = archive.select("file", "place", "page_id", F.octet_length("record").cast("long").alias("length"))
    return found.join(ids, ["file", "place"]).select(
        "page_id", "fault", (F.col("end") - F.col("start")).alias("length"))


OP9_SQL = r"""
SELECT page_id,
       CASE WHEN page_id % 499 = 3 THEN 'missing' WHEN page_id % 211 = 5 THEN 'length' ELSE 'content' END AS fault,
       strlen('WARC/1.1') + 2 + strlen('WARC-Type: resource') + 2 + strlen('WARC-Record-ID: <urn:page:') + strlen(page_id::VARCHAR)
       + strlen('>') + 2 + strlen('WARC-Date: 1970-01-01T00:00:00Z') + 2 + strlen('WARC-Target-URI: ') + strlen(coalesce(url, ''))
       + 2 + strlen('Content-Type: text/html') + 2 + strlen('Content-Length: ') + strlen(strlen(coalesce(html, ''))::VARCHAR)
       + 4 + strlen(coalesce(html, '')) + 4 AS length
FROM pages
WHERE page_id % 499 = 3 OR page_id % 211 = 5 OR page_id % 97 = 7
"""
