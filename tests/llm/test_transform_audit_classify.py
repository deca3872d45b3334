"""Fill-in-middle, filter audit and quality classifier beside brute-force versions."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from brute import sha
from pyspark.sql import functions as F

from spinmart.llm import filter_audit, fill_in_middle, quality_classifier
from spinmart.llm.fill_in_middle import Fenwick, Layout, Marks

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(params=["edge", "small", "empty"])
def rows(request, edge):
    return edge if request.param == "edge" else [] if request.param == "empty" else request.getfixturevalue("rows_small")


def bag(rows):
    return Counter(tuple(r) for r in rows)


# ---------------------------------------------------------------- fill in middle

def cut_one(doc_id, text, seed=7, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    p, s, m = marks
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    output = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    return len(units), form, len(prefix), len(middle), output


@pytest.mark.parametrize("options", [{}, {"seed": 3, "rate": 60, "spm": 0}, {"seed": 5, "spm": 100}])
def test_fill_in_middle(table, rows, options):
    rows = [*rows, (7_000, "a <P> b\nc"), (7_001, "\n"), (7_002, "é\n東\n\n京"), (-5, "x\ny"), (7_003, "<\nS>\n<P")]
    got = fill_in_middle.fill_in_middle(table(rows), **options)
    assert bag(got.collect()) == bag((i, *cut_one(i, t, **options)) for i, t in rows)
    back = got.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert bag(back.collect()) == bag((i, t or "") for i, t in rows)


def test_other_marks_and_marks_that_cannot_be_told_apart(table, edge):
    marks = Marks("[pre]", "[suf]", "[mid]")
    got = fill_in_middle.fill_in_middle(table(edge), marks=marks)
    assert bag(got.collect()) == bag((i, *cut_one(i, t, marks=("[pre]", "[suf]", "[mid]"))) for i, t in edge)
    back = got.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form"), marks).alias("text"))
    assert bag(back.collect()) == bag((i, t or "") for i, t in edge)
    for bad in (("", "b", "c"), ("a", "a", "c"), ("ab", "b", "c"), ("xa", "ay", "c"), ("aba", "c", "d")):
        with pytest.raises(ValueError):
            Marks(*bad)


@pytest.mark.parametrize("block", [1, 3, 16, 1024])
def test_cuts_by_descent_are_those_of_a_scan(block):
    pick = random.Random(block)
    for _ in range(60):
        text = "".join(pick.choices("aé東\n\n ", k=pick.randrange(60))).encode()
        units = re.findall(rb"[^\n]*\n|[^\n]+", text)
        layout = Layout(text, block)
        assert layout.n == len(units)
        for k in range(len(units) + 1):
            part = b"".join(units[:k])
            assert layout.cut(k) == (len(part), len(part.decode()))


def test_fenwick_tree():
    counts = np.random.default_rng(0).integers(0, 4, 37)
    tree, sums = Fenwick(counts), np.concatenate([[0], np.cumsum(counts)])
    assert [tree.before(k) for k in range(38)] == sums.tolist()
    for rank in range(1, int(sums[-1]) + 1):
        block, before = tree.descend(rank)
        assert before == sums[block] < rank <= sums[block + 1]


def test_long_text_is_cut_whole(table):
    text = "".join(f"line {i} é\n" for i in range(200_000))
    (row,) = fill_in_middle.fill_in_middle(table([(1, text)])).collect()
    assert tuple(row) == (1, *cut_one(1, text)) and sha(row.output.encode())


# ---------------------------------------------------------------- filter audit

def judge_one(rows):
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bits = [len(words) < 100, 100 * len(set(words)) < 80 * len(words),
                100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t),
                t in least and (i is None or least[t] < i)]
        out.append((i, len(words), len(set(words)), sum(b << k for k, b in enumerate(bits))))
    return out


def audit_brute(rows, parts, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    want = {}
    fails = [f for _, _, _, f in judge_one(rows)]
    for part in set(parts):
        docs = [(i, {c for k, c in enumerate("ABCDE") if f >> k & 1}) for (i, _), f, p in zip(rows, fails, parts) if p == part]
        total = Counter()
        for order in permutations("ABCDE"):
            gone = set()
            for step, c in enumerate(order):
                now = [(d, i) for d, (i, f) in enumerate(docs) if c in f and d not in gone]
                again = sum(c in f for d, (_, f) in enumerate(docs) if d in gone)
                gone |= {d for d, _ in now}
                total[c] += len(now)
                want[part, "".join(order), step + 1] = [
                    len(docs) - len(gone), len(now), again, sum(f == {c} for _, f in docs),
                    sum(i in good for _, i in now), sum(i in toxic for _, i in now)]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(total[order[step - 1]])
    return want


def shouted(rows):
    pick = random.Random(2)
    more = [(800 + k, " ".join(f"{pick.choice('ABCab')}{pick.randrange(300)}{pick.choice(['', '', '#'])}" for _ in range(150)))
            for k in range(20)]
    return [*rows, *more, *[(900 + k, more[k % 3][1]) for k in range(40)], (None, more[0][1]), (850, "Only Upper|CASE")]


def test_filter_audit(spark, table, rows):
    rows = shouted(rows) if rows else rows
    labels = [(i, (i or 0) % 2, int((i or 0) % 5 == 0)) for i, _ in rows if i is None or i % 3] + [(850, 0, 1), (850, 1, None)]
    docs = table(rows).withColumn("lang", F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("l"), F.col("doc_id") % 4)))
    matrix = filter_audit.build_matrix(docs)
    flags = filter_audit.judge(matrix)
    assert bag(flags.select("doc_id", "n_words", "n_distinct", "fails").collect()) == bag(judge_one(rows))
    found = filter_audit.attach_labels(flags, spark.createDataFrame(labels, LABELS))
    got = filter_audit.audit(found).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    parts = ["" if i is None or i % 4 == 0 else f"l{i % 4}" for i, _ in rows]
    assert {tuple(r)[:3]: list(r)[3:] for r in got.collect()} == audit_brute(rows, parts, labels)


def test_matrix_and_dictionary_hold_every_word(table, rows):
    matrix = filter_audit.build_matrix(table(rows), part=None, words=True).collect()
    terms = [(w.term, w.word) for r in matrix for w in r.words]
    named = dict(terms)
    assert len(named) == len(terms) == len({w for _, w in terms})
    got = []
    for r in matrix:
        for k, i in enumerate(r.doc_id):
            a, b = r.row_start[k:k + 2]
            assert r.term[a:b] == sorted(set(r.term[a:b]))
            got.append((i, frozenset(zip((named[t] for t in r.term[a:b]), r.n[a:b]))))
    want = [(i, frozenset(Counter(w.decode() for w in (t or "").encode().split()).items())) for i, t in rows]
    assert bag(got) == bag(want)


def test_given_orders_and_filters(spark):
    judged = spark.createDataFrame([("p", 1, True, False), ("p", 3, False, True), ("p", 0, True, True)],
                                   "part string, fails int, good boolean, toxic boolean")
    got = filter_audit.audit(judged, "XY", ["YX"]).orderBy("step").drop("part").collect()
    assert [tuple(r) for r in got] == [("YX", 1, 2, 1, 0, 0, 0, 1, 1), ("YX", 2, 1, 1, 1, 1, 1, 0, 3)]


# ---------------------------------------------------------------- quality classifier

def labelled_rows(n=400):
    """Prose of two vocabularies, and the same with symbols, capitals or a repeated line: quality 0."""
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(pick.choices("aeiou" if i % 2 else "rstlneaoi", k=pick.randint(2, 8))) for _ in range(pick.randint(30, 150))]
        kind = pick.choice(["prose"] * 3 + ["symbols", "capitals", "lines"])
        text = " ".join(words)
        if kind == "symbols":
            text = " ".join(w + pick.choice(["##", "$$", ""]) for w in words)
        elif kind == "capitals":
            text = text.upper()
        elif kind == "lines":
            text = "\n".join([" ".join(words[:6])] * 20)
        rows.append((i, text))
        labels.append((i, int(kind == "prose"), 0))
    return rows, labels


def test_quality_is_learned(spark, table):
    rows, labels = labelled_rows()
    got = quality_classifier.classify(table([*rows, (None, None), (5_000, ""), (1, rows[1][1])]),
                                      spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1)], LABELS)).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(truth[r.doc_id] == r.predicted for r in held) >= 0.97 * len(held) and len(held) > 100
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len(got) == len(rows) + 3 and len({r.score for r in got if r.doc_id == 1}) == 1
    import zlib
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in got)


def test_held_out_labels_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    got = quality_classifier.op13_quality_classifier(spark, folder).where("held_out")
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "predicted", "quality").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.98 * len(rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    above = sum((a > b) + (a == b) / 2 for a in good for b in bad)
    assert above >= 0.99 * len(good) * len(bad)


def test_held_out_labels_are_not_used(spark, table):
    rows, labels = labelled_rows(200)
    held = quality_classifier.held_out_rows()
    table_of = spark.createDataFrame(labels, LABELS)
    other = table_of.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    both = [quality_classifier.classify(table(rows), x).select("doc_id", "score").collect() for x in (table_of, other)]
    assert bag(both[0]) == bag(both[1])


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_no_labels_and_labels_of_one_kind(spark, table, edge, quality):
    labels = [] if quality is None else [(i, quality, 0) for i, _ in edge if i is not None]
    got = quality_classifier.classify(table(edge), spark.createDataFrame(labels, LABELS)).collect()
    assert {round(r.score, 3) for r in got} == {0.5 if quality is None else quality}
    assert not quality_classifier.classify(table([]), spark.createDataFrame(labels, LABELS)).collect()


def test_normal_equations_are_those_of_all_rows_however_cut(spark, table):
    rows, labels = labelled_rows(150)
    stats = quality_classifier.document_statistics(table(rows))
    train = quality_classifier.labelled(stats, spark.createDataFrame(labels, LABELS))
    drawn = quality_classifier.Cosines.draw(*quality_classifier.standardisation(stats), n=24)
    one, many = (quality_classifier.normal_equations(train.repartition(n), drawn) for n in (1, 7))
    assert all((a == b).all() for a, b in zip(one, many))
    local = train.collect()
    z = drawn.of(np.array([r.stats for r in local], np.float32).astype(float)) / quality_classifier.UNIT
    y, fold = np.array([r.label for r in local]), np.array([r.fold for r in local])
    for k in range(quality_classifier.FOLDS):
        mine = fold == k
        assert np.allclose(one[0][k], z[mine].T @ z[mine]) and np.allclose(one[1][k], y[mine] @ z[mine])
        assert one[2][k] == mine.sum()


def test_cosines_approximate_the_kernel():
    pick = np.random.default_rng(1)
    x = pick.standard_normal((40, 15))
    drawn = quality_classifier.Cosines.draw(np.zeros(15), np.ones(15), n=8192)
    z = drawn.of(x)[:, :-1] / quality_classifier.UNIT
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    spread = quality_classifier.BANDWIDTH ** 2 * 15
    assert np.abs(2 / 8192 * z @ z.T - np.exp(-distance / (2 * spread))).max() < 0.06


def test_isotonic_regression():
    pick = np.random.default_rng(2)
    for _ in range(50):
        n = int(pick.integers(1, 12))
        y, w = pick.integers(0, 5, n) / 4, pick.integers(1, 6, n).astype(float)
        mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
        want = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(quality_classifier.pool(y, w), want)


def test_words_are_hashed_as_they_are_split(monkeypatch):
    """Equal words have one hash wherever they stand, others differ, in chunks of any size."""
    pick = random.Random(6)
    texts = [" ".join("".join(pick.choices("abAB é#", k=pick.randint(0, 5))) for _ in range(pick.randrange(40))) for _ in range(60)]
    texts = [t.encode() for t in [*texts, "", "\n\t", "x" * 3_000, "ab" * 700 + " " + "ba" * 700, "ab ba abab baba"]] + [None]
    for size in (1, 50, 1 << 18):
        monkeypatch.setattr(filter_audit, "CHUNK", size)
        terms = filter_audit.Terms(texts, words=True)
        assert terms.counts.tolist() == [len((t or b"").split()) for t in texts]
        flat = [w for t in texts if t for w in t.split()]
        assert [terms.words[i] for i in terms.places.tolist()] == flat and len(terms.key) == len(set(flat))
        assert (np.diff(terms.key.astype(object)) > 0).all()
