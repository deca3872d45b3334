"""Each operator beside a brute-force version, on edge rows, the small test tables and empty tables."""

import base64
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from spinmart.llm import bpe, jaccard_join, line_dedup, lm_scoring, quality_rules, sharding, substring_dedup
from spinmart.llm.blocks import pack, unpack, window_hashes
from spinmart.llm.components import connect

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(params=["edge", "small", "empty"])
def rows(request, edge):
    return edge if request.param == "edge" else [] if request.param == "empty" else request.getfixturevalue("rows_small")


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_rules(table, rows):
    got = quality_rules.build_ledger(table(rows)).withColumn("kept", ~quality_rules.fails(quality_rules.WEB_TEXT))
    names = list(quality_rules.MEASURES)
    want = []
    for i, t in rows:
        m = brute.quality(t)
        bits = brute.failed(m)
        want.append((i, *[m[n] for n in names], sum(b << k for k, b in enumerate(bits)), not any(bits)))
    assert bag(got.select("doc_id", *names, "fail_bits", "kept").collect()) == bag(want)


def test_rule_ablations(table, edge):
    ledger = quality_rules.build_ledger(table(edge))
    policies = (quality_rules.BASE, quality_rules.WEB_TEXT)
    bits = [r[0] for r in ledger.select("fail_bits").collect()]
    want = set()
    for p in policies:
        for rule in quality_rules.RULES:
            if rule.name in p.rules:
                own = [b & p.mask() for b in bits]
                want.add((p.name, p.version, rule.name, sum(b & rule.mask > 0 for b in bits),
                          sum(b == rule.mask for b in own), sum(b == 0 for b in own), sum(b & ~rule.mask == 0 for b in own)))
    assert {tuple(r) for r in quality_rules.ablations(ledger, policies).collect()} == want


def prose(n):
    """Words of which ever fewer are new, with numbers of their own now and then."""
    pick = random.Random(3)
    words = [f"w{int(2_600 * pick.random() ** 3)}" for _ in range(n)]
    return " ".join(w if i % 97 else f"{w} own{i}" for i, w in enumerate(words))


def test_long_clean_texts_are_kept(spark):
    """The pipeline's policy judges long texts as it judges their parts; poor ones still fail, short ones as before."""
    poor = " ".join(f"w{random.Random(k).randrange(500)}" for k in range(20_000))
    texts = [prose(5_000), prose(20_000), prose(60_000), poor, " ".join(poor.split()[:3_000])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ledger = quality_rules.build_ledger(docs, rules=quality_rules.RULES_2)
    want = [sum(len(set(w[i:i + 5_000])) for i in range(0, len(w), 5_000)) for w in map(str.split, texts)]
    assert [r[0] for r in ledger.orderBy("doc_id").select("n_window_distinct").collect()] == want
    old = {r.doc_id for r in ledger.where(~quality_rules.fails(quality_rules.WEB_TEXT)).collect()}
    new = {r.doc_id for r in ledger.where(~quality_rules.fails(quality_rules.WEB_TEXT_2, quality_rules.RULES_2)).collect()}
    assert (old, new) == ({0}, {0, 1, 2})
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == new


def test_bpe_equals_the_library(table, rows):
    ranks = bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode_texts(table(rows), PATH, public_tokenizers.PATTERN, decoded=True)
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert bag((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in got.collect()) == bag(want)
    back = bpe.decode_ids(got.select("doc_id", "ids"), PATH)
    assert bag((r[0], bytes(r[1])) for r in back.collect()) == bag((i, (t or "").encode()) for i, t in rows)


def test_bpe_with_ranks_out_of_order():
    """A vocabulary where a merge can bring up one of lower rank."""
    pick = random.Random(3)
    for _ in range(30):
        longer = {bytes(pick.choices(b"abc", k=pick.randint(2, 5))) for _ in range(40)}
        tokens = [bytes([b]) for b in range(256)] + pick.sample(sorted(longer), len(longer))
        ranks = {t: i for i, t in enumerate(tokens)}
        own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(pick.choices("abc", k=pick.randint(1, 14))) for _ in range(200)]
        got = bpe.Vocabulary(ranks).encode([w.encode() for w in words])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [own.encode_ordinary(w) for w in words]


def test_ranks_are_read_as_written():
    ranks = bpe.read_ranks(PATH)
    line = open(PATH, "rb").readline().split()
    assert ranks[base64.b64decode(line[0])] == int(line[1]) and len(ranks) == 50_256


def test_language_model(table, rows):
    got = lm_scoring.score_texts(table(rows)).collect()
    want = [(i, *x) for (i, _), x in zip(rows, brute.language_model(rows, lm_scoring.BIGRAM))]

    def rounded(found):
        return bag((*r[:5], round(r[5], 6), round(r[6], 6)) for r in found)

    assert rounded(got) == rounded(want)


def test_language_model_beats_unigrams_on_held_out_texts(spark, table, rows_small):
    held = lm_scoring.score_texts(table(rows_small)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_automaton_weights_sum_to_one(table):
    """Over all known words and one unknown, from every state."""
    rows = [(i, t) for i, t in [(1, "a b a c"), (3, "b c a"), (4, "c c")]]
    model = brute.language_model(rows, lm_scoring.BIGRAM)
    trained = [t for (_, t), m in zip(rows, model) if not m[0]]
    known = sorted({w for t in trained for w in t.split()})
    n, v = model[0][3], len(known) + 1
    uni = Counter(w for t in trained for w in [*t.split(), None])
    pairs = Counter(p for t in trained for p in zip(t.split(), [*t.split()[1:], None]))
    for state in known:
        total = sum(lm_scoring.BIGRAM * pairs[state, w] / uni[state] + (1 - lm_scoring.BIGRAM) * (uni[w] + 1) / (n + v + 1)
                    for w in [*known, None]) + (1 - lm_scoring.BIGRAM) / (n + v + 1)
        assert total == pytest.approx(1)


def same_components(rows, got):
    """Every row's set size and component, compared without relying on ids being unique."""
    roots, sizes = brute.components(rows)
    least = defaultdict(list)
    for (i, _), root in zip(rows, roots):
        least[root].append(i)
    want = [(i, n, min((x for x in least[root] if x is not None), default=None)) for (i, _), root, n in zip(rows, roots, sizes)]
    assert bag(got.select("doc_id", "n_shingles", "component_id").collect()) == bag(want)


def test_jaccard_join(table, rows):
    same_components(rows, jaccard_join.find_components(table(rows)))


def near_copies(sizes, copies, seed):
    """Texts with copies of rising distance, so that chains of links and near misses arise."""
    pick = random.Random(seed)
    rows = []
    for size in sizes:
        text = [f"w{pick.randrange(10_000)}" for _ in range(size)]
        for _ in range(copies):
            other = list(text)
            for _ in range(pick.randrange(1 + size // 12)):
                kind, at = pick.randrange(3), pick.randrange(len(other))
                if kind == 0:
                    other[at] = f"x{pick.randrange(10_000)}"
                elif kind == 1:
                    del other[at]
                else:
                    other.insert(at, f"y{pick.randrange(10_000)}")
                if len(other) < 3:
                    break
            rows.append((len(rows), " ".join(other)))
            if pick.random() < 0.5:
                text = other
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_finds_links_of_all_sizes(table, seed):
    rows = near_copies([4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 22, 28, 35, 47, 60, 80, 120, 200, 400], 14, seed)
    same_components(rows, jaccard_join.find_components(table(rows)))


def test_jaccard_join_of_a_common_passage_in_chunks(table, monkeypatch):
    """Many texts share a passage without linking, and lists are cut into several chunks."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 7)
    pick = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *[f"w{pick.randrange(9_000)}" for _ in range(pick.randint(4, 30))]])) for i in range(90)]
    rows += near_copies([45] * 3, 12, 9)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    same_components(rows, jaccard_join.find_components(table(rows)))


def test_jaccard_keep_one(table, edge):
    docs = table(edge)
    roots, sizes = brute.components(edge)
    groups = defaultdict(list)
    want = Counter()
    for row, root, n in zip(edge, roots, sizes):
        if n:
            groups[root].append(row)
        else:
            want[row] += 1
    got = bag(jaccard_join.keep_one(docs).select("doc_id", "text").collect())
    assert got - want == got - Counter({r: n for r, n in got.items() if not brute.shingles(r[1])})
    kept = [r for r in got.elements() if brute.shingles(r[1])]
    assert len(kept) == len(groups)
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        (one,) = [r for r in kept if r in members]
        assert one[0] == min(ids, default=None)


def test_every_pair_of_near_sets_shares_an_asked_segment():
    """The pigeonhole itself, without the index: some unit that one side asks in is listed by the other."""
    rows = near_copies([4, 6, 9, 13, 20, 33, 50, 90, 150], 8, 4)
    texts = [t.encode() for _, t in rows]
    sets = jaccard_join.Sets(texts)
    docs = np.flatnonzero(sets.n)
    found = jaccard_join.Entries(sets, docs)
    _, counts, place = found.index()
    asked = found.asked(counts[place])
    lists = {d: set(found.key[found.doc == d].tolist()) for d in docs.tolist()}
    asks = {d: set(found.key[(found.doc == d) & asked].tolist()) for d in docs.tolist()}
    for i in docs.tolist():
        for j in range(i):
            a, b = brute.shingles(rows[i][1]), brute.shingles(rows[j][1])
            if a != b and 100 * len(a & b) >= 80 * len(a | b):
                assert asks[i] & lists[j] or asks[j] & lists[i]


def test_components_of_chains(spark):
    pick = random.Random(1)
    links = [(i, i + 1) for i in range(60) if i % 13] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    pick.shuffle(links)
    parent = {n: n for pair in links for n in pair}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = connect(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {n: p for n, p in parent.items() if n != 200}


def test_line_dedup(table, rows):
    got = line_dedup.drop_common_lines(table(rows))
    want = [(i, n, n - len(kept), b"\n".join(kept).decode()) for (i, _), (n, kept) in zip(rows, brute.dropped_lines(rows))]
    assert bag(got.select("doc_id", "n_lines", "n_dropped", "text").collect()) == bag(want)
    assert "key" in got.columns


def test_line_index():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 5_000, dtype=np.uint64))
    index = line_dedup.LineIndex(keys, np.arange(1, len(keys) + 1))
    assert sorted(index.slots(keys)) == list(range(len(keys)))
    assert (index.probe(keys) == np.arange(1, len(keys) + 1)).all()
    others = np.random.default_rng(1).integers(0, 2**64, 5_000, dtype=np.uint64)
    assert not index.probe(np.setdiff1d(others, keys)).any()
    assert not line_dedup.LineIndex(keys[:0], np.zeros(0, np.int64)).probe(keys).any()


def test_substring_dedup(table, rows):
    got = substring_dedup.remove_earlier_passages(table(rows))
    want = [(i, n, gone, kept.decode()) for (i, _), (n, gone, kept) in zip(rows, brute.earlier_passages(rows))]
    assert bag(got.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == bag(want)


def test_substring_factors_name_their_reference(table, edge):
    texts = defaultdict(list)
    for i, t in edge:
        texts[i].append(brute.words_of(t))
    for r in substring_dedup.remove_earlier_passages(table(edge)).where("n_removed > 0").collect():
        covered = set()
        for f in r.factors:
            covered.update(range(f.start, f.start + f.words))
            assert f.words >= 50 and (r.doc_id is None or f.reference < r.doc_id)
        assert len(covered) == r.n_removed


@pytest.mark.parametrize("hot", [False, True])
def test_sharding(spark, table, rows, hot, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 7)
    if hot and rows:
        rows = [*rows, *[(10_000 + i, "the same text " * 40) for i in range(300)]]
    got = sharding.shard_by_bytes(table(rows)).collect()
    assert bag((r.doc_id, r["size"]) for r in got) == bag((i, len((t or "").encode()) + 1) for i, t in rows)
    slots, bytes_, places = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r["size"]
        places[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    assert all(len(p) == 1 for p in places.values())
    if rows:
        units = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
            "pmod(xxhash64(coalesce(text, '')), 65536) AS unit", "octet_length(coalesce(text, '')) + 1 AS size").groupBy(
            "unit").agg(F.sum("size")).collect()
        assert max(bytes_.values()) == brute.smallest_capacity([s for _, s in sorted(map(tuple, units))], 16)


def test_window_hashes_and_packing():
    words = np.random.default_rng(0).integers(0, 2**63, 200).astype(np.uint64)
    for width in (1, 2, 3, 5, 8, 50, 200):
        found = window_hashes(words, width)
        assert len(found) == 201 - width
        assert window_hashes(words[len(found) - 1:], width)[0] == found[-1]
    assert len(window_hashes(words, 201)) == 0
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 500, dtype=np.uint64))
    assert (unpack(pack(keys)) == keys).all()
