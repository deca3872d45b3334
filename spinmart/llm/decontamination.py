"""Find benchmark questions in documents, also with other numbers, names and units.

Texts are read in several forms (``FORMS``). As words, each is its case-folded form without punctuation. As values, a
number or a unit turns into a typed placeholder. As templates, a name inside a sentence does so too, which is the only
form that looks at capitals: names with other values are found in texts that write them so. Placeholders of one kind
in a row are one slot, so "300" fits "three hundred", and a list of numbers one of another length. Every window of every form of the
benchmark is joined with those of the documents by hash. Matches of one document and item in one form on one
diagonal (same distance between their places) are put together; they count if they cover enough words in a row and if
the slots are consistent, each value of the item standing for one value of the document; two may stand for the same. Runs
made mostly of placeholders must be longer, see ``judge``; their verbatim copies are found as words.

A bitmap of fixed size, made from the benchmark's windows, spares nearly all document windows the join; what it lets
through by chance, the join removes.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import accumulate, chain, count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinmart.llm import ship_with_tasks
from spinmart.llm.blocks import hash_all, texts_of, window_hashes
from spinmart.llm.names import step_aside
from spinmart.operators.lookups import broadcast_if_small

WINDOW_WORDS = 8
# Words in a row that make a leak; a shorter item must be met nearly whole, its first word aside.
LEAK_WORDS = 13
# Items below this are too short to tell a leak from chance.
LEAST_ITEM_WORDS = 5
# Literals that a run needs at either end, in a window's words, or else in all. A nearly whole item needs a window's.
LEAST_LITERALS = 4
RUN_LITERALS = 7
BITMAP_BITS = 22
WORDS_KEPT = 1_000_000
# Bytes of text that are looked at together.
PIECE_BYTES = 2 << 20

LITERAL, NUMBER, UNIT, NAME = range(4)
# Which kinds are placeholders in each form.
WORDS, VALUES, TEMPLATE = range(3)
FORMS = {WORDS: (), VALUES: (NUMBER, UNIT), TEMPLATE: (NUMBER, UNIT, NAME)}
# Words read as numbers and as units.
NUMBER_WORDS = frozenset(
    b"zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy "
    b"eighty ninety hundred thousand million billion".split())
UNIT_WORDS = frozenset(
    b"mm cm m km meter meters metre metres inch inches foot feet yard yards mile miles mg g kg gram grams kilogram "
    b"kilograms pound pounds ounce ounces ml l liter liters litre litres gallon gallons second seconds minute minutes "
    b"hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree "
    b"degrees".split())

# ``place`` counts slots, which are words or placeholders; ``start`` and ``end`` are the words that the window covers.
WINDOW = "form int, width int, hash long, place int, start int, end int, slots array<string>"
WINDOW_COLUMNS = [c.split()[0] for c in WINDOW.split(", ")]


class Templates:
    """Template words of texts, remembered word by word."""

    def __init__(self) -> None:
        # Numbers with signs, separators, currency or a unit written on.
        self.number = regex.compile(rb"[+-]?[$]?\d+(?:[.,:/]\d+)*%?[a-z]{0,3}")
        self.edge = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
        self.forget()

    def forget(self) -> None:
        self.place: defaultdict[bytes, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.forms: list[bytes] = []
        self.hashes, self.kinds = np.zeros(0, np.uint64), np.zeros(0, np.int8)
        self.capital, self.closes = np.zeros(0, bool), np.zeros(0, bool)
        self.full = np.zeros(0, bool)

    def learn(self) -> None:
        new = list(islice(self.place, len(self.forms), None))
        if not new:
            return
        forms = [w.strip(self.edge).decode("utf-8", "replace").casefold().encode() for w in new]
        kinds = [NUMBER if f in NUMBER_WORDS or (f[:1] and (f[:1].isdigit() or f[:1] in b"+-$") and self.number.fullmatch(f))
                 else UNIT if f in UNIT_WORDS else LITERAL for f in forms]
        self.forms += forms
        self.hashes = np.concatenate([self.hashes, hash_all(forms)])
        self.full = np.concatenate([self.full, np.array(list(map(bool, forms)), bool)])
        self.kinds = np.concatenate([self.kinds, np.array(kinds, np.int8)])
        self.capital = np.concatenate([self.capital, np.array(
            [w.strip(self.edge).decode("utf-8", "replace")[:1].isupper() for w in new], bool)])
        self.closes = np.concatenate([self.closes, np.array([w.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":") for w in new],
                                                             bool)])

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers, kinds, words per text, which words begin a sentence); bare
        punctuation is no word."""
        if len(self.forms) > WORDS_KEPT:
            self.forget()
        number = self.place.__getitem__
        lists = [[number(w) for w in t.split()] if t else [] for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        words = np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum()))
        self.learn()
        opens = np.ones(len(words), bool)  # first word of a sentence
        opens[1:] = self.closes[words[:-1]]
        opens[(np.cumsum(counts) - counts)[counts > 0]] = True
        kinds = self.kinds[words]
        kinds[(kinds == LITERAL) & self.capital[words] & ~opens] = NAME
        full = self.full[words]
        row = np.repeat(np.arange(len(texts)), counts)[full]
        return words[full], kinds[full], np.bincount(row, minlength=len(texts)), opens[full]


def pieces(batch: pa.RecordBatch):
    """The batch in parts of about ``PIECE_BYTES`` of text."""
    sizes = [len(t or b"") for t in texts_of(pa.Table.from_batches([batch]))]
    at = np.cumsum(sizes, dtype=np.int64) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def windows_of(templates: Templates, texts: list[bytes | None], widths: dict[int, list[int]]):
    """For each form and width: the hashes of all windows in a row, and a function that gives, for chosen ones, the
    texts of those inside a text, the slots of each such text, and the rows of ``WINDOW``. Of slots, a row has the values
    of the placeholders, with place and kind."""
    words, all_kinds, word_counts, opens = templates(texts)
    word_starts = np.cumsum(word_counts) - word_counts
    text = np.repeat(np.arange(len(word_counts), dtype=np.int32), word_counts)
    literals = templates.hashes[words]
    marks = hash_all([b"", b" number", b" unit", b" name"])
    for form, listed in widths.items():
        placeholder = np.isin(range(4), FORMS[form])
        kinds = np.where(placeholder, np.arange(4), LITERAL).astype(np.int8)[all_kinds]
        held = np.flatnonzero(kinds)
        more = held[held > 0]
        more = more[(kinds[more] == kinds[more - 1]) & ~opens[more] & (text[more] == text[more - 1])]
        begins = np.ones(len(words), bool)
        begins[more] = False
        hashes = literals.copy()
        hashes[held] = marks[kinds[held]]
        hashes, first = hashes[begins], np.flatnonzero(begins)  # first words of the slots
        ends = np.append(first[1:], len(words))
        starts = np.searchsorted(first, word_starts)
        counts = np.diff(starts, append=len(first))

        def rows_of(chosen, width, form=form, kinds=kinds, first=first, ends=ends, starts=starts, counts=counts, hashes=None):
            a, z = first[chosen], ends[chosen + width - 1]
            within = text[a] == text[z - 1]
            chosen, hashes, a, z = chosen[within], hashes[within], a[within], z[within]
            row = text[a]

            def slots(i):
                return [f"{k} {kinds[first[i + k]]} " + b" ".join(
                    templates.forms[w] for w in words[first[i + k]:ends[i + k]].tolist()).decode("utf-8", "replace")
                        for k in np.flatnonzero(kinds[first[i:i + width]]).tolist()]

            return row, counts[row], [(form, width, *x, slots(i)) for *x, i in zip(
                hashes.view(np.int64).tolist(), (chosen - starts[row]).tolist(), (a - word_starts[row]).tolist(),
                (z - word_starts[row]).tolist(), chosen.tolist())]

        for width in listed:
            found = window_hashes(hashes, width)
            yield form, width, found, lambda chosen, found=found, width=width, rows_of=rows_of: rows_of(
                chosen, width, hashes=found[chosen])


WINDOW_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]


def arrays_of(windows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*windows)) if windows else [[]] * len(WINDOW_TYPES)
    return [pa.array(c, t) for c, t in zip(columns, WINDOW_TYPES)]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``item_words``, ``item_slots`` and the columns of ``WINDOW`` for every window of every item.

    A window has ``WINDOW_WORDS`` slots, or as many as the item has in that form if these are fewer."""

    def cut(batches):
        templates = Templates()
        for batch in chain.from_iterable(map(pieces, batches)):
            texts, owner, sizes, windows = texts_of(pa.Table.from_batches([batch])), [], [], []
            words = templates(texts)[2]
            for _, width, hashes, rows_of in windows_of(
                    templates, texts, {form: list(range(LEAST_ITEM_WORDS, WINDOW_WORDS + 1)) for form in FORMS}):
                rows, counts, found = rows_of(np.arange(len(hashes)))
                chosen = np.flatnonzero(np.minimum(counts, WINDOW_WORDS) == width).tolist()
                owner += rows[chosen].tolist()
                sizes += counts[chosen].tolist()
                windows += [found[i] for i in chosen]
            owner = np.array(owner, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(owner)), pa.array(words[owner], pa.int32()),
                 pa.array(sizes, pa.int32()), *arrays_of(windows)],
                names=["item_id", "item_words", "item_slots", *WINDOW_COLUMNS])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, item_words int, item_slots int, {WINDOW}")


def bitmap_of(windows: DataFrame) -> tuple[bytes, bytes]:
    """Bits of the low and of the high end of the benchmark's hashes: 1 MB at most, whatever the benchmark's size."""
    maps = []
    for bits in (F.col("hash").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)), F.shiftrightunsigned("hash", 64 - BITMAP_BITS)):
        found = np.zeros(1 << BITMAP_BITS, bool)
        for byte, mask in windows.select(bits.cast("int").alias("bit")).groupBy(
                F.shiftright("bit", 5).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 32)"))).collect():
            found[byte * 32:byte * 32 + 32] |= (mask >> np.arange(32) & 1).astype(bool)
        maps.append(np.packbits(found).tobytes())
    return maps[0], maps[1]


def document_windows(docs: DataFrame, maps: tuple[bytes, bytes], widths: dict[int, list[int]]) -> DataFrame:
    """``doc_id``, ``text_hash`` and the columns of ``WINDOW`` for windows that the bitmap lets through."""

    def cut(batches):
        templates = Templates()
        low, high = (np.unpackbits(np.frombuffer(m, np.uint8)).view(bool) for m in maps)
        mask, shift = np.uint64((1 << BITMAP_BITS) - 1), np.uint64(64 - BITMAP_BITS)
        for batch in chain.from_iterable(map(pieces, batches)):
            texts, owner, windows = texts_of(pa.Table.from_batches([batch])), [], []
            for _, _, hashes, rows_of in windows_of(templates, texts, widths):
                hit = np.flatnonzero(low[hashes & mask])
                rows, _, found = rows_of(hit[high[hashes[hit] >> shift]])
                owner += rows.tolist()
                windows += found
            owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_hash").take(owner), *arrays_of(windows)],
                names=["doc_id", "text_hash", *WINDOW_COLUMNS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        cut, f"doc_id {kind}, text_hash long, {WINDOW}")


class Last:
    """Where a value was last given something else than now."""

    def __init__(self) -> None:
        self.now: dict[str, tuple[str, int]] = {}
        self.other: dict[str, int] = {}

    def __call__(self, value: str, given: str, place: int) -> int:
        before, at = self.now.get(value, (given, -1))
        if before != given:
            self.other[value] = at
        self.now[value] = given, place
        return self.other.get(value, -1)


def judge(width: int, item_slots: int, matches: list[dict]) -> tuple[int, int, str] | None:
    """(item words in a row, first document word, kind) of the best run on a diagonal, None if it is no leak.

    A run is a range of slots within windows that match without a gap, with slots that do not contradict each other.
    It counts with ``LEAK_WORDS`` words in both texts and ``RUN_LITERALS`` literals; or with ``LEAK_WORDS`` slots, if the
    windows at its ends have ``LEAST_LITERALS`` of ``WINDOW_WORDS``; or if it lacks one slot of the item at most and has
    as many literals as one such window. The item has ``width`` slots at least."""
    best, same = (0, 0, 0), False
    at = {m["item_place"]: m for m in matches}
    for begin in sorted(p for p in at if p - 1 not in at):
        stop = next(p for p in count(begin) if p not in at)  # after the last window
        values: dict[int, tuple[str, str]] = {}
        next_light: dict[int, int] = {}
        for place in reversed(range(begin, stop)):
            match = at[place]
            values |= {place + int(a.split(" ", 1)[0]): (a.split(" ", 1)[1], b.split(" ", 1)[1])
                       for a, b in zip(match["item_values"], match["slots"])}
            light = (width - len(match["item_values"])) * WINDOW_WORDS >= LEAST_LITERALS * width
            next_light[place] = place if light else next_light.get(place + 1, stop)
        literals = [0, *accumulate(i not in values for i in range(begin, stop + width - 1))]
        left, there, found = begin, Last(), best
        for last in range(begin, stop + width - 1):
            if last in values:
                left = max(left, there(*values[last], last) + 1)
            size, tail = last - left + 1, last - width + 1
            if size < width:
                continue
            held, first = literals[last + 1 - begin] - literals[left - begin], left
            if held < RUN_LITERALS or min(at[tail]["item_end"] - at[left]["item_start"],
                                          at[tail]["end"] - at[left]["start"]) < LEAK_WORDS:
                if next_light[tail] == tail and last - next_light[left] + 1 >= LEAK_WORDS:
                    first = next_light[left]
                elif size < item_slots - 1 or held * 2 < min(size, WINDOW_WORDS):
                    continue
            found = max(found, (at[tail]["item_end"] - at[first]["item_start"], -first, last))
        if found > best:
            best = found
            start = at[-found[1]]["start"]
            same = all(a == b for i, (a, b) in values.items() if -found[1] <= i <= found[2])
    return (best[0], start, "verbatim" if same else "reparameterised") if best[0] else None


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item met in it: ``doc_id``, ``text_hash``, ``item_id``, ``matched_words``,
    ``item_words``, ``start_word`` and ``kind`` ("verbatim" or "reparameterised").

    A leak is a run of at least ``LEAK_WORDS`` words, or of a shorter item but its first or last word, with
    consistent slots and enough literals (``judge``). Items of fewer than ``LEAST_ITEM_WORDS`` words, and NULL or empty
    texts on either side, match nothing. ``text_hash`` tells rows with
    equal ids apart; repeated rows give one row. Other columns are not used.
    """
    items = benchmark_windows(benchmark)
    widths: dict[int, list[int]] = {}
    for form, width in sorted(map(tuple, items.select("form", "width").distinct().collect())):  # four widths a form at most
        widths.setdefault(form, []).append(width)
    listed = broadcast_if_small(items)
    hits = document_windows(docs, bitmap_of(listed), widths)
    pairs = hits.join(listed.select(
        "hash", "form", "width", "item_id", "item_words", "item_slots", F.col("place").alias("item_place"),
        F.col("start").alias("item_start"), F.col("end").alias("item_end"), F.col("slots").alias("item_values")),
        ["hash", "form", "width"]).dropDuplicates(["doc_id", "text_hash", "item_id", "form", "width", "place", "item_place"])
    keys = ["doc_id", "text_hash", "item_id", "item_words", "item_slots", "form", "width"]
    # A diagonal has at most one match per item word.
    grouped = pairs.withColumn("diagonal", F.col("place") - F.col("item_place")).groupBy(*keys, "diagonal").agg(
        F.collect_list(F.struct("item_place", "item_start", "item_end", "start", "end", "item_values", "slots")).alias("matches")
    ).drop("diagonal")

    def judged(batches):
        for batch in batches:
            found = [judge(w, n, m) for w, n, m in zip(*(batch.column(c).to_pylist() for c in (
                "width", "item_slots", "matches")))]
            rows = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            columns = list(zip(*[f for f in found if f])) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(rows) for c in ("doc_id", "text_hash", "item_id", "item_words")]
                + [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())],
                names=["doc_id", "text_hash", "item_id", "item_words", "matched_words", "start_word", "kind"])

    types = {f.name: f.dataType.simpleString() for f in grouped.schema}
    leaks = grouped.mapInArrow(judged, ", ".join(f"{c} {types[c]}" for c in keys[:4])
                               + ", matched_words int, start_word int, kind string")
    best = F.max_by(F.struct("matched_words", "start_word", "kind"),
                    F.struct("matched_words", (-F.col("start_word")).alias("first"), "kind"))
    return leaks.groupBy(*keys[:4]).agg(best.alias("_best")).select(*keys[:4], "_best.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, with their own columns, whatever their names."""
    docs, own = step_aside(docs, ("_leak", "_hash"))
    leaked = broadcast_if_small(
        find_leaks(docs, benchmark).select(F.col("doc_id").alias("_leak"), F.col("text_hash").alias("_hash")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("_leak")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(leaked, same, "left_anti").withColumnsRenamed(own)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                      spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_hash")


ship_with_tasks(__name__)
