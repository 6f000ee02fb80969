"""Benchmark decontamination by templates: numbers (in digits of any script or in words), names and units become typed placeholders,
windows of templates are hash-joined, and what stands in the placeholders must agree."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.samples import free_names
from harvestry.llm.workers import map_batches
from harvestry.scratch import materialise

#: Words in a window, and the share of an item's windows that a document must show.
WINDOW, COVERAGE = 6, 0.4
#: Windows with fewer ordinary words than this are compared word for word.
MIN_PLAIN = 2
#: Bits of the filter that keeps windows of documents that no item has from being moved.
FILTER_BITS = 1 << 24
#: Distinct words kept by a process; beyond it, between texts, the table starts anew.
MAX_WORDS = 250_000

# Words for units of measure and money.
UNITS = frozenset(
    """
    mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres
    mg g kg t oz lb lbs gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds
    ml l cl dl liter liters litre litres gallon gallons cup cups
    s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years
    usd eur gbp dollar dollars cent cents euro euros percent degree degrees kmh mph
    """.split()
)
# Words for numbers; "second" is a unit.
NUMBER_WORDS = frozenset(
    """
    zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
    twenty thirty forty fifty sixty seventy eighty ninety hundred hundreds thousand thousands million millions billion billions dozen dozens
    first third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth
    twentieth thirtieth fortieth fiftieth sixtieth seventieth eightieth ninetieth hundredth thousandth millionth
    """.split()
)
ORDINAL_ENDS = frozenset((b"st", b"nd", b"rd", b"th"))
_UNITS, _NUMBER_WORDS = (frozenset(u.encode() for u in words) for words in (UNITS, NUMBER_WORDS))
_JOINTS, _DIGIT = re.compile(rb"[ -]+"), re.compile(r"\d")
#: What a word is: none of these, or a placeholder; a name at the head of a sentence is a word.
_WORD, _NUMBERS, _QUANTITIES, _UNIT, _NAME = range(5)
_KINDS = np.array([0, *(xxhash.xxh64_intdigest(k) for k in (b"<number>", b"<quantity>", b"<unit>", b"<name>"))], np.uint64)
#: Beside the kind: the word ends a sentence; it is a number that may go on; it may go on with one; it is the `and` in one.
_KIND_BITS, _ENDING, _STARTING, _GOING_ON, _BETWEEN = 7, 8, 16, 32, 64
#: First bytes of numbers and quantities, and last bytes of sentences.
_STARTS, _ENDS = frozenset(bytes([c]) for c in b"+-$0123456789"), frozenset((b".", b"!", b"?"))
_EDGE = b" \t\n\r.,;:!?()[]{}\"'`"
_NUMBER = re.compile(rb"[+-]?[$]?\d[\d.,:/]*%?")
_QUANTITY = re.compile(rb"([+-]?[$]?\d[\d.,:/]*)([a-z]+)", re.I)


def _ascii_digits(bare: bytes) -> bytes:
    """bare with the decimal digits of all scripts as 0 to 9."""
    text = bare.decode("utf-8", "replace")
    return _DIGIT.sub(lambda c: str(unicodedata.decimal(c[0])), text).encode() if _DIGIT.search(text) else bare


def _says_number(low: bytes) -> bool:
    """Whether all parts of a number of several words, at hyphens and spaces, are words for numbers (or, between them, numbers or `and`)."""
    parts = _JOINTS.split(low)
    return parts[-1] in _NUMBER_WORDS and all(p in _NUMBER_WORDS or p == b"and" or _NUMBER.fullmatch(p) for p in parts)


class Templates(dict):
    """Word bytes to a number, under which the hash of the word in lower case and a code of what it is are kept."""

    def __init__(self):
        super().__init__()
        self.hashes, self.codes = np.empty(MAX_WORDS, np.uint64), np.empty(MAX_WORDS, np.uint8)

    def read(self, text: bytes | None) -> tuple[list[bytes], np.ndarray]:
        """The words of a text, a number of several words as one, and their numbers here."""
        words = text.split() if text else []
        numbers = self.numbers(words)
        codes = self.codes[numbers]
        if not (codes & _GOING_ON).any():
            return words, numbers
        goes_on, starts, between = codes & _GOING_ON > 0, codes & _STARTING > 0, codes & _BETWEEN > 0
        joined = np.zeros(len(words), bool)  # with the word before
        joined[1:] = starts[:-1] & goes_on[1:]
        at = np.flatnonzero(between[1:-1] & starts[:-2] & goes_on[:-2] & goes_on[2:]) + 1
        joined[at] = joined[at + 1] = True
        if not joined.any():
            return words, numbers
        heads = np.flatnonzero(~joined).tolist()
        words = [b" ".join(words[a:b]) for a, b in zip(heads, [*heads[1:], len(words)], strict=True)]
        return words, self.numbers(words)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) + len(words) > MAX_WORDS:
            self.clear()  # between texts only: numbers stay valid inside one
        if len(words) > len(self.hashes):  # a single text with so many words
            self.hashes, self.codes = np.empty(2 * len(words), np.uint64), np.empty(2 * len(words), np.uint8)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def __missing__(self, word: bytes) -> int:
        if word.isalpha() and word.islower():  # of plain letters, as most words are
            low, code = word, _WORD
            if word in _NUMBER_WORDS:
                code = _NUMBERS | _STARTING | _GOING_ON
            elif word in _UNITS:
                code = _UNIT
            elif word == b"and":
                code = _BETWEEN
        else:
            low, code = self._looked_at(word)
        out = self[word] = len(self)
        self.hashes[out] = xxhash.xxh64_intdigest(low)
        self.codes[out] = code
        return out

    @staticmethod
    def _looked_at(word: bytes) -> tuple[bytes, int]:
        """A word in lower case without marks around it, and its code."""
        bare = word.strip(_EDGE)
        low = bare.lower()
        lead = bare[:1]
        code = _ENDING if word.rstrip(b"\"')]}")[-1:] in _ENDS else 0
        # beyond ASCII, decimal digits begin with U+0660, whose first byte is 0xD9
        said = bare if bare.isascii() or max(bare) < 0xD9 else _ascii_digits(bare)
        if low in _UNITS:
            return low, code | _UNIT
        in_words = low in _NUMBER_WORDS or ((b"-" in low or b" " in low) and _says_number(low))
        if in_words or said[:1] in _STARTS:
            q = _QUANTITY.fullmatch(said)
            if in_words or _NUMBER.fullmatch(said) or (q and q[2].lower() in ORDINAL_ENDS):
                code |= _NUMBERS | (_STARTING if word.endswith(bare) else 0)
                return low, code | (_GOING_ON if word.startswith(bare) and said[:1] not in _STARTS else 0)
            return low, code | (_QUANTITIES if q and q[2].lower() in _UNITS else _WORD)
        if not lead.islower():
            text = bare.decode("utf-8", "replace")
            if len(text) > 1 and text[0].isupper() and text[1:].islower():
                code |= _NAME
        return low, code


def _rolled(columns: list[np.ndarray], n: int) -> np.ndarray:
    out = np.full(n, len(columns), np.uint64)
    for h in columns:
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def windows(table: Templates, text: bytes | None, widths: list[int], both: bool = False, shorter: bool = False):
    """For each width, or for as many words as there are if these are fewer and shorter is given: (width, places, hashes, a function from an index of these to the words in the slots there).

    Whether a window's first word is at the head of a sentence depends on what stands before the
    window, which a copy elsewhere doesn't share. With both, windows whose first word looks like a
    name come a second time, with that word read the other way.
    """
    words, numbers = table.read(text)
    if not words:
        return
    if shorter:
        widths = [min(w, len(words)) for w in widths]
    literal, codes = table.hashes[numbers], table.codes[numbers]
    kinds = codes & _KIND_BITS
    slot_in, slot_head = kinds != _WORD, (kinds != _WORD) & (kinds != _NAME)
    inside = np.where(slot_in, _KINDS[kinds], literal)
    head = np.where(slot_head, inside, literal)
    first = np.concatenate([[True], codes[:-1] & _ENDING > 0])
    template, slot = np.where(first, head, inside), np.where(first, slot_head, slot_in)
    before = np.concatenate([[0], np.cumsum(~slot)])
    for width in widths:
        n = len(words) - width + 1
        if n < 1:
            continue
        plain = before[width : width + n] - before[:n]
        readings = [(np.arange(n), template, slot, plain)]
        if both and len(at := np.flatnonzero(slot_in[:n] != slot_head[:n])):
            readings.append((at, np.where(first, inside, head), np.where(first, slot_in, slot_head), plain[at] + np.where(first[at], -1, 1)))
        for at, lead, lead_slot, plain in readings:
            rows = slice(0, n) if len(at) == n else at
            exact = plain < min(MIN_PLAIN, width)
            hashes = _rolled([(template if k else lead)[k : k + n][rows] for k in range(width)], len(at))
            if len(only := at[exact]):
                hashes[exact] = _rolled([literal[only + k] for k in range(width)], len(only))

            def slots(j, width=width, at=at, exact=exact, lead_slot=lead_slot):
                i = at[j]
                return [] if exact[j] else [words[k].strip(_EDGE).lower().decode("utf-8", "replace") for k in range(i, i + width) if (slot if k > i else lead_slot)[k]]

            yield width, at, hashes.view(np.int64), slots


def _agreeing(met: Column) -> Column:
    """Places of the windows (at, pairs of values i of the item and d of the document) that agree on a one-to-one mapping."""
    pairs = F.array_distinct(F.flatten(met["pairs"]))
    one_each = (F.size(pairs) == F.size(F.array_distinct(pairs["i"]))) & (F.size(pairs) == F.size(F.array_distinct(pairs["d"])))

    def weighed(p):
        showing = F.size(F.filter(met, lambda w: F.array_contains(w["pairs"], p)))
        asked = F.size(F.filter(met, lambda w: F.exists(w["pairs"], lambda q: q["i"] == p["i"])))
        return F.struct((2 * showing > asked).alias("most"), showing.alias("n"), (p["i"] == p["d"]).alias("same"), p["i"].alias("i"), p["d"].alias("d"))

    def beaten(ps, p):
        return F.exists(ps, lambda q: ((q["i"] == p["i"]) | (q["d"] == p["d"])) & (F.struct(q["n"], q["same"], q["i"], q["d"]) > F.struct(p["n"], p["same"], p["i"], p["d"])))

    # the one-element arrays bind what is used more than once to a name, so that it is found once an alignment
    likely = F.transform(F.array(F.transform(pairs, weighed)), lambda ps: F.filter(ps, lambda p: p["most"] | p["same"]))
    good = F.transform(likely, lambda ps: F.transform(F.filter(ps, lambda p: ~beaten(ps, p)), lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d"))))
    rest = F.flatten(F.transform(good, lambda g: F.filter(met, lambda w: F.forall(w["pairs"], lambda p: F.array_contains(g, p)))))
    return F.when(one_each, met["at"]).otherwise(rest["at"])


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, body_hash, items, coverage) of the rows that hold a benchmark item, also with other
    numbers, names or units in it, wherever in a sentence it starts; body_hash is xxhash64 of the
    text (null: of nothing).

    A row holds an item if at least `coverage` of the item's windows are found that agree on what
    stands in each slot: along one alignment, a value of the item stands for itself or for the
    value of the document that it meets in more than half of its windows. Windows without slots
    always count, and a window in conflict takes no other with it. Items of fewer words than a window have one window, of all
    their words. Null and empty texts and items match nothing. Rows are told apart by id (null is
    one too) and text, so repeated rows share a verdict, given once. Other columns aren't read.

    Of the documents only windows that pass a filter of fixed size are moved, and the hash join
    that follows decides; it is left to adaptive execution to split a hot window.
    """
    items = benchmark.select(F.col("item_id").alias("item"), F.col("text").cast("binary").alias("body")).filter("item is not null and body is not null")

    def of_items(batches):
        table = Templates()
        for batch in batches:
            rows = []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for width, _, hashes, slots in windows(table, body.as_py(), [window], shorter=True):
                    rows += [(item, width, len(hashes), i, h, slots(i)) for i, h in enumerate(hashes.tolist())]
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["item", "width", "n", "at", "h", "slots"])

    wanted = materialise(map_batches(items, of_items, "item long, width int, n int, at int, h long, slots array<string>"), "windows")
    widths = sorted(r[0] for r in wanted.select("width").distinct().collect())  # window at most
    marks = wanted.select(F.pmod("h", F.lit(FILTER_BITS)).alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits"))
    field = np.zeros(FILTER_BITS // 64, np.int64)
    for row in marks.collect():  # FILTER_BITS / 64 rows at most
        field[row["w"]] = row["bits"]

    def of_docs(batches):
        table = Templates()
        for batch in batches:
            rows = []
            for i, body in enumerate(batch.column(2)):
                for _, places, hashes, slots in windows(table, body.as_py(), widths, both=True):
                    b = hashes % FILTER_BITS  # like pmod: numpy's remainder has the divisor's sign
                    for k in np.flatnonzero(field[b >> 6] >> (b & 63) & 1).tolist():
                        rows.append((i, int(places[k]), int(hashes[k]), slots(k)))
            if rows:
                i, at, h, s = zip(*rows, strict=True)
                ids = [batch.column(k).take(pa.array(i)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(at, pa.int32()), pa.array(h, pa.int64()), pa.array(s, pa.list_(pa.string()))], ["id", "body_hash", "d_at", "d_h", "d_slots"])

    base = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("body_hash"), F.col(text).cast("binary").alias("body"))
    hits = map_batches(base, of_docs, "id long, body_hash long, d_at int, d_h long, d_slots array<string>")
    met = hits.join(wanted, F.col("d_h") == F.col("h")).filter("size(slots) = size(d_slots)")
    window = F.struct("at", F.array_distinct(F.arrays_zip(F.col("slots").alias("i"), F.col("d_slots").alias("d"))).alias("pairs"))
    aligned = met.groupBy("id", "body_hash", "item", "n", (F.col("d_at") - F.col("at")).alias("shift")).agg(F.collect_set(window).alias("met"))
    agreeing = aligned.withColumn("places", _agreeing(F.col("met"))).filter(F.size("places") > 0)
    share = F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.first("n")
    found = agreeing.groupBy("id", "body_hash", "item").agg(share.alias("share")).filter(F.col("share") >= coverage)
    return found.groupBy("id", "body_hash").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("share").alias("coverage"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs, all columns and rows as they are, without the contaminated() ones."""
    i, h = free_names(docs, "id", "hash")
    found = contaminated(docs, benchmark, **how).select(F.col("id").alias(i), F.col("body_hash").alias(h))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(docs["text"]) == F.col(h))
    return docs.join(found.hint("shuffle_hash"), same, "left_anti")
