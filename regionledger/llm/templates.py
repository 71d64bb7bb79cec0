"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units are replaced by typed placeholders, the
values being kept as slots. Windows of `k` template words of the benchmark are joined to those of
the documents by hash. Matches of an item at one offset form an alignment; it counts if
its slots are consistent - a benchmark value always stands for the same document value and the other
way round - and its windows cover `COVER` of the item. So a question that was copied with
other numbers and names is found, and unrelated text that only shares the word pattern is not.

A benchmark of any size is used: its windows' bits (bounded) are sent to the tasks so that only
likely windows leave them, and what leaves is joined exactly.

With `whole` (the queries), windows are also keyed by their lower-cased words, values included, so copies
count in any case and at any share of literal words, alone or beside windows with other values. Texts are then
also read in a second way, in which neighbouring names, and neighbouring numbers with their units, are one
placeholder that holds the whole value, so that values of other lengths shift nothing. Numbers and units may get
values that others have as well; only names must map one to one. Document units are compared by their singular.

An item with fewer than `k` words is one window of its own length. Windows in which under half of
the words are literal are no evidence if their values differ. Null or blank texts and items match nothing; items or
documents that are repeated, or have null ids, count as rows of their own (results are
per text). Empty tables give no matches. Columns other than id and text are not read.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionledger.llm import sketch, words
from regionledger.sources import scratch

K = 8
COVER = 0.6
MAX_CELLS = 1 << 27

# Fixed word lists.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g gram grams kg kilogram kilograms ton tons tonne tonnes ounce ounces oz"
    " pound pounds lb lbs ml l liter liters litre litres gallon gallons cup cups second seconds sec minute minutes min hour hours hr day days"
    " week weeks month months year years km/h mph m/s kph degree degrees percent % cent cents dollar dollars euro euros usd eur gbp"
    " watt watts kw kwh volt volts amp amps hz khz mhz ghz kb mb gb tb byte bytes bit bits meter meters metre metres"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    " thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice"
).split()
#: Words that are no names although they open a sentence.
PLAIN = (
    "a an the this that these those he she it they we you i his her its their our your my there here what which who whom whose when where why how"
    " if then than and or but so as at by for from in into of on onto to with without after before during since until while because although"
    " is are was were be been has have had do does did can could will would shall should may might must not no yes all each every some any both"
    " find calculate compute determine suppose let given assume consider solve show prove explain describe name list write choose select answer question"
).split()
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:!?()[]{}\"'")] = True
_SINGULAR = {"feet": "foot", "inches": "inch"} | {u: u[:-1] for u in UNITS if u[-1] == "s" and u[:-1] in UNITS}
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x4E554D, 0x4E414D45, 0x554E4954))


def _prints(of: list[str]) -> np.ndarray:
    return next(words.chunks(pa.array([" ".join(of)]), True))[2].hashes


def _singulars() -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of plural units in order, and of their singulars."""
    plural, singular = _prints(list(_SINGULAR)), _prints(list(_SINGULAR.values()))
    order = np.argsort(plural)
    return plural[order], singular[order]


class Templates:
    """Template words of a chunk of texts, and the values their slots hold (0: literal)."""

    def __init__(self, w: words.Words, lists: tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]):
        units, numbers, plain, singulars = lists
        data, start, end = w.data, w.starts.copy(), w.ends.copy()
        for _ in range(3):
            start += _PUNCT[data[start]] & (end - start > 1)
            end -= _PUNCT[data[end - 1]] & (end - start > 1)
        own = w.prints(start, end)
        first, second = data[start], data[np.minimum(start + 1, end - 1)]
        digit = lambda x: (x >= 48) & (x <= 57)
        number = digit(first) | (np.isin(first, list(b"+-$")) & digit(second)) | np.isin(own, numbers)
        after = np.append(False, number[:-1])
        after[w.first[:-1][w.counts > 0]] = False
        unit = after & np.isin(own, units)
        upper = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        name = upper & ~number & ~unit & ~np.isin(own, plain)
        self.own, self.name = own, name
        # The own word, a unit in its singular.
        plural, singular = singulars
        self.seen = own.copy()
        found = np.minimum(np.searchsorted(plural, own), len(plural) - 1)
        at = np.flatnonzero((plural[found] == own) & ~name)
        self.seen[at] = singular[found[at]]
        self.slots = np.where(number | unit | name, own, np.uint64(0))
        self.tokens = np.select([number, unit, name], [NUMBER, UNIT, NAME], own)
        self.words, self.runs, self.sizes = w, False, np.ones(len(own), np.int64)

    def collapsed(self) -> Templates:
        """The same texts with each run of names, or of numbers and units, as one word."""
        out = copy.copy(self)
        w, n = self.words, len(self.own)
        name, unit = self.tokens == NAME, self.tokens == UNIT
        kind = np.where(self.slots == 0, 0, np.where(name, 1, 2))
        begin = np.ones(n, bool)
        begin[1:] = (kind[1:] == 0) | (kind[1:] != kind[:-1])
        begin[w.first[:-1][w.counts > 0]] = True
        at = np.flatnonzero(begin)
        size = np.diff(np.append(at, n))
        values = words.spanned(self.own, at, size)
        slot = kind[at] > 0
        units = np.append(0, np.cumsum(unit))
        token = np.where(kind[at] == 1, NAME, np.where(units[at + size] > units[at], UNIT, NUMBER))
        out.own, out.name = values, kind[at] == 1
        out.seen = words.spanned(self.seen, at, size)
        out.slots = np.where(slot, values, np.uint64(0))
        out.tokens = np.where(slot, token, values)
        out.words, out.runs, out.sizes = copy.copy(w), True, size
        out.words.first = np.searchsorted(at, w.first)
        return out

    def literal(self, at: np.ndarray, k: int) -> np.ndarray:
        """Whether half of the words are literal, those inside placeholders counted one by one."""
        all_words, plain = (np.append(0, np.cumsum(x)) for x in (self.sizes, self.slots == 0))
        return 2 * (plain[at + k] - plain[at]) >= all_words[at + k] - all_words[at]

    def windows(self, k: int, whole: bool) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
        """Whether windows are keyed by their own words, their positions, keys and fingerprints of their words.

        Those keyed by template are at least half literal; of the others, those without values are the same.
        """
        prints, inside = self.words.sequences(k, seed=int(self.runs), hashes=self.tokens)
        own, _ = self.words.sequences(k, seed=int(self.runs), hashes=self.own)
        literal = np.append(0, np.cumsum(self.slots == 0))
        share = np.zeros(len(inside), np.int64)
        m = max(0, len(inside) - k + 1)
        share[:m] = (literal[k:] - literal[:-k])[:m]
        at = np.flatnonzero(inside & (2 * share >= k))
        yield False, at, prints[at], own[at]
        if whole:
            at = np.flatnonzero(inside & (share < k))
            yield True, at, own[at], own[at]


_WINDOWS = "print long, a long, b long, pos int, n int, runs boolean, exact boolean, own_print long, slots array<long>, names array<boolean>, seen array<long>"


def _rows(
    t: Templates, exact: bool, at: np.ndarray, prints: np.ndarray, own: np.ndarray, k: int, a: np.ndarray, b: np.ndarray, item: bool, whole: bool
) -> pa.RecordBatch:
    w = t.words
    text = np.searchsorted(w.first, at, "right") - 1
    each = at[:, None] + np.arange(k)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(x[each].ravel()))
    none = lambda x: pa.nulls(len(at), pa.list_(x))
    if item:
        values = [lists(t.slots.view(np.int64)), lists(t.name), none(pa.int64())]
    else:
        values = [none(pa.int64()), none(pa.bool_()), lists((t.seen if whole else t.own).view(np.int64))]
    return pa.RecordBatch.from_arrays(
        [pa.array(prints.view(np.int64)), pa.array(a[text]), pa.array(b[text]), pa.array((at - w.first[text]).astype(np.int32)),
         pa.array(np.diff(w.first)[text].astype(np.int32)), pa.array(np.full(len(at), t.runs)), pa.array(np.full(len(at), exact)),
         pa.array(own.view(np.int64)), *values],
        ["print", "a", "b", "pos", "n", "runs", "exact", "own_print", "slots", "names", "seen"],
    )


def windows(texts: DataFrame, k: int, lengths: list[int], bits=None, cells: int = 0, whole: bool = False) -> DataFrame:
    """Template windows of a table (a, b, text): of `k` words, and of each of `lengths`.

    Items list `slots`, the values of their slots (0: literal), and which are `names`, documents `seen`, all words.

    A shorter window must be the whole text if there are no bits yet (a benchmark item);
    with bits, only windows whose bits are set are listed.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _prints(UNITS), _prints(NUMBERS), _prints(PLAIN), _singulars()
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            for i, j, w in words.chunks(batch.column("text"), lower=True):
                t = Templates(w, lists)
                for t in (t, t.collapsed()) if whole else (t,):
                    for length in [k, *lengths]:
                        for exact, at, prints, own in t.windows(length, whole):
                            if bits is not None:
                                m = sketch.holds(bits.value, prints, cells)
                            else:
                                m = t.words.counts[np.searchsorted(t.words.first, at, "right") - 1] == length
                                # A long item that is a few long values and little else is no template.
                                m = (length == k) | (m if exact else m & t.literal(at, length))
                            if m.any():
                                yield _rows(t, exact, at[m], prints[m], own[m], length, a[i:j], b[i:j], bits is None, whole)

    return texts.mapInArrow(of, _WINDOWS)


def matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", k: int = K, cover: float = COVER, whole: bool = False
) -> DataFrame:
    """(a, b, item, offset, covered, words, same): consistent alignments of items with texts.

    With `whole`, offset, covered and words of some alignments are in placeholders, each a whole value.

    a and b are two hashes of the document's text; `same` tells whether every slot has the
    benchmark's own value (a plain copy). Windows keyed by template decide alone or together with those
    keyed by their words (`whole`), so the latter can only add alignments.
    """
    spark = docs.sparkSession
    t = docs.select(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), F.col(text).alias("text"))
    items = benchmark.select(F.monotonically_increasing_id().alias("a"), F.col(item_id).cast("long").alias("item"), F.col("text"))
    items = scratch.materialise(items)
    of_items = scratch.materialise(windows(items.select("a", F.lit(0).cast("long").alias("b"), "text"), k, list(range(1, k)), whole=whole))
    lengths = [r[0] for r in of_items.where(F.col("n") < k).select("n").distinct().collect()]
    n = of_items.count()
    # 32 cells a benchmark window: of all document windows about 0.1 % pass the two rows by
    # chance (4 cells gave about 5 %, and every one of them crossed the network with its values).
    cells = sketch.cells_for(8 * n, MAX_CELLS)

    def listed(batches):
        for batch in batches:
            yield sketch.listed(batch.column("print").to_numpy().view(np.uint64), cells)

    bits = spark.sparkContext.broadcast(sketch.bits(of_items.select("print").distinct().mapInArrow(listed, sketch.LISTED), cells, 1))
    found = windows(t, k, lengths, bits, cells, whole)
    # Copies of a text count once, before anything is joined.
    found = scratch.materialise(found.groupBy("print", "a", "b", "pos").agg(F.first("seen").alias("seen"), F.first("own_print").alias("seen_print")))
    pairs = found.join(
        of_items.select(
            "print", F.col("a").alias("row"), F.col("pos").alias("at"), F.col("n").alias("words"), "runs", "exact", "own_print",
            F.col("slots").alias("own"), "names",
        ),
        "print",
    )
    slots = F.filter(F.arrays_zip("own", "names", "seen"), lambda x: x["own"] != 0)
    own = F.col("own_print") == F.col("seen_print")
    listed_at = lambda x: F.sort_array(F.collect_set(x("at")))
    values_of = lambda x: F.array_distinct(F.flatten(F.collect_set(x(slots))))
    template = lambda x: F.when(~F.col("exact"), x)
    every = lambda x: F.col(x) if isinstance(x, str) else x
    aligned = pairs.groupBy("a", "b", "row", "words", "runs", (F.col("pos") - F.col("at")).alias("offset")).agg(
        F.max(F.size("own")).alias("k"),
        *[
            F.struct(listed_at(x).alias("at"), values_of(x).alias("s"), F.min(x(own)).alias("same")).alias(name)
            for name, x in (("template", lambda c: template(every(c))), ("every", every))
        ],
    )
    covered = F.expr("aggregate(transform(e.at, (x, i) -> least(k, coalesce(get(e.at, i + 1) - x, k))), 0, (s, x) -> s + x)")
    return (
        aligned.withColumn("e", F.explode(F.array("template", "every") if whole else F.array("template")))
        .withColumn("covered", covered)
        .where((F.col("covered") >= cover * F.col("words")) & _consistent(F.col("e.s"), whole))
        .join(items.select(F.col("a").alias("row"), "item"), "row")
        .select("a", "b", "item", "offset", "covered", "words", "e.same")
    )


def _consistent(s: Column, whole: bool) -> Column:
    """Whether a benchmark value always stands for the same document value and the other way round (`whole`: names only)."""
    values = lambda x, c: F.size(F.array_distinct(F.transform(x, lambda y: y[c])))
    if not whole:
        return (values(s, "own") == F.size(s)) & (values(s, "seen") == F.size(s))
    names, others = F.filter(s, lambda x: x["names"]), F.filter(s, lambda x: ~x["names"])
    return (values(names, "own") == F.size(names)) & (values(names, "seen") == F.size(names)) & (values(others, "own") == F.size(others))


def mark(docs: DataFrame, found: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of every row with `items`, the sorted distinct items that it leaks, and `copied`."""
    keep = docs.columns if keep is None else keep
    leaks = found.groupBy("a", "b").agg(F.sort_array(F.collect_set("item")).alias("items"), F.min("same").alias("copied"))
    rows = docs.select(F.struct(*keep).alias("row"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    return rows.join(leaks, ["a", "b"], "left").select("row.*", F.coalesce("items", F.expr("CAST(array() AS array<bigint>)")).alias("items"), "copied")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", k: int = K, cover: float = COVER, whole: bool = False) -> DataFrame:
    """The rows of `docs` that leak no item."""
    found = scratch.materialise(matches(docs, benchmark, text, k=k, cover=cover, whole=whole).select("a", "b").distinct())
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    return rows.join(found, ["a", "b"], "left_anti").select("row.*")
