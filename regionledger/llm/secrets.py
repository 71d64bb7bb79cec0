"""Secret scan: base spans by pattern, weak parts linked to complementary parts nearby.

Strong spans (`assign`, `access`, `hex`) stand on their own. Weak parts - account names,
short keys and endpoints - are everyday text, so one is reported only if a part of a
complementary class lies within `scope` characters: a name needs a secret, a key needs a
name or an access identifier, an endpoint needs both. The link is an interval join:
parts are laid into cells of `scope` characters, each cell is summed up per class (first
start, last end) before anything is joined, and a part meets the cells its scope touches.
A cell cannot hold a part that ends before a scope and another that starts behind it, so
the two bounds decide exactly, and no pairs of parts are formed.

Only built-in functions are used. Positions are code points, ends exclusive. A null text
counts as empty; every input row gives one output row, so repeated rows and null or
repeated ids stay apart; columns other than the id and the text are not read; an empty
table gives an empty result. Parts of one text are bounded by that text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regionledger.sources import scratch

SCOPE = 200


def either_case(words: str) -> str:
    """The pattern with every ASCII letter in either case, and no other character."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() and c.isascii() else c for c in words)


_LINK = r"[\"']?\x20*[:=]\x20*[\"']?"


@dataclass(frozen=True)
class Part:
    kind: str
    #: What the part can stand for: name, secret or place.
    role: str
    strong: bool
    pattern: str
    #: Group whose length counts, and the least length.
    group: int
    least: int
    #: Strings of which a text must hold one to be searched (empty: a match of `pattern`).
    hints: tuple[str, ...]


PARTS = (
    Part("assign", "secret", True, f"({either_case('password|passwd|secret|token|api_?key')}){_LINK}([A-Za-z0-9+/_.=-]+)", 2, 6, ("=", ":")),
    # A run that is too short for a kind can't hold a longer match, so the length is in the pattern.
    Part("access", "name", True, "AKIA[A-Z0-9]{16,}", 0, 20, ("AKIA",)),
    Part("hex", "secret", True, "[0-9a-f]{24,}", 0, 24, ()),
    Part("name", "name", False, f"({either_case('user_?name|user|login|account|client_?id|key_?id')}){_LINK}([A-Za-z0-9_.@+-]+)", 2, 3, ("=", ":")),
    Part("key", "secret", False, f"({either_case('passphrase|passcode|pass|pwd|pin|auth|credential|private_?key|key')}){_LINK}([A-Za-z0-9+/_.=-]+)", 2, 4, ("=", ":")),
    Part("endpoint", "place", False, "(https?|ftp|postgres|mysql|mongodb|redis|ssh|amqp)://([A-Za-z0-9._~:/?#@!$&()*+,;=%-]+)", 2, 3, ("://",)),
)
KINDS = [p.kind for p in PARTS]


def _spans(p: Part) -> Column:
    """Matches in order: characters since the previous match, length, length that counts."""
    pattern = F.lit(p.pattern)
    gaps = F.transform(F.split("t", p.pattern), F.length)
    whole = F.transform(F.regexp_extract_all("t", pattern, F.lit(0)), F.length)
    counted = F.transform(F.regexp_extract_all("t", pattern, F.lit(p.group)), F.length) if p.group else whole
    worth = F.lit(False)
    for h in p.hints:
        worth = worth | F.contains(F.col("t"), F.lit(h))
    found = F.arrays_zip(gaps.alias("gap"), whole.alias("len"), counted.alias("counts"))
    return F.when((worth if p.hints else F.lit(True)) & F.rlike(F.col("t"), pattern), found)


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, parts): a numbered row per input row, and every part of every text.

    Rows are numbered and their matches written once, without the texts, so that a lost
    executor can't renumber them.
    """
    t = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    stored = scratch.materialise(t.select("rid", "doc_id", *[_spans(p).alias(p.kind) for p in PARTS]))
    each = Window.partitionBy("rid", "kind").orderBy("i")
    found = None
    for n, p in enumerate(PARTS):
        one = stored.where(F.col(p.kind).isNotNull()).select(
            "rid", F.lit(n).alias("kind"), F.posexplode(p.kind).alias("i", "m")
        )
        found = one if found is None else found.unionAll(one)
    ends = F.sum(F.col("m.gap") + F.coalesce(F.col("m.len"), F.lit(0))).over(each)
    least = F.element_at(F.array(*[F.lit(p.least) for p in PARTS]), F.col("kind") + 1)
    found = (
        found.withColumn("end", ends).where(F.col("m.counts") >= least)
        .select("rid", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end")
    )
    return stored.select("rid", "doc_id"), found


def _of(values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("kind") + 1)


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong parts, and the weak ones that have their complement within `scope`.

    A weak part that overlaps a strong one is part of that secret already and not listed.
    """
    found = found.withColumns({
        "role": _of([p.role for p in PARTS]), "strong": _of([p.strong for p in PARTS]),
    })
    order = Window.partitionBy("rid").orderBy("start", "kind")
    before = F.max(F.when(F.col("strong"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("strong"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    found = found.withColumns({"b": before, "a": after}).where(
        F.col("strong") | ((F.coalesce("b", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("a") >= F.col("end"), F.lit(True)))
    ).drop("a", "b")
    cell = lambda c: F.floor(c / scope)
    cells = found.withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end") - 1)))).groupBy(
        "rid", "cell", F.col("role").alias("other")
    ).agg(F.min("start").alias("from"), F.max("end").alias("to"))
    weak = found.where(~F.col("strong"))
    near = (
        weak.withColumn("cell", F.explode(F.sequence(cell(F.greatest(F.col("start") - scope, F.lit(0))), cell(F.col("end") - 1 + scope))))
        .join(cells, ["rid", "cell"])
        .where((F.col("other") != F.col("role")) & (F.col("from") <= F.col("end") + scope) & (F.col("to") >= F.col("start") - scope))
        .groupBy("rid", "kind", "start", "end", "role")
        .agg(F.max(F.col("other") == "name").alias("name"), F.max(F.col("other") == "secret").alias("secret"))
    )
    linked = near.where(
        F.when(F.col("role") == "name", F.col("secret"))
        .when(F.col("role") == "secret", F.col("name"))
        .otherwise(F.col("name") & F.col("secret"))
    )
    return found.where("strong").select("rid", "kind", "start", "end").unionAll(
        linked.select("rid", "kind", "start", "end")
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id and `found`, an array of (start, kind, end) in order.

    `kind` counts through KINDS.
    """
    rows, found = parts(docs, doc_id, text)
    spans = link(found, scope).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    return rows.join(spans, "rid", "left").select(
        "doc_id", F.coalesce("found", F.expr("CAST(array() AS array<struct<start: bigint, kind: int, end: bigint>>)")).alias("found")
    )


def redact(docs: DataFrame, spans: Column, mark: str = "[SECRET]") -> Column:
    """Text with every span of an array like `found` replaced (overlaps count once)."""
    kept = F.aggregate(
        spans, F.struct(F.lit("").alias("s"), F.lit(0).cast("bigint").alias("at")),
        lambda a, x: F.struct(
            F.when(x["start"] >= a["at"], F.concat(a["s"], F.substr(docs["text"], a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).otherwise(a["s"]).alias("s"),
            F.greatest(a["at"], x["end"]).alias("at"),
        ),
    )
    return F.concat(kept["s"], F.substr(docs["text"], kept["at"] + 1))
