"""Personal data: base patterns, and a semi-Markov conditional random field for the rest.

The field scores whole spans of words: a candidate segment's features are about the span as a whole (its
digits, its shape, checksums, an address spelled out) and the words before it. Dynamic programming over
segments of at most `MOST` words chooses boundaries and types jointly. It is trained by the
exact gradient of the segmentation's likelihood on examples made of words of a bounded sample of
documents and of personal data and look-alikes written by rule.

Only stretches around a word with a digit, an `@` or a spelled-out dot are decoded, whole, however
long (in overlapping pieces); segments elsewhere have no feature of a span and would be no entity.
Words over LONG_WORD code points are cut at marks first, so data in minified JSON or long URLs is
seen; spans over 200 code points have no features (no entity is that long). Spans of the field that overlap a base
span are dropped, so base spans stay as they are.

A null text counts as empty; every input row gives one output row; null and repeated ids
are kept; an empty table gives an empty result; other columns are not read. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionledger.llm import sample

BASE = ("email", "ip", "card", "phone")
#: Types of the field; the first is everything else.
LABELS = ("other", "email", "ip", "card", "phone", "id")
KINDS = BASE + tuple(f"crf_{x}" for x in LABELS[1:])
#: Most words of an entity, and words of context around a trigger.
MOST = 8
CONTEXT = 3
FIT_ROWS = 500
LONGEST = 1 << 16
EXAMPLES = 700
EPOCHS = 12

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A look-behind spares a retry at every digit of a run; a match never starts inside one.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    out = []
    at, done = t.find("@"), 0
    while at >= 0:
        start = at
        while start > done and t[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, 0, done))
        at = t.find("@", max(at + 1, done))
    if _DIGIT.search(t):
        for m in _IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in t:
            for m in _PHONE.finditer(t):
                if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


# Patterns and words of the features.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIGGER = re.compile(r"[0-9@]|[\[({<](dot|at)[\])}>]|^dot$", re.I)
#: Matches somewhere in every text that has a word `_TRIGGER` matches (and in more).
_ANY = re.compile(r"[0-9@]|[\[({<](dot|at)[\])}>]|dot", re.I)
#: Words of a stretch decoded at once; longer stretches are decoded in overlapping pieces.
STRETCH = 400
#: Words longer than this (minified data, long URLs) are cut at marks into pieces that are words of their own.
LONG_WORD = 200
_PIECE = re.compile(r"[^,;:\"'()\[\]{}<>|=&?/\\]+")
_JOINT = re.compile(r"[\[({<]?(dot|at|@)[\])}>]?", re.I)
_SHAPES = tuple(re.compile(p, re.I) for p in (
    r"[a-z0-9._%+-]+@[a-z0-9-]+(\.[a-z0-9-]+)+",
    r"[a-z0-9._%+-]+ ?[\[({<]?(at|@)[\])}>]? ?[a-z0-9-]+( ?[\[({<]?(dot|\.)[\])}>]? ?[a-z0-9-]+)+",
    r"[0-9]{1,3}(\.[0-9]{1,3}){3}",
    r"[0-9]{1,3}( ?[\[({<]?(dot|\.)[\])}>]? ?[0-9]{1,3}){3}",
    r"[0-9]{4}([ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}",
    r"(\+|00)[0-9]{1,3}[ ./()-]*[0-9]{1,5}([ ./()-]+[0-9]{2,5}){1,4}",
    r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    r"0[0-9]{2,4}[ /.-][0-9]{2,4}([ .-]?[0-9]{2,4}){1,3}",
    r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    r"[a-z]{2}[0-9]{2}( ?[a-z0-9]{4}){3,7}( ?[a-z0-9]{1,3})?",
    r"[0-9]+",
    r"[0-9]+([.,][0-9]+)+%?",
    r"[0-9]{1,4}[/.-][0-9]{1,2}[/.-][0-9]{1,4}",
    r"[a-z]*[0-9]+[a-z]+[a-z0-9]*",
))
_CUES = (
    frozenset("phone tel telephone call mobile cell fax dial whatsapp sms ring".split()),
    frozenset("email e-mail mail contact write reach".split()),
    frozenset("card visa mastercard amex credit debit payment".split()),
    frozenset("ssn social iban account passport id tax".split()),
    frozenset("ip host server address addr".split()),
    frozenset("version order page year room chapter section figure table no number".split()),
)
_DIGIT_STEPS = (0, 3, 6, 9, 12, 15, 19)
_EDGE = ".,;:!?()[]{}<>\"'"
N_FEATURES = 1 + 3 + len(_DIGIT_STEPS) + len(_SHAPES) + 3 + len(_CUES) + 2


def tokens(t: str, begin: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    """Words without marks at their ends, save an opening bracket or plus of a number.

    A word longer than LONG_WORD code points is cut at marks (`_PIECE`), and each piece is a word.
    """
    out = []
    for m in _WORD.finditer(t, begin, len(t) if end is None else end):
        a, b = m.span()
        pieces = [(a, b)] if b - a <= LONG_WORD else [p.span() for p in _PIECE.finditer(t, a, b)]
        for a, b in pieces:
            while b - a > 1 and t[b - 1] in _EDGE and not (t[b - 1] in ")]}>" and t[a] in "([{<"):
                b -= 1
            while b - a > 1 and t[a] in _EDGE and not (t[a] in "([{<" and (t[b - 1] in ")]}>" or t[a + 1].isdigit())):
                a += 1
            out.append((a, b))
    return out


def features(t: str, words: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Indexes of the features of the span of words i to j (exclusive)."""
    a, b = words[i][0], words[j - 1][1]
    s = t[a:b]
    n = j - i
    out = [0, 1 + min(n, 3) - 1]
    at = 4
    if b - a > 200:
        return out
    digits = "".join(c for c in s if "0" <= c <= "9")
    out.append(at + sum(len(digits) > x for x in _DIGIT_STEPS[:-1]))
    at += len(_DIGIT_STEPS)
    flat = re.sub(r"[ \t-\r]+", " ", s)
    out += [at + k for k, p in enumerate(_SHAPES) if p.fullmatch(flat)]
    at += len(_SHAPES)
    if len(digits) >= 13 and luhn(digits):
        out.append(at)
    if "@" in s:
        out.append(at + 1)
    if any(c.isalpha() for c in s):
        out.append(at + 2)
    at += 3
    before = {t[x:y].lower() for x, y in words[max(0, i - 3) : i]}
    out += [at + k for k, c in enumerate(_CUES) if before & c]
    at += len(_CUES)
    # An address that is spelled out goes on beside the span.
    if j < len(words) and _JOINT.fullmatch(t, *words[j]):
        out.append(at)
    if i and _JOINT.fullmatch(t, *words[i - 1]):
        out.append(at + 1)
    return out


def _lattice(t: str, words: list[tuple[int, int]]):
    """Per end j and length n the features of the segment, as index lists."""
    return [[features(t, words, j - n, j) for n in range(1, min(MOST, j) + 1)] for j in range(1, len(words) + 1)]


def _scores(lattice, weights: np.ndarray) -> list[np.ndarray]:
    """Per end a table of (length, label) scores; `other` has one word only."""
    out = []
    for row in lattice:
        s = np.array([weights[:, f].sum(1) for f in row])
        s[1:, 0] = -np.inf
        out.append(s)
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def decode(lattice, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation: (first word, label, end word) of every entity."""
    k = len(LABELS)
    best = [np.zeros(k)]
    back = []
    for j, s in enumerate(_scores(lattice, weights), 1):
        arrive = np.stack([(best[j - n][:, None] + (moves if j - n else np.zeros((k, k)))).max(0) if j - n else np.zeros(k) for n in range(1, len(s) + 1)])
        total = s + arrive
        back.append(total.argmax(0))
        best.append(total.max(0))
    out, j = [], len(lattice)
    label = int(best[j].argmax()) if j else 0
    while j:
        n = int(back[j - 1][label]) + 1
        if label:
            out.append((j - n, label, j))
        j -= n
        if j:
            label = int((best[j] + moves[:, label]).argmax())
    return out[::-1]


def _gradient(lattice, gold: list[tuple[int, int, int]], weights, moves, g_weights, g_moves) -> float:
    """Adds the gradient of one example's log-likelihood; returns the log-likelihood."""
    k, size = len(LABELS), len(lattice)
    s = _scores(lattice, weights)
    ahead = [np.zeros(k)]
    into = [None]
    for j in range(1, size + 1):
        arrive = [np.zeros(k) if j == n else _logsum(ahead[j - n][:, None] + moves, 0) for n in range(1, len(s[j - 1]) + 1)]
        into.append(arrive)
        ahead.append(_logsum(s[j - 1] + np.stack(arrive), 0))
    total = _logsum(ahead[size], 0)
    after = [None] * (size + 1)
    after[size] = np.zeros(k)
    for j in range(size - 1, -1, -1):
        follow = [s[j + n - 1][n - 1] + after[j + n] for n in range(1, min(MOST, size - j) + 1)]
        x = _logsum(np.stack(follow), 0)
        after[j] = _logsum(moves + x[None, :], 1) if j else x
        if j:
            p = np.exp(ahead[j][:, None] + moves + x[None, :] - total)
            g_moves -= p
    for j in range(1, size + 1):
        for n in range(1, len(s[j - 1]) + 1):
            p = np.exp(into[j][n - 1] + s[j - 1][n - 1] + after[j] - total)
            for f in lattice[j - 1][n - 1]:
                g_weights[:, f] -= p
    value, before = 0.0, None
    for i, label, j in gold:
        for f in lattice[j - 1][j - i - 1]:
            g_weights[label, f] += 1
        value += s[j - 1][j - i - 1][label]
        if before is not None:
            g_moves[before, label] += 1
            value += moves[before, label]
        before = label
    return float(value - total)


def _made(rng: random.Random, words: list[str]) -> tuple[int, str]:
    """A piece of personal data (label, text), or a look-alike with label 0."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: re.sub(r"[^a-z]", "", rng.choice(words).lower()) or "anna"
    kind = rng.randrange(14)
    if kind < 3:
        host = f"{w()}{rng.choice(['', '.' + w()])}.{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"
        name = f"{w()}{rng.choice(['', '.' + w(), d(2)])}"
        at, dot = rng.choice([("@", "."), (" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", ".")])
        return 1, f"{name}{at}{host.replace('.', dot)}"
    if kind < 4:
        return 2, rng.choice([".", " dot ", "[.]"]).join(str(rng.randrange(256)) for _ in range(4))
    if kind < 6:
        n = d(15)
        n += next(c for c in "0123456789" if luhn(n + c))
        return 3, rng.choice([" ", "-", "", "."]).join([n[:4], n[4:8], n[8:12], n[12:]])
    if kind < 9:
        return 4, rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"+{d(2)} {d(3)} {d(7)}", f"00{d(2)} {d(2)} {d(3)} {d(4)}", f"0{d(3)} {d(3)} {d(4)}", f"+1 ({d(3)}) {d(3)}-{d(4)}"])
    if kind < 10:
        return 5, rng.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{rng.choice(['DE', 'FR', 'ES'])}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}"])
    if rng.random() < 0.2:
        # The shape of a card, but not its checksum.
        n = d(15)
        n += rng.choice([c for c in "0123456789" if not luhn(n + c)])
        return 0, rng.choice([" ", "-", ""]).join([n[:4], n[4:8], n[8:12], n[12:]])
    return 0, rng.choice([
        str(rng.randrange(1900, 2030)), f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.{d(2)}", f"{d(2)}/{d(2)}/20{d(2)}", f"20{d(2)}-0{rng.randrange(1, 10)}-1{d(1)}", d(rng.randrange(1, 13)), f"{d(2)},{d(3)}",
        f"{d(2)}%", f"${d(3)}.{d(2)}", f"{w()}{d(2)}", f"{d(3)} dot {w()}", f"{d(4)}{w()}", f"{d(2)} {d(3)} {d(2)}", f"{d(8)}{w()}{d(6)}", f"{d(2)}:{d(2)}", f"@{w()}", f"dot {w()}",
    ])


def train(texts: list[str], examples: int = EXAMPLES, epochs: int = EPOCHS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (label, feature) and moves (label, label), by Adagrad on the exact gradient."""
    rng = random.Random(seed)
    words = [w for t in texts for w in t.split()] or ["and", "the"]
    cues = [sorted(c) for c in _CUES]
    fitting = {1: cues[1], 2: cues[4], 3: cues[2], 4: cues[0], 5: cues[3], 0: cues[5]}
    made = []
    for _ in range(examples):
        label, text = _made(rng, words)
        head = [rng.choice(words) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.3:
            head.append(rng.choice(fitting[label]))
        tail = [rng.choice(words) for _ in range(rng.randint(0, 3))]
        t = " ".join([*head, text, *tail])
        a = len(" ".join(head)) + bool(head)
        at = tokens(t)
        gold = []
        i = 0
        while i < len(at):
            j = i + 1
            if label and at[i][0] >= a and at[i][0] < a + len(text):
                while j < len(at) and at[j][0] < a + len(text):
                    j += 1
                gold.append((i, label, j))
            else:
                gold.append((i, 0, j))
            i = j
        if all(j - i <= MOST for i, _, j in gold):
            made.append((_lattice(t, at), gold))
    k = len(LABELS)
    weights, moves = np.zeros((k, N_FEATURES)), np.zeros((k, k))
    s_weights, s_moves = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    for _ in range(epochs):
        rng.shuffle(made)
        for b in range(0, len(made), 20):
            g_weights, g_moves = -1e-3 * weights, -1e-3 * moves
            for lattice, gold in made[b : b + 20]:
                _gradient(lattice, gold, weights, moves, g_weights, g_moves)
            s_weights += g_weights**2
            s_moves += g_moves**2
            weights += 0.3 * g_weights / np.sqrt(s_weights)
            moves += 0.3 * g_moves / np.sqrt(s_moves)
    return weights, moves


def field_spans(t: str, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the field's entities in a text.

    A text is looked at if any part of it could hold a trigger (`_ANY` matches a superset
    of what `_TRIGGER` finds in a word). A stretch of triggers is decoded whole, in pieces
    of at most `STRETCH` words that overlap by two entities and context: a piece keeps
    the entities that end before its overlap, and the next piece, which starts early
    enough to see any entity across that point whole, adds those after the last kept one.
    """
    if not _ANY.search(t):
        return []
    at = tokens(t)
    hits = [i for i, (a, b) in enumerate(at) if _TRIGGER.search(t[a:b])]
    out = []
    i = 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] - hits[j] <= 2 * CONTEXT:
            j += 1
        first, last = max(0, hits[i] - CONTEXT), min(len(at), hits[j] + CONTEXT + 1)
        start, done = first, first
        while True:
            end = min(last, start + STRETCH)
            part = at[start:end]
            for x, label, y in decode(_lattice(t, part), weights, moves):
                if start + x < done or (end < last and start + y > end - MOST):
                    continue
                out.append((part[x][0], len(BASE) + label - 1, part[y - 1][1]))
                done = start + y
            if end >= last:
                break
            start = max(start + 1, end - 2 * MOST - CONTEXT)
        i = j + 1
    out.sort()
    return out


def spans(t: str, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and the field's spans that overlap none of them nor each other."""
    base = base_spans(t)
    starts, top, tops = [b[0] for b in base], 0, []
    for b in base:
        top = max(top, b[2])
        tops.append(top)
    out, done = list(base), 0
    for a, kind, b in field_spans(t, weights, moves):
        k = int(np.searchsorted(starts, b)) - 1
        if a >= done and (k < 0 or tops[k] <= a):
            out.append((a, kind, b))
            done = b
    out.sort()
    return out


def fit(docs: DataFrame, text: str = "text", rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The field, trained on words of at most `rows` documents chosen by a hash of the text.

    Texts of more than `LONGEST` bytes are not in the sample; all are scanned.
    """
    t = docs.select(F.col(text).alias("t")).where(f"t != '' AND octet_length(t) <= {LONGEST}")
    return train([r["t"] for r in sample.smallest_hashes(t, "t", rows).collect()])


def scan(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and `found`, an array of (start, kind, end) in order, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                [{"start": a, "kind": k, "end": b} for a, k, b in spans(t.as_py() or "", *shared.value)] for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "found"])

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return t.mapInArrow(of, "doc_id long, found array<struct<start: long, kind: int, end: long>>")
