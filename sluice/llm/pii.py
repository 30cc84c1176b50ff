"""Personal data by patterns and a linear-chain conditional random field.

Patterns find the base spans. The field tags tokens by the shapes of the words around them, so it also finds
what is written like personal data but fails a pattern or its check: a number without its plus sign, a
card with a wrong digit, an address with an odd ending. It is trained from a small labelled table: stretches
of some documents, tagged by their base spans. Decoding is by Viterbi over many stretches at once.

Personal data has a digit or an at sign, so a sequence of the field is the stretch of a text within
``AROUND`` characters of one; stretches that touch are one sequence. What lies outside is not tagged. All of
a text is searched for them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows

KINDS = ("email", "ip", "card", "phone")
# Bounds of the labelled table: documents, stretches with and without base spans, characters of a stretch.
ROWS, WINDOWS, LONGEST = 4_000, 1_200, 600
AROUND, MOST_TOKENS = 40, 1_024

_LOCAL = "A-Za-z0-9._%+-"
# The part before the at sign begins where its run does, or where the last match ended, so runs are read once.
_AT = re.compile(rf"(?<![{_LOCAL}])[{_LOCAL}]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


# Base spans


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right is doubled and its digits are summed."""
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for match in _AT.finditer(text):
        start, at = max(match.start(), end), match.end() - 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts):
            yield match.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 10 <= sum("0" <= char <= "9" for char in match[0]) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span, by start, then by kind as listed."""
    found = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    if text.count(".") > 2:
        found += [(start, 1, end) for start, end in _ips(text)]
    found += [(start, 2, end) for start, end in _cards(text)]
    if "+" in text:
        found += [(start, 3, end) for start, end in _phones(text)]
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# Stretches, tokens and their shapes

_TRIGGER = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
OUTSIDE = 0
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
# What may follow what: the inside of a kind only its begin or its inside.
ALLOWED = np.ones((LABELS, LABELS), bool)
for _kind in range(len(KINDS)):
    ALLOWED[:, 2 + 2 * _kind] = False
    ALLOWED[1 + 2 * _kind : 3 + 2 * _kind, 2 + 2 * _kind] = True
MAY_START = np.array([label % 2 == 1 or label == OUTSIDE for label in range(LABELS)])


def stretches(text: str) -> list[tuple[int, int]]:
    """Extents of the parts of a text that are decoded; a word is cut at most at a border of ``AROUND`` more characters."""
    found: list[list[int]] = []
    for match in _TRIGGER.finditer(text):
        start, end = match.start() - AROUND, match.end() + AROUND
        if found and start <= found[-1][1]:
            found[-1][1] = end
        else:
            found.append([start, end])
    widened = []
    for start, end in found:
        start, end = max(start, 0), min(end, len(text))
        least, most = max(start - AROUND, 0), min(end + AROUND, len(text))
        while start > least and text[start - 1].isalnum():
            start -= 1
        while end < most and text[end].isalnum():
            end += 1
        if widened and start <= widened[-1][1]:
            start = widened.pop()[0]
        widened.append((start, end))
    return widened


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [match.span() for match in _TOKEN.finditer(text, start, end)]


def shape(word: str) -> str:
    """Digits by their number, words by case and length, marks as they are."""
    first = word[0]
    if "0" <= first <= "9":
        return f"d{min(len(word), 20)}{'s' if len(word) < 3 or (len(word) == 3 and word <= '255') else ''}"
    if not first.isalpha():
        return first
    case = "x" if word.islower() else "X" if word.isupper() else "Xx" if word[1:].islower() else "xX"
    return f"{case}{min(len(word), 4)}{'' if word.isascii() else 'u'}"


_EDGE = "^"


def contexts(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, ...]]:
    """Per token the shapes of the two before it, of itself and of the two after it, each with the gap before it."""
    shapes, before = [_EDGE, _EDGE], spans[0][0] if spans else 0
    for start, end in spans:
        gap = "" if start == before else "/" if "\n" in text[before:start] else "_"
        shapes.append(gap + shape(text[start:end]))
        before = end
    shapes += [_EDGE, _EDGE]
    return list(zip(shapes, shapes[1:], shapes[2:], shapes[3:], shapes[4:], strict=False))


def features(context: tuple[str, ...]) -> list[str]:
    a, b, c, d, e = context
    return [
        f"0 {c}", f"-1 {b}", f"+1 {d}", f"-2 {a}", f"+2 {e}", f"-1 0 {b} {c}", f"0 +1 {c} {d}", f"-1 +1 {b} {d}",
        f"-2 -1 0 {a} {b} {c}", f"0 +1 +2 {c} {d} {e}",
    ]


def tags(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """The labels that base spans give tokens: those wholly inside one, of overlapping spans the first."""
    found, at = [], 0
    inside: tuple[int, int, int] | None = None
    for start, end in spans:
        while at < len(base) and base[at][2] <= start:
            at += 1
        span = base[at] if at < len(base) and base[at][0] <= start and end <= base[at][2] else None
        found.append(OUTSIDE if span is None else 1 + 2 * span[1] + (span == inside))
        inside = span
    return found


# The field


@dataclass
class Field:
    """Weights of features per label, of one label after another, and of first labels."""

    names: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, LABELS)))
    follows: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(LABELS))

    def __bool__(self) -> bool:
        return bool(self.names)

    def scores(self, found: list[tuple[str, ...]]) -> np.ndarray:
        """A row of scores per context."""
        known = [[self.names[name] for name in features(one) if name in self.names] for one in found]
        rows = np.repeat(np.arange(len(known)), [len(ids) for ids in known])
        ids = np.fromiter((i for one in known for i in one), np.int64, len(rows))
        picked = self.weights[ids]
        return np.stack([np.bincount(rows, picked[:, label], len(known)) for label in range(LABELS)], axis=1)


_NEVER = -1e30


def viterbi(emissions: np.ndarray, lengths: np.ndarray, model: Field) -> np.ndarray:
    """The best labels of padded sequences, whose scores are ``(sequence, place, label)``."""
    count, longest, _ = emissions.shape
    follows = np.where(ALLOWED, model.follows, _NEVER)
    best = emissions[:, 0] + np.where(MAY_START, model.first, _NEVER)
    came = np.zeros((count, longest, LABELS), np.int8)
    came[:] = np.arange(LABELS)
    for place in range(1, longest):
        going = lengths > place
        ways = best[going][:, :, None] + follows
        came[going, place] = ways.argmax(axis=1)
        best[going] = ways.max(axis=1) + emissions[going, place]
    labels = np.zeros((count, longest), np.int8)
    labels[:, -1] = best.argmax(axis=1)
    every = np.arange(count)
    for place in range(longest - 1, 0, -1):
        # Past a sequence's end each label comes of itself.
        labels[:, place - 1] = came[every, place, labels[:, place]]
    return labels


def _marginals(weights: np.ndarray, model: Field, ids: np.ndarray, lengths: np.ndarray):
    """Log of the total weight, and the expected labels, pairs and first labels of padded sequences."""
    count, longest = ids.shape
    top = weights.max(axis=1)
    factors = np.exp(weights - top[:, None])
    steps = np.exp(model.follows) * ALLOWED
    present = np.arange(longest) < lengths[:, None]
    local = factors[ids]
    ahead = np.zeros((count, longest, LABELS))
    scale = np.ones((count, longest))
    ahead[:, 0] = local[:, 0] * np.exp(model.first) * MAY_START
    for place in range(longest):
        if place:
            ahead[:, place] = (ahead[:, place - 1] @ steps) * local[:, place]
        scale[:, place] = ahead[:, place].sum(axis=1)
        ahead[:, place] /= scale[:, place, None]
    back = np.ones((count, longest, LABELS))
    pairs = np.zeros((LABELS, LABELS))
    for place in range(longest - 1, 0, -1):
        message = local[:, place] * back[:, place] / scale[:, place, None]
        ends = ~present[:, place]
        before = message @ steps.T
        before[ends] = 1.0
        back[:, place - 1] = before
        message[ends] = 0.0
        pairs += (ahead[:, place - 1].T @ message) * steps
    total = (np.log(scale) + top[ids])[present].sum()
    return total, ahead * back * present[:, :, None], pairs


def fit(sequences: list[tuple[list[tuple[str, ...]], list[int]]], *, ridge: float = 0.5, rounds: int = 60) -> Field:
    """A field of the greatest penalised likelihood of tagged sequences, by limited-memory quasi-Newton steps.

    Without a tagged token there is nothing to learn: the field is empty and tags nothing.
    """
    sequences = [(found, labels) for found, labels in sequences if found]
    if not any(label for _, labels in sequences for label in labels):
        return Field()
    sequences.sort(key=lambda one: (len(one[0]), one))
    numbers: dict[tuple[str, ...], int] = {}
    names: dict[str, int] = {}
    for found, _ in sequences:
        for one in found:
            numbers.setdefault(one, len(numbers))
    for one in numbers:
        for name in features(one):
            names.setdefault(name, len(names))
    by_context = np.array([[names[name] for name in features(one)] for one in numbers])
    batches = []
    observed, observed_pairs, observed_first = np.zeros((len(numbers), LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    for at in range(0, len(sequences), 128):
        part = sequences[at : at + 128]
        lengths = np.array([len(found) for found, _ in part])
        ids = np.zeros((len(part), lengths.max()), np.int64)
        for row, (found, labels) in enumerate(part):
            ids[row, : len(found)] = [numbers[one] for one in found]
            np.add.at(observed, (ids[row, : len(found)], labels), 1)
            np.add.at(observed_pairs, (labels[:-1], labels[1:]), 1)
            observed_first[labels[0]] += 1
        batches.append((ids, lengths))
    sizes = (len(names) * LABELS, LABELS * LABELS, LABELS)

    def parts(vector: np.ndarray) -> Field:
        weights, follows, first = np.split(vector, np.cumsum(sizes)[:-1])
        return Field(names, weights.reshape(-1, LABELS), follows.reshape(LABELS, LABELS), first)

    def loss(vector: np.ndarray) -> tuple[float, np.ndarray]:
        model = parts(vector)
        weights = model.weights[by_context].sum(axis=1)
        total, expected, pairs, first = 0.0, np.zeros_like(observed), np.zeros_like(observed_pairs), np.zeros(LABELS)
        for ids, lengths in batches:
            found, labels, moves = _marginals(weights, model, ids, lengths)
            total += found
            pairs += moves
            first += labels[:, 0].sum(axis=0)
            for label in range(LABELS):
                expected[:, label] += np.bincount(ids.ravel(), labels[:, :, label].ravel(), len(numbers))
        told = (observed * weights).sum() + (observed_pairs * model.follows).sum() + (observed_first * model.first).sum()
        wrong = expected - observed
        slope = np.stack(
            [np.bincount(by_context.ravel(), np.repeat(wrong[:, label], by_context.shape[1]), len(names)) for label in range(LABELS)],
            axis=1,
        )
        gradient = np.concatenate([slope.ravel(), (pairs - observed_pairs).ravel(), first - observed_first])
        return total - told + ridge / 2 * vector @ vector, gradient + ridge * vector

    return parts(_least(loss, np.zeros(sum(sizes)), rounds))


def _least(loss, at: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Where a smooth convex function is least, about: limited-memory quasi-Newton steps, halved until they descend."""
    value, gradient = loss(at)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, shares = gradient.copy(), []
        for step, turn, inner in reversed(pairs):
            shares.append(step @ way / inner)
            way -= shares[-1] * turn
        if pairs:
            step, turn, inner = pairs[-1]
            way *= inner / (turn @ turn)
        else:
            way /= max(np.linalg.norm(way), 1.0)
        for (step, turn, inner), share in zip(pairs, reversed(shares), strict=True):
            way += (share - turn @ way / inner) * step
        falls, size = way @ gradient, 1.0
        while size > 1e-6:
            new = at - size * way
            new_value, new_gradient = loss(new)
            if new_value <= value - 1e-4 * size * falls:
                break
            size /= 2
        else:
            return at
        step, turn = new - at, new_gradient - gradient
        if step @ turn > 1e-10:
            pairs = [*pairs[-(memory - 1) :], (step, turn, step @ turn)]
        done = abs(value - new_value) < 1e-5 * max(abs(value), 1.0)
        at, value, gradient = new, new_value, new_gradient
        if done:
            break
    return at


# Decoding texts

_CONTEXTS = 100_000


class Decoder:
    """Finds spans in many texts at once; scores of contexts are kept, a bounded number of them."""

    def __init__(self, model: Field):
        self.model = model
        self.numbers: dict[tuple[str, ...], int] = {}
        self.scores = np.zeros((0, LABELS))

    def _numbered(self, found: list[list[tuple[str, ...]]]) -> list[list[int]]:
        if len(self.numbers) > _CONTEXTS:
            self.numbers, self.scores = {}, np.zeros((0, LABELS))
        new: dict[tuple[str, ...], int] = {}
        known = len(self.numbers)
        for one in found:
            for context in one:
                if context not in self.numbers and context not in new:
                    new[context] = known + len(new)
        if new:
            self.scores = np.concatenate([self.scores, self.model.scores(list(new))])
            self.numbers |= new
        return [list(map(self.numbers.__getitem__, one)) for one in found]

    def labels(self, found: list[list[tuple[str, ...]]]) -> list[np.ndarray]:
        """The labels of sequences of contexts, by batches of like lengths."""
        numbered = self._numbered(found)
        order = sorted(range(len(found)), key=lambda at: len(found[at]))
        labels: list[np.ndarray] = [np.empty(0, np.int8)] * len(found)
        at = 0
        while at < len(order):
            part = order[at : at + 512]
            part = part[: max(1, 100_000 // max(len(numbered[part[-1]]), 1))]
            at += len(part)
            lengths = np.array([len(numbered[one]) for one in part])
            if not lengths.max():
                continue
            ids = np.zeros((len(part), lengths.max()), np.int64)
            for row, one in enumerate(part):
                ids[row, : lengths[row]] = numbered[one]
            best = viterbi(self.scores[ids], lengths, self.model)
            for row, one in enumerate(part):
                labels[one] = best[row, : lengths[row]]
        return labels

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, kind, end) of what the field tags in each text. Stretches of more than ``MOST_TOKENS`` tokens are
        decoded in pieces of that many."""
        if not self.model:
            return [[] for _ in texts]
        owners, pieces, sequences = [], [], []
        for owner, text in enumerate(texts):
            for start, end in stretches(text):
                every = tokens(text, start, end)
                for at in range(0, len(every), MOST_TOKENS):
                    owners.append(owner)
                    pieces.append(every[at : at + MOST_TOKENS])
                    sequences.append(contexts(text, pieces[-1]))
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for owner, piece, labels in zip(owners, pieces, self.labels(sequences), strict=True):
            for at in np.flatnonzero(labels % 2 == 1).tolist():
                last = at
                while last + 1 < len(labels) and labels[last + 1] == labels[at] + 1:
                    last += 1
                found[owner].append((piece[at][0], int(labels[at]) // 2, piece[last][1]))
        return found


def added(base: list[tuple[int, int, int]], tagged: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The tagged spans, which do not overlap each other, that no base span touches."""
    ends = sorted((start, end) for start, _, end in base)
    found, at, reach = [], 0, 0
    for start, kind, end in sorted(tagged):
        while at < len(ends) and ends[at][0] < end:
            reach = max(reach, ends[at][1])
            at += 1
        if reach <= start:
            found.append((start, kind, end))
    return found


# Tables


def labelled(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rows: int = ROWS, windows: int = WINDOWS
) -> DataFrame:
    """The labelled table: ``text, spans`` of at most ``windows`` stretches with base spans and as many without.

    They come of about ``rows`` documents, chosen by a hash of their id, of those that a checksum of the id
    does not keep for measuring (``crc32(id) % 5 == 0``). Equal stretches are one row, those of more than
    ``LONGEST`` characters are none. Of more, those with the smallest hashes are taken.
    """
    count = documents.count()
    share = 1_000_000 if count <= rows else int(1_000_000 * rows / count)
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    learned = F.crc32(key.cast("binary")) % 5 != 0
    chosen = documents.where(learned & (F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share))

    def cut(given):
        for (body,) in given:
            body = body or ""
            base = base_spans(body)
            at = 0
            for start, end in stretches(body):
                while at < len(base) and base[at][0] < start:
                    at += 1
                within = []
                while at < len(base) and base[at][0] < end:
                    within.append((base[at][0] - start, base[at][1], base[at][2] - start))
                    at += 1
                if end - start <= LONGEST and all(e <= end - start for _, _, e in within):
                    yield body[start:end], listed(within)

    found = map_rows(chosen.select(F.col(text).cast("string")), cut, "text string, spans string").distinct()
    order = (F.xxhash64("text"), "text")
    with_spans = found.where("spans != ''").orderBy(*order).limit(windows)
    return with_spans.unionByName(found.where("spans = ''").orderBy(*order).limit(windows))


def tagged(text: str, spans: str) -> tuple[list[tuple[str, ...]], list[int]]:
    """A row of the labelled table as contexts and labels."""
    base = []
    for one in filter(None, spans.split(",")):
        kind, start, end = one.split(":")
        base.append((int(start), KINDS.index(kind), int(end)))
    found = tokens(text, 0, len(text))
    return contexts(text, found), tags(found, base)


def train(documents: DataFrame, **options) -> Field:
    """A field from the labelled table of ``documents``, or of a table ``text, spans`` given as ``table``; fitted in one task."""
    table = options.pop("table", None)
    table = labelled(documents, **options) if table is None else table

    def learn(given):
        model = fit([tagged(text or "", spans or "") for text, spans in sorted(given)])
        names = json.dumps(list(model.names))
        yield names, model.weights.tobytes(), model.follows.tobytes(), model.first.tobytes()

    rows = table.select("text", "spans").repartition(1)
    learned = map_rows(rows, learn, "names string, weights binary, follows binary, first binary").first()
    if learned is None:
        return Field()
    names, weights, follows, first = learned
    return Field(
        {name: at for at, name in enumerate(json.loads(names))},
        np.frombuffer(bytes(weights)).reshape(-1, LABELS),
        np.frombuffer(bytes(follows)).reshape(LABELS, LABELS),
        np.frombuffer(bytes(first)),
    )


HELD_ROWS, HELD_CHARS = 256, 4 << 20


def _searched(rows, at: int, decoder: Decoder):
    """(row, base spans, added spans) of rows whose text is in place ``at``, some rows at a time."""

    def flush(held):
        texts = [row[at] or "" for row in held]
        for row, text, more in zip(held, texts, decoder.spans(texts), strict=True):
            base = base_spans(text)
            yield row, base, added(base, more)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[at] or "")
        if len(held) >= HELD_ROWS or chars >= HELD_CHARS:
            yield from flush(held)
            held, chars = [], 0
    yield from flush(held)


def scan(documents: DataFrame, model: Field, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts and digest of its base spans, all spans, and those that the field adds.

    Base spans stay as they are; the field adds those of its spans that touch none. A null text is empty
    and has no spans. Rows with a null or repeated id are answered row by row; other columns are
    ignored. Without anything to learn from, nothing is added.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(rows):
        for (key, _), base, more in _searched(rows, 1, Decoder(shared.value)):
            counts = np.bincount([kind for _, kind, _ in base], minlength=len(KINDS)).tolist() if base else [0] * len(KINDS)
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            yield key, *counts, digest, listed(sorted([*base, *more])), len(more), listed(more)

    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string"))
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    kind = source.schema[0].dataType.simpleString()
    return map_rows(source, work, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint, added string")


def redacted(documents: DataFrame, model: Field, *, text: str = "text") -> DataFrame:
    """``documents`` with every span replaced by its kind in angle brackets; spans that overlap are replaced as one.

    Rows, columns and nulls stay.
    """
    at = documents.columns.index(text)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{one.name}` {one.dataType.simpleString()}" for one in documents.schema)

    def work(rows):
        for row, base, more in _searched(rows, at, Decoder(shared.value)):
            row = list(row)
            if base or more:
                row[at] = replaced(row[at], [*base, *more])
            yield tuple(row)

    return map_rows(documents, work, fields)


def replaced(body: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out.append(f"{body[at:start]}<{KINDS[kind]}>")
        at = max(at, end)
    return "".join(out) + body[at:]
