"""Token counts by field and section, from one encoding of the whole document.

A document is its fields, one after another. It is encoded once; the tokens' character spans
are joined with the spans of its fields and sections, both in order, so the interval join is
a merge. A token that crosses a border goes where the rule says:

* ``first``: to the section of its first character
* ``majority``: to the section that has most of its characters, the earlier one of equals
* ``split``: in equal parts per character to each of them
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, utf8

RULES = ("first", "majority", "split")


class SpanEncoder:
    """Ids and character spans of whole texts, by a byte-level vocabulary of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last; characters may be shared by tokens."""
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.sizes[ids])
        if len(text) == (int(ends[-1]) if len(ends) else 0):
            return ends - self.sizes[ids], ends
        data = np.frombuffer(utf8(text), np.uint8)
        # The character that each byte belongs to.
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[ends - self.sizes[ids]], character[ends - 1] + 1


def attributed(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section, and how many cross a border. Section ``i`` is ``borders[i] : borders[i + 1]``.

    Sections cover the text and have characters; tokens come in order.
    """
    sections = len(borders) - 1
    first = np.searchsorted(borders, starts, side="right") - 1
    last = np.searchsorted(borders, ends - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    counts = np.zeros(sections)
    if rule == "first":
        np.add.at(counts, first, 1.0)
        return counts, len(crossing)
    np.add.at(counts, first[first == last], 1.0)
    for token in crossing.tolist():
        over = np.arange(first[token], last[token] + 1)
        share = np.minimum(borders[over + 1], ends[token]) - np.maximum(borders[over], starts[token])
        if rule == "majority":
            counts[over[np.argmax(share)]] += 1
        else:
            counts[over] += share / share.sum()
    return counts, len(crossing)


def section_borders(fields: Sequence[str], separator: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """Borders of all sections of a document, and the field of each.

    A field's sections are its lines with their ends; what separates fields belongs to the field
    before. Empty fields have no section.
    """
    borders, of_field, at = [0], [], 0
    for number, field in enumerate(fields):
        body = field + separator if number + 1 < len(fields) else field
        done = 0
        while done < len(body):
            end = body.find("\n", done) + 1 or len(body)
            borders.append(at + end)
            of_field.append(number)
            done = end
        at += len(body)
    return np.array(borders), np.array(of_field, np.int64)


def token_counts(
    documents: DataFrame,
    path: str,
    pattern: str,
    *,
    doc_id: str = "doc_id",
    fields: Sequence[str] = ("text",),
    rule: str = "majority",
) -> DataFrame:
    """Per document: tokens in all, tokens per field, tokens per section in order, and crossing tokens.

    ``field_tokens`` and ``section_tokens`` add up to ``n_tokens`` under every rule. A null field
    is empty; a document without characters has no tokens and no sections. Null and repeated
    ids are answered row by row, other columns are ignored, an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {', '.join(RULES)}")
    source = documents.select(
        F.col(doc_id).alias("doc_id"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(f"f{i}") for i, name in enumerate(fields)],
    )

    def work(rows):
        encoder = SpanEncoder(path, pattern)
        for key, *bodies in rows:
            borders, of_field = section_borders(bodies)
            starts, ends = encoder.spans("\n".join(bodies))
            counts, crossing = attributed(starts, ends, borders, rule)
            by_field = np.zeros(len(bodies))
            np.add.at(by_field, of_field, counts)
            yield key, len(starts), len(counts), crossing, by_field.tolist(), counts.tolist()

    schema = (
        f"doc_id {source.schema[0].dataType.simpleString()}, n_tokens bigint, n_sections bigint, "
        "n_crossing bigint, field_tokens array<double>, section_tokens array<double>"
    )
    return map_rows(source, work, schema)
