"""Reading JSON text: the helpers that run inside tasks.

Everything here works on one text at a time; Spark decides which task gets which text.
"""

from __future__ import annotations

import codecs
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from json.decoder import scanstring
from typing import Any

_BLANK = re.compile(r"[ \t\r\n]*")
_NESTING = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_NUMBER_START = frozenset("-0123456789")
_STRING_OR_BLANKS = re.compile(r'("(?:[^"\\]|\\.)*")|[ \t\r\n]+', re.DOTALL)
_UNFINISHED = re.compile("[-+.0-9a-zA-Z]+")
_LONE_SURROGATE = re.compile("[\ud800-\udfff]")
# Python's limit for turning digits into a number is a little above.
_MOST_DIGITS = 4000


# Objects of plain members: no blanks, no escapes, no objects or arrays within. Most records are such, and
# a pattern finds all their members at once.
_PLAIN_STRING = r'"[^"\\\x00-\x1f]*"'
_PLAIN_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
_PLAIN_VALUE = rf"{_PLAIN_STRING}|{_PLAIN_NUMBER}|true|false|null"
_PLAIN_OBJECT = re.compile(rf"\{{(?:{_PLAIN_STRING}:(?:{_PLAIN_VALUE})(?:,{_PLAIN_STRING}:(?:{_PLAIN_VALUE}))*+)?\}}")
_PLAIN_MEMBER = re.compile(rf"({_PLAIN_STRING}):({_PLAIN_VALUE})")


def _plain_members(text: str) -> dict[str, str] | None:
    """Names and values as they are spelled, if the text is an object of plain members; of equal names the last counts."""
    return dict(_PLAIN_MEMBER.findall(text)) if _PLAIN_OBJECT.fullmatch(text) else None


def _refuse(name: str) -> Any:
    raise ValueError(f"{name} is not JSON")


# Numbers stay text while scanning: only the extent of a value is wanted.
_scan = json.JSONDecoder(parse_constant=_refuse, parse_int=str, parse_float=str).scan_once
_compact = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode


class _Literal(str):
    """A number that is kept as it is spelled."""


def _integer(text: str) -> int | _Literal:
    return int(text) if len(text) <= _MOST_DIGITS else _Literal(text)


def _decimal(text: str) -> float | _Literal:
    """A double where one holds the value, else the number's text."""
    value = float(text)
    try:
        if math.isfinite(value) and Decimal(repr(value)) == Decimal(text):
            return value
    except InvalidOperation:
        pass
    return _Literal(text)


_load = json.JSONDecoder(parse_constant=_refuse, parse_int=_integer, parse_float=_decimal).decode


def _written(value: Any) -> str:
    """Compact JSON that any UTF-8 writer takes: surrogates without a partner are escaped."""
    if isinstance(value, _Literal):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{_written(name)}:{_written(item)}" for name, item in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return _LONE_SURROGATE.sub(lambda char: f"\\u{ord(char.group()):04x}", _compact(value))


def _members(text: str) -> dict[str, tuple[str, str]]:
    """The fields of an object's text: by name, how the name and the value are spelled.

    Of fields with one name the last counts, in the place of the first.
    """

    plain = _plain_members(text)
    if plain is not None:
        return {name[1:-1]: (name, value) for name, value in plain.items()}

    def skip(pos: int) -> int:
        return _BLANK.match(text, pos).end()

    def expect(pos: int, chars: str) -> int:
        if text[pos : pos + 1] not in tuple(chars):
            raise ValueError(f"not a JSON object: expected one of {chars} at {pos}")
        return pos + 1

    found: dict[str, tuple[str, str]] = {}
    pos = skip(expect(skip(0), "{"))
    more = text[pos : pos + 1] != "}"
    while more:
        begin, after = pos, expect(pos, '"')
        name, end = scanstring(text, after, True)
        pos = skip(expect(skip(end), ":"))
        try:
            _, value_end = _scan(text, pos)
        except (StopIteration, RecursionError) as error:
            raise ValueError(f"no JSON value that can be read at {pos}") from error
        found[name] = text[begin:end], text[pos:value_end]
        pos = expect(skip(value_end), ",}") - 1
        more = text[pos] == ","
        if more:
            pos = skip(pos + 1)
    if skip(pos + 1) != len(text):
        raise ValueError(f"not a JSON object: more text at {pos + 1}")
    return found


def file_text(content: bytes, begins: bool = True) -> tuple[str, bool]:
    """Decoded file content up to the first undecodable byte, and whether there was one.

    Content that does not begin a file has no byte order mark and is UTF-8.
    """
    if begins:
        content = content.removeprefix(codecs.BOM_UTF8)
    encoding = json.detect_encoding(content) if begins else "utf-8"
    try:
        return content.decode(encoding), False
    except UnicodeDecodeError as bad:
        return content[: bad.start].decode(encoding, "ignore"), True


@dataclass
class Outer:
    """Where a reader stands outside of objects: open arrays, the fewest there were, and what has to come next."""

    arrays: int = 0
    separator_due: bool = False
    item_due: bool = False
    fewest: int | None = None


def outer_objects(
    text: str, pos: int = 0, arrays: int = 0, after_value: bool = False
) -> tuple[list[tuple[int, int]], int]:
    """Extents of the outermost objects from ``pos`` on, and where reading stopped.

    Arrays are entered at any depth and scalars are skipped. Reading stops at the end of
    the text, or at the first token that does not fit. ``arrays`` open arrays surround
    ``pos``; ``after_value`` says that the last thing before it was a complete value.
    """
    return _outer_objects(text, pos, Outer(arrays, after_value and arrays > 0), False)


def _outer_objects(text: str, pos: int, at: Outer, more: bool) -> tuple[list[tuple[int, int]], int]:
    """As :func:`outer_objects`; ``at`` is moved along, up to where reading stops. If ``more`` text follows, a
    number or a word that the text ends with is not read."""
    spans = []
    while True:
        at.fewest = at.arrays if at.fewest is None else min(at.fewest, at.arrays)
        pos = _BLANK.match(text, pos).end()
        if pos == len(text):
            return spans, pos
        char = text[pos]
        if at.separator_due and char == ",":
            at.separator_due, at.item_due, pos = False, True, pos + 1
            continue
        if char == "]":
            if not at.arrays or at.item_due:
                return spans, pos
            at.arrays, pos = at.arrays - 1, pos + 1
            at.separator_due = at.arrays > 0
            continue
        if at.separator_due:
            return spans, pos
        if char == "[":
            at.arrays, at.item_due, pos = at.arrays + 1, False, pos + 1
            continue
        if more and _UNFINISHED.fullmatch(text, pos):
            return spans, pos
        try:
            _, end = _scan(text, pos)
        except (ValueError, StopIteration, RecursionError):
            return spans, pos
        if char == "{":
            spans.append((pos, end))
        elif not at.arrays and char in _NUMBER_START and text[end : end + 1].strip(" \t\r\n"):
            return spans, pos
        pos, at.separator_due, at.item_due = end, at.arrays > 0, False


def close_of(text: str, pos: int, braces: int, in_string: bool) -> tuple[int, int] | None:
    """Where the object or string that is open at ``pos`` ends, and by how much the array
    depth changed on the way; ``None`` if it is still open at the end of the text."""
    end, arrays, _, _ = _nesting(text, pos, braces, in_string)
    return None if end is None else (end, arrays)


def _nesting(text: str, pos: int, braces: int, in_string: bool) -> tuple[int | None, int, int, bool]:
    """As :func:`close_of`, with the depth and whether a string is open where it stops."""
    arrays = 0
    for token in _NESTING.finditer(text, pos):
        char = token.group()
        if char == '"':
            in_string = not in_string
            if not in_string and braces == 0:
                return token.end(), arrays, 0, False
        elif in_string or len(char) > 1:
            continue
        elif char == "{":
            braces += 1
        elif char == "}":
            braces -= 1
            if braces <= 0:
                return token.end(), arrays, 0, False
        else:
            arrays += 1 if char == "[" else -1
    return None, arrays, braces, in_string


# What a stretch of text is: an object, or the beginning, a middle part or the end of one that crosses a border.
WHOLE, OPEN, INNER, CLOSE, ERROR = "whole", "open", "inner", "close", "error"


class ObjectReader:
    """The outermost objects of a text that comes in pieces, from any place on whose nesting is known.

    Pieces do not end within an escape sequence. What is not finished in a piece is given as a fragment, so no
    more than a piece is held. A string outside of objects that crosses a border is given like an object.
    """

    def __init__(self, in_string: bool = False, braces: int = 0, arrays: int = 0, after_value: bool = False):
        self.in_string, self.braces = in_string, braces
        self.inside = in_string or braces > 0
        self.at = Outer(arrays, after_value and arrays > 0)
        self.pending = ""
        self.failed = False

    def feed(self, piece: str, more: bool = False) -> Iterator[tuple[str, str | None]]:
        if self.failed:
            return
        text, pos, self.pending = self.pending + piece, 0, ""
        if self.inside:
            end, change, self.braces, self.in_string = _nesting(text, 0, self.braces, self.in_string)
            self.at.arrays += change
            if end is None:
                yield INNER, text
                return
            self.inside, pos = False, end
            self.at.separator_due, self.at.item_due = self.at.arrays > 0, False
            yield CLOSE, text[:pos]
        spans, stop = _outer_objects(text, pos, self.at, more)
        for begin, end in spans:
            yield WHOLE, text[begin:end]
        if stop == len(text):
            return
        if text[stop] in '{"' and not self.at.separator_due:
            end, change, braces, in_string = _nesting(text, stop, 0, False)
            if end is None:
                self.inside, self.braces, self.in_string = True, braces, in_string
                self.at.arrays += change
                yield OPEN, text[stop:]
                return
        if more and not self.at.separator_due and _UNFINISHED.fullmatch(text, stop):
            self.pending = text[stop:]
            return
        self.failed = True
        yield ERROR, None


def _normal(value: str) -> str:
    """A plain value as keys write it."""
    if value[0] not in _NUMBER_START:
        return value
    return _written(_integer(value) if value.lstrip("-").isdigit() else _decimal(value))


def key_text(record: str | None, paths: list[str]) -> str:
    """Compact JSON object of the fields of ``record`` that exist, in the order of ``paths``.

    Numbers are written as doubles and integers are; those that no double holds keep their spelling.
    """
    plain = _plain_members(record) if isinstance(record, str) else None
    if plain is not None:
        # No path leads into a plain value.
        found = [(path, plain.get(f'"{path}"')) for path in paths if "." not in path]
        there = {path: value for path, value in found if value not in (None, "null")}
        return "{" + ",".join(f"{_written(path)}:{_normal(value)}" for path, value in there.items()) + "}"
    try:
        key, root = {}, _load(record) if isinstance(record, str) else None
        for path in paths:
            value = root
            for name in path.split("."):
                value = value.get(name) if isinstance(value, dict) else None
            if value is not None:
                key[path] = value
        return _written(key)
    except RecursionError as error:
        raise ValueError("the record is nested too deeply") from error


def merged_text(record: str | None, changes: str | None) -> str | None:
    """``record`` with the top-level fields of ``changes`` set, in place or at the end.

    Names and values keep their spelling; blanks between them go.
    """
    if not isinstance(record, str):
        return None
    if not isinstance(changes, str):
        return record
    fields = _members(record)
    for name, (spelled, value) in _members(changes).items():
        fields[name] = fields[name][0] if name in fields else spelled, value
    return "{" + ",".join(f"{name}:{_without_blanks(value)}" for name, value in fields.values()) + "}"


def _without_blanks(value: str) -> str:
    return _STRING_OR_BLANKS.sub(lambda part: part.group(1) or "", value) if value[0] in "{[" else value
