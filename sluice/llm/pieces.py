"""Texts cut into pieces that byte-level BPE encodes independently, and bounded caches of their codes.

The pre-tokenizer never joins what stands before a run of white space with what follows its
start, nor a run's other characters with a last space that a word follows. So a text may be cut
at its spaces and each piece encoded on its own; words repeat, so their codes are cached.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# Unicode White_Space, which ends words in the pre-tokenizer; fixed values of Unicode.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# A space after white space may be no border.
_AFTER_WHITE = [white + " " for white in WHITE]
LONGEST = 64
CACHE = 120_000


def cuts_at_spaces(text: str) -> bool:
    """Whether every space of a text begins a piece."""
    return not (text.startswith(" ") or any(pair in text for pair in _AFTER_WHITE))


def cut(text: str) -> list[str]:
    """The pieces of a text, in order; joined they are the text."""
    if not cuts_at_spaces(text):
        return _RUNS.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + word for word in rest]] if first else []


class Codes:
    """Codes of pieces, two generations of at most ``size`` each; long pieces are not kept."""

    def __init__(self, encode: Callable[[list[str]], Iterable], size: int = CACHE):
        self.encode, self.size = encode, size
        self.new: dict = {}
        self.old: dict = {}

    def of(self, parts: list[str]) -> list:
        """The code of each piece. Pieces not known yet are encoded in one call."""
        distinct = set(parts)
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        missing = [part for part in distinct if part not in new]
        rest = []
        for part in missing:
            if part in old:
                new[part] = old[part]
            else:
                rest.append(part)
        new.update(zip(rest, self.encode(rest), strict=True))
        found = list(map(new.__getitem__, parts))
        for part in rest:
            if len(part) > LONGEST:
                del new[part]
        return found
