"""Words of a text as a piece tokenizer sees them: a run of spaces and what follows it.

No piece of the vocabularies in use holds a space after another character (`Vocabulary`
checks it), so each unit is encoded by itself, and distinct ones need it once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

SPACE = "▁"
#: Characters of text, and of units not met before, that are handled together.
SLICE, FRESH = 4 << 20, 1 << 20
#: Units that a task remembers; beyond, it starts anew.
KEEP = 400_000

_UNIT = re.compile(r" +[^ ]*")


class _Numbers(dict):
    """Numbers keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def split(text: str) -> list[str]:
    """The units of a text; the first space is the one that tokenizers add in front."""
    if not text:
        return []
    return _UNIT.findall(" " + text.replace(SPACE, " "))


class Units:
    """Numbers the distinct units of a task's texts and has each new one learned once.

    `learn` gets lists of units whose numbers follow on from all it has got before, or start
    at 0 again after a call of `forget`.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None]) -> None:
        self.learn, self.forget = learn, forget
        self.numbers, self.known = _Numbers(), 0

    def _teach(self) -> None:
        group, size = [], 0
        for unit in islice(self.numbers, self.known, None):
            group.append(unit)
            size += len(unit) + 1
            if size >= FRESH:
                self.learn(group)
                group, size = [], 0
        if group:
            self.learn(group)
        self.known = len(self.numbers)

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, each text's unit numbers) of runs of rows whose units are learned."""
        row, size, begun, each = 0, 0, self.known, []
        for i, value in enumerate(texts):
            text = value.as_py() or ""
            units = split(text)
            each.append(np.fromiter(map(self.numbers.__getitem__, units), np.int32, len(units)))
            size += len(text)
            if size >= SLICE or len(self.numbers) - begun >= FRESH // 10:
                self._teach()
                yield row, each
                if len(self.numbers) > KEEP:
                    self.numbers, self.known = _Numbers(), 0
                    self.forget()
                row, size, begun, each = i + 1, 0, self.known, []
        if each:
            self._teach()
            yield row, each
