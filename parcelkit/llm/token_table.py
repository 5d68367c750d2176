"""Numbers of distinct tokens, worked out once per worker and then looked up by array indexing."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np


class TokenTable:
    """``describe(token)`` gives ``width`` floats; at most about ``cached`` tokens are kept."""

    def __init__(self, describe: Callable[[str], list[float]], width: int, cached: int = 400_000):
        self.describe, self.width, self.cached = describe, width, cached
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.numbers = array("f")

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word, matrix of all known tokens); valid until the next call."""
        if len(self.index) > self.cached:
            self.clear()
        index = self.index
        for w in [w for w in set(words) if w not in index]:
            index[w] = len(index)
            self.numbers.extend(self.describe(w))
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        matrix = np.frombuffer(self.numbers, np.float32).reshape(-1, self.width) if index else np.zeros(
            (0, self.width), np.float32)
        return at, matrix
