"""Words as numbers: a dictionary that grows as words are met, and numbers packed into few bytes."""

from __future__ import annotations

import numpy as np


class Codes(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def packed(values: np.ndarray) -> tuple[bytes, int]:
    """Unsigned numbers in as few bytes each as hold the largest (1, 2, 3, 4 or 8), and that number of bytes."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 3, 4, 8) if most < 1 << (8 * w))
    if width == 3:
        return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes(), width
    return values.astype(f"<u{width}").tobytes(), width


def unpacked(data: bytes, width: int) -> np.ndarray:
    if width == 3:
        whole = np.zeros((len(data) // 3, 4), np.uint8)
        whole[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
        return whole.view("<u4").ravel().astype(np.int64)
    return np.frombuffer(data, f"<u{width}").astype(np.int64)
