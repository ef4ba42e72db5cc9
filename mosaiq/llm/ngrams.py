"""Hashed character n-grams of whole texts, and a linear fit to their presence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Code points that are hashed at once; a longer text goes piece by piece.
PIECE = 1 << 18
_MIX, _PRIME = np.uint32(2654435761), np.uint32(16777619)


class Grams:
    """Distinct hash buckets (2 to the power ``bits``) of the character n-grams
    of the given orders, by text. The text is set between spaces, so that word
    edges count as characters. Beside the table of buckets a text takes memory
    for one piece, however long it is."""

    def __init__(self, orders: Sequence[int], bits: int, lower: bool) -> None:
        self.orders, self.bits, self.lower = tuple(orders), bits, lower
        self._last = np.zeros(1 << bits, np.int32)

    def of(self, text: str | None) -> np.ndarray:
        parts = [self._distinct(p) for p in self._pieces(text or "")]
        if len(parts) == 1:
            return parts[0]
        seen = np.zeros(1 << self.bits, bool)
        for p in parts:
            seen[p] = True
        return np.flatnonzero(seen).astype(np.int32)

    def _pieces(self, text: str) -> Iterator[str]:
        whole = f" {text} "
        if len(whole) <= PIECE:
            yield whole.lower() if self.lower else whole
            return
        for a in range(0, len(whole), PIECE):
            part = whole[a : a + PIECE + max(self.orders) - 1]
            yield part.lower() if self.lower else part

    def _distinct(self, piece: str) -> np.ndarray:
        data = np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4")
        h, found = np.zeros(len(data), np.uint32), []
        for n in range(1, max(self.orders) + 1):
            # h[i]: of the n characters from i on
            h = h[: max(0, len(data) - n + 1)] * _PRIME + (data[n - 1 :] + np.uint32(n)) * _MIX
            if n in self.orders:
                found.append((((h ^ (h >> np.uint32(15))) * _MIX) >> np.uint32(32 - self.bits)).astype(np.int32))
        b = np.concatenate(found)
        at = np.arange(len(b), dtype=np.int32)
        self._last[b] = at
        return b[self._last[b] == at]


def packed(found: np.ndarray) -> bytes:
    return found.astype("<i4").tobytes()


def logistic_on_presence(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, *, weight: np.ndarray | None = None, epochs: int = 5, batch: int = 32, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression of ``y`` on the presence of buckets, each scaled by
    its ``ratio``: gradient steps over small batches, each row's step divided
    by its squared length, the weights averaged over the later epochs. The
    batches are the same on every run. Returns the weight of each bucket (its
    ratio included) and the bias."""
    n = len(rows)
    w, total, bias, bias_total = np.zeros(len(ratio), np.float32), np.zeros(len(ratio), np.float32), 0.0, 0.0
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(prior / (1 - prior)))
    share = np.ones(n, np.float32) if weight is None else weight.astype(np.float32)
    step = np.array([4 * rate / (float((ratio[r] ** 2).sum()) + 1) for r in rows], np.float32) * share
    order = np.random.default_rng(42).permutation(n)
    for epoch in range(epochs):
        for a in range(0, n, batch):
            part = order[a : a + batch]
            flat = np.concatenate([rows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            m = bias + np.bincount(owner, w[flat] * ratio[flat], minlength=len(part))
            err = 1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[part]
            w -= np.bincount(flat, (err * step[part])[owner], minlength=len(ratio)).astype(np.float32) * ratio
            bias -= 0.1 * rate * float((err * share[part]).mean())
        if epoch >= epochs // 2:
            total += w
            bias_total += bias
    later = max(1, epochs - epochs // 2)
    return total / later * ratio, bias_total / later
