"""Helpers of the operators on words: chunks of bounded size and vectorised word hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Byte positions of text that one vectorised step holds at once.
CHUNK_BYTES = 2 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
#: A random number for each byte value, the same for both cases of A-Z, and one that keeps the cases apart.
FOLDED, EXACT = _RANDOM[_LOWER], _RANDOM
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, encoded texts) of consecutive rows, about `limit` bytes each; a longer text stands alone."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if text is not None else b""
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of some texts: byte bounds, 64-bit hashes, and each text's share of them."""

    def __init__(self, raw: list[bytes], table: np.ndarray = FOLDED):
        self.buffer = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
        self.text_start = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw], dtype=np.int64)]).astype(np.int64)
        apart = SEPARATOR[self.buffer]
        change = np.flatnonzero(np.diff(apart, prepend=True))
        self.starts, self.ends = change[0::2], change[1::2]
        up, down = powers(len(self.buffer) + 1)
        sums = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum(table[self.buffer] * up[: len(self.buffer)], out=sums[1:])
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
        #: words of text i are bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, self.text_start)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k words in a row within a text, and the bounds of each text's share."""
        n = np.diff(self.bounds)
        count = np.maximum(n - k + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(self.bounds[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
        out = np.zeros(len(at), np.uint64)
        for i in range(k):
            out = (out + self.hashes[at + i]) * np.uint64(0xC2B2AE3D27D4EB4F)
            out ^= out >> np.uint64(31)
        return mixed(out), bounds
