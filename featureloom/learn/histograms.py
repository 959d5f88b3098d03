"""Gradient histograms of coded rows in numpy.

Features are packed: the codes of several features, narrow ones with narrow ones,
make one number below ``TABLE`` a row (:class:`Packing`). A histogram is one complex
array over the cells of all features (real part: sum of gradients, imaginary part:
sum of hessians); feature f has ``widths[f]`` cells from ``first[f]``. Many rows are
counted in one table a pack, which is summed up by feature afterwards; few rows
feature by feature, where such tables would cost more than the rows. Gradients are
rounded to a grid on which all sums are exact (:func:`grid`), so neither the way nor
the order of summing shows.
"""

from __future__ import annotations

import math

import numpy as np

TABLE = 4096  # cells of a pack's table
FEW_ROWS = TABLE // 2
CHUNK_CELLS = 1 << 15


class Packing:
    """Which features share a pack, and how a pack's number holds their codes."""

    def __init__(self, widths: np.ndarray):
        self.widths, self.first, self.cells = [int(w) for w in widths], np.cumsum(widths) - widths, int(np.sum(widths))
        self.packs: list[list[int]] = []
        self.place: dict[int, tuple[int, int]] = {}  # feature: its pack, and the product of the widths behind it
        cells = TABLE + 1
        for f in np.argsort(widths, kind="stable").tolist():
            if cells * self.widths[f] > TABLE:
                self.packs.append([])
                cells = 1
            self.packs[-1].append(f)
            cells *= self.widths[f]
        for k, pack in enumerate(self.packs):
            behind = 1
            for f in reversed(pack):
                self.place[f] = k, behind
                behind *= self.widths[f]

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Rows of codes as one row of numbers a pack."""
        columns, out = np.ascontiguousarray(codes.T), np.zeros((len(self.packs), len(codes)), np.uint16)
        for pack, number in zip(self.packs, out):
            for f in pack:
                number *= np.uint16(self.widths[f])
                number += columns[f]
        return out

    def codes(self, packed: np.ndarray, f: int, at: np.ndarray) -> np.ndarray:
        """The codes of one feature in the rows ``at``."""
        k, behind = self.place[f]
        return packed[k].take(at) // np.uint16(behind) % np.uint16(self.widths[f])

    def histogram(self, packed: np.ndarray, at: np.ndarray | None, gh: np.ndarray) -> np.ndarray:
        """The histogram of the rows ``at`` (all: None); ``gh`` holds the gradients of these rows."""
        out = np.zeros(self.cells, np.complex128)
        if len(gh) < FEW_ROWS:
            step = max(1, CHUNK_CELLS // max(len(gh), 1))
            cells, again, used = np.empty((step, len(gh)), np.intp), np.tile(gh, step), 0
            for pack, number in zip(self.packs, packed):
                number = number if at is None else number.take(at)
                for f in reversed(pack):
                    if f != pack[0]:
                        rest = number // np.uint16(self.widths[f])
                        code, number = number - rest * np.uint16(self.widths[f]), rest
                    else:
                        code = number
                    np.add(code, self.first[f], out=cells[used])
                    used += 1
                    if used == step:
                        np.add.at(out, cells.ravel(), again)
                        used = 0
            np.add.at(out, cells[:used].ravel(), again[:used * len(gh)])
            return out
        for pack, number in zip(self.packs, packed):
            table = np.zeros(math.prod(self.widths[f] for f in pack), np.complex128)
            np.add.at(table, (number if at is None else number.take(at)).astype(np.intp), gh)
            self._spread(table, pack, out)
        return out

    def _spread(self, table: np.ndarray, pack: list[int], out: np.ndarray) -> None:
        if len(pack) == 1:
            out[self.first[pack[0]]:self.first[pack[0]] + len(table)] = table
            return
        half = len(pack) // 2
        table = table.reshape(math.prod(self.widths[f] for f in pack[:half]), -1)
        self._spread(table.sum(axis=1), pack[:half], out)
        self._spread(table.sum(axis=0), pack[half:], out)


def grid(rows: int) -> float:
    """One over the finest step whose multiples up to 1 add up exactly over so many rows."""
    return math.ldexp(1.0, max(52 - rows.bit_length(), 0))


def on_grid(margins: np.ndarray, y: np.ndarray, scale: float) -> np.ndarray:
    """Gradient + i hessian of the logistic loss, as multiples of 1 / ``scale``."""
    chance = 1.0 / (1.0 + np.exp(-margins))
    out = np.empty(len(y), np.complex128)
    out.real, out.imag = np.rint((chance - y) * scale) / scale, np.rint(chance * (1.0 - chance) * scale) / scale
    return out
