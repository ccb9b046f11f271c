"""A byte-level convolutional network in numpy: one layer of learned filters of several widths, max-pooled, and a softmax.

A filter of width k is k rows of 512 weights, so a convolution is k table
look-ups and no embedding is needed; all filters share the look-up of a byte at
an offset. Texts lie end to end in one array with a gap of zero bytes between
them, so a filter never sees two texts. Beside its own value a byte has a mark
(symbols below) if it continues a repetition of what stood a few bytes before; a
convolution alone can't compare two places of the text.

Windows are of a fixed length and overlap by the widest filter; together they
cover the whole text. Memory holds one block of windows at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The widest lag and the run that make a repetition, and the windows whose responses a processor's cache holds.
LAGS, RUN, CACHED = 24, 8, 16
#: A byte's class: itself, or itself marked as part of a repetition.
SYMBOLS = 512


def symbols(raw: np.ndarray) -> np.ndarray:
    """Bytes to symbols: 256 more where the last RUN bytes all equal those `lag` before, for a lag up to LAGS."""
    out = raw.astype(np.int16)
    marked = np.zeros(len(raw), bool)
    for lag in range(2, LAGS + 1):
        if len(raw) <= lag + RUN:
            break
        same = raw[lag:] == raw[:-lag]
        same &= raw[lag:] != 0
        width = 1
        while width < RUN:  # same[i] and the `width` before it
            same[width:] &= same[:-width]
            same[:width] = False
            width *= 2
        marked[lag:] |= same
    out[marked] += 256
    return out


def windows(texts: list[bytes], size: int, overlap: int, lead: np.ndarray | None = None, own: np.ndarray | None = None, marks: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of every text: symbols (n, size), the text it is of, and the bytes that are new in it.

    An empty text has one empty window. lead and own: of a piece of a longer text,
    the bytes before it that are context alone, and the bytes after those that are its own.
    marks: whether bytes in repetitions are symbols of their own.
    """
    length = np.array([len(t) for t in texts], np.int64)
    lead = np.zeros_like(length) if lead is None else lead
    own = length if own is None else own
    step = size - overlap
    n = np.maximum(1, -(-own // step))
    start = np.cumsum(np.r_[0, lead + n * step + size + LAGS + RUN])
    raw = np.zeros(int(start[-1]) + size, np.uint8)
    for s, t in zip(start.tolist(), texts):
        raw[s : s + len(t)] = np.frombuffer(t, np.uint8)
    of = np.repeat(np.arange(len(texts)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    view = np.lib.stride_tricks.sliding_window_view(symbols(raw) if marks else raw.astype(np.int16), size)[start[of] + lead[of] + k * step]
    return view, of, np.minimum(step, own[of] - k * step)


def pieces(texts: list[bytes], size: int, overlap: int, most: int = 1 << 20, marks: bool = True):
    """Windows of texts in portions of about `most` bytes, long texts in several: (view, text, new bytes), as windows() has them."""
    step, context = size - overlap, LAGS + RUN
    held, of, lead, own, total = [], [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t), 1), most // step * step):
            before, after = min(a, context), a + most // step * step
            held.append(t[a - before : after + overlap])
            of.append(i)
            lead.append(before)
            own.append(min(len(t), after) - a)
            total += len(held[-1])
            if total >= most:
                view, k, new = windows(held, size, overlap, np.array(lead), np.array(own), marks)
                yield view, np.array(of)[k], new
                held, of, lead, own, total = [], [], [], [], 0
    if held:
        view, k, new = windows(held, size, overlap, np.array(lead), np.array(own), marks)
        yield view, np.array(of)[k], new


@dataclass
class Network:
    """tables[i]: the weights (SYMBOLS, n) at offset i of the n filters wider than i; filters stand from wide to narrow."""

    classes: list
    tables: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    window: int = 256

    @property
    def overlap(self) -> int:
        return len(self.tables) - 1

    def responses(self, view: np.ndarray, r: np.ndarray, more: np.ndarray) -> np.ndarray:
        m = r.shape[1]
        np.take(self.tables[0], view[:, :m], axis=0, out=r, mode="clip")
        for i, t in enumerate(self.tables[1:], 1):
            n = t.shape[1]
            part = more.reshape(-1)[: r.shape[0] * m * n].reshape(-1, m, n)
            np.take(t, view[:, i : i + m], axis=0, out=part, mode="clip")
            r[:, :, :n] += part
        return r

    def tops(self, view: np.ndarray, places: bool = False):
        """The largest response of every filter in every window, ReLU applied, and where it was if asked for."""
        n, m = len(self.bias), view.shape[1] - self.overlap
        room, top = np.empty((2, CACHED, m, n), np.float32), np.empty((len(view), n), np.float32)
        place = np.empty((len(view), n), np.int64) if places else None
        for at in range(0, len(view), CACHED):
            v = view[at : at + CACHED].astype(np.intp)
            r = self.responses(v, room[0, : len(v)], room[1])
            top[at : at + CACHED] = r.max(axis=1)
            if places:
                place[at : at + CACHED] = r.argmax(axis=1)
        return np.maximum(top + self.bias, 0), place

    def logits(self, view: np.ndarray) -> np.ndarray:
        return self.tops(view)[0] @ self.dense + self.offset


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(view: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: list, widths: dict[int, int], epochs: int = 6, rate: float = 0.01, batch: int = 64, seed: int = 7) -> Network:
    """Fit to windows by Adam on the weighted cross-entropy; gradients pass through the place of each maximum. Reruns agree."""
    rng = np.random.default_rng(seed)
    wide, total = max(widths), sum(widths.values())
    tables = [rng.normal(0, 0.15, (SYMBOLS, sum(n for k, n in widths.items() if k > i))).astype(np.float32) for i in range(wide)]
    for t in tables:
        t[256:] += t[:256]  # a marked byte begins near its plain one
    net = Network(classes, tables, np.zeros(total, np.float32), rng.normal(0, 0.2, (total, len(classes))).astype(np.float32), np.zeros(len(classes), np.float32), view.shape[1])
    params = [*net.tables, net.bias, net.dense, net.offset]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(view))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            v, y = view[rows], label[rows]
            top, place = net.tops(v, True)
            p = softmax(top @ net.dense + net.offset)
            p[np.arange(len(rows)), y] -= 1
            p *= weight[rows, None] / len(rows)
            back = (p @ net.dense.T) * (top > 0)
            grads = []
            for i, table in enumerate(net.tables):
                n = table.shape[1]
                g = np.zeros_like(table)
                np.add.at(g, (v[np.arange(len(rows))[:, None], place[:, :n] + i], np.arange(n)[None, :]), back[:, :n])
                grads.append(g)
            grads += [back.sum(0), top.T @ p, p.sum(0)]
            t += 1
            for x, g, m, s in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                x -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def weights(labels: np.ndarray) -> np.ndarray:
    """Weights that give every label the same sum."""
    share = np.bincount(labels)
    return (len(labels) / np.maximum(share, 1) / max(1, (share > 0).sum()))[labels].astype(np.float32)
