"""A hidden Markov model over token classes: Baum-Welch counts and exact sequence likelihoods, in numpy.

Sequences are cut into segments of up to ``SEGMENT`` symbols so that many run side by side.
A likelihood is still that of the whole sequence: every segment gives the matrix that
leads from the state at its first symbol to that at its last, scaled as it goes, and the
matrices of a sequence are multiplied in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEGMENT = 256
#: Segments that run side by side.
TOGETHER = 2048


@dataclass(frozen=True)
class Model:
    """First-state chances, moves between states, chances of a symbol in a state (states x symbols), state shares."""

    start: np.ndarray
    moves: np.ndarray
    emit: np.ndarray
    share: np.ndarray


@dataclass
class Counts:
    """What Baum-Welch adds up: expected first states, moves, symbols by state, and the natural log-likelihood."""

    start: np.ndarray
    moves: np.ndarray
    emit: np.ndarray
    loss: float = 0.0

    @classmethod
    def empty(cls, states: int, symbols: int) -> Counts:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((states, symbols)))


def initial(frequency: np.ndarray, states: int, seed: int = 11) -> Model:
    """States that stay mostly put, each with the symbols' frequencies disturbed by chance."""
    rng = np.random.default_rng(seed)
    emit = (frequency + 1e-3) * rng.uniform(0.2, 1.8, (states, len(frequency)))
    moves = np.full((states, states), 0.05 / max(1, states - 1)) + np.eye(states) * 0.95
    even = np.full(states, 1 / states)
    return Model(even, moves / moves.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True), even)


def update(counts: Counts, symbol_weight: float = 0.05) -> Model:
    """Chances from counts; every move and symbol keeps a small chance."""
    start = counts.start + 0.1
    moves = counts.moves + 0.1
    emit = counts.emit + symbol_weight
    share = counts.emit.sum(1) + 0.1
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True), share / share.sum())


def segments(sequences: list[np.ndarray]) -> list[tuple[int, bool, np.ndarray]]:
    """(sequence, whether it is its first, symbols) of every segment, in order."""
    return [(i, a == 0, s[a : a + SEGMENT]) for i, s in enumerate(sequences) for a in range(0, len(s), SEGMENT)]


def _padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols by step (steps x parts; parts by falling length), and how many parts are live at each step."""
    sizes = np.array([len(p) for p in parts])
    steps = int(sizes[0])
    block = np.zeros((steps, len(parts)), np.int64)
    for i, p in enumerate(parts):
        block[: len(p), i] = p
    return block, (sizes[None, :] > np.arange(steps)[:, None]).sum(1)


def expect(model: Model, sequences: list[np.ndarray], counts: Counts) -> None:
    """Add the expected counts of the sequences, segment by segment.

    A segment that continues a sequence starts from the states' shares.
    """
    cut = sorted(segments(sequences), key=lambda s: -len(s[2]))
    by_symbol = np.ascontiguousarray(model.emit.T)
    for a in range(0, len(cut), TOGETHER):
        part = cut[a : a + TOGETHER]
        block, live = _padded([s for _, _, s in part])
        first = np.array([f for _, f, _ in part])
        steps, n = block.shape
        emitted = by_symbol[block]
        ahead = np.empty_like(emitted)
        value = np.where(first[:, None], model.start, model.share) * emitted[0]
        for t in range(steps):
            k = live[t]
            if t:
                value = ahead[t - 1, :k] @ model.moves
                value *= emitted[t, :k]
            total = value.sum(1)
            counts.loss += float(np.log(total).sum())
            ahead[t, :k] = value / total[:, None]
        behind = np.ones((n, model.start.size))
        chance = np.zeros_like(emitted)
        for t in range(steps - 1, -1, -1):
            k = live[t]
            state = ahead[t, :k] * behind[:k]
            state /= state.sum(1, keepdims=True)
            chance[t, :k] = state
            if t:
                right = emitted[t, :k] * behind[:k]
                before = ahead[t - 1, :k]
                reach = right @ model.moves.T
                scale = (before * reach).sum(1, keepdims=True)
                counts.moves += (before / scale).T @ right * model.moves
                behind[:k] = reach / reach.sum(1, keepdims=True)
        counts.start += chance[0][first].sum(0)
        flat = block.reshape(-1)
        for s in range(model.start.size):
            counts.emit[s] += np.bincount(flat, chance[:, :, s].reshape(-1), minlength=counts.emit.shape[1])


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of every whole sequence; an empty one has 0."""
    cut = segments(sequences)
    states = model.start.size
    spans = np.empty((len(cut), states, states))
    scales = np.zeros(len(cut))
    order = sorted(range(len(cut)), key=lambda i: -len(cut[i][2]))
    by_symbol = np.ascontiguousarray(model.emit.T)
    for a in range(0, len(order), TOGETHER):
        ids = np.array(order[a : a + TOGETHER])
        block, live = _padded([cut[i][2] for i in ids])
        emitted = by_symbol[block[0]]
        value = emitted[:, None, :] * np.eye(states)
        scale = np.zeros(len(ids))
        for t in range(block.shape[0]):
            k = live[t]
            if t:
                value[:k] = (value[:k].reshape(-1, states) @ model.moves).reshape(k, states, states)
                value[:k] *= by_symbol[block[t, :k]][:, None, :]
            total = value[:k].sum((1, 2))
            value[:k] /= total[:, None, None]
            scale[:k] += np.log(total)
        spans[ids], scales[ids] = value, scale
    owner = np.array([i for i, _, _ in cut], int)
    heads = np.flatnonzero([f for _, f, _ in cut])
    sizes = np.diff(np.r_[heads, len(cut)])
    out = np.zeros(len(sequences))
    by_size = np.argsort(-sizes, kind="stable")
    heads, sizes = heads[by_size], sizes[by_size]
    state = np.tile(model.start, (len(heads), 1))
    for step in range(int(sizes[0]) if len(sizes) else 0):
        k = int((sizes > step).sum())
        at = heads[:k] + step
        value = state[:k] if step == 0 else state[:k] @ model.moves
        value = np.einsum("nk,nkl->nl", value, spans[at])
        total = value.sum(1)
        state[:k] = value / total[:, None]
        out[owner[at]] += np.log(total) + scales[at]
    return out
