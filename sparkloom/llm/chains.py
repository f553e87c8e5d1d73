"""Forward-backward over many chains of unequal length at once."""

from __future__ import annotations

import numpy as np


def time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chains sorted from long to short: how many reach each step, and the
    places of their elements, ordered by step, in the chains laid end to end."""
    if not len(lengths) or not lengths[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    step = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    return np.bincount(step), np.argsort(step, kind="stable")


def forward(start: np.ndarray, move: np.ndarray, out: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward messages (time-major), the scales, and each chain's log likelihood.

    ``out``: for each element, time-major, the weight of every state. Weights need
    not be probabilities; the likelihood is then the partition function.
    """
    messages, scales = np.empty_like(out), np.empty(len(out), out.dtype)
    total = np.zeros(alive[0] if len(alive) else 0, np.float64)
    at, last = 0, None
    for n in alive.tolist():
        now = out[at : at + n] * (start if last is None else last[:n] @ move)
        c = now.sum(1)
        now /= c[:, None]
        messages[at : at + n] = now
        scales[at : at + n] = c
        last = now
        at += n
    if at:
        logs, at = np.log(scales.astype(np.float64)), 0
        for n in alive.tolist():
            total[:n] += logs[at : at + n]
            at += n
    return messages, scales, total


def forward_backward(start: np.ndarray, move: np.ndarray, out: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of every element's state (time-major), expected moves, log likelihoods."""
    gamma, scales, total = forward(start, move, out, alive)
    moves, back = np.zeros_like(move), move.T.copy()
    at, behind = len(out), None
    for n in alive.tolist()[::-1]:
        at -= n
        own, weight = gamma[at : at + n], out[at : at + n] / scales[at : at + n, None]
        if behind is not None:
            m = len(behind)
            moves += own[:m].T @ behind
            beta = behind @ back
            own[:m] *= beta
            weight[:m] *= beta
        behind = weight
    return gamma, moves * move, total
