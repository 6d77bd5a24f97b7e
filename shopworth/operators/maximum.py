"""Maximum likelihood for a handful of parameters whose sums Spark computes.

Only the parameters, the value, the gradient and the curvature are on the
driver; each step is one Spark aggregate over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np

MAX_STEP = 2.0
GAIN_TOLERANCE = 1e-11
BOUND_SLACK = 1e-6
# Share by which a certificate moves a parameter to look at its neighbours.
NEIGHBOUR = 0.01


class Evaluation(NamedTuple):
    """Log-likelihood with its first and second derivatives by the parameters."""

    value: float
    gradient: np.ndarray
    hessian: np.ndarray


class Penalty(NamedTuple):
    """A normal prior on the logarithm of each parameter: its precision, and the priors' centres."""

    weight: float
    centre: Sequence[float]


class Maximum(NamedTuple):
    """Where the (penalised) likelihood is greatest; ``value`` is the likelihood without penalty."""

    theta: list[float]
    value: float
    n_iter: int
    converged: bool
    at_bound: bool
    penalty: float = 0.0


class Check(NamedTuple):
    """What speaks for one parameter of a fit; all figures are by its logarithm and with the penalty.

    ``bound`` is ``low`` or ``high`` where the parameter lies on a bound, else ``inner``;
    ``pushed`` says that the slope there points out of the bounds. ``below`` and ``above`` are what the likelihood loses
    on moving the parameter by ``NEIGHBOUR`` alone, null beyond a bound.
    """

    parameter: str
    value: float
    bound: str
    slope: float
    curvature: float
    below: float | None
    above: float | None
    pushed: bool


class Certificate(NamedTuple):
    """Whether a fit is a maximum, and why.

    ``gain`` is what a Newton step over the inner parameters would still add to the
    likelihood, ``steepest`` the greatest eigenvalue of the curvature over them: below zero at
    a strict maximum. ``certified`` needs a gain within the rounding of the sums, curvature below
    zero, no neighbour that is better, and bounds that hold their parameter.
    """

    checks: list[Check]
    loglik: float
    gain: float
    steepest: float | None
    certified: bool


class Trial(NamedTuple):
    """A fit on the customers of one half, and the other half's log-likelihood under it."""

    penalty: float
    fit: Maximum
    holdout: float


def _move(
    current: Evaluation, damping: float, at_low: np.ndarray, at_high: np.ndarray
) -> np.ndarray:
    """A damped Newton step that leaves parameters alone which it would push out of bounds."""
    move = np.zeros_like(current.gradient)
    free = np.ones(len(move), dtype=bool)
    while free.any():
        # Absolute eigenvalues make every step point uphill.
        values, vectors = np.linalg.eigh(-current.hessian[np.ix_(free, free)])
        values = np.abs(values)
        values = np.maximum(values, 1e-12 * max(values.max(), 1e-300)) + damping * values.max()
        move[:] = 0.0
        move[free] = vectors @ ((vectors.T @ current.gradient[free]) / values)
        outward = free & ((at_low & (move < 0)) | (at_high & (move > 0)))
        if not outward.any():
            break
        free &= ~outward
        move[outward] = 0.0
    return move


def _reach(point: np.ndarray, move: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The share of ``move`` that stays within the bounds and the longest step."""
    longest = max(np.max(np.abs(move)) / MAX_STEP, 1.0)
    room = np.where(move > 0, high - point, point - low)
    shares = room[move != 0] / np.abs(move[move != 0])
    return float(min(1 / longest, shares.min(initial=1.0)))


def _by_logarithms(
    evaluate: Callable[[Sequence[float]], Evaluation], weight: float, centre: np.ndarray
) -> Callable[[np.ndarray], Evaluation]:
    """The penalised likelihood and its derivatives by the logarithms of the parameters."""

    def at(log_theta: np.ndarray) -> Evaluation:
        theta = np.exp(log_theta)
        value, gradient, hessian = evaluate([float(t) for t in theta])
        slope = theta * gradient
        curve = theta[:, None] * hessian * theta + np.diag(slope)
        away = log_theta - centre
        curve = curve - weight * np.eye(len(theta))
        return Evaluation(value - weight / 2 * float(away @ away), slope - weight * away, curve)

    return at


def certify(
    evaluate: Callable[[Sequence[float]], Evaluation],
    names: Sequence[str],
    theta: Sequence[float],
    bounds: Sequence[tuple[float, float]],
    penalty: Penalty,
) -> Certificate:
    """Whether ``theta`` is where the (penalised) likelihood is greatest, by derivatives and by its neighbours.

    It evaluates the likelihood at the fit and at two neighbours of each parameter, and
    needs nothing of how the fit was found.
    """
    low, high = np.log(np.array(bounds, dtype=float)).T
    at = _by_logarithms(evaluate, penalty.weight, np.log(np.array(penalty.centre, dtype=float)))
    point = np.log(np.array(theta, dtype=float))
    here = at(point)
    # What the sums round to; a neighbour on a plateau may seem better by as much.
    noise = GAIN_TOLERANCE * max(abs(here.value), 1.0)
    at_low, at_high = point - low < BOUND_SLACK, high - point < BOUND_SLACK
    inner = ~(at_low | at_high)
    pushed = (at_low & (here.gradient <= 0)) | (at_high & (here.gradient >= 0))
    checks = []
    for i, name in enumerate(names):
        losses = []
        for step in (np.log1p(-NEIGHBOUR), np.log1p(NEIGHBOUR)):
            moved = point.copy()
            moved[i] += step
            inside = low[i] - BOUND_SLACK <= moved[i] <= high[i] + BOUND_SLACK
            losses.append(float(here.value - at(moved).value) if inside else None)
        bound = "low" if at_low[i] else "high" if at_high[i] else "inner"
        slope, curve = float(here.gradient[i]), float(here.hessian[i, i])
        checks.append(Check(name, float(theta[i]), bound, slope, curve, *losses, bool(pushed[i])))
    gain, steepest = 0.0, None
    if inner.any():
        slopes, curves = here.gradient[inner], here.hessian[np.ix_(inner, inner)]
        steepest = float(np.linalg.eigvalsh(curves).max())
        gain = float(slopes @ np.linalg.lstsq(-curves, slopes, rcond=None)[0]) / 2
    certified = (
        bool((inner | pushed).all())
        and (steepest is None or steepest < 0)
        and 0 <= gain <= noise
        and all(loss is None or loss >= -noise for c in checks for loss in (c.below, c.above))
    )
    return Certificate(checks, float(here.value), gain, steepest, certified)


def maximise(
    evaluate: Callable[[Sequence[float]], Evaluation],
    start: Sequence[float],
    bounds: Sequence[tuple[float, float]],
    max_iter: int = 60,
    penalty: Penalty | None = None,
) -> Maximum:
    """Damped Newton steps on the logarithms of positive, bounded parameters.

    A parameter pressed against its bound is held there and reported as
    ``at_bound``: on data without drop-out the likelihood has no inner maximum. With a
    ``penalty`` there always is one, as it grows with the square of the logarithms.
    """
    low, high = np.log(np.array(bounds, dtype=float)).T
    weight = penalty.weight if penalty else 0.0
    centre = np.log(np.array(penalty.centre if penalty else start, dtype=float))
    at = _by_logarithms(evaluate, weight, centre)
    point = np.clip(np.log(np.array(start, dtype=float)), low, high)
    current = at(point)
    damping, converged, n_iter = 1e-3, False, 1
    while n_iter < max_iter:
        move = _move(current, damping, point <= low, point >= high)
        gain = float(current.gradient @ move)
        # Below this, what a step could gain is lost in the rounding of the sums.
        if damping < 1 and gain <= GAIN_TOLERANCE * abs(current.value):
            converged = True
            break
        trial = np.clip(point + _reach(point, move, low, high) * move, low, high)
        candidate = at(trial)
        n_iter += 1
        if np.isfinite(candidate.value) and candidate.value > current.value:
            point, current, damping = trial, candidate, damping / 10
        else:
            damping = max(damping, 1e-6) * 10
            if damping > 1e8:
                break
    at_bound = bool(np.any((point - low < BOUND_SLACK) | (high - point < BOUND_SLACK)))
    away = point - centre
    value = current.value + weight / 2 * float(away @ away)
    return Maximum([float(t) for t in np.exp(point)], value, n_iter, converged, at_bound, weight)


def best_penalty(trials: Sequence[Trial]) -> float:
    """The weight of an inner maximum under which customers left out are likeliest, of equal ones the least."""
    inner = [t for t in trials if t.penalty > 0 and not t.fit.at_bound] or trials
    return max(inner, key=lambda t: (t.holdout, -t.penalty)).penalty
