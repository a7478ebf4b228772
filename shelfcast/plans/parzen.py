"""Adaptive choice of parameters: densities of good and bad trials, the next trial where they differ most."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist

import numpy as np

#: Candidates drawn for every parameter of a trial.
CANDIDATES = 24

#: Trials drawn blindly before the densities count.
STARTUP = 10

#: Share of the finished trials that count as good, and most of them.
GOOD_SHARE, MOST_GOOD = 0.1, 25

_NORMAL = NormalDist()


class Density:
    """Mixture of normals cut off at the ends of a range: one for every value, and a wide one over the range.

    The width of a value's normal is its distance to the farther of its neighbours (the ends count as such
    for the outermost), between 1 / min(100, 1 + values) of the range and the range.
    """

    def __init__(self, values: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        size = high - low
        centres = [*values, (low + high) / 2]
        order = sorted(range(len(centres)), key=lambda i: centres[i])
        padded = [low, *[centres[i] for i in order], high]
        widths = [0.0] * len(centres)
        least = size / min(100.0, 1.0 + len(centres))
        for place, i in enumerate(order, start=1):
            gap = max(padded[place] - padded[place - 1], padded[place + 1] - padded[place])
            widths[i] = min(max(gap, least), size)
        widths[-1] = size
        self.centres, self.widths = np.array(centres), np.array(widths)
        self.below = np.array([_NORMAL.cdf((low - c) / w) for c, w in zip(centres, widths)])
        self.above = np.array([_NORMAL.cdf((high - c) / w) for c, w in zip(centres, widths)])

    def draw(self, choice: float, quantile: float) -> float:
        """A value from two numbers in [0, 1): which normal, and where in it."""
        i = min(int(choice * len(self.centres)), len(self.centres) - 1)
        at = self.below[i] + quantile * (self.above[i] - self.below[i])
        value = self.centres[i] + self.widths[i] * _NORMAL.inv_cdf(min(max(at, 1e-12), 1 - 1e-12))
        return float(min(max(value, self.low), self.high))

    def log(self, value: float) -> float:
        z = (value - self.centres) / self.widths
        mass = np.exp(-0.5 * z * z) / (self.widths * math.sqrt(2 * math.pi) * np.maximum(self.above - self.below, 1e-12))
        return float(np.log(mass.mean() + 1e-300))


def split_trials(losses: Sequence[float]) -> tuple[list[int], list[int]]:
    """(good, bad) trials: the least losses, a share of all and one at least; earlier trials win ties."""
    order = sorted(range(len(losses)), key=lambda i: (losses[i], i))
    n_good = min(max(1, math.ceil(GOOD_SHARE * len(losses))), MOST_GOOD)
    return sorted(order[:n_good]), sorted(order[n_good:])


class Sampler:
    """Draws trials from a space of named parameters, told the losses of those before.

    Every parameter is drawn by itself: of CANDIDATES values from the density of the good trials the one
    is taken at which that density is greatest against that of the bad trials. The first STARTUP trials are
    drawn from the whole ranges. A trial whose loss is not known yet counts with the greatest loss known,
    so trials that run at the same time do not crowd in one place.
    """

    def __init__(self, space: Mapping[str, object], seed: int = 42, startup: int = STARTUP, candidates: int = CANDIDATES):
        self.space, self.startup, self.candidates = dict(space), startup, candidates
        self.random = np.random.default_rng(seed)
        self.trials: list[dict[str, object]] = []
        self.losses: list[float | None] = []

    def _placed(self) -> list[float]:
        known = [x for x in self.losses if x is not None]
        worst = max(known, default=0.0)
        return [worst if x is None else x for x in self.losses]

    def ask(self) -> dict[str, object]:
        """The parameters of one more trial."""
        blind = len(self.trials) < self.startup or not any(x is not None for x in self.losses)
        good, bad = ([], []) if blind else split_trials(self._placed())
        trial = {}
        for name, kind in self.space.items():
            uniform = self.random.random(2 * self.candidates)
            if blind:
                trial[name] = kind.at(float(uniform[0]))
            else:
                values = [[kind.place(self.trials[i][name]) for i in side] for side in (good, bad)]
                trial[name] = kind.better(*values, uniform[: self.candidates], uniform[self.candidates :])
        self.trials.append(trial)
        self.losses.append(None)
        return trial

    def tell(self, trial: int, loss: float) -> None:
        self.losses[trial] = loss


class Ranged:
    """A parameter that lies between two ends of a line; ``place`` and ``value`` go there and back."""

    def ends(self) -> tuple[float, float]:
        raise NotImplementedError

    def place(self, value: object) -> float:
        raise NotImplementedError

    def value(self, place: float) -> object:
        raise NotImplementedError

    def at(self, share: float) -> object:
        low, high = self.ends()
        return self.value(low + share * (high - low))

    def better(self, good: Sequence[float], bad: Sequence[float], choices: np.ndarray, quantiles: np.ndarray) -> object:
        wanted, other = Density(good, *self.ends()), Density(bad, *self.ends())
        drawn = [wanted.draw(float(c), float(q)) for c, q in zip(choices, quantiles)]
        gains = [wanted.log(x) - other.log(x) for x in drawn]
        return self.value(drawn[int(np.argmax(gains))])


def better_choice(n: int, good: Sequence[int], bad: Sequence[int], choices: np.ndarray) -> int:
    """One of ``n`` options, whose chances are their counts and an equal share of one count more."""

    def chances(seen: Sequence[int]) -> np.ndarray:
        counts = np.bincount(np.array(seen, dtype=np.int64), minlength=n) + 1.0 / n
        return counts / counts.sum()

    wanted, other = chances(good), chances(bad)
    drawn = np.minimum(np.searchsorted(np.cumsum(wanted), choices, side="right"), n - 1)
    return int(drawn[int(np.argmax(np.log(wanted[drawn]) - np.log(other[drawn])))])
