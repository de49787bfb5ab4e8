"""Binary linear-chain conditional random field over sparse string features."""

from __future__ import annotations

import math
from collections.abc import Sequence


def _add(a: float, b: float) -> float:
    top, low = (a, b) if a > b else (b, a)
    return top + math.log1p(math.exp(low - top))


class Crf:
    """Labels 0 and 1. ``weights`` scores label 1 by feature (label 0 scores 0);
    ``steps[a][b]`` scores label b after label a."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.steps = [[0.0, 0.0], [0.0, 0.0]]

    def unary(self, chain: Sequence[Sequence[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in feats]) for feats in chain]

    def decode(self, chain: Sequence[Sequence[str]]) -> list[int]:
        """The most probable labels (Viterbi; label 0 on ties)."""
        if not chain:
            return []
        (s00, s01), (s10, s11) = self.steps
        scores = self.unary(chain)
        zero, one, back = 0.0, scores[0], []
        for u in scores[1:]:
            from_one = (zero + s00 < one + s10, zero + s01 < one + s11)
            zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11) + u
            back.append(from_one)
        label = int(one > zero)
        out = [label]
        for b in reversed(back):
            label = int(b[label])
            out.append(label)
        return out[::-1]

    def marginals(self, chain: Sequence[Sequence[str]]) -> tuple[list[float], list[list[float]]]:
        """Probability of label 1 at each place, expected counts of the steps."""
        u, s = self.unary(chain), self.steps
        n = len(u)
        ahead, behind = [(0.0, u[0])], [(0.0, 0.0)] * n
        for x in u[1:]:
            a, b = ahead[-1]
            ahead.append((_add(a + s[0][0], b + s[1][0]), _add(a + s[0][1], b + s[1][1]) + x))
        for i in range(n - 2, -1, -1):
            a, b = behind[i + 1]
            b += u[i + 1]
            behind[i] = (_add(s[0][0] + a, s[0][1] + b), _add(s[1][0] + a, s[1][1] + b))
        z = _add(*ahead[-1])
        steps = [[0.0, 0.0], [0.0, 0.0]]
        for i in range(n - 1):
            for a in (0, 1):
                for b in (0, 1):
                    steps[a][b] += math.exp(ahead[i][a] + s[a][b] + (u[i + 1] if b else 0.0) + behind[i + 1][b] - z)
        return [math.exp(f[1] + b[1] - z) for f, b in zip(ahead, behind, strict=True)], steps

    def fit(self, chains: Sequence[Sequence[Sequence[str]]], labels: Sequence[Sequence[int]],
            rounds: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Crf:
        """Gradient ascent on the conditional likelihood, page by page, with a
        step that shrinks per feature (AdaGrad) and weight decay."""
        moved: dict = {}

        def step(key, old: float, gradient: float) -> float:
            gradient -= decay * old
            moved[key] = moved.get(key, 1e-6) + gradient * gradient
            return old + rate * gradient / math.sqrt(moved[key])

        for _ in range(rounds):
            for chain, truth in zip(chains, labels, strict=True):
                if not chain:
                    continue
                p, expected = self.marginals(chain)
                gradient: dict[str, float] = {}
                for feats, y, q in zip(chain, truth, p, strict=True):
                    for f in feats:
                        gradient[f] = gradient.get(f, 0.0) + y - q
                for f, g in gradient.items():
                    self.weights[f] = step(f, self.weights.get(f, 0.0), g)
                for a, b in zip(truth, truth[1:], strict=False):
                    expected[a][b] -= 1
                for a in (0, 1):
                    for b in (0, 1):
                        self.steps[a][b] = step((a, b), self.steps[a][b], -expected[a][b])
        return self
