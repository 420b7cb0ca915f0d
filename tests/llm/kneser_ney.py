"""Interpolated Kneser-Ney in dictionaries, one language at a time: what the models of Spark tables must equal."""

from collections import defaultdict


def back_off(gram: str, probs, weights, uniform: float) -> float:
    factor = 1.0
    for n in range(len(gram), 0, -1):
        part = gram[len(gram) - n:]
        if part in probs[n]:
            return factor * probs[n][part]
        factor *= weights[n].get(part[:-1], 1.0)
    return factor * uniform


def interpolate(counts: dict[str, int], order: int, uniform: float, kept=lambda gram: True):
    """Interpolated Kneser-Ney with one absolute discount per order; the shares of grams that are not ``kept`` go to their contexts' weights. Below the highest order a gram counts the distinct
    characters before it, except where it begins a run and nothing can precede it."""
    levels: list[dict[str, int]] = [{} for _ in range(order + 1)]
    for gram, c in counts.items():
        levels[len(gram)][gram] = levels[len(gram)].get(gram, 0) + c
    for n in range(order, 1, -1):
        for gram in levels[n]:
            shorter = gram[1:]
            if shorter:
                levels[n - 1][shorter] = levels[n - 1].get(shorter, 0) + 1
    probs: list[dict[str, float]] = [{} for _ in range(order + 1)]
    weights: list[dict[str, float]] = [{} for _ in range(order + 1)]
    for n in range(1, order + 1):
        ones = sum(1 for c in levels[n].values() if c == 1)
        twos = sum(1 for c in levels[n].values() if c == 2)
        discount = ones / (ones + 2 * twos) if ones else 0.5
        total, types = defaultdict(int), defaultdict(int)
        for gram, c in levels[n].items():
            total[gram[:-1]] += c
            types[gram[:-1]] += 1
        for context, t in total.items():
            weights[n][context] = discount * types[context] / t
        for gram, c in levels[n].items():
            if not kept(gram):
                weights[n][gram[:-1]] += max(c - discount, 0) / total[gram[:-1]]
        for gram, c in levels[n].items():
            if not kept(gram):
                continue
            context = gram[:-1]
            lower = uniform if n == 1 else back_off(gram[1:], probs, weights, uniform)
            probs[n][gram] = max(c - discount, 0) / total[context] + weights[n][context] * lower
        if n == 1 and not levels[1]:
            weights[1][""] = 1.0
    return probs, weights
