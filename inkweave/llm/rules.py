"""Ordered rule lists by incremental reduced-error pruning, exported to SQL.

A rule is a conjunction of ``feature >= value`` and ``feature <= value``. Rules are grown one at a
time on two thirds of the rows still uncovered, by information gain over the class sought, pruned on
the other third, and kept while they are right more often than wrong there. The list reads: the first
rule that fits says yes; if none fits, no.
"""

from __future__ import annotations

import math

import numpy as np

Condition = tuple[int, str, float]  # feature, '>=' or '<=', value


def _covers(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for f, op, v in rule:
        hit &= x[:, f] >= v if op == ">=" else x[:, f] <= v
    return hit


def _best_condition(x: np.ndarray, y: np.ndarray) -> tuple[float, Condition] | None:
    """The condition with the highest gain p1 * (log2 share after - log2 share before)."""
    p0, n0 = y.sum(), (~y).sum()
    if not p0 or not n0:
        return None
    before, best = math.log2(p0 / (p0 + n0)), None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, pos = x[order, f], y[order]
        change = np.flatnonzero(v[1:] > v[:-1])  # cut between k and k + 1
        if not len(change):
            continue
        p, n = np.cumsum(pos)[change], np.cumsum(~pos)[change]
        for op, pp, nn in (("<=", p, n), (">=", p0 - p, n0 - n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - before), -np.inf)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), (f, op, round(float((v[change[k]] + v[change[k] + 1]) / 2), 4)))
    return best if best and best[0] > 0 else None


def _grow(x: np.ndarray, y: np.ndarray, longest: int) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < longest:
        hit = _covers(rule, x)
        best = _best_condition(x[hit], y[hit])
        if best is None:
            break
        rule.append(best[1])
        if y[_covers(rule, x)].all():
            break
    return rule


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray) -> list[Condition]:
    """The shortest beginning of the rule with the best (p - n) / (p + n) on rows it was not grown on."""

    def worth(r: list[Condition]) -> float:
        hit = _covers(r, x)
        p, n = int((hit & y).sum()), int((hit & ~y).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def induce(x: np.ndarray, y: np.ndarray, most_rules: int = 24, longest: int = 5, seed: int = 7) -> list[list[Condition]]:
    """The rules for ``y``. Without rows of both classes there is nothing to learn and the list is empty."""
    rng, rules, failed = np.random.default_rng(seed), [], 0
    left = np.ones(len(x), bool)
    y = y.astype(bool)
    while len(rules) < most_rules and failed <= 4 and y[left].any() and (~y[left]).any():
        at = np.flatnonzero(left)
        rng.shuffle(at)
        # Stratified: two thirds of each class to grow, the rest to prune.
        grow = np.concatenate([(c := at[y[at] == k])[: math.ceil(len(c) * 2 / 3)] for k in (True, False)])
        prune = np.setdiff1d(at, grow)
        rule = _grow(x[grow], y[grow], longest)
        if not rule:
            break
        if len(prune):
            rule = _prune(rule, x[prune], y[prune])
            hit = _covers(rule, x[prune])
            if (hit & y[prune]).sum() <= (hit & ~y[prune]).sum():
                failed += 1  # another division of the rows may do better
                if failed > 4:
                    break
                continue
        rules.append(rule)
        left &= ~_covers(rule, x)
    return rules


def predict(rules: list[list[Condition]], x: np.ndarray) -> np.ndarray:
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= _covers(r, x)
    return hit


def to_sql(rules: list[list[Condition]], names: list[str], of: str) -> str:
    """A CASE expression over the fields of the struct ``of``: true where a rule fits."""
    if not rules:
        return "false"
    whens = " ".join("WHEN " + " AND ".join(f"{of}.{names[f]} {op} {v!r}D" for f, op, v in r) + " THEN true" for r in rules)
    return f"CASE {whens} ELSE false END"
