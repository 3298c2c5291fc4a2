"""The scores again, pair by pair in plain Python, and the full scan over contacts."""

from __future__ import annotations


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return (1 - (total - 2 * lcs(a, b)) / total) * 100 if total else 100.0


def token_sort(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    both, left, right = ta & tb, ta - tb, tb - ta
    if both and (not left or not right):
        return 100.0
    shared = " ".join(sorted(both))
    one = " ".join([*sorted(both), *sorted(left)])
    two = " ".join([*sorted(both), *sorted(right)])
    scores = [ratio(one, two)]
    if both:
        scores += [ratio(shared, one), ratio(shared, two)]
    return max(scores)


def partial(a, b):
    def one_way(short, long):
        spans = {long[i:j] for i in range(len(long)) for j in range(i + 1, min(i + len(short), len(long)) + 1)
                 if j - i == len(short) or i == 0 or j == len(long)}
        return max((ratio(short, s) for s in spans), default=0.0)

    if not a and not b:
        return 100.0
    if len(a) == len(b):
        return max(one_way(a, b), one_way(b, a))
    return one_way(*sorted((a, b), key=len))


def partial_token(a, b):
    ta, tb = a.split(), b.split()
    if set(ta) & set(tb):
        return 100.0
    return max(
        partial(" ".join(sorted(ta)), " ".join(sorted(tb))),
        partial(" ".join(sorted(set(ta))), " ".join(sorted(set(tb)))),
    )


def weighted(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    if spread < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort(a, b), token_set(a, b)))
    weight = 0.9 if spread <= 8 else 0.6
    return max(ratio(a, b), weight * partial(a, b), 0.95 * weight * partial_token(a, b))


def scan(wanted, contacts, cutoff, score=weighted):
    """``{name: (score, position)}`` by scoring every pair; first contact wins ties."""
    best = {}
    for name in set(wanted):
        if name is None:
            continue
        for position, other in enumerate(contacts):
            if other is None:
                continue
            value = score(name, other)
            if value >= cutoff and (name not in best or value > best[name][0] + 1e-9):
                best[name] = (value, position)
    return best
