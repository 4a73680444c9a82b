"""Mixing by brute force: targets round by round, copies from every seed tried."""

import hashlib
from collections import Counter, defaultdict

from gridmart.llm import mixing as M


def brute_targets(sizes, max_rate=3.0):
    """Round by round: share by weight, stop at the cap, share the excess again."""
    sources = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    target, free, rest = dict.fromkeys(sources, 0.0), set(sources), float(sum(sizes.values()))
    while rest > 1e-9 and free:
        total = sum(weight[s] for s in free)
        shares = {s: rest * weight[s] / total for s in free}
        rest = 0.0
        for s in sorted(free, key=str):
            new = target[s] + shares[s]
            cap = max_rate * sizes[s]
            if new >= cap:
                rest += new - cap
                free.discard(s)
            target[s] = min(new, cap)
    return target


def u(pick, source, doc_id, text, nth=0):
    parts = [source, doc_id, hashlib.md5((text or "").encode()).hexdigest(), nth]
    digest = hashlib.md5("|".join("null" if p is None else str(p) for p in parts).encode()).hexdigest()
    return (int(hashlib.md5(f"{M.SEED}|{pick}|{digest}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13


def brute_copies(rows):
    """Copies of each (source, id, text), summed over equal rows: every source by its best seed."""
    sizes, seen, draws = defaultdict(int), Counter(), defaultdict(list)
    for doc_id, text, source in rows:
        key = (source, doc_id, text or "")
        size = len((text or "").encode().split())
        sizes[source] += size
        draws[source].append((key, size, seen[key]))
        seen[key] += 1
    targets, out = brute_targets(sizes), {}
    for source, own in draws.items():
        rate = targets[source] / sizes[source] if sizes[source] else 0.0
        tries = []
        for pick in range(M.SEEDS):
            got = Counter()
            for key, size, nth in own:
                got[key] += int(rate) + (u(pick, *key, nth) < rate - int(rate))
            miss = abs(sum(size * (int(rate) + (u(pick, *key, nth) < rate - int(rate))) for key, size, nth in own) - targets[source])
            tries.append((miss, pick, got))
        out.update(min(tries, key=lambda t: t[:2])[2])
    return out
