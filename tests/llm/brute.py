"""Plain versions of the contracts, written without the library."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, fold=False):
    text = text or ""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if fold else text)


def shingle_list(text, k):
    w = words(text, fold=True)
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []


def contaminated(pairs, items, threshold=0.8):
    classes = collections.defaultdict(list)
    for item, text in items:
        classes[frozenset(shingle_list(text, 5))].append(item)
    out = []
    for i, text in pairs:
        own = set(shingle_list(text, 5))
        for c, ids in classes.items():
            if c and len(own & c) >= threshold * len(c):
                out.append((i, min(ids), len(own & c), len(c), len(own)))
    return out


def fingerprint(text):
    import xxhash

    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingle_list(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, radius=3):
    prints = {t: fingerprint(t) for t in {t for _, t in pairs}}
    nodes = sorted(set(prints.values()))
    label = {x: x for x in nodes}
    for _ in nodes:
        new = {x: min(label[y] for y in nodes if (x ^ y).bit_count() <= radius) for x in nodes}
        if new == label:
            break
        label = new
    first = {}
    for i, t in pairs:
        at = label[prints[t]]
        first[at] = min((x for x in (first.get(at), i) if x is not None), default=None)
    return [(i, prints[t], first[label[prints[t]]]) for i, t in pairs]


def deduped(pairs, length=35):
    seen = collections.Counter()
    for _, t in pairs:
        w = words(t)
        seen.update(tuple(w[k : k + length]) for k in range(len(w) - length + 1))
    out = []
    for i, t in pairs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15),
}
SECRET = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
}


def spans(text, patterns):
    kinds = list(patterns)
    return sorted((m.start(), kinds.index(k), m.end()) for k, (p, ok) in patterns.items() for m in re.finditer(p, text or "") if ok(m))


def named(found, kinds):
    return ",".join(f"{kinds[k]}:{a}:{z}" for a, k, z in found)
