"""Plain Python versions of the contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def groups(texts, percent=90, size=3):
    """key -> (set size, smallest key reachable)."""
    sets = {k: shingle_set(t, size) for k, t in texts.items()}
    home = {k: k for k in sets}

    def find(k):
        while home[k] != k:
            k = home[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            home[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def contamination(text, items, size=10):
    """(words, hit words, items) by comparing every window with every place."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        listed = words(item_text)
        length = min(size, len(listed))
        for k in range(len(listed) - length + 1 if listed else 0):
            for at in range(len(own) - length + 1):
                if own[at : at + length] == listed[k : k + length]:
                    hit.update(range(at, at + length))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda v: re.sub("[^0-9]", "", v)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out += [("ip", *m.span()) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out += [("card", *m.span()) for m in cards if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    out += [("phone", *m.span()) for m in phones if 8 <= len(digits(m[0])) <= 15]
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def counted(spans, kinds):
    found = Counter(s[0] for s in spans)
    return [found[k] for k in kinds]


def equal_texts(rows):
    """key -> (key that stays, rows in the group) for distinct keys."""
    found = defaultdict(list)
    for key, text in rows.items():
        found[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key))
    return {key: (min(group)[1], len(group)) for group in found.values() for _, key in group}


def near_groups(prints, bits=2):
    """key -> smallest key reachable by fingerprints of at most ``bits`` differing bits."""
    home = {k: k for k in prints}

    def find(k):
        while home[k] != k:
            k = home[k]
        return k

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            low, high = sorted((find(a), find(b)))
            home[high] = low
    return {k: find(k) for k in prints}


def simhash(text, size=3):
    listed = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not listed:
        return 0
    grams = [" ".join(listed[k : k + size]) for k in range(max(1, len(listed) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def runs(text, longest):
    """All runs of 1 to ``longest`` words, joined by spaces."""
    listed = words(text)
    return [" ".join(listed[k : k + n]) for n in range(1, longest + 1) for k in range(len(listed) - n + 1)]


def importance(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    """key -> (features, weight, score, rank) for distinct keys."""
    count = lambda texts: Counter(zlib.crc32(r.encode()) % buckets for t in texts for r in runs(t, longest))
    s, t = count(rows.values()), count(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in s}
    out, fit = {}, []
    for key, text in rows.items():
        found = [gain[zlib.crc32(r.encode()) % buckets] for r in runs(text, longest)]
        weight = sum(found) // len(found) if found else 0
        u = (int(sha(f"{seed}:{key}")[:8], 16) + 0.5) / 2**32
        out[key] = (len(found), weight, weight + math.floor(-1000 * math.log(-math.log(u))))
        if len(words(text)) >= least:
            fit.append((-out[key][2], key))
    rank = {key: k + 1 for k, (_, key) in enumerate(sorted(fit)[: len(fit) * percent // 100])}
    return {key: (*found, rank.get(key)) for key, found in out.items()}


def trie(conversations):
    """Rows of the trie of {key: [(role, text), ...]}, sorted."""
    nodes = defaultdict(list)
    for key, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(key)
    rows = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(nodes[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ended = ",".join(str(k) for k in sorted(members) if len(conversations[k]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        children = sum(len(n) == len(node) + 1 for n in below)
        rows.append((min(members), len(node), parent, len(members), children, len(leaves), saved, sha(ended)))
    return sorted(rows, key=lambda r: (r[0], r[1]))
