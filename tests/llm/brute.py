"""Plain Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WHITE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contaminated(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for at in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[at : at + width])].add("null" if item is None else str(item))
    lengths = {len(window) for window in windows}
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for length in lengths:
            for at in range(len(words) - length + 1):
                window = tuple(words[at : at + length])
                if window in windows:
                    hit |= set(range(at, at + length))
                    ids |= windows[window]
        yield doc, len(words), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)


def jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        ahead = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for order, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 18), (2, "hex", "[0-9a-f]+", 16)):
        found += [
            (m.start(), order, kind, m.end())
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def url(value, rules):
    at = (value or "").find("://")
    host = path = ""
    if at >= 0:
        host = re.match(r"[^/?#]*", value[at + 3 :])[0]
        path = re.match(r"[^?#]*", value[at + 3 + len(host) :])[0]
        host = host.translate(LOWER)
    fitting = [
        (len(h) + len(p), len(h), v == "block", h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def near(docs, percent):
    rows, parent, classes, holders = [], {}, defaultdict(list), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    for doc, text in docs:
        words = WHITE_WORD.findall((text or "").translate(LOWER))
        shingles = (tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4)))
        shingles = frozenset(shingles) if words else frozenset()
        rows.append((doc, shingles))
        parent[doc] = doc
        if shingles:
            classes[shingles].append(doc)
    sets = list(classes)
    for at, shingles in enumerate(sets):
        for other in classes[shingles][1:]:
            link(classes[shingles][0], other)
        for shingle in shingles:
            holders[shingle].append(at)
    both = Counter((a, b) for held in holders.values() for a in held for b in held if a < b)
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            link(classes[sets[a]][0], classes[sets[b]][0])
    return {(doc, len(s), root(doc), root(doc) == doc) for doc, s in rows}


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Shares given out until none is above its source's limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[at % len(weights)] for at, s in enumerate(order)}
    found = dict.fromkeys(order, 0.0)
    free, rest = set(order), share * sum(sizes.values())
    while free and rest > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            found[s] += rest * weight[s] / total
        rest = sum(max(0.0, found[s] - cap * sizes[s]) for s in order)
        full = {s for s in free if found[s] >= cap * sizes[s]}
        for s in full:
            found[s] = cap * sizes[s]
        free -= full
    return found


def quality(text):
    text = text or ""
    words = WHITE_WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {
        place
        for at in range(len(words) - 2)
        if triples[tuple(words[at : at + 3])] > 1
        for place in (at, at + 1, at + 2)
    }
    lines = [line for line in text.split("\n") if WHITE_WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def tokens(text, scores):
    """Viterbi over the whole text, without words or trie."""
    if not text:
        return 0
    marked = "▁" + text.replace(" ", "▁")
    byte, longest = min(scores.values()) - 10_000_000, max(map(len, scores))
    best = [(0, 0)]
    for end in range(1, len(marked) + 1):
        width = len(marked[end - 1].encode())
        found = (best[-1][0] + width * byte, best[-1][1] - width)
        for start in range(max(0, end - longest), end):
            score = scores.get(marked[start:end])
            if score is not None:
                found = max(found, (best[start][0] + score, best[start][1] - 1))
        best.append(found)
    return -best[-1][1]


def archived(pages):
    payloads = [(page, (html or "").encode()) for page, _, html in pages]
    last = {}
    for page, body in payloads:
        last[body] = max(last.get(body, -1), -1 if page is None else page)
    for page, body in payloads:
        revisit = len(body) >= 1000 and page != last[body]
        digest = hashlib.sha1(body).hexdigest()
        yield page, len(body), digest, "revisit" if revisit else "response", last[body] if revisit else None


def collocations(rows, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(" ".join(words[at : at + size]) for at in range(len(words) - size + 1))
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            words = phrase.split(" ")
            if len(words) < 2 or a < least:
                continue
            if len(words) == 2 and any(
                100 * b >= 50 * a and b >= least and " " + phrase + " " in " " + longer + " "
                for longer, b in counts.items()
                if b >= least and longer.count(" ") == 2
            ):
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (counts[" ".join(words[:k])] * counts[" ".join(words[k:])]), k,
                 counts[" ".join(words[:k])], counts[" ".join(words[k:])])
                for k in range(1, len(words))
            )
            found.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, n[lang], -score


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle(doc, text):
    """(n, form, prefix, middle, output) of a row."""
    text = text or ""
    digest = sha(f"42:{'' if doc is None else doc}")
    h = [int(digest[8 * at : 8 * at + 8], 16) for at in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def simhash(text):
    words = WHITE_WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[at : at + 3]) for at in range(max(1, len(words) - 2) if words else 0)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def simhash_groups(prints):
    """Fingerprint -> the group's number, by comparing all different ones."""
    values = np.array(sorted(set(prints)), np.uint64)
    group = np.arange(len(values))
    for at, value in enumerate(values):
        near = np.bitwise_count(values ^ value) <= 3
        for other in set(group[near]) - {group[at]}:
            group[group == other] = group[at]
    return dict(zip(values.tolist(), group.tolist(), strict=True))


def simhash_rows(docs):
    """(doc, fingerprint, component) of (doc, text) rows."""
    prints = [simhash(text) for _, text in docs]
    groups = simhash_groups(prints)
    least = {}
    for (doc, _), value in zip(docs, prints, strict=True):
        if doc is not None:
            least[groups[value]] = min(doc, least.get(groups[value], doc))
    for (doc, _), value in zip(docs, prints, strict=True):
        yield doc, f"{value:016x}", least.get(groups[value])
