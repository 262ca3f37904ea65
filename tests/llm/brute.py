"""Plain Python versions of the contracts, for small tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb

SPACE = "[ \t-\r]"


def table(sf_dir, name):
    return duckdb.sql(f"SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')").fetchall()


def documents(sf_dir):
    return {r[0]: r[1] for r in table(sf_dir, "documents")}


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(f"{SPACE}+", low) if w]


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def components(texts, width, num, den):
    """id -> smallest id reachable by links with intersection * den >= num * union."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def base_scores(texts):
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    count = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    score = lambda ws: sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
    return {i: (held[i], len(ws), sum(count[w] > 0 for w in ws), n, score(ws)) for i, ws in tokens.items()}


def lattice_scores(texts, prior, rounds, prior_tokens):
    """id -> log10 probability with piece weights after so many rounds, in plain probabilities scaled by SCALE per byte."""
    scale = 2000.0
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    tokens = {i: [b" " + w.encode() for w in words(t)] for i, t in texts.items()}
    count = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    ends, weights, end = sum(not h for h in held.values()), prior, 1 / prior_tokens

    def edges(word, w):
        return [(a, b, w[word[a:b]] * scale ** (b - a)) for b in range(1, len(word) + 1) for a in range(b) if word[a:b] in w]

    def before(word, found):
        mass = [1.0] + [0.0] * len(word)
        for a, b, p in found:
            mass[b] += mass[a] * p
        return mass

    for _ in range(rounds):
        expected = collections.Counter()
        for word, n in count.items():
            found = edges(word, weights)
            mass, after = before(word, found), [0.0] * len(word) + [1.0]
            for a, b, p in reversed(found):
                after[a] += p * after[b]
            for a, b, p in found:
                expected[word[a:b]] += n * mass[a] * p * after[b] / mass[-1]
        total = sum(expected.values()) + ends + prior_tokens
        end = (ends + 1) / (total + 1)
        weights = {k: (1 - end) * (expected[k] + prior_tokens * p) / (total - ends) for k, p in prior.items()}
    log10 = {w: math.log10(before(w, edges(w, weights))[-1]) - len(w) * math.log10(scale) for ws in tokens.values() for w in ws}
    return {i: sum(log10[w] for w in ws) + math.log10(end) for i, ws in tokens.items()}


def statistics(text):
    text = text or ""
    w = [x for x in re.split(f"{SPACE}+", text) if x]
    windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    inside = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = text.split("\n")
    dup = sum(1 for k, x in enumerate(lines) if re.sub(SPACE, "", x) and x in lines[:k])
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 12 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PII.items()) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def cut_lines(texts):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    return {i: "\n".join(x for x in (t or "").split("\n") if common.get(key(x), i) == i) for i, t in texts.items()}


def distance_inside(item, text):
    """Least edit distance of the item to any part of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for a, c in enumerate(item, 1):
        new = [a]
        for b, d in enumerate(text, 1):
            new.append(min(row[b] + 1, new[-1] + 1, row[b - 1] + (c != d)))
        row = new
    return min(row)
