"""Plain versions of the text operators, for small tables."""

import math
import re
from collections import Counter

SPACES = r"[\x20\x09-\x0D]+"


def words(text, lower=True):
    found = [w for w in re.split(SPACES, text or "") if w]
    return [w.encode().lower().decode() for w in found] if lower else found


def shingles(text, width):
    own = words(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)))


def components(texts, width, num, den):
    """doc_id -> smallest reachable doc_id, by comparing all pairs."""
    sets, root = {i: shingles(t, width) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(texts):
        for b in sorted(texts):
            both = len(sets[a] & sets[b])
            if a < b and both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


def phrases(text, table):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    hits = [(i, label) for phrase, label in table for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(own), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in hits}))


def quality(text):
    own = words(text, lower=False)
    runs = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {i + k for i in range(len(own) - 4) if runs[tuple(own[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    return len(own), sum(map(len, own)), sum(len(re.findall(r"[#*$%&|<>]", w)) for w in own), len(lines) - len(set(lines)), len(covered), failed


def url(text, rules):
    host = path = ""
    if "://" in (text or ""):
        rest = text.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.encode().lower().decode()
    fit = [(len(r.host + r.path), r.host + r.path, r.verdict) for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def unigram_tokens(word, scores, longest=130):
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        best.append(max((best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(max(0, i - longest), i) if word[j:i] in scores))
    return -best[-1][1]


def language_scores(texts, held_out):
    """doc_id -> (n_tokens, n_known, train_tokens, base score, score) under absolute discounting."""
    tokens = {i: [*words(t), "\n"] for i, t in texts.items()}
    ones, twos = Counter(), Counter()
    for i, own in tokens.items():
        if not held_out(i):
            ones.update(own)
            twos.update(zip(own, own[1:]))
    total, size, after = sum(ones.values()), len(ones), Counter(v for v, _ in twos)
    out = {}
    for i, own in tokens.items():
        base = score = 0.0
        for v, w in zip([None, *own], own):
            p = (ones[w] + 1) / (total + size + 1)
            base += math.log10(p)
            if v in after:
                p = max(twos[v, w] - 0.75, 0) / ones[v] + 0.75 * after[v] / ones[v] * p
            score += math.log10(p)
        out[i] = (len(own), sum(w in ones for w in own), total, base, score)
    return out
