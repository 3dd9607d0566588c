"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

LOWER = {code: code + 32 for code in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(LOWER))


def licenses(rows):
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    out = {}
    for doc_id, text in rows:
        w = words(text)
        at = [(k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p)] == p]
        places = [k for k, _ in at]
        out[doc_id] = (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in at})))
    return out


def exact(rows):
    normal = {doc_id: re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for doc_id, text in rows}
    groups = {}
    for doc_id, text in normal.items():
        groups.setdefault(text, []).append(doc_id)
    return {d: (min(groups[t]), len(groups[t]), d == min(groups[t]), sha(t)) for d, t in normal.items()}


PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def personal(text):
    def holds(kind, body):
        digits = re.sub("[^0-9]", "", body)
        if kind == "ip":
            return all(int(part) <= 255 for part in body.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PII.items() for m in pattern.finditer(text or "") if holds(kind, m.group())]


def contaminated(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = {}
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[doc_id] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def repeats(rows, length=50):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        grams = [data[k : k + length] for k in range(len(data) - length + 1)]
        hit = bytearray(len(data))
        for k, gram in enumerate(grams):
            if gram in seen:
                hit[k : k + length] = b"\1" * length
        seen.update(grams)
        spans = sum(1 for k in range(len(data)) if hit[k] and (not k or not hit[k - 1]))
        out[doc_id] = (len(data), sum(hit), spans, sha(bytes(byte for byte, gone in zip(data, hit) if not gone)))
    return out


def secrets(text):
    shapes = {
        "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18), "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    }
    found = [(m.start(), at, f"{kind}:{m.start()}:{m.end()}") for at, (kind, (p, ok)) in enumerate(shapes.items()) for m in p.finditer(text or "") if ok(m)]
    return [said for _, _, said in sorted(found)]


def shingles(text, n):
    w = words(text, SPACED)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near(rows, n=4, percent=80):
    sets = {doc_id: shingles(text, n) for doc_id, text in rows}
    label = {doc_id: doc_id for doc_id in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def grams(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(rows, target, percent=5, least=20, buckets=10_000):
    """rows with distinct ids -> doc_id: (n_features, weight, score, rank)."""
    place = lambda text: [zlib.crc32(gram.encode()) % buckets for gram in grams(text)]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(place(text))
    for text in target:
        t.update(place(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = {}
    for doc_id, text in rows:
        found = place(text)
        weight = sum(gain[b] for b in found)
        h = int(sha(f"42:{doc_id}")[:8], 16)
        out[doc_id] = (len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least)
    able = sorted((-score, doc_id) for doc_id, (_, _, score, ok) in out.items() if ok)
    rank = {doc_id: k + 1 for k, (_, doc_id) in enumerate(able[: percent * len(able) // 100])}
    return {doc_id: (n, weight, score, rank.get(doc_id)) for doc_id, (n, weight, score, _) in out.items()}


def turned(doc_id, text, unit=re.compile("[A-Za-z]+|[^A-Za-z]", re.S)):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = unit.findall(text)
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def letters(text):
    """Runs of letters and the marks on them, lower-cased."""
    runs, run = [], ""
    for c in (text or "").lower():
        kind = unicodedata.category(c)[0]
        if kind == "L" or (run and kind == "M"):
            run += c
        elif run:
            runs, run = [*runs, run], ""
    return runs + [run] * bool(run)


def languages(labelled, texts, longest=5):
    """labelled (text, lang) -> for each text (lang, score)."""
    langs = sorted({lang for text, lang in labelled if letters(text)})
    counts = {(lang, size): Counter() for lang in langs for size in range(longest + 1)}

    def pieces(word, size):
        marked = word if size == 1 else f"<{word}>"
        return [word] if size == 0 else [marked[k : k + size] for k in range(len(marked) - size + 1)]

    for text, lang in labelled:
        for word in letters(text):
            for size in range(longest + 1):
                counts[lang, size].update(pieces(word, size))
    vocabulary = [set().union(*(counts[lang, size] for lang in langs)) if langs else set() for size in range(longest + 1)]

    def logs(size, term):
        return [math.log((counts[lang, size][term] + 0.5) / (sum(counts[lang, size].values()) + len(vocabulary[size]) + 1)) for lang in langs]

    def of(word):
        for size in (0, *range(longest, 0, -1)):
            known = [logs(size, term) for term in pieces(word, size) if term in vocabulary[size]]
            if known:
                return [sum(column) / len(known) for column in zip(*known)]
        return [0.0] * len(langs)

    out = []
    for text in texts:
        words = letters(text)
        if not words or not langs:
            out.append(("und", 0.0))
            continue
        total = [sum(column) for column in zip(*(of(word) for word in words))]
        best = max(range(len(langs)), key=lambda k: (total[k], -k))
        share = min(len(words), 20) / len(words)
        out.append((langs[best], 1 / sum(math.exp((value - total[best]) * share) for value in total)))
    return out
