"""Plain models of the operators' contracts, one text at a time, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANKS = " \t\n\x0b\x0c\r"


def sha(value: str | bytes) -> str:
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def matches(text, rules):
    """(start, rank, kind, end) of the base rules, and how many of each."""
    found, n = [], [0] * len(rules)
    for rank, (kind, pattern, holds) in enumerate(rules):
        for m in re.finditer(pattern, text or ""):
            if holds(m):
                found.append((m.start(), rank, kind, m.end()))
                n[rank] += 1
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found)), n


# The base patterns of the contracts.
SECRETS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def digits(m) -> str:
    return re.sub("[^0-9]", "", m[0])


def luhn(number: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(p) <= 255 for p in m[0].split(".")),
    ),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def line_dedup(texts, min_docs=10, min_chars=1):
    """(lines, dropped, kept text) per text."""

    def key(line):
        stripped = lower(line.strip(BLANKS))
        return stripped if len(stripped) >= min_chars else ""

    counts = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and counts[key(x)] >= min_docs)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text, size):
    words = WORD.findall(lower(text or ""))
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_dedup(rows, size, threshold=80):
    """{id: (set size, smallest id reachable)} of (id, text) rows with distinct ids."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def substring_dedup(texts, length):
    """(bytes, removed, runs, kept bytes) per text."""
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return out


def terms(text):
    return TERM.findall(lower(text or ""))


def decontamination(texts, items, window=10):
    """(words, hit words as a set, item names) per text."""
    windows = defaultdict(set)
    for name, text in items:
        words = terms(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(name))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, names = terms(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((len(words), hit, names))
    return out


def statistics(text):
    """words, word characters, symbols, repeated lines, repeated words, whether the base fails."""
    text = text or ""
    words = WORD.findall(text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if counts[t] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def mixture_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by sharing again what is over, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        target = {
            s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in order
        }
        over = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def token_counts(text, encoding, sections, rule):
    """{section: (tokens, crossing tokens)}; sections are (name, first byte, end), in order."""
    counts = {name: [0.0, 0] for name, _, _ in sections}
    at = 0
    for token in encoding.encode_ordinary(text):
        end = at + len(encoding.decode_single_token_bytes(token))
        parts = [(name, min(end, high) - max(at, low)) for name, low, high in sections]
        parts = [(name, size) for name, size in parts if size > 0]
        for name, size in parts:
            counts[name][1] += len(parts) > 1
            if rule == "share":
                counts[name][0] += size / (end - at)
        if rule == "first":
            counts[parts[0][0]][0] += 1
        elif rule == "most":
            counts[max(parts, key=lambda p: p[1])[0]][0] += 1
        at = end
    return {name: tuple(c) for name, c in counts.items()}


def line_sections(text):
    out, at = [], 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        end = at + len(line.encode()) + (i + 1 < len(lines))
        out.append((i, at, end))
        at = end
    return out


def spelling_variants(docs, ratio=10, every=31, least=7, min_count=2):
    """word: (form, root, n, n_near, form_n), from (id, text) pairs."""
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= min_count}
    masked, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            masked[w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * c:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def hard_negatives(rows, every=100, n_positives=5, n_negatives=10):
    """(anchor, positive, rank, negative, scores), from (id, vector, label) triples."""
    good = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            good.append((i, [math.floor(256 * x) for x in vector], label))
    out = []
    for a, (anchor, own, label) in enumerate(good):
        if anchor % every:
            continue
        score = [sum(x * y for x, y in zip(own, v)) for _, v, _ in good]
        order = sorted((x for x in range(len(good)) if x != a), key=lambda x: (-score[x], good[x][0]))
        for p in [x for x in order if good[x][2] == label][:n_positives]:
            fits = [
                x
                for x in order
                if good[x][2] != label and 30 * score[p] <= 100 * score[x] <= 90 * score[p]
            ]
            for rank, x in enumerate(fits[:n_negatives], 1):
                out.append((anchor, good[p][0], rank, good[x][0], score[p], score[x]))
    return sorted(out)


def document_features(text):
    """The numbers that the trees of the quality rules look at, in their order."""
    text = text or ""
    words = WORD.findall(text)
    n, chars, symbols, repeated, covered, _ = statistics(text)
    lines = text.split("\n")
    per_line = [len(WORD.findall(line)) for line in lines]
    upper, digits = (sum(low <= c <= high for c in text) for low, high in (("A", "Z"), ("0", "9")))
    marks = sum(c.isascii() and not c.isalnum() and c not in BLANKS and c not in "#*$%&|<>" for c in text)
    return [
        math.log1p(n),
        chars / max(n, 1),
        symbols / max(n, 1),
        repeated / len(lines),
        covered / max(n, 1),
        upper / max(chars, 1),
        digits / max(chars, 1),
        marks / max(chars, 1),
        len(set(words)) / max(n, 1),
        n / len(lines),
        sum(0 < k < 3 for k in per_line) / len(lines),
        math.log1p(max((len(w.encode()) for w in words), default=0)),
    ]
