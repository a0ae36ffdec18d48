"""Plain single-machine versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def simhash(text, shingle=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def groups(prints, radius=3):
    """Index of the first member of each one's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(lines.values()) - len(lines), len(covered)


def base_failed(text):
    n, *_, repeat = measures(text)
    return n < 10 or 100 * repeat > 20 * n


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.findall("[0-9]", m.group())) <= 15]


def targets(sizes, weights=(1, 2, 3)):
    """{source: size} -> {source: target}, sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * left >= 3 * sizes[s] * total}
        if not full:
            target |= {s: w[s] * left / total for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return target


def mixed(rows):
    """rows (doc_id, source, size) -> (source_size, target, words taken, passes kept whole) of each."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    target, at, out = targets(sizes), defaultdict(int), {}
    key = lambda i: hashlib.md5(f"mix:{rows[i][0]}".encode()).hexdigest()
    for i in sorted(range(len(rows)), key=key):
        _, s, n = rows[i]
        parts = [max(0, min(n, int(target[s]) - at[s] - e * sizes[s])) for e in range(3)]
        out[i] = (sizes[s], target[s], sum(parts), sum(1 for p in parts if p and 2 * p >= n))
        at[s] += n
    return [out[i] for i in range(len(rows))]


def without_repeats(rows, length):
    """rows (doc_id, text) in order -> {doc_id: (n_bytes, n_removed, n_spans, sha256 of the rest)}."""
    seen, out = set(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return out
