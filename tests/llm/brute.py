"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text: str | None) -> list[str]:
    return [w.decode() for w in WORD.findall((text or "").encode())]


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def classes(docs, width=3, percent=90):
    """{id: (set size, least id reachable)} for unique ids."""
    sets = {}
    for i, text in docs:
        w = WORD.findall((text or "").encode().translate(LOWER))
        grams = [tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))]
        sets[i] = frozenset(grams) if w else frozenset()
    label = {i: i for i in sets}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted."""
    found = [
        (m.start(), n, m.end(), kind)
        for n, (kind, pattern) in enumerate(PII.items())
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m.group())
    ]
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def without_windows(docs, width=35):
    """One (n_words, n_removed, digest) per document, in order."""
    parted = [words(text) for _, text in docs]
    seen = Counter(
        tuple(w[i : i + width]) for w in parted for i in range(len(w) - width + 1)
    )
    out = []
    for w in parted:
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((len(w), keep.count(False), sha(kept)))
    return out


def without_bytes(docs, length=100):
    """One (n_bytes, n_removed, n_spans, digest) per document, in order of id."""
    seen, out = set(), []
    for _, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), gone.count(1), len(re.findall(rb"\x01+", gone)), sha(kept)))
    return out


def rule_counts(text: str | None):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text, w = text or "", words(text)
    places: dict[tuple, list[int]] = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines = Counter(line for line in text.split("\n") if words(line))
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(lines.values()) - len(lines), len(covered),
    )
