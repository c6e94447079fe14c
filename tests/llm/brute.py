"""Plain versions of the operators, for small tables."""

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = WORD.findall(lowered(text))
    if not words:
        return set()
    width = min(5, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def linked(x, y):
    both = len(x & y)
    return bool(x and y) and 100 * both >= 75 * (len(x) + len(y) - both)


def components(docs):
    """{doc_id: smallest reachable id} from {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    lowest = {i: i for i in docs}
    changed = True
    pairs = [(a, b) for a in docs for b in docs if a < b and linked(sets[a], sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(lowest[a], lowest[b])
            if lowest[a] != low or lowest[b] != low:
                lowest[a] = lowest[b] = low
                changed = True
    return lowest, {i: len(s) for i, s in sets.items()}


def without_copies(docs, width=50):
    """{doc_id: (bytes, removed, spans, digest)} from {doc_id: text}."""
    raw = {i: (t or "").encode() for i, t in docs.items()}
    first = {}
    for i in sorted(raw):
        for k in range(len(raw[i]) - width + 1):
            first.setdefault(raw[i][k : k + width], i)
    found = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        found[i] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return found


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def personal(text):
    """Base spans as kind:start:end, in order."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", m))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m))
    return [f"{kind}:{m.start()}:{m.end()}" for kind, m in found]


def lines_left(docs, min_words=10, min_docs=50):
    """{doc_id: text without repeated runs of two lines, or of one line that is long or in many documents}."""
    seen, left = {}, {}
    holders = {}
    for i in docs:
        for line in set((docs[i] or "").split("\n")):
            holders[line] = holders.get(line, 0) + 1
    places = []
    for i in sorted(docs):
        lines = (docs[i] or "").split("\n")
        worded = [k for k, x in enumerate(lines) if WORD.search(x)]
        places.append((i, lines, worded))
        for p, k in enumerate(worded):
            seen.setdefault(lines[k], (i, p))
            if p + 1 < len(worded):
                seen.setdefault((lines[k], lines[worded[p + 1]]), (i, p))
    for i, lines, worded in places:
        gone = set()
        for p, k in enumerate(worded):
            goes = len(WORD.findall(lines[k])) >= min_words or holders[lines[k]] >= min_docs
            if goes and seen[lines[k]] < (i, p):
                gone.add(k)
            if p + 1 < len(worded) and seen[lines[k], lines[worded[p + 1]]] < (i, p):
                gone.update((k, worded[p + 1]))
        left[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return left
