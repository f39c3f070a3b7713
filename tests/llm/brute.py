"""Plain versions of the operators, on lists of rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, linked):
    """Smallest node reachable, by trying all pairs."""
    nodes = sorted(set(nodes))
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def windows(rows, size=35):
    words = [WORD.findall(r[1] or "") for r in rows]
    starts = Counter(tuple(w[k : k + size]) for w in words for k in range(len(w) - size + 1))
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1):
            if starts[tuple(w[k : k + size])] > 1:
                gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def strings(rows, size=100):
    """``rows`` in the order in which earlier is defined."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - size + 1):
            w = data[k : k + size]
            if w in seen:
                gone[k : k + size] = True
            seen.add(w)
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows):
    prints = [(r[0], simhash(r[1])) for r in rows]
    by_print = defaultdict(list)
    for doc, p in prints:
        by_print[p].append(doc)
    roots = components(by_print, lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for p, docs in by_print.items():
        least[roots[p]] += [d for d in docs if d is not None]
    return [(doc, f"{p:016x}", min(least[roots[p]], default=None)) for doc, p in prints]


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def leaks(rows, items, similarity=0.8):
    """(document, item) pairs with a window at least that similar."""
    out = set()
    for item, text in items:
        w = WORD.findall((text or "").lower())
        if item is None or not w:
            continue
        for doc, body in rows:
            words = WORD.findall((body or "").lower())
            for s in range(len(words)):
                row = edit(w, words[s : s + int(len(w) / similarity) + 1])
                if any(1 - d / max(len(w), n) >= similarity - 1e-9 for n, d in enumerate(row)):
                    out.add((doc, item))
                    break
    return out


def links(vectors, cosine=0.95):
    """n_links and component per row."""
    units = []
    for _, v in vectors:
        fit = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        v = np.array(v, dtype=np.float32).astype(np.float64) if fit else None
        units.append(v / np.linalg.norm(v) if fit else None)
    n = len(vectors)
    linked = [[a is not None and b is not None and i != j and len(a) == len(b) and a @ b >= cosine for j, b in enumerate(units)] for i, a in enumerate(units)]
    roots = components(range(n), lambda a, b: linked[a][b])
    least = defaultdict(list)
    for k, r in roots.items():
        least[r] += [vectors[k][0]] * (vectors[k][0] is not None)
    return [(vectors[k][0], sum(linked[k]), min(least[roots[k]], default=None)) for k in range(n)]


def audit(rows, known):
    """(part, order, step, ...) by applying every order to every document."""
    seen = defaultdict(list)
    for doc, text, *_ in rows:
        if doc is not None:
            seen[text or ""].append(doc)
    good, toxic = ({d for d, *marks in known if marks[at] == 1} for at in (0, 1))
    failing = []
    for doc, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc is not None and min(seen[text]) < doc,
        }
        failing.append((lang or "", {k for k, v in fails.items() if v}, doc is not None and doc in good, doc is not None and doc in toxic))
    out, worth = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        counts = defaultdict(lambda: [0] * 6)
        for part, fails, is_good, is_toxic in failing:
            gone = False
            for step, letter in enumerate(order, 1):
                c = counts[part, step]
                here = letter in fails
                c[0] += not gone and not here
                c[1] += here and not gone
                c[2] += here and gone
                c[3] += fails == {letter}
                c[4] += here and not gone and is_good
                c[5] += here and not gone and is_toxic
                gone |= here
        for (part, step), c in counts.items():
            out[part, "".join(order), step] = c
            worth[part, order[step - 1]] += c[1]
    return Counter((part, order, step, *c, worth[part, order[step - 1]]) for (part, order, step), c in out.items())


def repairs(rows):
    """Conversations repaired by a walk over their rows with a least (cost, audit) for each state."""
    spaced = lambda v: " " if v is None else str(v)
    convs = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = spaced(role), spaced(text)
        how = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        convs[conv] += [(turn, "user" if how == 4 else role, text)] * {0: 0, 3: 2}.get(how, 1)
    return Counter((conv, *_repaired(turns)) for conv, turns in convs.items())


def _repaired(turns):
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in turns:
        solid = re.sub("[ \t\n\x0b\x0c\r]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(cells):
        cells = dict(cells)
        for _ in range(4):
            for state, (cost, edits, lines) in list(cells.items()):
                to, line = (3, "assistant:") if state == 2 else (2, "user:")
                if to not in cells or (cost + 2, edits + "I") < cells[to][:2]:
                    cells[to] = (cost + 2, edits + "I", [*lines, line])
        return cells

    cells = {0: (0, "", [])}
    for (_, role, text), fault in zip(turns, faults):
        after = {}
        for state, (cost, edits, lines) in inserted(cells).items():
            moves = [(state, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                more, to, full = fault == "truncated", 3 if state == 2 else 2, "assistant" if state == 2 else "user"
                moves += [(1, more, "K", [f"{role}:{text}"])] * (state == 0 and role[:1] == "s")
                moves += [(to, more, "K", [f"{role}:{text}"])] * (role[:1] == full[0])
                moves.append((to, more + 2, "R", [f"{full}:{text}"]))
            for to, more, edit_, line in moves:
                if to not in after or (cost + more, edits + edit_) < after[to][:2]:
                    after[to] = (cost + more, edits + edit_, lines + line)
        cells = after
    cost, edits, lines = min((c for s, c in inserted(cells).items() if s in (0, 3)), key=lambda c: c[:2])
    numbers = [t for t, *_ in turns if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def paragraphs(text):
    return Counter(p for p in re.split(r"(?<=\n)|(?<=[.!?] )", text) if p)


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def edits(rows):
    """(doc, n_chars, sha256 of the edited text, likeness to it, likeness to the next document)."""
    def mark(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    order = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), mark(r[1]), r[1]))
    out = []
    for (doc, text), (_, follow) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(text, edited), 9), round(likeness(text, follow), 9)))
    return Counter(out)
