"""Small corpora with every odd case: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = [a + b + c for a in ("th", "re", "on", "st") for b in ("a", "e", "é", "ou") for c in ("nd", "r", "ing", "ß", "t")]
INSULTS = ["idiot", "scum", "moron"]
CLASHING = ["row", "key", "lines", "size", "block", "print", "class", "_", "gone", "copies", "bits", "count",
            "part", "mask", "digest", "spread", "own", "n", "place", "guest", "mark", "first", "numbered"]


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    return "".join(w + (".\n" if k % 11 == 10 else " ") for k, w in enumerate(words)).strip()


def documents(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    passage, line = prose(rng, 60), "a line that many documents share, of some length "
    base = prose(rng, 150)
    rows = []
    for k in range(60):
        rows.append((k, prose(rng, rng.randrange(20, 160)), "en", f"src{k % 4}"))
    for k in range(60, 70):
        rows.append((k, base, "en", "src0"))  # exact copies
    for k in range(70, 76):
        words = base.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words), "en", "src1"))  # near copies
    for k in range(76, 84):
        rows.append((k, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "de", "src2"))  # one passage
    for k in range(84, 92):
        rows.append((k, f"{prose(rng, 20)}\n  {line.upper() if k % 2 else line}\t\n{prose(rng, 20)}\n{line}", "en", None))  # one line
    for k in range(92, 96):
        rows.append((k, "that " * 90 + prose(rng, 10), "en", "src3"))  # one word again and again
    rows += [
        (96, None, "en", "src0"), (97, "", None, "src1"), (98, " \t\n\r\x0b\f ", "en", "src1"), (99, "\n", "en", "src2"),
        (100, "one", "en", "src2"), (101, "x" * 300, "en", "src2"), (102, prose(rng, 6000), "fr", "src3"), (103, "nul\x00byte é " * 30, "fr", "src3"),
        (None, base, "en", "src0"), (None, "no number and no copy", None, None),
        (104, base, "en", "src0"), (104, base, "en", "src0"), (104, "the same number and another text", "en", "src0"),
        (105, "Released under the MIT License.", "en", "src0"), (106, "Text. Released under the MIT License. This work is licensed under the GNU General Public License, version 3.\nMore", "en", "src0"),
    ]
    for k in range(107, 112):
        rows.append((k, base + " " + rng.choice(INSULTS) + " " + prose(rng, 20), "en", "src1"))
    return rows


def labels(rows: list[tuple]) -> list[tuple]:
    return [(r[0], int(len(r[1] or "") > 100), int(any(w in (r[1] or "") for w in INSULTS))) for r in rows if r[0] is not None and r[0] % 2] + [
        (None, 1, 1), (3, None, None), (5, 0, 0), (5, 1, 1)]


def benchmark(rows: list[tuple]) -> list[tuple]:
    words = rows[10][1].split()[:18]
    near = rows[12][1].split()[:25]
    near[7] = "other"
    return [(0, " ".join(words)), (1, " ".join(near)), (2, "words that stand in no document at all but here alone"), (3, None), (None, "x"), (4, ""), (0, "zzz second text of a number")]


def embeddings(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vectors = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(80)]
    for k in range(40):
        vectors.append([x + rng.gauss(0, 0.05) for x in vectors[k % 8]])
    vectors += [vectors[0]] * 6 + [[2 * x for x in vectors[0]]]
    rows = [(k, v) for k, v in enumerate(vectors)]
    return rows + [(900, None), (901, [0.0] * 16), (902, [None] + [1.0] * 15), (903, [float("nan")] * 16), (904, [float("inf")] * 16), (905, []),
                   (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, vectors[1]), (0, vectors[0])]


def conversations(seed: int = 6) -> list[tuple]:
    """Short, long and unnumbered ones, with missing and repeated turns, odd roles and empty texts."""
    rng, rows = random.Random(seed), []
    for conv, length in [(k, rng.randrange(1, 9)) for k in range(120)] + [(500, 70), (501, 200), (None, 40)]:
        for turn in range(length):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, "system" if turn == 0 and conv and conv % 5 == 0 else role, prose(rng, rng.randrange(1, 30)) + rng.choice([".", "!", "", "? \n"])))
    for _ in range(250):
        rows.append((rng.choice([600, 601, 602, None]), rng.choice([None, *range(-3, 25)]), rng.choice(["user", "assistant", "system", "tool", None, "", "User"]),
                     rng.choice(["", None, " \t\n", "ok.", "and then", "y?", "x" * 5000, "é!"])))
    rows += [(700, 2, "user", "the only row."), (701, None, None, None)]
    # A conversation that is dropped whole.
    gone = next(k for k in range(1000, 2000) if all(zlib.crc32(f"{k}:{t}".encode()) % 20 == 0 for t in (0,)))
    return rows + [(gone, 0, "user", "dropped.")]


def write(folder: Path, empty: bool = False) -> str:
    """documents, labels, benchmark, embeddings and conversations as Parquet files."""
    rows = [] if empty else documents()
    known = [] if empty else labels(rows)
    items = [] if empty else benchmark(rows)
    vectors = [] if empty else embeddings()
    col = lambda data, at, kind: pa.array([r[at] for r in data], kind)
    docs = {"doc_id": col(rows, 0, pa.int64()), "text": col(rows, 1, pa.string()), "lang": col(rows, 2, pa.string()), "source": col(rows, 3, pa.string()),
            "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64())}
    docs |= {name: pa.array(["clash"] * len(rows), pa.string()) for name in CLASHING}
    pq.write_table(pa.table(docs), folder / "documents.parquet")
    pq.write_table(pa.table({"doc_id": col(known, 0, pa.int64()), "quality": col(known, 1, pa.int32()), "toxic": col(known, 2, pa.int32()), "label": pa.array(["x"] * len(known), pa.string())}), folder / "labels.parquet")
    pq.write_table(pa.table({"item_id": col(items, 0, pa.int64()), "text": col(items, 1, pa.string()), "doc_id": pa.array([1] * len(items), pa.int64())}), folder / "benchmark.parquet")
    pq.write_table(pa.table({"vec_id": col(vectors, 0, pa.int64()), "embedding": col(vectors, 1, pa.list_(pa.float32())), "label": pa.array([1] * len(vectors), pa.int32()),
                             "class": pa.array(["c"] * len(vectors), pa.string())}), folder / "embeddings.parquet")
    turns = [] if empty else conversations()
    pq.write_table(pa.table({"conv_id": col(turns, 0, pa.int64()), "turn": col(turns, 1, pa.int64()), "role": col(turns, 2, pa.string()), "text": col(turns, 3, pa.string())}
                            | {name: pa.array(["clash"] * len(turns), pa.string()) for name in ("kind", "times", "head", "digest", "how", "found", "copy")}), folder / "conversations.parquet")
    return str(folder)
