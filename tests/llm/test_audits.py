"""Filter interaction audit, conversation repair and document fingerprints, against SQL and brute force."""

import itertools
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
import corpus_data as data  # noqa: E402
from basketlens.llm import conversations, registry, sketches  # noqa: E402
from basketlens.session import Scratch  # noqa: E402
from compare import connect, differences  # noqa: E402

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    return data.write(tmp_path_factory.mktemp("odd"))


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_conversation_repair"])
def test_rows_match_sql_on_odd_rows(spark, odd, name):
    assert differences(QUERIES[name](spark, odd), connect(odd), ORACLE[name]) == []


def test_filter_audit(spark, odd):
    rows = data.documents()
    got = Counter(tuple(r) for r in QUERIES["op11_filter_audit"](spark, odd).collect())
    assert got == brute.audit(rows, data.labels(rows))
    assert {r[0] for r in got} == {"", "en", "de", "fr"} and len(got) == 4 * 600


def test_audit_of_many_copies_without_number(spark, tmp_path):
    from basketlens.llm.interplay import audit_filters

    table = [(None, "the same words", "en")] * 50 + [(7, "the same words", None), (7, "the same words", "en"), (8, "the same words", "xx")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = Counter(tuple(r) for r in audit_filters(docs, labels, Scratch(spark, "t")).collect())
    assert got == brute.audit(table, [(7, 1, 0), (7, 0, 1)])


def test_conversation_repair(spark, odd):
    got = Counter(tuple(r) for r in QUERIES["op12_conversation_repair"](spark, odd).collect())
    assert got == brute.repairs(data.conversations())
    nothing = [r for r in got if r[0] is not None and r[0] >= 1000]
    assert [r[1:8] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("partitions", [1, 60])
def test_conversations_that_spread_over_tasks(spark, odd, partitions):
    """One conversation may begin in one task, fill others, and end in a further one."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = Counter(tuple(r) for r in QUERIES["op12_conversation_repair"](spark, odd).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute.repairs(data.conversations())


def _every_edit(symbols):
    """Least (cost, audit) of a conversation by trying every edit and up to two insertions before, between and after its rows."""
    best = None
    choices = [["D"] if s == "x" else ["D", "R", "K"] for s in symbols]
    for edits in itertools.product(*choices):
        for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
            roles, cost, audit = "", 0, ""
            for at, many in enumerate(inserts):
                roles, cost, audit = roles + "?" * many, cost + 2 * many, audit + "I" * many
                if at < len(symbols):
                    s, e = symbols[at], edits[at]
                    roles += {"D": "", "R": "?", "K": s.lower()}[e]
                    cost += {"D": 3, "R": 2, "K": 0}[e] + (e != "D" and s.isupper())
                    audit += e
            body = roles[1:] if roles[:1] == "s" else roles
            fits = len(body) % 2 == 0 and all(r in "?" + "ua"[k % 2] for k, r in enumerate(body)) and (body or not roles)
            if fits and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_interval_parsing_finds_the_least_edits():
    for length in range(4):
        for symbols in itertools.product("suaoUAx" if length < 3 else "suaAx", repeat=length):
            cells = conversations.parse("".join(symbols))
            assert min(cells["00"], cells["03"]) == _every_edit(symbols), symbols


def test_split_of_long_spans_does_not_matter(monkeypatch):
    rng = random.Random(3)
    symbols = "".join(rng.choice("suaoUAx") for _ in range(70))
    whole = conversations.parse(symbols)
    for block in (1, 7, 16):
        monkeypatch.setattr(conversations, "BLOCK", block)
        span = conversations.Span({})
        for s in symbols:
            span.add(s)
        assert span.cells() == whole


def test_fingerprints(spark, odd):
    rows = QUERIES["op13_fingerprints"](spark, odd).collect()
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)
    assert got == brute.edits(data.documents())
    prints = {}
    for r in rows:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len({p for k in range(60, 70) for p in prints[k]}) == 1 and prints[96] == prints[97]


def test_fingerprints_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketches, "ROWS_PER_RANGE", 15)
    monkeypatch.setattr(sketches, "PAIRS", 4)
    rng = random.Random(2)
    table = [(rng.choice([None, 1, 3, 3, 9, 2**60, 2**60 + 1, -5, *range(100, 160)]), rng.choice([None, "", "a. b.", "x\ny\nx\n" * rng.randrange(9), data.prose(rng, 30)])) for _ in range(300)]
    rows = sketches.fingerprint_documents(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows) == brute.edits(table)


def test_a_document_alone_follows_itself(spark):
    row = sketches.fingerprint_documents(spark.createDataFrame([(4, "One. Two. Three")], "doc_id long, text string")).first()
    assert row.near_next == 1.0 and row.n_chars == 15


@pytest.mark.parametrize("apart", [0, 1, 10, 300, 5000])
def test_peeling_recovers_what_differs(apart):
    rng = np.random.default_rng(apart)
    common = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (apart, apart // 3))
    sets = [np.concatenate([common, left]), np.concatenate([right, common[::-1]])]
    (a, b), (c, d) = sketches.differing(sets, np.array([[0, 1], [1, 1]]))
    assert (sorted(a), sorted(b)) == (sorted(left), sorted(right)) and not len(c) and not len(d)


def test_short_paragraphs_that_repeat_have_digests_of_their_own():
    """Numbers of repetition and short paragraphs must not cancel each other out."""
    for text in ("a. b. c. " * 300, "".join(f"{c}\n" * (k + 1) for k, c in enumerate("abcdefghijklmnop"))):
        assert len(sketches.digests(text)) == sum(brute.paragraphs(text).values())
        sets = [sketches.digests(text), sketches.digests("")]
        assert len(sketches.differing(sets, np.array([[0, 1]]))[0][0]) == len(sets[0])


def test_cells_of_a_fingerprint():
    """The sketch of a small set, cell by cell."""
    keys = sketches.digests("One. Two.\nOne. ")
    assert len(set(keys.tolist())) == 3 and sketches.digests("One. ")[0] in keys
    table = sketches.sketch([keys])
    count, key = [0] * 24, [0] * 24
    for at, k in zip(table.cells(np.zeros(3, dtype=np.int64), keys).T, keys):
        for cell in at:
            count[cell] += 1
            key[cell] ^= int(k)
    assert table.count.tolist() == count and table.key.tolist() == key
