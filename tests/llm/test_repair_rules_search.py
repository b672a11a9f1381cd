"""Conversation repair, quality rules and lexical search against brute-force versions."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest
from helpers import SCHEMA, edge_documents, edge_frame, empty_frame

from textpulse.llm import conversations, lexical, quality

# --- conversation repair -----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, position string, audit int"


def ordered_rows(rows):
    """Rows of a conversation as they are taken: by turn, nulls first, then role and digest."""
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), hashlib.md5(row[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if blank else "duplicate" if (role, text) in seen else
                   "truncated" if not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost and audit by trying every edit of at most three rows, with up to two insertions in each gap."""
    kinds = faults(rows)
    found = []
    for gaps in itertools.product(range(3), repeat=len(rows) + 1):
        for letters in itertools.product("KRD", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and x != "D" for f, x in zip(kinds, letters)):
                continue
            cost = 5 * sum(gaps) + sum({"K": 0, "R": 1, "D": 2}[x] + 5 * (f == "truncated" and x != "D") for f, x in zip(kinds, letters))
            audit = "".join("I" * g + x for g, x in zip(gaps, letters)) + "I" * gaps[-1]
            # Inserted and rewritten roles are free: one dot each, to be read as u or a.
            shape = "".join("." * g + {"K": r[1][:1] or "?", "R": ".", "D": ""}[x] for g, x, r in zip(gaps, letters, rows)) + "." * gaps[-1]
            for free in itertools.product("ua", repeat=shape.count(".")):
                roles = iter(free)
                if re.fullmatch("(s?(ua)+)?", "".join(next(roles) if c == "." else c for c in shape)):
                    found.append((cost, audit))
                    break
    return min(found)


def brute_repair(rows):
    rows = ordered_rows(rows)
    kinds, count = faults(rows), collections.Counter
    cost, audit = cheapest(rows)
    turns = {t for t, *_ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    lines, at, system = [], 0, 0
    for letter in audit:
        _, role, text = rows[at] if letter != "I" else (0, "", "")
        at += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = ("user", "assistant")[(len(lines) - system) % 2]
        elif role[:1] == "s":
            system = 1
        lines.append(f"{role}:{text}")
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count(kinds)["blank"], count(kinds)["duplicate"], count(kinds)["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_conversations(draw, count, most):
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t", "and then. ", None]
    return {c: [(draw.choice([None, 1, 2, 3, 9]), draw.choice(["system", "user", "assistant", "tool", "", None, "user"]), draw.choice(texts))
                for _ in range(draw.randint(1, most))] for c in range(count)}


@pytest.mark.parametrize("block", [1, 2, 65_536])
def test_repair_equals_all_ways(spark, block):
    talks = random_conversations(random.Random(block), 60, 3)
    talks[None] = [(1, "user", "Hi."), (2, "assistant", "Hi."), (2, "assistant", "Hi.")]
    rows = [(c, t, r, x, "p", 1) for c, own in talks.items() for t, r, x in own]
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    ids = spark.createDataFrame([(c,) for c in [*talks, 1000]], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.digests(frame, ids, block).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {**{c: brute_repair(own) for c, own in talks.items()}, 1000: empty}
    lines = collections.defaultdict(list)
    for r in sorted(conversations.repaired(frame, block).collect(), key=lambda r: r.position):
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in talks} == {c: got[c][-1] for c in talks}


def test_long_conversations_are_cut_into_blocks(spark):
    """The result does not depend on the blocks, and many copies of a row are one row on the way."""
    draw = random.Random(4)
    rows = [(1, i, draw.choice(["user", "assistant", "tool"]), draw.choice([f"text {i}.", f"cut {i}", ""]), "", 0) for i in range(400)]
    rows += [(2, 1, "user", "again.", "", 0)] * 300
    frame = spark.createDataFrame(rows, TURNS)
    one, many = ({r.conv_id: tuple(r) for r in conversations.digests(frame, frame, size).collect()} for size in (65_536, 7))
    assert one == many and one[2][3] == 299 and len(one[2][7]) == 300
    codes = bytes(draw.choice([0, 1, 2, 3, 6, 9, 10]) for _ in range(300))
    assert conversations._audit(codes, 0, 3) == forward_only(codes, 3)


def forward_only(codes, end):
    """Audit-least cheapest edits with whole strings carried along, in quadratic space."""
    best = {0: (0, "")}
    for code in codes:
        best = {j: min((c + w[0], a + w[1]) for i, (c, a) in best.items() if (w := conversations.EDITS[code][i][j]))
                for j in range(4) if any(conversations.EDITS[code][i][j] for i in best)}
    return best[end][1]


def test_damage_and_empty_tables(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.digests(conversations.damaged(none), none).count() == 0 and conversations.repaired(none).count() == 0
    rows = spark.createDataFrame([(c, t, None if t == 3 else "assistant", "A. B! C?", "", 0) for c in range(40) for t in range(5)], TURNS)
    import zlib
    want = collections.Counter()
    for c, t in itertools.product(range(40), range(5)):
        dealt = zlib.crc32(f"{c}:{t}".encode()) % 20
        if dealt:
            want[c, t, "user" if dealt == 4 else " " if t == 3 else "assistant", "" if dealt == 1 else "A B C" if dealt == 2 else "A. B! C?",
                 1 + (dealt == 3)] += 1
    assert collections.Counter(map(tuple, conversations.damaged(rows).collect())) == want


# --- quality rules -----------------------------------------------------------------------

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n, repeat = len(words), {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(words) < 500 else None
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat) if repeat is not None else None


def quality_texts():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdeoü", k=draw.randint(2, 8))) for _ in range(200)]
    prose = " ".join(draw.choices(words, k=120))
    return [prose, prose + "\n", "x y z " * 40, "\n".join([prose[:90]] * 30), " ".join(f"{w} # $ %" for w in prose.split()), prose.upper().replace("Ü", "U"),
            " ".join(draw.choices("0123456789", k=100)), "a b c d", " ".join(["the"] * 60 + prose.split()[:60]), "\x0b\x0c \x1c ", prose + " the cat sat the cat sat"]


def test_measures_equal_brute_force(spark):
    texts = quality_texts()
    rows = edge_documents() + [(100 + i, t, "en", "a", 0, "r", 0) for i, t in enumerate(texts)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality.judged(spark.createDataFrame(rows, SCHEMA), measures=names).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    for i, text in enumerate(texts):
        own = next(r for r in got if r.doc_id == 100 + i)
        assert tuple(own[n] for n in names) == brute_quality(text)
    kept = {r.doc_id for r in got if r.failed_rule is None}
    assert kept == {100, 101, 110}  # ASCII prose; the upper-case, repeated, symbol, digit and short ones go
    assert quality.judged(empty_frame(spark), measures=names).count() == 0
    back = quality.passing(spark.createDataFrame(rows, SCHEMA))
    assert back.columns == edge_frame(spark).columns and {r.doc_id for r in back.collect()} == kept


def test_the_cascade_is_ordered_and_stops():
    verdicts = np.array([[1, 1, 0, 0], [1, 1, 0, 0], [0, 1, 1, 0], [0, 0, 1, 0]], bool)
    nanos = np.array([[100, 1000, 10, 5]] * 4)
    # Rule 2 is cheapest for what it rejects; then rule 0; rule 1 has nothing left and is dearer than 3.
    assert quality.cascade(verdicts, nanos) == [2, 0, 3, 1]
    assert sorted(quality.cascade(np.zeros((0, 4), bool), np.zeros((0, 4), int))) == [0, 1, 2, 3]
    asked = []
    rules = [quality.Rule(n, lambda t, n=n: asked.append(n) or n == "b") for n in "abc"]
    assert quality.failed(quality.Text(b"x"), rules) == "b" and asked == ["a", "b"]


# --- lexical search ----------------------------------------------------------------------

def brute_search(docs, items, k):
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    terms = [(i, find.findall((t or "").translate(lower))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n_docs, total = len(terms), sum(len(t) for _, t in terms)
    df = collections.Counter(w for _, t in terms for w in set(t))
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(find.findall((t or "").translate(lower)))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, t in terms:
            m = 100 - 50 + 50 * len(t) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * tf // (1000 * tf + 20 * m))
                        for w, tf in collections.Counter(t).items() if w in wanted)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("TERMS_AT_ONCE", 12), ("TREE_DOCS", 16), ("TREE_ENTRIES", 90), ("BLOCKS", 4), ("FIRST_OF", 3)):
            monkeypatch.setattr(lexical, name, value)
    draw = random.Random(2)
    words = ["alpha", "Beta", "gamma9", "дом", "漢字", "x", "Österreich", "delta", "no", "yes", "É", "42"]
    texts = [(i, draw.choice([" ", ", ", "-"]).join(draw.choices(words, k=draw.randint(1, 25)))) for i in range(120)]
    texts += [(200 + i, "alpha beta x") for i in range(30)] + [(7, texts[7][1]), (8, "!!!")]
    docs = [(i, t, "en", "a", 0, "r", 0) for i, t in texts] + edge_documents()
    items = [(1, "ALPHA beta"), (2, "дом, 漢字 unheard"), (2, "x"), (3, None), (None, "quick fox 42"), (5, ""), (6, " ".join(words) * 3), (9, "unheard of")]
    got = lexical.search(spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    assert sorted(map(tuple, got), key=repr) == brute_search([(d[0], d[1]) for d in docs], items, 10)


def test_search_without_documents_or_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(edge_frame(spark), none).count() == 0
    some = spark.createDataFrame([(1, "quick")], "item_id long, text string")
    assert lexical.search(empty_frame(spark), some).count() == 0


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(1)
    width, n = 300, 1500
    rows = []
    for i in range(n):  # ten subjects with words of their own
        own = np.unique(np.concatenate([draw.integers(0, 30, 8), 30 + 27 * (i % 10) + draw.integers(0, 27, 6)]))
        rows.append((own, draw.integers(100_000, 900_000, len(own))))
    ptr = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])])
    weights = np.concatenate([draw.integers(100, 900, 30), draw.integers(3000, 7000, width - 30)])
    starts = lexical.block_starts(np.bincount(np.concatenate([t for t, _ in rows]), minlength=width))
    tree = lexical.BallTree(ptr, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), starts, weights)
    leaves = scored = 0
    for q in range(30):
        terms = np.unique(np.concatenate([draw.integers(0, 30, 6), 30 + 27 * (q % 10) + draw.integers(0, 27, 5)]))
        own = weights[terms]
        block, place = np.unique(np.searchsorted(starts, terms, "right") - 1, return_inverse=True)
        vector = (terms, own, block, np.sqrt(np.bincount(place, own.astype(float) ** 2)))
        dense = np.zeros(width, np.int64)
        dense[terms] = own
        want = np.array([int((dense[t] * v).sum()) for t, v in rows])[tree.order]
        reach = tree.bounds(0, len(tree.low), *vector)
        assert all(reach[k] >= want[a:b].max() for k, (a, b) in enumerate(zip(tree.low, tree.high)))
        best = lexical.Best(1, 10)
        scored += lexical.descend(tree, list(range(n)), (q, *vector), dense, best)
        leaves += int((tree.children == 0).sum())
        assert sorted(-r[0] for r in best.rows) == sorted(want)[-10:]
    assert scored < leaves / 4


# --- the registered queries next to their SQL ----------------------------------------------

@pytest.mark.parametrize("name", ["op1_exact_topk", "op9_license_scan", "op11_conversation_repair", "op12_quality_rules", "op13_lexical_search"])
def test_query_equals_sql(spark, name):
    from textpulse.llm.registry import ORACLE_SQL, QUERIES
    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    frame, cursor = QUERIES[name](spark, folder), con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    rows = lambda found: sorted(repr([r[c] for c in sorted(names)]) for r in found)
    assert rows(r.asDict() for r in frame.collect()) == rows(dict(zip(names, r)) for r in cursor.fetchall())
