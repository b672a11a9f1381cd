"""The registered queries and the corpus pipeline."""

import random

import numpy as np
from pyspark.sql import functions as F
from helpers import SCHEMA, edge_documents, edge_frame, empty_frame, stored
from test_operators import brute_components, brute_fingerprint, check_pieces  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from textpulse.llm import mixing
from textpulse.llm.registry import ORACLE_SQL, QUERIES


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and set(QUERIES) <= names and set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def staged(spark, docs, tmp_path):
    """Input and output rows of every stage."""
    out = []
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        result = stored(function(spark, docs, str(tmp_path)), tmp_path, f"{number}-{name}")
        out.append((name, docs, result))
        docs = result
    return out


def corpus():
    draw = random.Random(12)
    vocabulary = {lang: ["".join(draw.choices(letters, k=draw.randint(2, 7))) for _ in range(300)]
                  for lang, letters in (("en", "etaoinshr"), ("xx", "kyzuöäwpb"))}
    rows = []
    for i in range(150):
        lang = draw.choice(["en", "en", "xx"])
        rows.append((i, " ".join(draw.choices(vocabulary[lang], k=draw.randint(30, 120))), lang, draw.choice("aaab"), 0, "r", i))
    shared = " ".join(draw.choices(vocabulary["en"], k=70))
    rows += [(200 + i, rows[i][1], rows[i][2], "a", 0, "r", i) for i in range(20)]  # exact copies
    rows += [(300 + i, f"{rows[40 + i][1]} {shared} {rows[60 + i][1]}", "en", "b", 0, "r", i) for i in range(5)]  # a shared passage
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus()
    docs = stored(spark.createDataFrame(rows, SCHEMA), tmp_path)
    result = {name: ([r for r in a.collect()], b.collect(), b.columns) for name, a, b in staged(spark, docs, tmp_path)}
    _, kept, columns = result["language_id"]
    assert columns == docs.columns and len(kept) == len(rows)  # nothing here is to be rejected

    before, after, _ = result["near_duplicates"]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in before}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for doc, p in sorted(prints.items()):
        least.setdefault(roots[p], doc)
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after, _ = result["repeated_passages"]
    texts = {r.doc_id: r for r in after}
    assert sorted(texts) == sorted(r.doc_id for r in before)
    seen, cut = set(), 0
    for r in before:  # in the order of the table
        words = r.text.split()
        grams = [tuple(words[i:i + 50]) for i in range(len(words) - 49)]
        need = {w for i, g in enumerate(grams) if g in seen for w in range(i, i + 50)}
        seen.update(grams)
        left = texts[r.doc_id].text.split()
        assert abs(len(words) - len(left) - len(need)) <= 3  # a word beside a passage may be equal by chance
        assert texts[r.doc_id].n_chars == (len(texts[r.doc_id].text) if need else 0)
        cut += bool(need)
    assert cut >= 4

    before, after, _ = result["mixture"]
    ids = {r.doc_id for r in before}
    assert {r.doc_id for r in after} <= ids and len(after) > 0.4 * len(before)

    before, pieces, _ = result["packing"]
    assert {p.doc_id for p in pieces} == {r.doc_id for r in before}
    assert all(sum(p.length for p in pieces if p.doc_id == r.doc_id) == next(p.doc_tokens for p in pieces if p.doc_id == r.doc_id) for r in before)


def test_stages_on_edge_cases(spark, tmp_path):
    docs = stored(edge_frame(spark), tmp_path)
    for name, before, after in staged(spark, docs, tmp_path):
        if name != "packing":
            assert after.columns == docs.columns
        if name == "near_duplicates":
            # Repeated rows and a copy in other case leave one row.
            groups = {brute_fingerprint(r.text) for r in before.collect()}
            assert after.count() == len(groups) and sorted(r.doc_id for r in after.collect() if r.doc_id in (1, 2)) == [1]
    assert len(edge_documents()) == docs.count()


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = stored(empty_frame(spark), tmp_path)
    assert all(after.count() == 0 for _, _, after in staged(spark, docs, tmp_path))


def test_run_equals_its_stages(spark, tmp_path):
    docs = stored(spark.createDataFrame(corpus(), SCHEMA), tmp_path)
    last = staged(spark, docs, tmp_path)[-1][2]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, last.collect()))


def test_expected_tokens_of_the_mixture(spark, tmp_path):
    docs = stored(spark.createDataFrame(corpus(), SCHEMA), tmp_path)
    got = mixing.calibrated(docs.withColumn("row", F.monotonically_increasing_id())).toPandas()
    for margin in mixing.MARGINS:
        present = got.tokens.groupby(got[margin]).sum()
        want = (present / present.sum()) ** mixing.TEMPER
        have = (got.tokens * got.probability).groupby(got[margin]).sum()
        assert np.allclose(have / have.sum(), want / want.sum(), atol=1e-6)
