"""Each operator against a brute-force version, and on the cases of helpers.edge_documents."""

import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from helpers import SCHEMA, edge_documents, edge_frame, empty_frame, stored
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textpulse.llm import ann, chunks, langid, licenses, mixing, packing, simhash, tokenfile, topk, toxicity
from textpulse.llm.components import components
from textpulse.llm.vectors import usable

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- near duplicates ---------------------------------------------------------------------

@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_links_are_all_close_pairs(spark, monkeypatch, distance):
    monkeypatch.setattr(simhash, "HOT_BUCKET", 6)  # so that small buckets are cut again too
    draw = random.Random(distance)
    centre = draw.getrandbits(64)
    values = {draw.getrandbits(64) for _ in range(40)} | {centre}
    for _ in range(150):
        near = centre
        for bit in draw.sample(range(64), draw.randint(0, 5)):
            near ^= 1 << bit
        values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance).collect()}
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    assert got == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(50, 51), (51, 52), (52, 50), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: r for n, r in got.items() if n != r} == {**{i: 100 for i in range(101, 141)}, **{i: 1 for i in range(2, 30)}, 51: 50, 52: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_edge_cases(spark):
    rows = edge_documents()
    got = simhash.near_duplicates(edge_frame(spark)).collect()
    mask = (1 << 64) - 1
    prints = [brute_fingerprint(r[1]) for r in rows]
    assert collections.Counter((r.doc_id, r.fp & mask) for r in got) == collections.Counter((r[0], p) for r, p in zip(rows, prints))
    roots = brute_components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for row, p in zip(rows, prints):
        if row[0] is not None:
            least[roots[p]] = min(row[0], least.get(roots[p], row[0]))
    assert all(r.component_id == least.get(roots[r.fp & mask]) for r in got)
    assert simhash.near_duplicates(empty_frame(spark)).count() == 0


# --- packing and files -------------------------------------------------------------------

def whole_ids(path, text):
    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    return np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check_pieces(pieces, rows, length):
    """Every id in one piece, sequences gapless and full or a power of two."""
    want = collections.Counter((i, whole_ids(BYTE, t).tobytes()) for i, t in rows)
    assert sum(len(p.ids) for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    by_doc = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_doc[p.doc_id].append(p)
    for doc, own in by_doc.items():
        texts = {ids for i, ids in want if i == doc}
        assert all(any(ids[4 * p.start:4 * (p.start + p.length)] == p.ids and len(ids) == 4 * p.doc_tokens for ids in texts) for p in own)
        assert sum(p.length for p in own) == sum(len(ids) // 4 * n for (i, ids), n in want.items() if i == doc)
    for _, own in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        at = 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at == length or at < length and at & (at - 1) == 0


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}])
def test_packing_on_edge_cases(spark, weights):
    pieces = packing.pack(edge_frame(spark), BYTE, weights, length=64, window=128).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in edge_documents()], 64)
    assert packing.pack(empty_frame(spark), BYTE).count() == 0


def test_windows_hold_the_target_mixture(spark):
    rows = [(i, " ".join(["word"] * (5 + i % 40)), "en", "abc"[i % 3], 0, "", 0) for i in range(600)]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(5), BYTE, {"a": 2, "b": 1, "c": 1}, length=64, window=256).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in rows], 64)
    tokens = collections.defaultdict(collections.Counter)
    for p in pieces:
        tokens[p.window][p.source] += p.length
    full = [w for w in sorted(tokens) if set(tokens[w]) == {"a", "b", "c"}][:-1]
    assert len(full) > 5
    for at, window in enumerate(full, 1):
        # No window strays, and what one lacks the next ones make up for.
        assert abs(tokens[window]["a"] - 128) <= 1 and abs(tokens[window]["b"] - 64) <= 1
        assert abs(sum(tokens[w]["a"] for w in full[:at]) - 128 * at) <= 1


def test_schedule_sends_everything_once():
    draw = random.Random(3)
    for _ in range(50):
        totals = [draw.choice([1, 2, 50, 1000, 10 ** 7]) for _ in range(draw.randint(1, 6))]
        schedule = packing.Schedule.of(totals, [draw.random() for _ in totals], 100)
        ends = schedule.before(np.array([0, schedule.windows]), slice(None))
        assert ends[0].tolist() == [0] * len(totals) and ends[1].tolist() == totals
        windows = np.arange(min(schedule.windows, 3000) + 1)
        assert (np.diff(schedule.before(windows, slice(None)), axis=0) >= 0).all()


def test_token_files_round_trip(spark, tmp_path):
    uri = f"file://{tmp_path}/tokens"
    manifest = tokenfile.write_tokens(edge_frame(spark), WORD, uri, length=16)
    got = sorted(tokenfile.read_tokens(manifest, uri).collect(), key=lambda r: r.start)
    want = collections.Counter((r[0], whole_ids(WORD, r[1]).tobytes()) for r in edge_documents())
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    for entry in manifest.collect():
        file = tokenfile.TokenFile(uri, entry.file)
        size = -(-entry.tokens // 16)
        stream = b"".join(bytes(r.ids) for r in got)[4 * entry.base:4 * (entry.base + entry.tokens)]
        shown = [file.sequence(k)[:sum(file.mask(k).to_pylist())] for k in range(size)]
        assert np.concatenate(shown).astype("<u4").tobytes() == stream
        assert not file.sequence(0).flags.owndata and not file.sequence(0).flags.writeable  # a view of the file


def test_empty_table_gives_no_files(spark, tmp_path):
    uri = f"file://{tmp_path}/none"
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty_frame(spark), WORD, uri), uri).count() == 0


# --- vector searches ---------------------------------------------------------------------

def vectors(spark, seed, count=400):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, 12))
    rows = [(i, (centres[i % 5] + 0.4 * rng.standard_normal(12)).tolist()) for i in range(count)]
    rows += [(count + i, rows[7][1]) for i in range(120)]  # one vector in many rows
    rows += [(9000, None), (9001, [float("nan")] * 12), (9002, [None] + [1.0] * 11), (9003, [float("inf")] * 12), (9004, []),
             (9005, [1.0, 2.0]), (None, [1.0] * 12), (9006, [0.0] * 12), (3, rows[3][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def valid(df, zero=True):
    rows = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is not None and v and len(v) == 12 and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            rows[r.vec_id] = v
    ids = np.array(sorted(rows))
    return ids, np.array([rows[i] for i in ids])


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_topk_equals_brute_force(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "CHUNK", 50)
    df = vectors(spark, lists)
    rows = usable(df).selectExpr("vec_id", "transform(v, x -> double(floor(256 * x))) v")
    got = topk.search(rows, rows.filter("vec_id % 10 = 0"), 5, lists).collect()
    ids, matrix = valid(df)
    whole = np.floor(256 * matrix).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 10 == 0):
        scores = whole @ whole[q]
        order = [c for c in np.lexsort((ids, -scores)) if c != q][:5]
        want |= {(int(ids[q]), rank, int(ids[c]), int(scores[c])) for rank, c in enumerate(order, 1)}
    assert {tuple(r) for r in got} == want


def test_searches_on_few_rows(spark):
    rows = usable(spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 0.5]), (7, [2.0, 1.0])], "vec_id long, embedding array<float>"))
    assert topk.search(rows, rows.filter("vec_id % 50 = 0"), 5).count() == 4
    assert ann.search(rows, rows.filter("vec_id % 50 = 0"), 5).count() == 4
    none = usable(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert topk.search(none, none, 5).count() == 0 and ann.search(none, none, 5).count() == 0


def test_neighbours_reach_the_recall(spark):
    df = vectors(spark, 9, 3000)
    rows = usable(df, nonzero=True)
    got = collections.defaultdict(list)
    for r in ann.search(rows, rows.filter("vec_id % 20 = 0"), 10).collect():
        got[r.query_id].append(r)
    ids, matrix = valid(df, zero=False)
    found = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        far = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        order = [c for c in np.lexsort((ids, far)) if c != q][:10]
        own = sorted(got[ids[q]], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11)) and len({r.vec_id for r in own}) == 10
        assert np.allclose([r.score for r in own], [far[np.searchsorted(ids, r.vec_id)] for r in own], rtol=1e-12)
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        found += len({r.vec_id for r in own} & {int(ids[c]) for c in order})
        total += 10
    assert found / total >= 0.9


def test_scan_keeps_what_is_near():
    rng = np.random.default_rng(0)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    x, q = rng.standard_normal((500, 64)) @ rotation, rng.standard_normal((20, 64)) @ rotation
    far = ((x[:, None] - q[None]) ** 2).sum(axis=2)
    limits = np.sort(far, axis=0)[20]
    kept = np.zeros(far.shape, bool)
    kept[ann.scan(x, q, limits)] = True
    assert kept[far <= limits].mean() > 0.98 and not kept[far > limits * 1.001].any()


# --- repeated passages -------------------------------------------------------------------

def prose(draw, n):
    return [f"w{draw.randrange(3000)}" for _ in range(n)]


def test_repeated_passages_are_found_whole(spark, tmp_path):
    draw = random.Random(5)
    rows, planted = [], {}
    passages = [prose(draw, 60 + 10 * i) for i in range(6)]
    short = prose(draw, 30)
    for i in range(160):
        before, after = prose(draw, draw.randint(0, 80)), prose(draw, draw.randint(0, 80))
        middle = passages[i % 6] if i % 2 else short if i % 10 == 0 else []
        if i % 2 and i >= 6 + i % 6:
            planted[i] = (len(before), len(before) + len(middle))
        text = " ".join(before + middle + after)
        rows.append((i, text.replace(" w1", "\n W1") if i % 3 == 0 else text, "en", "a", len(text), "", 0))
    got = chunks.find_repeats(stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), tmp_path)).collect()
    found = {r.doc_id: r for r in got}
    firsts = {next(i for i in range(160) if i % 2 and i % 6 == k) for k in range(6) if k % 2}
    want = {i for i in range(160) if i % 2} - firsts
    assert set(found) == want  # clean documents and those with a short passage are left alone
    for i in want:
        first, last = planted.get(i, (None, None))
        if first is not None:
            assert found[i].first_word <= first and found[i].last_word >= last - 1 and found[i].n_words <= last - first + 2


def brute_cover(texts, least=50):
    """Word numbers of each text that lie in a run of ``least`` words seen before."""
    seen, out = set(), []
    for text in texts:
        words, own = text.lower().split(), set()
        for i in range(len(words) - least + 1):
            gram = tuple(words[i:i + least])
            if gram in seen:
                own |= set(range(i, i + least))
            seen.add(gram)
        out.append(own)
    return out


def found_cover(spark, texts, tmp_path):
    rows = [(i, t, "en", "a", 0, "", 0) for i, t in enumerate(texts)]
    got = chunks.find_repeats(stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), tmp_path)).collect()
    out = [set() for _ in texts]
    for r in got:
        own = set(range(r.first_word, r.last_word + 1))
        assert not own & out[r.doc_id] and r.n_words == len(own)  # disjoint
        out[r.doc_id] |= own
    return out


def test_parts_from_different_places_are_no_repeat(spark, tmp_path):
    draw = random.Random(9)
    a, b, c = (prose(draw, 40) for _ in range(3))
    other = lambda n: prose(draw, n)
    texts = [other(30) + a, other(20) + b, a + b, other(9) + a + b + other(9), c + a, b + c + a + b]
    texts = [" ".join(t) for t in texts]
    assert found_cover(spark, texts, tmp_path) == brute_cover(texts)
    assert brute_cover(texts)[2] == set() and len(brute_cover(texts)[3]) == 80


@pytest.mark.parametrize("seed", range(3))
def test_spans_equal_all_grams_of_boilerplate_mixes(spark, tmp_path, seed):
    draw = random.Random(seed)
    parts = [prose(draw, draw.randint(5, 70)) for _ in range(14)]
    texts = [" ".join(sum(([*draw.choice(parts), *prose(draw, draw.choice([0, 0, 1, 30]))] for _ in range(draw.randint(1, 7))), []))
             for _ in range(150)]
    got, want = found_cover(spark, texts, tmp_path), brute_cover(texts)
    assert all(g <= w for g, w in zip(got, want)) or [(g - w) for g, w in zip(got, want) if g - w] == []
    missed = sum(len(w - g) for g, w in zip(got, want))
    assert missed <= 0.002 * sum(map(len, want))  # a chunk border may fall out of step beside a passage


def test_row_numbers_do_not_depend_on_splits(spark, tmp_path):
    from textpulse.llm.common import numbered
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    path = str(tmp_path / "many.parquet")
    frame.repartition(5).write.option("parquet.block.size", 4096).option("parquet.page.size", 512).parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    found = []
    try:
        for size in ("20000", "1000000"):
            for name in names:
                spark.conf.set(name, size)
            rows, where = numbered(spark.read.parquet(path))
            found.append((rows.rdd.getNumPartitions(), sorted(map(tuple, rows.select("row", where["doc_id"]).collect()))))
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert found[0][0] > found[1][0] and found[0][1] == found[1][1]
    assert len({row for row, _ in found[0][1]}) == 20_000


def test_cut_repeats_on_edge_cases(spark, tmp_path):
    rows = edge_documents()
    copy = " ".join(prose(random.Random(1), 120))
    rows += [(20, copy, "en", "a", 1, "k", 5), (21, "Before  it\n" + copy + "\nand  after", "en", "a", 1, "k", 5), (22, copy, None, None, None, None, None)]
    docs = stored(spark.createDataFrame(rows, SCHEMA), tmp_path)
    got = chunks.cut_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    texts = {r.doc_id: r for r in got.collect()}
    assert texts[20].text == copy and texts[21].text == "Before  it\nand  after" and texts[22].text == ""
    assert texts[21].n_chars == len(texts[21].text) and texts[4].text is None and texts[7].text == rows[8][1] and texts[1].row == "x"
    assert chunks.find_repeats(empty_frame(spark)).count() == 0


def test_chunks_resist_shifts():
    draw = random.Random(2)
    words = [w.encode() for w in prose(draw, 2000)]
    shifted = [b"put", b"in"] + words
    cut = lambda ws: {b" ".join(ws[a:b]) for a, b in itertools.pairwise([0, *chunks.chunk_ends(ws).tolist()])}
    assert len(cut(words) - cut(shifted)) <= 3
    data = b" ".join(words[:50])
    slow = [sum(int(chunks.GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) & 0xFFFFFFFF for i in range(len(data))]
    assert chunks.gear(data).tolist() == slow


# --- mixing ------------------------------------------------------------------------------

def test_raking_meets_the_margins(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choices(["alpha", "beta", "gamma", "delta", "of"], k=draw.randint(1, 60))), draw.choice(["en", "fr"]),
             draw.choice("aaaabc"), 0, "", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.monotonically_increasing_id())
    got = mixing.calibrated(docs, {"source": {"a": 0.5, "b": 0.25, "c": 0.25}, "lang": {"en": 0.5, "fr": 0.5}, "topic": 1.0}).toPandas()
    assert {r.doc_id: (r.tokens, r.topic) for r in got.itertuples()} == {r[0]: (mixing.topic(r[1].encode())[0] + 1, mixing.topic(r[1].encode())[1]) for r in rows}
    expected = got.tokens * got.probability
    for margin, want in (("source", {"a": 0.5, "b": 0.25, "c": 0.25}), ("lang", {"en": 0.5, "fr": 0.5})):
        shares = expected.groupby(got[margin]).sum() / expected.sum()
        assert all(abs(shares[k] - v) < 1e-6 for k, v in want.items())
        drawn = (got.tokens * got.kept).groupby(got[margin]).sum() / (got.tokens * got.kept).sum()
        assert all(abs(drawn[k] - v) < 0.06 for k, v in want.items())
    assert got.probability.max() == 1.0 and abs(got.kept.mean() - got.probability.mean()) < 0.04


def test_mixing_on_edge_cases(spark, tmp_path):
    docs = stored(edge_frame(spark), tmp_path)
    got = mixing.calibrated(docs.withColumn("row", F.monotonically_increasing_id()))
    assert got.count() == len(edge_documents())
    assert mixing.sample(docs).columns == docs.columns
    none = stored(empty_frame(spark), tmp_path, "none")
    assert mixing.sample(none).count() == 0
    with pytest.raises(ValueError):
        mixing.shares(["x"], np.array([1.0]), {"y": 1.0})


# --- language, licenses, toxicity --------------------------------------------------------

WORDS = {"en": "the of and that with this from have which their would there about other".split(),
         "fr": "les des une dans pour que qui avec sur pas mais nous vous être".split(),
         "de": "der die und das nicht eine sich auch werden nach über durch wird bei".split()}


def test_language_on_held_out_texts(spark):
    draw = random.Random(4)
    rows = [(" ".join(draw.choices(WORDS[lang], k=draw.randint(5, 60))), lang) for lang in WORDS for _ in range(120)]
    draw.shuffle(rows)
    model = langid.fit(spark.createDataFrame(rows[:240], "text string, lang string"))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows[240:])], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, (_, lang) in enumerate(rows[240:])]) > 0.98
    assert not any(r.rejected for r in got.values()) and all(0 <= r.score <= 1 for r in got.values())
    junk = spark.createDataFrame([(1, "zqxj vkwq xzzk qqjw kxvz wqzx jjkq zxqv " * 8)], "doc_id long, text string")
    assert langid.predict(junk, model).first().rejected


def test_language_on_edge_cases(spark, tmp_path):
    docs = stored(edge_frame(spark), tmp_path)
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(edge_documents())
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 8) or r.doc_id is None and r.score == 0) for r in got)
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, None}
    unknown = langid.fit(empty_frame(spark))
    assert {r.lang_pred for r in langid.predict(docs, unknown).collect()} == {"und"}
    assert langid.predict(empty_frame(spark), model).count() == 0


def test_licenses_on_edge_cases(spark):
    notice = licenses.NOTICES[4][1]
    broken = notice.replace("in source and", "in any source and also")
    rows = edge_documents() + [
        (30, "Released under the MIT-License, or the (MIT) License. Apache  LICENSE", "en", "a", 0, "", 0),
        (31, "x " + notice.upper() + " y", "en", "a", 0, "", 0), (32, broken, "en", "a", 0, "", 0),
        (33, "GNU general public", "en", "a", 0, "", 0), (34, "the cc by cc by gnu general public license", "en", "a", 0, "", 0)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[30].n_base, by[30].first_word, by[30].last_word, by[30].base_labels, by[30].score) == (3, 3, 9, "apache,mit", 1.0)
    assert by[31].labels == "bsd" and by[31].n_base == 0 and by[31].base_labels == "" and by[31].first_word is None
    assert by[32].labels == "bsd" and by[33].labels == "" and (by[34].n_base, by[34].base_labels) == (3, "cc-by,gpl")
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[7].n_words == 5
    assert licenses.scan(empty_frame(spark)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_the_distance():
    terms = {t: 1.0 + i / 10 for i, t in enumerate(["idiot", "idiots", "moron", "scum", "disgusting", "worthless", "trash"])}
    lexicon = toxicity.Lexicon(terms)
    draw = random.Random(6)
    words = set(terms) | {"", "i", "idi0t", "idot", "iidiot", "disgustin", "dizgustng", "scm", "trsh", "zebra"}
    for term in terms:
        for _ in range(150):
            letters = list(term)
            for _ in range(draw.randint(1, 3)):
                at = draw.randrange(len(letters))
                letters[at:at + draw.randint(0, 1)] = draw.choice([[], ["a"], ["t"], ["s"]])
                letters = letters or ["x"]
            words.add("".join(letters))
    for word in words:
        near = [(distance(word, t), -terms[t], t) for t in terms if distance(word, t) <= toxicity.allowed_edits(t)]
        best = min(near) if near else None
        assert lexicon.match(word) == ((best[2], best[0]) if best else None), word


def test_context_tells_quotation_from_abuse():
    scorer = toxicity.Scorer({"idiot": 4.0})
    plain, quoted, told = (scorer.features(t)[1] for t in ("what an idiot that man is", 'he said "what an idiot that is" to me', "you are an idiot my friend"))
    assert quoted < plain < told
    assert scorer.features(None) == scorer.features("") == scorer.features("a kind word")


def test_toxicity_on_held_out_texts(spark):
    draw = random.Random(7)
    filler = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(600):
        words = draw.choices(filler, k=draw.randint(10, 80))
        toxic = i % 5 == 0
        if toxic:
            for term in draw.sample(["idiot", "moron", "scumbag", "worthless"], 2):
                words.insert(draw.randrange(len(words)), term)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    scorer = toxicity.fit(frame, spark.createDataFrame(labels[:400] + [(None, 1), (1, None)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(frame, scorer).collect()}
    assert set(scorer.terms) == {"idiot", "moron", "scumbag", "worthless"}
    assert all(got[i].predicted == toxic for i, toxic in labels[400:])
    spelled = spark.createDataFrame([(1, "w1 idiiot w2 morron w3 worthles")], "doc_id long, text string")
    assert toxicity.score(spelled, scorer).first().score > got[1].score
    assert toxicity.score(edge_frame(spark), scorer).count() == len(edge_documents())
    assert toxicity.score(empty_frame(spark), scorer).count() == 0
    blank = toxicity.fit(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(frame, blank).collect()} == {0}


def test_checksum_of_fold(spark):
    rows = [(i,) for i in range(50)] + [(None,)]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", langid.fold("doc_id", 3).alias("f")).collect()
    assert all(r.f == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 3) for r in got)


def brute_noted(text):
    """Labels of notices that stand in the text in order, each template gram once, within a few diagonals."""
    words, labels = text.split(), set()
    grams = list(zip(words, words[1:]))
    for label, notice in licenses.NOTICES:
        own = notice.split()
        met = [(p, q) for p, g in enumerate(grams) for q, h in enumerate(zip(own, own[1:])) if g == h]
        for start in {p - q for p, q in met}:
            near = sorted((p, q) for p, q in met if start <= p - q <= start + licenses.DRIFT)
            longest = [1] * len(near)
            for i, (p, q) in enumerate(near):
                longest[i] = 1 + max((longest[j] for j in range(i) if near[j][0] < p and near[j][1] < q), default=0)
            if max(longest) >= licenses.COVERED * (len(own) - 1):
                labels.add(label)
    return labels


def test_repeated_words_of_a_notice_are_no_license(spark):
    draw = random.Random(6)
    texts = ["this is " * 12, "free software " * 30]
    for _, notice in licenses.NOTICES:
        words = notice.split()
        texts.append(" ".join(reversed(words)))
        texts.append(" ".join(words[len(words) // 2:] + words[:len(words) // 2]))
        for k in (1, 3, 9):
            spoilt = list(words)
            for _ in range(k):
                at = draw.randrange(len(spoilt))
                spoilt[at:at + draw.randint(0, 1)] = draw.choice([["new"], [], [draw.choice(words)]])
            texts.append("some words before " + " ".join(spoilt) + " and behind")
        texts.append(" ".join(draw.choice(words) for _ in range(200)))
        grams = list(zip(words, words[1:]))
        texts.append(" ".join(" ".join(draw.choice(grams)) for _ in range(150)))
    rows = [(i, t, "en", "a", 0, "", 0) for i, t in enumerate(texts)]
    none = (("never", "no such phrase"),)
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA), phrases=none).collect()}
    want = {i: ",".join(sorted(brute_noted(t))) for i, t in enumerate(texts)}
    assert {i: r.labels for i, r in got.items()} == want
    assert want[0] == want[1] == "" and sum(map(bool, want.values())) > 10
    assert all((r.score >= licenses.COVERED) == bool(r.labels) and (r.score == 0 or r.labels) for r in got.values())
