import json
import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from textpulse.operators import threads
from textpulse.schemas import MESSAGE
from textpulse.sources import arrays
from textpulse.sources.items import ORDER, read_items

RUN = datetime(2025, 1, 1, tzinfo=timezone.utc)


def _walk(items):
    """Plain recursion over the same rules."""
    rows = []

    def comments(nodes, parent, post):
        for c in nodes:
            if not c.get("id"):
                continue
            rows.append((c["id"], parent, (c.get("body") or "").strip(), post.get("subredditName"), "Comment",
                         (c.get("upVotes") or 0) - (c.get("downVotes") or 0)))
            if isinstance(c.get("replies"), list):
                comments(c["replies"], c["id"], post)

    for p in items:
        if not p.get("id"):
            continue
        rows.append((p["id"], None, ((p.get("title") or "") + "\n" + (p.get("body") or "")).strip(),
                     p.get("subredditName"), "Post", (p.get("upVotes") or 0) - (p.get("downVotes") or 0)))
        if isinstance(p.get("comments"), list):
            comments(p["comments"], p["id"], p)
    return rows


def _tree(rng, depth, counter):
    nodes = []
    for _ in range(rng.randint(0, 3) if depth else 0):
        counter[0] += 1
        node = {"body": f' "quoted" [b{counter[0]}] {{x}} \\ ', "upVotes": rng.randint(0, 9)}
        if rng.random() > 0.1:
            node["id"] = f"c{counter[0]}"
        node["replies"] = _tree(rng, depth - 1, counter) if rng.random() > 0.2 else rng.choice(["", None, []])
        nodes.append(node)
    return nodes


def _items():
    rng, counter = random.Random(7), [0]
    items = [{"id": f"p{i}" if i % 11 else "", "title": f"T{i}", "subredditName": f"s{i % 3}", "upVotes": i,
              "downVotes": 2, "comments": _tree(rng, 7, counter)} for i in range(40)]
    items += [{"id": "q1", "title": None, "comments": {"id": "x"}}, {"id": "q2", "body": "only body"},
              {"title": "no id", "comments": [{"id": "lost"}]}]
    return items


@pytest.mark.parametrize("lines", [True, False])
def test_flatten_matches_recursion_in_order(spark, tmp_path, lines):
    items = _items()
    text = "\n".join(map(json.dumps, items)) if lines else json.dumps(items)
    (tmp_path / "items.json").write_text(text)
    flat = threads.flatten_threads(read_items(spark, str(tmp_path), multi_line=not lines), ORDER)
    rows = flat.orderBy(*ORDER, "place").collect()
    got = [(r.id, r.parent_id, r.text, r.subreddit, r.type, r.score) for r in rows]
    assert got == _walk(items) and len(got) > 200


def _chain(depth):
    nested = "[]"
    for i in range(depth, 0, -1):
        nested = f'[{{"id":"n{i}","replies":{nested}}}]'
    return nested


@pytest.mark.parametrize("indent", [None, 1])
def test_array_files_are_read_in_splits(spark, tmp_path, indent):
    rng, counter = random.Random(3), [0]
    items = [{"id": f"p{i}", "title": f'quote " brace }} {{ [ back\\slash \\" é {i}', "body": "x" * rng.choice([0, 10, 9000]),
              "comments": _tree(rng, 5, counter)} for i in range(300)]
    (tmp_path / "one.json").write_text(" \n" + json.dumps(items, indent=indent, ensure_ascii=False) + "\n")
    (tmp_path / "two.json").write_text(json.dumps([1, "a{", [{"id": "nested"}], items[0], None, items[1]]))
    (tmp_path / "none.json").write_text("[]")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for name in names:
            spark.conf.set(name, "20000")
        assert arrays._segments(spark, str(tmp_path)).rdd.getNumPartitions() > 20
        read = read_items(spark, str(tmp_path), multi_line=True).orderBy(*ORDER).collect()
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    got = {name: [r for r in read if r._file.endswith(name)] for name in ("one.json", "two.json", "none.json")}
    assert [r.id for r in got["one.json"]] == [i["id"] for i in items]
    assert all((r.title, r.body) == (i["title"], i["body"]) and json.loads(r.comments) == i["comments"] for r, i in zip(got["one.json"], items))
    assert [r.id for r in got["two.json"]] == ["p0", "p1"] and not got["none.json"]


def _thread(spark, comments):
    nulls = {"title": "string", "body": "string", "createdAt": "variant", "upVotes": "long",
             "downVotes": "long", "subredditName": "string", "url": "string", "author": "string"}
    return spark.createDataFrame([("p", comments)], "id string, comments string").withColumns(
        {c: F.lit(None).cast(t) for c, t in nulls.items()})


def test_deep_chain_is_whole(spark, tmp_path):
    for depth in (400, 2_000, 20_000):
        flat = threads.flatten_threads(_thread(spark, _chain(depth))).orderBy("place").collect()
        assert [(r.id, r.parent_id) for r in flat] == [("p", None), ("n1", "p"), *[(f"n{i}", f"n{i - 1}") for i in range(2, depth + 1)]]
    (tmp_path / "items.json").write_text(f'{{"id":"p","comments":{_chain(2_000)}}}\n\n{{"id":"q"}}\nno JSON\n')
    assert threads.flatten_threads(read_items(spark, str(tmp_path)), ORDER).count() == 2_002


def test_wide_thread_is_whole_in_linear_time(spark):
    def wide(n):
        inner = ",".join(f'{{"id":"r{i}","body":"reply ]}} {i}"}}' for i in range(n // 2))
        return f'[{{"replies":[{inner}],"id":"first"}},' + ",".join(f'{{"id":{i}}}' for i in range(n // 2)) + "]"
    seconds = []
    for n in (50_000, 400_000):
        began = time.perf_counter()
        found = threads.flatten_threads(_thread(spark, wide(n)))
        assert found.agg(F.count("*"), F.count_distinct("id"), F.count_if(F.col("parent_id") == "first")).first() == (n + 2, n + 2, n // 2)
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 16 * seconds[0]


@pytest.mark.parametrize("text", ["", "[", "[]", "{}", '{"id":"x"}', '[{"id":"x"]', '[{"id":"x"}]]', '"[1]"', "null", '[{"id":"x"}] more',
                                  '[1,"x",null,[{"id":"y"}],{"id":null},{"id":"","replies":[{"id":"z"}]}]'])
def test_text_without_comments(spark, text):
    assert [r.id for r in threads.flatten_threads(_thread(spark, text)).collect()] == ["p"]


def test_dedupe_keeps_first_and_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(3, "a", "late"), (1, "a", "early"), (2, "b", "x")] + [
        (10 + i, "hot", str(i)) for i in range(2000)], "n int, id string, text string").repartition(4)
    out = threads.dedupe_first(df, ("n",))
    assert {r.id: r.text for r in out.collect()} == {"a": "early", "b": "x", "hot": "0"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_times(spark):
    df = spark.createDataFrame([("1", "1641852316"), ("2", "abc"), ("3", None)], "id string, timestamp string")
    rows = threads.impute_timestamps(threads.parse_timestamps(df), RUN).orderBy("id").collect()
    assert [r.timestamp_imputed for r in rows] == [False, True, True]
    stamped = threads.impute_timestamps(threads.parse_timestamps(df), RUN)
    assert threads.since_filter(stamped, None).count() == 3
    assert threads.since_filter(stamped, datetime(2022, 1, 10, 22, 5, 16)).count() == 2  # strict
    assert threads.since_filter(stamped, RUN).count() == 0


def test_gate(spark):
    assert threads.require_rows(spark.range(10), 10).count() == 10
    with pytest.raises(threads.InsufficientData):
        threads.require_rows(spark.range(9), 10)


def test_message_schema(spark, tmp_path):
    from textpulse.plans.batch import messages
    (tmp_path / "items.json").write_text("\n".join(map(json.dumps, _items())))
    df = messages(read_items(spark, str(tmp_path)), RUN)
    types = dict(df.dtypes)
    assert {f.name: f.dataType.simpleString() for f in MESSAGE.fields} == {c: types[c] for c in MESSAGE.fieldNames()}


def test_a_shallow_scan_finds_the_same_roots():
    """Without the objects below, whose brackets are matched all the same."""
    from textpulse.functions.brackets import NONE, scan
    item = '{"id":1,"x":{"comments":[{}]},"comments":[{"id":"a\\"]","replies":[{"id":3,"replies":[]}]},{"id":"b"}],"title":"[{"}'
    for text, names in ((item, {"root": "comments"}), (f"[{item}, {item}, 3]", {"children": "comments"})):
        whole, roots = scan(text, **names), scan(text, **names, deep=False)
        ends = lambda tree: [(tree.start[i], tree.end[i], tree.low[i], tree.high[i]) for i in range(len(tree.start)) if tree.parent[i] == NONE]
        assert ends(roots) == ends(whole) and set(roots.parent) == {NONE} and len(whole.start) > len(roots.start)
        assert scan(text.replace('3,"replies":[]}', '3,"replies":[}'), **names, deep=False) is None


def test_structure_of_array_bytes():
    """Quotes and depth by table, as one byte after another gives them; without a backslash nothing looks for one."""
    import numpy as np
    from textpulse.sources import arrays
    for text in ('[{"a":"b]"},{}]', r'[{"a\"]":"\\"},{"b":"\\\"}"}]', '"', "\\", "é\U0001f600{"):
        raw = text.encode()
        quotes, seen, slashes = [], 0, 0
        for byte in raw:
            quotes.append(seen)
            seen += byte == 0x22 and slashes % 2 == 0
            slashes = slashes + 1 if byte == 0x5C else 0
        passed, change = arrays._structure(np.frombuffer(raw, np.uint8))
        assert passed.tolist() == quotes and change.tolist() == [{"[": 1, "{": 1, "]": -1, "}": -1}.get(chr(b), 0) for b in raw]
        assert arrays._CHANGE.sum() == 0
