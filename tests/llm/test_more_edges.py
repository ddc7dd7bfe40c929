"""Cases at the rim: huge items, tight budgets, last code points, vectors of several lengths."""

import random

import numpy as np
import pytest

from tillroll.llm import chat_windows, decontaminate, neighbours, url_rules


def test_rules_fit_paths_that_begin_with_the_last_code_point(spark):
    urls = ["http://a.com/\U0010ffffx", "http://a.com/\U0010ffff", "http://a.com/", "http://b.net/\U0010ffff"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = [("com", "/", "block"), ("a.com", "/\U0010ffff", "allow"), ("net", "/x", "block")]
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(pages, rules).collect()}
    inner = ("a.com/\U0010ffff", "allow")
    assert got == {0: inner, 1: inner, 2: ("com/", "block"), 3: (None, "allow")}


def test_windows_stay_within_the_budget(spark):
    rng = random.Random(1)
    rows = [(0, i, "user", "x" * n) for i, n in enumerate([400, 400, 3500, 40])]
    for c in range(1, 60):
        sizes = [rng.choice([40, 400, 900, 1700, 2500, 3500]) for _ in range(rng.randrange(1, 9))]
        if c % 3 == 0:
            rows.append((c, -1, "system", "s" * rng.choice([40, 900, 2000])))
        rows += [(c, i, rng.choice(["user", "assistant"]), "x" * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    tokens = {(c, t): -(-len(x) // 4) + 4 for c, t, _, x in rows}
    windows = chat_windows.format_windows(df).collect()
    again = 0
    for w in windows:
        opening = tokens.get((w["conv_id"], -1), 0) if w["window_start"] else 0
        if w["tokens"] > 1024:
            # Then nothing is repeated but the system turn, beside one turn.
            assert w["n_turns"] <= 1 + (opening > 0)
        again += w["context_turns"] > (opening > 0)
    assert again > 10
    assert sum(w["n_turns"] - w["context_turns"] for w in windows) == len(rows)


@pytest.mark.parametrize("most_words", [60])
def test_items_in_pieces_hit_like_whole_ones(spark, most_words):
    rng = random.Random(2)
    items = [(f"i{k % 9}", " ".join(rng.choice("abcd") for _ in range(rng.randrange(25)))) for k in range(20)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(200))) for i in range(10)]
    items = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = [
        sorted(map(str, decontaminate.scan_documents(docs, items, ["doc_id"], 4, most).collect()))
        for most in (10**6, most_words)
    ]
    assert got[0] == got[1]


def test_an_item_of_over_a_million_words(spark):
    words = [f"w{i}" for i in range(1_150_000)]
    items = spark.createDataFrame([("big", " ".join(words))], "item_id string, text string")
    texts = [(1, " ".join(words[600_000:600_012])), (2, " ".join(words[0:9])), (3, " ".join(words[-10:]) + " x")]
    texts.append((4, " ".join(words[49_990:50_010])))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = decontaminate.scan_documents(docs, items, ["doc_id"]).collect()
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in got} == {
        1: (12, ["big"]), 2: (0, []), 3: (10, ["big"]), 4: (20, ["big"]),
    }


def test_crowds_of_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    rows = []
    for dim in (16, 24, 17):
        centre = rng.normal(size=dim)
        rows += [(len(rows) + i, (centre + 0.01 * rng.normal(size=dim)).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_vectors(df, rounds=1, repairs=0).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: (39, i - i % 40) for i in range(120)}
