"""Operators on small fixtures: NULLs, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import (
    chat_windows,
    decontaminate,
    mixing,
    neighbours,
    pii,
    quality,
    shards,
    simhash,
    url_rules,
    warc,
)
from tillroll.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, doc string"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))


def documents(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """NULL everywhere, empty, repeated, and very long texts."""
    rows = [
        (1, "One two three four five six seven eight nine ten eleven.", "en", "a", 5),
        (1, "One two three four five six seven eight nine ten eleven.", "en", "a", 5),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, LONG, "en", None, 9),
        (4, LONG, "fr", "b", 9),
        (5, "alone ÄÖ \x00 words", None, "b", 1),
    ]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}}


def test_simhash_groups(spark, odd, none):
    got = sorted(
        (r["doc_id"] or 0, r["component_id"]) for r in simhash.near_groups(odd).collect()
    )
    # Texts without words share fingerprint zero; copies share theirs.
    assert got == [(0, 2), (0, 2), (1, 1), (1, 1), (2, 2), (3, 3), (4, 3), (5, 5)]
    left = simhash.deduplicated(odd)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 5]
    assert simhash.deduplicated(none).collect() == []


def test_tiles_lose_no_link(spark):
    """Crowded blocks cut into small tiles give the groups that brute force gives."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    flips = [int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 7))) for c in centres for _ in range(60)]
    prints = sorted({f - 2**64 if f >= 2**63 else f for f in flips})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    links = simhash._compared(simhash._tiled(df, 4, 8), 4).collect()
    place = {p: i for i, p in enumerate(prints)}
    u = np.array(prints, np.int64).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4

    def labels(pairs):
        label = list(range(len(prints)))
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                m = min(label[a], label[b])
                changed |= label[a] != m or label[b] != m
                label[a] = label[b] = m
        return label

    ours = [(place[r["a"]], place[r["b"]]) for r in links]
    assert labels(ours) == labels(list(zip(*np.nonzero(near))))


def test_decontamination_edges(spark, odd, none):
    items = spark.createDataFrame(
        [("a", "two THREE, four five six seven eight nine ten eleven twelve"), ("b", "alone ÄÖ"),
         ("b", "alone ÄÖ"), (None, "words"), ("d", None), ("e", "...")],
        "item_id string, text string",
    )
    key = [F.col("doc_id")]
    for most in (200_000, 3):  # one automaton, and several over a written table
        rows = decontaminate.scan_documents(odd, items, key, most_words=most).collect()
        got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows}
        assert (1, 11, 10, ("a",)) in got and (5, 3, 3, ("b",)) in got and (None, 0, 0, ()) in got
        assert len(rows) == 8
        spans = next(r["spans"] for r in rows if r["doc_id"] == 1)
        assert [(s["start"], s["end"]) for s in spans] == [(4, 55)]
    kept = decontaminate.decontaminated(odd, items)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 2, 3, 4]
    assert decontaminate.decontaminated(odd, items.limit(0)).count() == 8
    assert decontaminate.decontaminated(none, items).collect() == []


def test_personal_data_disguises(spark, odd, none):
    texts = {
        1: "write jane.doe (at) mail [dot] example [dot] com now",
        2: "call plus one five five five one two three four five six seven today",
        3: "jоhn@example.com",  # Cyrillic o
        4: "look at the dot com era",
        5: "joe at site dot org",
        6: "a\u200bb@x.org",
    }
    docs = documents(spark, [(i, t, None, None, None) for i, t in texts.items()])
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs, ["doc_id"]).collect()}

    def found(i):
        return [
            (s.split(":")[0], texts[i][slice(*map(int, s.split(":")[1:]))])
            for s in got[i]["spans"].split(",") if s
        ]

    assert found(1) == [("email", "jane.doe (at) mail [dot] example [dot] com")]
    assert found(2) == [("phone", "plus one five five five one two three four five six seven")]
    assert found(3) == [("email", "jоhn@example.com"), ("email", "hn@example.com")]
    assert got[3]["n_email"] == 1 and got[3]["n_added"] == 1
    assert found(5) == [("email", "joe at site dot org")]
    assert found(6) == [("email", "a\u200bb@x.org"), ("email", "b@x.org")]
    assert pii.find_personal_data(odd, ["doc_id"]).count() == 8
    assert pii.find_personal_data(none, ["doc_id"]).collect() == []


def test_personal_data_takes_linear_time():
    for text in ("1" * 200_000, " " * 200_000, "a" * 200_000 + "@", "+" + "1-" * 100_000, "1." * 100_000):
        pii.disguised(text, pii.detect(text))


def test_address_parts_of_any_length():
    long_zeros, long_number = "0" * 5000 + "1.2.3.4", "9" * 5000 + ".1.1.1"
    assert pii.detect(long_zeros) == [("ip", 0, len(long_zeros))]
    assert pii.detect(long_number) == []
    assert pii.detect("1.2.3.256 000.0.0.0") == [("ip", 10, 19)]


def test_mixing_stays_within_a_block(spark, odd, none):
    rows = mixing.mix(odd, block_rows=2).collect()
    first = [r for r in rows if r["epoch"] == 0]
    assert sorted(r["doc"]["doc_id"] or 0 for r in first) == [0, 0, 1, 1, 2, 3, 4, 5]
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixed(none).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(odd, weights={"a": 1.0})
    wanted = mixing.mix(odd, weights={"a": 0.8, "b": 0.1, None: 0.1}, block_rows=1).collect()
    slots = max(r["slot"] for r in wanted) + 1
    assert abs(sum(r["source"] == "a" for r in wanted) - 0.8 * slots) < 1.1


def test_sharding_edges(spark, odd, none):
    rows = shards.shuffle_into_shards(odd, 3).collect()
    assert sorted(r["doc"]["doc_id"] or 0 for r in rows) == [0, 0, 1, 1, 2, 3, 4, 5]
    assert sorted((r["shard"], r["slot"]) for r in rows) == [
        (0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1),
    ]
    assert shards.sharded(none).collect() == []
    matrix = shards.communication_matrix([5, 0, 11, 2], [6, 6, 6], 1)
    assert matrix.sum(axis=1).tolist() == [5, 0, 11, 2] and matrix.sum(axis=0).tolist() == [6, 6, 6]
    rng = np.random.default_rng(0)
    big = [shards.hypergeometric(rng, 10**10, 3 * 10**10, 10_000) for _ in range(400)]
    assert abs(np.mean(big) - 2500) < 10 and 35 < np.std(big) < 52


def test_quality_edges(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["keep"] for r in quality.score(odd, empty).collect()} == {True}
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 1, 0), (5, 0, 1), (4, None, 0), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    rows = quality.score(odd, labels).collect()
    assert len(rows) == 8 and all(0 <= r["posterior"] <= 1 for r in rows)
    assert quality.good_documents(odd, labels).columns == odd.columns
    assert quality.good_documents(none, labels).collect() == []


def test_sparse_sites_shrink(spark):
    rows = [("big", "p", 0.9)] * 300 + [("poor", "p", 0.1)] * 300 + [("tiny", "p", 0.0)]
    rows = [(h, p, e + (i % 7 - 3) / 40) for i, (h, p, e) in enumerate(rows)]
    _, prior = quality.site_rates(spark.createDataFrame(rows, "host string, path string, evidence double"))
    assert 0.4 < prior["rate"] < 0.6
    assert 0 < prior["host"] < 1  # hosts differ a lot, so few rows outweigh the global mean
    alike = [("h%d" % (i % 50), "p", 0.5 + (i * 37 % 11 - 5) / 20) for i in range(5000)]
    _, prior = quality.site_rates(spark.createDataFrame(alike, "host string, path string, evidence double"))
    assert prior["host"] > 100


def test_chat_windows(spark):
    rows = [(1, 0, "system", "be <kind>", 0)]
    rows += [(1, 2 * i + 1, "user", "q" * (i % 50), 0) for i in range(400)]
    rows += [(1, 2 * i + 2, "assistant", f"\\<{i}>" + "a" * (i * 13 % 900), 0) for i in range(400)]
    rows += [(2, None, None, None, 0), (2, None, None, None, 0), (None, 3, "assistant", "x", 0)]
    rows += [(3, 0, "assistant", "y" * 50_000, 0)]
    talk = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n int")
    windows = chat_windows.format_windows(talk, budget=600, history=100).cache()
    long = windows.filter("conv_id = 1").orderBy("window_start").collect()
    assert len(long) > 10 and all(w["tokens"] <= 600 for w in long)
    assert all(w["formatted"].startswith("<system>be \\lkind\\g</turn>\n") for w in long)
    assert any(w["context_turns"] > 1 for w in long)
    got = {r["conv_id"]: r for r in chat_windows.digests(windows).collect()}
    assert got[1]["n_turns"] == 801 and got[2]["n_turns"] == 2 and got[None]["loss_chars"] == 1
    learned = sum(len(r[3]) for r in rows if r[0] == 1 and r[2] == "assistant")
    assert got[1]["loss_chars"] == learned and got[3]["loss_chars"] == 50_000
    assert chat_windows.digests(chat_windows.format_windows(talk.limit(0))).collect() == []


def test_url_rules(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b.com/x/y?q", 0), (1, "http://a.b.com/x/y?q", 0), (2, None, 0), (3, "no scheme", 0),
         (None, "https://B.com", 0), (5, "ftp://notb.com/x/", 0), (6, "x://b.com/" + "x/" * 30_000, 0),
         (7, "x://" + "a." * 20_000 + "b.com/x/", 0)],
        "page_id bigint, url string, host int",
    )
    rules = spark.createDataFrame(
        [("b.com", "/x/", "block"), ("b.com", "/x/y", "allow"), ("b.com", "/x/", "allow"),
         ("b.com", None, "block"), ("com", "/", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, rules, default="none").collect()}
    assert got == {
        (1, "b.com/x/y", "allow"), (2, None, "none"), (3, None, "none"), (None, "b.com", "block"),
        (5, "com/", "allow"), (6, "b.com/x/", "block"), (7, "b.com/x/", "block"),
    }
    assert {r["rule"] for r in url_rules.judge(pages, rules.limit(0)).collect()} == {None}
    assert url_rules.judge(pages.limit(0), rules).collect() == []


def test_warc_audit(spark):
    rows = [(f, s * 70_000, 70_000, 10 * f + s, f"{f}-{s}") for f in range(3) for s in range(40)]
    columns = "file_id bigint, start bigint, length bigint, page_id bigint, sha256 string"
    changed = [r if r[3] != 15 else (*r[:4], "bad") for r in rows if r[3] != 7]
    changed.append((2, 9_999_999, 5, None, None))
    primary, replica = (spark.createDataFrame(x, columns) for x in (rows + rows[:3], changed))
    got = sorted((r["start"], r["kind"], r["page_id"]) for r in warc.audit(primary, replica).collect())
    wanted = [(r[1], "changed", 15) for r in rows if r[3] == 15] + [(r[1], "missing", 7) for r in rows if r[3] == 7]
    assert [g for g in got if g[1] != "extra"] == sorted(wanted)
    assert (9_999_999, "extra", None) in got
    assert warc.audit(primary, primary).collect() == []
    assert warc.audit(primary.limit(0), primary.limit(0)).collect() == []


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 16))
    crowd = base[0] + 0.02 * rng.standard_normal((70, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, crowd]))]
    rows += [(200, base[5].tolist()), (200, base[5].tolist()), (None, (2 * base[5]).tolist())]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (304, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.near_vectors(df, rounds=1, repairs=0).collect()
    assert len(got) == len(rows)
    sound = [r for r in rows if r[1] and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    m = np.array([r[1] for r in sound])
    m /= np.linalg.norm(m, axis=1)[:, None]
    links = ((m @ m.T) >= 0.95).sum(axis=1) - 1
    want = [(r[0], int(n)) for r, n in zip(sound, links)] + [(i, 0) for i in range(300, 305)]
    least = lambda pair: (pair[0] is not None, pair)
    assert sorted(((r["vec_id"], r["n_links"]) for r in got), key=least) == sorted(want, key=least)
    of = {r["vec_id"]: r["component_id"] for r in got}
    assert of[200] == 5 and of[None] == 5 and of[100] == 0 and of[300] == 300


def test_mixing_follows_weights_over_many_periods():
    """Less than one block from the target in every slot, over the ends of periods that were planned apart."""
    rng = np.random.default_rng(3)
    cases = (
        ([5.0, 1.0, 1.7, 0.01], 1024), ([0.5, 0.25, 0.25], 64), ([1.0], 16), ([0.3, 0.3, 0.3, 0.1], 16),
        (rng.pareto(0.8, 40) + 0.05, 8192), (rng.random(700) + 0.1, 8192), ([1.0] * 333, 512),
    )
    for targets, period in cases:
        weights = mixing.whole_weights(targets)
        whole = sum(weights)
        share = np.array(targets) / np.sum(targets)
        assert np.abs(np.array(weights) / whole - share).max() < 1e-9 and min(weights) * period >= whole
        done = np.zeros(len(share), np.int64)
        for number in range(9):
            for k, block, slot, release, deadline in mixing.period_plan(weights, number, period).tolist():
                assert block == done[k] and release <= slot < deadline
                assert release == block * whole // weights[k]
                assert deadline == -(-(block + 1) * whole // weights[k])
                done[k] += 1
                if slot % 7 == 0:
                    assert np.abs(done - (slot + 1) * share).max() < 1 + 1e-6
            assert done.sum() == (number + 1) * period
    for targets in ([5.0, 1.0, 1.7, 0.01], [0.5, 0.25, 0.25]):
        share = np.array(targets) / np.sum(targets)
        counts = np.zeros(len(share))
        for slot, (k, _) in enumerate(mixing.turns(targets, 5000), 1):
            counts[k] += 1
            assert np.abs(counts - slot * share).max() < 1 + 1e-6


def test_mixing_with_a_tiny_weight_ends(spark, monkeypatch):
    """Below one slot in 2^20 (here 256) a source gets that, so the mixture stays of bearable length."""
    weights = mixing.whole_weights([1.0, 1.0, 1e-12])
    assert weights[2] / sum(weights) == pytest.approx(2**-20, rel=1e-3)
    monkeypatch.setattr(mixing, "LONGEST", 256)
    docs = documents(spark, [(i, "t", "en", f"s{i % 2}" if i else "tiny", 0) for i in range(64)])
    targets = {"s0": 0.5, "s1": 0.5, "tiny": 1e-9}
    rows = mixing.mix(docs, weights=targets, block_rows=16).filter("epoch = 0")
    assert sorted(r[0] for r in rows.select("doc.doc_id").collect()) == list(range(64))
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={**targets, "s1": float("nan")})


def test_mixing_hundreds_of_sources(spark, monkeypatch):
    """A hot source among hundreds, over several periods, with and without shared units."""
    monkeypatch.setattr(mixing, "PERIOD", 512)
    sizes = {None: 1500, **{f"s{i}": 1 + i % 7 for i in range(500)}}
    rows = [(i, "t", "en", s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = documents(spark, rows)
    share = {s: n**0.9 for s, n in sizes.items()}
    whole = sum(share.values())
    for units, bound in ((mixing.MAX_UNITS, 1), (64, 2)):
        got = mixing.mix(docs, block_rows=1, max_units=units).collect()
        first = [r["doc"]["doc_id"] for r in got if r["epoch"] == 0]
        assert sorted(first) == list(range(len(rows)))
        by_slot = sorted(got, key=lambda r: r["slot"])
        assert [r["slot"] for r in by_slot] == list(range(len(got))) and len(got) > 4 * 512
        assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
        for t in range(131, len(got), 131):
            counts = {}
            for r in by_slot[:t]:
                counts[r["source"]] = counts.get(r["source"], 0) + 1
            assert max(abs(counts.get(s, 0) - t * w / whole) for s, w in share.items()) < bound


def test_audit_reports_a_recall_of_zero(spark):
    base = np.random.default_rng(2).standard_normal((40, 16))
    u = np.concatenate([base, base[:1] + 0.001])
    u /= np.linalg.norm(u, axis=1)[:, None]
    rows = [(i, 1, v.tolist()) for i, v in enumerate(u)]
    points = spark.createDataFrame(rows, "node bigint, n bigint, u array<double>")
    none = points.select("node", (F.col("n") - 1).alias("links"))
    assert neighbours._audit(points, none, 0.95, 100) == 0.0
    assert neighbours._audit(points.filter("node < 40"), none, 0.95, 100) == 1.0
    # One vector at first; all of them as too few have links.
    assert neighbours._audit(points, none, 0.95, 1) == 0.0


def pair_table(spark, crowd):
    """200 isolated pairs at a cosine of about 0.96, and a crowd of near copies."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((200, 32))
    pairs = base + 0.28 * rng.standard_normal((200, 32))
    many = rng.standard_normal(32) + 0.01 * rng.standard_normal((crowd, 32))
    m = np.concatenate([base, pairs, many])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>")
    m /= np.linalg.norm(m, axis=1)[:, None]
    return df, ((m @ m.T) >= 0.95).sum(axis=1) - 1


def test_audit_looks_at_isolated_pairs_apart_from_crowds(spark):
    df, links = pair_table(spark, 3000)
    points = df.select(
        F.col("vec_id").alias("node"), F.lit(1).cast("bigint").alias("n"), F.col("embedding").alias("u")
    )
    points = points.withColumn("u", F.udf(neighbours.unit, "array<double>")("u")).cache()
    lost = [(i, int(n) if i >= 400 else 0) for i, n in enumerate(links)]
    resolved = spark.createDataFrame(lost, "node bigint, links bigint")
    assert neighbours._audit(points, resolved, 0.95, 4000) == 0.0


def test_failed_repairs_end_in_an_exact_pass(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "LEAF", 2)
    monkeypatch.setattr(neighbours, "EXACT_BLOCK", 128)
    df, links = pair_table(spark, 60)
    got = neighbours.near_vectors(df, rounds=0, repairs=0).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(links.tolist()))
    assert {r["audited_recall"] for r in got} == {1.0}


@pytest.mark.parametrize(
    "kind, disguise",
    [
        ("email", "jane (at) example dot com"), ("email", "jane [at] example dot com"),
        ("email", "jane@example dot com"), ("email", "jane at mail.example [dot] com"),
        ("phone", "+1 555 867 five three oh nine"), ("card", "4111 1111 1111 one one one one"),
        ("ip", "one dot one dot one dot one"), ("ip", "10.one.0 dot 1"),
    ],
)
def test_personal_data_in_mixed_disguises(kind, disguise):
    text = f"so {disguise}; bye"
    assert (kind, 3, 3 + len(disguise)) in pii.disguised(text, pii.detect(text))


def test_mixed_words_that_hide_nothing():
    for text in ("meet at the shop", "meet at example.com", "in 1999, one of two", "one dot two", "the one 5 at 3"):
        assert pii.disguised(text, pii.detect(text)) == []
    for text in ("one " * 50_000, "1 one." * 30_000, "a@b." * 50_000, "1 2 3 " * 50_000):
        pii.disguised(text, pii.detect(text))
