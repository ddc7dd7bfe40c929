"""Line keep bitmaps, collocations and hard negatives against plain Python on awkward small tables."""

import math
import random
import re
from collections import Counter, defaultdict
from contextlib import contextmanager

import pytest

from tillroll.llm import collocations as phrases
from tillroll.llm.collocations import collocations
from tillroll.llm.hard_negatives import hard_negatives
from tillroll.llm.lines import keep_bitmaps, kept_lines, without_repeated_lines

DOCS = "doc_id bigint, text string, lang string, keep string, n_lines int, `doc.x` string"


@contextmanager
def small_batches(spark, rows):
    """Arrow batches of few rows, so that groups are torn between them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow_lines(docs, min_chars, min_docs):
    """(doc_id, text) -> kept text."""
    order = lambda d: (d is not None, d or 0)
    found = defaultdict(set)

    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            found[key(line)].add(order(doc_id))

    def stays(doc_id, line):
        k = key(line)
        return len(k) < min_chars or len(found[k]) < min_docs or order(doc_id) == max(found[k])

    return {
        (d, t): [line for line in (t or "").split("\n") if stays(d, line)] for d, t in docs
    }


def line_docs():
    rng = random.Random(5)
    common = ["Shared line number %d" % i for i in range(8)] + ["ÄÖÜ äöü ßß éé", "short", ""]
    docs = [(None, "Shared line number 1\nown"), (None, None), (1, None), (2, ""), (2, ""), (3, "\n\n")]
    for i in range(4, 240):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))]
        lines.append("\t the HOT line of all \r")
        docs.append((i, "\n".join(lines)))
    docs += [docs[-1]] * 3 + [(239, "another text of one id\nShared line number 2")]
    return docs + [(500, "\n".join(["The hot Line of all"] * 300 + ["x" * 50_000]))]


@pytest.mark.parametrize("batch", [3, 10_000])
def test_lines_equal_plain_python(spark, batch):
    docs = line_docs()
    df = spark.createDataFrame([(*d, "en", "k", 7, "y") for d in docs], DOCS)
    for min_chars, min_docs in ((10, 5), (1, 1)):
        want = slow_lines(docs, min_chars, min_docs)
        with small_batches(spark, batch):
            rows = without_repeated_lines(df, min_chars=min_chars, min_docs=min_docs).collect()
            bits = keep_bitmaps(df, min_chars, min_docs).collect()
        assert df.columns == list(rows[0].asDict()) and len(rows) == len(docs)
        joined = {k: None if k[1] is None else "\n".join(v) for k, v in want.items()}
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(
            (d, joined[d, t]) for d, t in docs
        )
        assert {(r["keep"], r["n_lines"], r["doc.x"]) for r in rows} == {("k", 7, "y")}
        counts = Counter((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in bits)
        assert counts == Counter(
            (d, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(v)) for (d, t), v in want.items()
        )


def test_lines_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert keep_bitmaps(docs).count() == 0 and without_repeated_lines(docs).columns == docs.columns


def test_bitmap_of_a_missing_text():
    assert kept_lines(None, 1, 0, b"") == b""


def slow_collocations(docs, min_count, max_words, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    rows = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in held.items():
            inside = [
                b for q, b in held.items() if len(q) > len(p)
                and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if any(100 * b >= 50 * a for b in inside):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(rows)


@pytest.mark.parametrize("block_words, max_words", [(60, 3), (1 << 18, 3), (200, 4), (100, 2)])
def test_collocations_equal_plain_python(spark, block_words, max_words):
    rng = random.Random(7)
    vocabulary = ["New", "york", "new", "Straße", "a", "b", "the", " x", "é-e", "日本"]
    marks = [" ", " ", " ", "  ", "\t", ", ", "\n", ". ", "?! "]

    def text(n):
        return "".join(rng.choice(vocabulary[: 3 + n % 8]) + rng.choice(marks) for _ in range(n))

    docs = [(rng.choice(["en", "de", None, "und"]), text(rng.randrange(80))) for _ in range(120)]
    docs += [("en", None), ("en", ""), ("fr", " .,! "), ("en", "new york " * 900)] + docs[:5]
    df = spark.createDataFrame([(i, t, la, "k", 1, "y") for i, (la, t) in enumerate(docs)], DOCS)
    got = collocations(df.repartition(3), 5, max_words, top=40, block_words=block_words).collect()
    assert sorted(map(tuple, got)) == slow_collocations(docs, 5, max_words, 40)


def test_collocations_of_a_text_in_segments(spark):
    rng = random.Random(3)
    words = ["w%d" % rng.randrange(40) + "x" * rng.randrange(30) for _ in range(90)]
    text = " ".join(rng.choice(words) for _ in range(150_000)) + " " + "y" * 1_200_000 + " w1 w2"
    assert len(text) > 3_000_000
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    got = collocations(df, 10, 3, top=100, block_words=70_000).collect()
    assert sorted(map(tuple, got)) == slow_collocations([("en", text)], 10, 3, 100)


@pytest.mark.parametrize("min_count", [3, 300])
def test_rare_phrases_stay_at_home_and_frequent_ones_are_counted_whole(spark, min_count):
    rng = random.Random(min_count)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(200)) for _ in range(20)]
    texts += ["a1 b2 c3 d4"] * min_count
    docs = [(t, lang) for t in texts for lang in ("en", "de")]
    df = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    blocks = phrases.occurrence_blocks(df, 2, block_words=500)
    possible = phrases._possible(blocks, 2, min_count, 16)

    def totals(counted):
        counts = counted.groupBy("lang", "phrase").sum("n").collect()
        return {(r[0], r[1]): r[2] for r in counts}

    every, sent = totals(phrases._counts(blocks, 2)), totals(phrases._counts(blocks, 2, possible))
    assert len(sent) < len(every) / 5
    frequent = {phrase: n for phrase, n in every.items() if n >= min(min_count, 255)}
    assert frequent and frequent.items() <= sent.items()


@pytest.mark.parametrize("bits", [0, 9])
def test_collocations_with_and_without_a_sketch(spark, bits, monkeypatch):
    monkeypatch.setattr(phrases, "_sketch_bits", lambda words: bits)
    rng = random.Random(bits)
    docs = [
        (rng.choice(["en", None]), " ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(60)))
        for _ in range(60)
    ]
    df = spark.createDataFrame(docs, "lang string, text string")
    got = collocations(df.repartition(3), 4, 3, top=50, block_words=300).collect()
    assert sorted(map(tuple, got)) == slow_collocations(docs, 4, 3, 50)


def test_collocations_of_an_empty_table(spark):
    assert collocations(spark.createDataFrame([], DOCS)).count() == 0


def slow_negatives(rows, every, positives, negatives):
    usable = [
        (i, v, label, [math.floor(256 * x) for x in vec])
        for i, (v, label, vec) in enumerate(rows)
        if v is not None and label is not None and vec is not None
        and all(x is not None and math.isfinite(x) for x in vec)
    ]
    out = []
    for i, v, label, vec in usable:
        if v % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vec, other)), w, lab == label)
            for j, w, lab, other in usable if j != i and len(other) == len(vec)
        )
        for s, w, _ in [r for r in scored if r[2]][:positives]:
            fits = [r for r in scored if not r[2] and -50 * s <= -100 * r[0] <= -95 * s]
            out += [(v, w, k, r[1], -s, -r[0]) for k, r in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes, batch", [(8 << 20, 10_000), (64, 7)])
def test_hard_negatives_equal_plain_python(spark, block_bytes, batch):
    rng = random.Random(11)

    def vector(n):
        return [rng.choice([-0.5, 0.25, 0.125, 0.5, rng.uniform(-0.2, 1)]) for _ in range(n)]

    rows = [(i, rng.randrange(3), vector(4)) for i in range(150)]
    rows += [(i, 1, vector(3)) for i in range(150, 190)]
    rows += [(200, 2, [1.0] * 4), (200, 2, [1.0] * 4), (200, 0, vector(4)), (-10, 1, vector(4))]
    rows += [(None, 1, vector(4)), (210, None, vector(4)), (220, 1, None), (230, 1, [None] * 4)]
    rows += [(240, 1, [math.nan] * 4), (250, 1, [math.inf] + [0.0] * 3), (260, 5, [0.0] * 4), (270, 1, [])]
    df = spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "vec_id bigint, label int, embedding array<double>, anchor string, slot int",
    )
    with small_batches(spark, batch):
        got = hard_negatives(df, anchor_every=10, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == slow_negatives(rows, 10, 5, 3)


def test_hard_negatives_with_large_components_and_empty_tables(spark):
    schema = "vec_id bigint, label int, embedding array<double>"
    rows = [(i, i % 2, [float(90_000 + i), -80_000.0 + 7 * i]) for i in range(40)]
    got = hard_negatives(spark.createDataFrame(rows, schema), anchor_every=10).collect()
    assert sorted(map(tuple, got)) == slow_negatives(rows, 10, 5, 3)
    beyond = spark.createDataFrame([(0, 1, [1e300, 0.0]), (1, 1, [1.0, 0.0])], schema)
    assert hard_negatives(beyond).count() == 0
    assert hard_negatives(spark.createDataFrame([], schema)).count() == 0
