"""Registered training-data queries against their SQL, and contracts SQL can't express."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tests.comparing import difference, oracle_connection
from tillroll.llm.catalogue import ORACLE, QUERIES
from tillroll.llm.common import table
from tillroll.llm.quality import score


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_oracle(spark, folder, name):
    result = QUERIES[name](spark, folder)
    assert difference(result, oracle_connection(folder), ORACLE[name]) is None


def components_of(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def slow_fingerprint(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_simhash_query_equals_brute_force(spark, folder):
    docs = sorted(table(spark, folder, "documents").collect(), key=lambda r: r["doc_id"])
    prints = np.array([slow_fingerprint(r["text"]) for r in docs], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    least = components_of(len(docs), zip(*np.nonzero(near)))
    want = {
        (d["doc_id"], f"{p:016x}", docs[c]["doc_id"])
        for d, p, c in zip(docs, prints.tolist(), least)
    }
    assert {tuple(r) for r in QUERIES["op5_simhash_dedup"](spark, folder).collect()} == want


def test_personal_data_query_equals_plain_patterns(spark, folder):
    # The patterns as the contract states them.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def valid(kind, match):
        digits = [int(c) for c in match if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = {r["doc_id"]: r for r in QUERIES["op9_personal_data"](spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert len(found) == len(docs)
    for doc in docs:
        spans = [
            (m.start(), i, kind, m.end())
            for i, (kind, pattern) in enumerate(patterns.items())
            for m in re.finditer(pattern, doc["text"] or "")
            if valid(kind, m[0])
        ]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        row = found[doc["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        counts = [sum(s[2] == kind for s in spans) for kind in patterns]
        assert [row[f"n_{kind}"] for kind in patterns] == counts


def test_sharding_query_is_even_and_gapless(spark, folder):
    rows = QUERIES["op7_sharding"](spark, folder).collect()
    ids = sorted(r["doc_id"] for r in table(spark, folder, "documents").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in rows) == ids
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, folder, "documents").collect()}
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "rows")
        assert r["grown_shard"] is None


def test_mixing_query_is_less_than_a_block_from_its_targets(spark, folder):
    sizes = Counter(r["source"] for r in table(spark, folder, "documents").select("source").collect())
    rows = QUERIES["op2_source_mixing"](spark, folder).collect()
    whole = sum(n**0.9 for n in sizes.values())
    slots = {r["slot"]: r for r in rows}
    assert sorted(slots) == list(range(len(slots)))
    done = Counter()
    for slot in range(len(slots)):
        r = slots[slot]
        assert r["release"] <= slot < r["deadline"]
        done[r["source"]] += 1
        assert all(abs(done[s] - (slot + 1) * n**0.9 / whole) < 1 + 1e-6 for s, n in sizes.items())
    # Every document once in the first pass, in full blocks but for the last of a source.
    ids = [r["doc_id"] for r in table(spark, folder, "documents").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows if r["epoch"] == 0) == sorted(ids)
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    assert all(len({r["source"] for r in rows if r["slot"] == s}) == 1 for s in slots)


def test_near_vector_query_equals_brute_force(spark, folder):
    rows = sorted(table(spark, folder, "embeddings").collect(), key=lambda r: r["vec_id"])
    values = [np.array(r["embedding"] or [], np.float64) for r in rows]
    usable = [k for k, v in enumerate(values) if len(v) and np.isfinite(v).all() and v.any()]
    pairs = []
    for k in usable:
        for other in usable:
            a, b = values[k], values[other]
            if k < other and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                pairs.append((k, other))
    least = components_of(len(rows), pairs)
    links = Counter(x for pair in pairs for x in pair)
    want = {
        (r["vec_id"], links[k], rows[least[k]]["vec_id"], least[k] == k) for k, r in enumerate(rows)
    }
    got = QUERIES["op3_embedding_dedup"](spark, folder).select("vec_id", "n_links", "component_id", "kept")
    assert {tuple(r) for r in got.collect()} == want


def test_quality_on_labelled_rows(spark):
    """Shares of right decisions over labelled documents of the middle size."""
    folder = "/root/testdata/sf0.01"
    keep = {r["doc_id"]: r["keep"] for r in QUERIES["op1_quality_classifier"](spark, folder).collect()}
    labels = table(spark, folder, "labels").collect()
    right = [keep[r["doc_id"]] == bool(r["quality"]) for r in labels if r["doc_id"] in keep]
    assert np.mean(right) > 0.95


def test_quality_on_held_out_labels(spark):
    """Fitted to half of the labels by hash, measured on the other half only."""
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = score(docs, labels.filter("xxhash64(doc_id) % 2 = 0"))
    keep = {r["k_id"]: r["keep"] for r in scored.collect()}
    held = labels.filter("xxhash64(doc_id) % 2 != 0").collect()
    right = [keep[r["doc_id"]] == bool(r["quality"]) for r in held if r["doc_id"] in keep]
    assert len(right) > 50 and np.mean(right) > 0.9


def test_pipeline_keeps_what_its_stages_decide(spark, folder):
    docs = table(spark, folder, "documents")
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == [*docs.columns, "shard", "slot"]
    rows = result.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    kept = spark.createDataFrame([(i,) for i in {r["doc_id"] for r in rows}], "doc_id bigint")
    left = docs.join(kept, "doc_id").collect()
    prints = np.array([slow_fingerprint(r["text"]) for r in left], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    assert near.sum() == len(left)
    assert sorted((r["shard"], r["slot"]) for r in rows)[0] == (0, 0)
