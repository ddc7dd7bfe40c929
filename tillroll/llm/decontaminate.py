"""Benchmark decontamination with an Aho-Corasick automaton over word windows."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import accumulated
from ..sources.scratch import written
from .common import keep_rows, quoted, row_keys, table

# ASCII letters lower-cased, digits kept, all other ASCII made blank; other bytes stay as they are.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_SURROGATES = range(0xD800, 0xE000)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class Windows:
    """One automaton over all windows of some items.

    Every distinct item word becomes one character, so a window is a short string, a
    document is a string of the same alphabet in which all other words are ``\\0``, and
    the automaton steps once per word.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], width: int):
        self.codes: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        windows: dict[str, set] = {}
        code = 1
        for item_id, text in items:
            words = words_of(text)
            for word in words:
                if word not in self.codes:
                    code = _SURROGATES.stop if code == _SURROGATES.start else code
                    self.codes[word] = chr(code)
                    code += 1
            coded = "".join(self.codes[w] for w in words)
            for i in range(max(1, len(coded) - width + 1) if coded else 0):
                windows.setdefault(coded[i : i + width], set()).add(item_id)
        for window, ids in windows.items():
            self.automaton.add_word(window, (len(window), ids))
        if windows:
            self.automaton.make_automaton()
        self.empty = not windows

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words are inside an occurrence of a window, and the items of these windows."""
        hit, items = np.zeros(len(words), dtype=bool), set()
        if not self.empty:
            coded = "".join(map(self.codes.get, words, itertools.repeat("\0")))
            for last, (length, ids) in self.automaton.iter(coded):
                hit[last - length + 1 : last + 1] = True
                items |= ids
        return hit, items


def hit_spans(text: bytes, runs: list[int]) -> list[dict[str, int]]:
    """Runs of hit words (first word, word behind the last, ...) as code point ranges of ``text``."""
    if not len(runs):
        return []
    places = [m.span() for m in _WORD.finditer(text.lower().decode("utf-8", "replace"))]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(runs[::2], runs[1::2])]


def _pieces(items: DataFrame, width: int, most_windows: int) -> DataFrame:
    """(item_id, piece, text, n_words): items cut into pieces of bounded words, written once.

    Neighbouring pieces share ``width`` - 1 words, so every window of ``width`` words lies in
    one piece; an item of fewer words is one piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                windows = max(1, len(words) - width + 1) if words else 0
                for at in range(0, windows, most_windows):
                    part = words[at : min(at + most_windows, windows) + width - 1]
                    row = [[item_id], [at], [b" ".join(part)], [len(part)]]
                    types = [pa.string(), pa.int64(), pa.binary(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(row, types)],
                        names=["item_id", "piece", "text", "n_words"],
                    )

    ddl = "item_id string, piece bigint, text binary, n_words bigint"
    return written(items.mapInArrow(cut, ddl), "benchmark-pieces")


def _item_blocks(pieces: DataFrame, most_words: int) -> Iterator[list[tuple]]:
    """Pieces in blocks of a bounded number of words, numbered on Spark, fetched one after the other."""
    order = [F.asc_nulls_last("item_id"), F.col("piece"), F.xxhash64("text"), F.col("text")]
    summed = accumulated(pieces, "n_words", "words", "all_words", order)
    numbered = summed.withColumn("block", F.expr(f"(words - n_words) div {most_words}"))
    numbered = written(numbered.select("item_id", "text", "block"), "benchmark-blocks")
    last = numbered.agg(F.max("block")).first()[0]
    for block in range(0 if last is None else last + 1):
        rows = numbered.filter(F.col("block") == block).collect()
        yield [(r["item_id"], r["text"]) for r in rows]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scanned(rows: DataFrame, items: list[tuple], width: int, last: bool) -> DataFrame:
    """``rows`` (text as bytes, runs of hit words, items) with the hits of one block added."""
    known = rows.sparkSession.sparkContext.broadcast(items)
    first_own = rows.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(known.value, width)
        for batch in batches:
            counts, runs, found, spans = [], [], [], []
            texts = batch.column("text").to_pylist()
            earlier = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist())
            for text, (old_runs, old_items) in zip(texts, earlier):
                words = words_of(text)
                hit, items_here = windows.scan(words)
                for a, b in zip(old_runs[::2], old_runs[1::2]):
                    hit[a:b] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                counts.append((len(words), int(hit.sum())))
                runs.append(edges.tolist())
                found.append(sorted({*old_items, *(i for i in items_here if i is not None)}))
                spans.append(hit_spans(text, runs[-1]) if last else [])
            n_words, n_hit = zip(*counts) if counts else ((), ())
            own = [
                batch.column("text") if not last else pa.nulls(len(texts), pa.binary()),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(runs, pa.list_(pa.int64())),
                pa.array(found, pa.list_(pa.string())),
                pa.array(spans, _SPANS),
            ]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:first_own] + own, names=batch.schema.names
            )

    return rows.mapInArrow(scan, rows.schema)


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    carried: list,
    width: int = 10,
    most_words: int = 200_000,
) -> DataFrame:
    """One row per document: carried columns, n_words, n_hit, items, spans.

    A word is a run of digits, ASCII letters (lower-cased) and characters beyond ASCII.
    A window is ``width`` consecutive words of an item, or the whole of a shorter one.
    ``n_hit`` counts document words inside any occurrence of a window, ``items`` holds
    the sorted ids of items with an occurrence, ``spans`` the runs of hit words as code
    point ranges of the original text. The text is read once per automaton, and there
    is one automaton unless the items have over ``most_words`` words together: then they
    are taken in blocks of that size, one scan after the other over a written table. An item of
    any length is cut into pieces that share ``width`` - 1 words, so a block has a bounded size.

    A NULL or empty text has no words. An item with a NULL text has no windows; one with
    a NULL id marks words but is not listed. Repeated documents give repeated rows,
    items that share an id count once. Empty tables give no rows, or no hits. Other
    columns are ignored unless carried. No shuffle: each document is judged alone.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    rows = docs.select(
        *carried,
        F.col("text").cast("binary").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"),
        F.array().cast("array<bigint>").alias("runs"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )
    blocks = _item_blocks(_pieces(items, width, max(1, most_words // 4)), most_words)
    block, later = next(blocks, []), next(blocks, None)
    while later is not None:
        rows = written(_scanned(rows, block, width, last=False), "scanned")
        block, later = later, next(blocks, None)
    return _scanned(rows, block, width, last=True).drop("text", "runs")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_documents(
        table(spark, folder, "documents"),
        table(spark, folder, "benchmark"),
        [F.col("doc_id").alias("doc_id")],
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: documents without any word inside a benchmark window."""
    found = scan_documents(docs, benchmark, row_keys(docs))
    return keep_rows(docs, found.filter("n_hit = 0").select("k_id", "k_hash"))


ORACLE = r"""
with d as (
    select row_number() over () as n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), b as (
    select item_id::varchar as item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark
), windows as (
    select distinct item_id, width, array_to_string(words[i:i + width - 1], ' ') as phrase
    from (select *, unnest(range(1, len(words) - width + 2)) as i
        from (select *, least(10, len(words)) as width from b where len(words) > 0))
), places as (
    select n, i, width, array_to_string(words[i:i + width - 1], ' ') as phrase
    from (select d.*, width, unnest(range(1, len(words) - width + 2)) as i
        from d cross join (select distinct width from windows))
), found as (
    select n, i, width, item_id from places join windows using (width, phrase)
), hits as (
    select n, count(distinct place) as n_hit
    from (select distinct n, unnest(range(i, i + width)) as place from found) group by n
), items as (
    select n, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct n, item_id from found where item_id is not null) group by n
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (n) left join items using (n)
"""
