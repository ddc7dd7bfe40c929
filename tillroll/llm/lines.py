"""Line dedup: keys of lines in range partitions, keep bitmaps per document."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import packed, table

_BLANKS = b" \t\n\x0b\x0c\r"
_ROWS_AT_ONCE = 50_000

# ``first`` is -1 in the one row that each document has besides those of its keys.
_OCCURRENCE = {
    "h1": pa.int64(),
    "h2": pa.int64(),
    "named": pa.bool_(),
    "id": pa.int64(),
    "text_hash": pa.int64(),
    "first": pa.int64(),
    "n_lines": pa.int64(),
    "positions": pa.binary(),
}
_OCCURRENCE_DDL = (
    "h1 bigint, h2 bigint, named boolean, id bigint, text_hash bigint, first bigint, "
    "n_lines bigint, positions binary"
)


def text_hash() -> Column:
    """Tells texts under one id apart; a missing text from an empty one as well."""
    return F.xxhash64("text", F.col("text").isNull())


def lines_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line bare of blanks at both ends, A-Z lower-cased; None if it is too short to count."""
    if len(line) < min_chars:
        return None
    key = line.strip(_BLANKS).lower()
    if key.isascii():
        return key if len(key) >= min_chars else None
    # Every code point has one byte that does not continue another.
    starts = np.frombuffer(key, np.uint8) & 0xC0 != 0x80
    return key if np.count_nonzero(starts) >= min_chars else None


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per document and key in it, with the lines that carry the key, and one per document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            keys = np.frombuffer(b"".join(columns[0]), "<i8").reshape(-1, 2)
            rows.clear()
            arrays = [pa.array(keys[:, 0]), pa.array(keys[:, 1])]
            arrays += [pa.array(c, t) for c, t in zip(columns[1:], list(_OCCURRENCE.values())[2:])]
            return pa.RecordBatch.from_arrays(arrays, names=list(_OCCURRENCE))

        for part in batches:
            columns = (part.column(c).to_pylist() for c in ("named", "id", "text_hash", "text"))
            for named, doc, own, text in zip(*columns):
                lines = lines_of(text)
                places: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    key = line_key(line, min_chars)
                    if key is not None:
                        places.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
                same = (named, doc, own)
                head = xxhash.xxh3_128_digest(f"{doc} {own}".encode())
                rows.append((head, *same, -1, len(lines), b""))
                for key, at in places.items():
                    rows.append((key, *same, at[0], len(lines), np.array(at, "<u4").tobytes()))
                    if len(rows) >= _ROWS_AT_ONCE:
                        yield batch()
        if rows:
            yield batch()

    texts = docs.select(
        F.col("doc_id").isNotNull().alias("named"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        text_hash().alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )
    return texts.mapInArrow(read, _OCCURRENCE_DDL)


def _streamed(ordered: DataFrame, min_docs: int) -> DataFrame:
    """Verdicts on occurrences sorted by key, then by document, largest first.

    The first document of a key keeps its lines. Rows behind it go as soon as the
    key is seen in ``min_docs`` documents. A batch knows all of a key except of its
    first and its last one: of these, the rows that it can't judge are given out as
    ``open``, with ``many`` if the batch alone holds enough documents. Rows that stay
    are not given out.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy()
            heads = batch.filter(pa.array(first < 0))
            rows = batch.filter(pa.array(first >= 0))
            h1, h2, doc, own = (rows.column(c).to_numpy() for c in ("h1", "h2", "id", "text_hash"))
            named = rows.column("named").to_numpy(zero_copy_only=False)
            changed = [c[1:] != c[:-1] for c in (h1, h2, named, doc, own)]
            start = np.ones(min(1, len(h1)), bool)
            new_key = np.concatenate([start, changed[0] | changed[1]])
            new_doc = np.concatenate([start, new_key[1:] | changed[2] | changed[3]])
            # A repeated row tells nothing new.
            new_row = np.concatenate([start, new_doc[1:] | changed[4]])
            group = np.cumsum(new_key) - 1
            seen = np.cumsum(new_doc)
            place = seen - seen[np.flatnonzero(new_key)][group]
            many = (np.bincount(group, new_doc) >= min_docs)[group] if len(group) else new_key
            torn = (group == 0) | (group == group[-1]) if len(group) else new_key
            gone = many & (place > 0) & new_row
            unsure = torn & ((place == 0) | ~many) & new_row
            for part, is_open in (
                (heads, None),
                (rows.filter(pa.array(gone)), None),
                (rows.filter(pa.array(unsure)), many[unsure]),
            ):
                if part.num_rows:
                    flags = np.zeros(part.num_rows, bool) if is_open is None else is_open
                    opened = np.full(part.num_rows, is_open is not None)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(opened), pa.array(flags)],
                        names=[*part.schema.names, "open", "many"],
                    )

    return ordered.mapInArrow(judged, f"{_OCCURRENCE_DDL}, open boolean, many boolean")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Which lines each document keeps: doc_id, text_hash, n_lines, n_dropped, keep.

    A line's key is the line without blanks at both ends, A-Z lower-cased. A key of at
    least ``min_chars`` code points that occurs in at least ``min_docs`` documents keeps
    its lines in the document with the largest id, all of them, and nowhere else.
    ``keep`` holds one bit per line, eight to a byte, deflated.

    Keys are 128-bit hashes. One row per document and key is sorted over range
    partitions by key, document and position, so that a key in any share of the
    documents is cut by its documents. Partitions are streamed; what a batch can't say of the
    keys at its two ends is settled by a join of these few rows. No text is shuffled.

    A NULL or empty text is one empty line. Documents without an id count as one
    document, smaller than all others. There is one row per distinct (id, text): rows
    that share an id are one document with several texts. Repeated rows share their bitmap. An
    empty table gives no rows. Columns besides ``doc_id`` and ``text`` are not read.
    """
    occurrences = written(_occurrences(docs, min_chars), "line-keys")
    order = [F.col("h1"), F.col("h2"), F.desc("named"), F.desc("id"), F.col("text_hash"), F.col("first")]
    ordered = occurrences.repartitionByRange(*order).sortWithinPartitions(*order)
    verdicts = written(_streamed(ordered, min_docs), "line-verdicts")

    opened = verdicts.filter("open")
    doc = F.struct("named", "id")
    keys = opened.groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(
        F.max(doc).alias("_largest"), F.count_distinct(doc).alias("_docs"), F.max("many").alias("_many")
    )
    frequent = keys.filter(F.col("_many") | (F.col("_docs") >= min_docs))
    same_key = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    settled = opened.join(frequent, same_key).filter(doc < F.col("_largest"))

    own = ["named", "id", "text_hash", "n_lines"]
    per_doc = (
        verdicts.filter("not open")
        .select(*own, "positions")
        .unionByName(settled.select(*own, "positions"))
        .groupBy(*own)
        .agg(F.collect_set("positions").alias("positions"))
    )

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped, bitmaps = [], []
            columns = (batch.column(c).to_pylist() for c in ("n_lines", "positions"))
            for n, places in zip(*columns):
                keep = np.ones(n, bool)
                keep[np.frombuffer(b"".join(places), "<u4")] = False
                dropped.append(n - int(np.count_nonzero(keep)))
                bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(dropped, pa.int64()), pa.array(bitmaps, pa.binary())],
                names=[*own, "n_dropped", "keep"],
            )

    ddl = "named boolean, id bigint, text_hash bigint, n_lines bigint, n_dropped bigint, keep binary"
    return per_doc.mapInArrow(drawn, ddl).select(
        F.when(F.col("named"), F.col("id")).alias("doc_id"), "text_hash", "n_lines", "n_dropped", "keep"
    )


def kept_lines(text: bytes | None, n_lines: int, n_dropped: int, keep: bytes) -> bytes:
    """What a bitmap leaves of a text."""
    if not n_dropped:
        return text or b""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)
    return b"\n".join(itertools.compress(lines_of(text), bits.tolist()))


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Each document as ``doc``, its text as bytes, and its bitmap."""
    texts = docs.select(
        packed(docs).alias("doc"),
        F.col("doc_id").cast("bigint").alias("own_id"),
        text_hash().alias("own_hash"),
        F.col("text").cast("binary").alias("own_text"),
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    return texts.join(bitmaps, same)


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the lines gone that ``keep_bitmaps`` drops; a missing text stays missing.

    All columns stay, whatever their names; options as for ``keep_bitmaps``.
    """
    rows = _with_bitmaps(docs, keep_bitmaps(docs, **options)).select(
        "doc", "own_text", "n_lines", "n_dropped", "keep"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = zip(*(batch.column(i).to_pylist() for i in range(1, 5)))
            texts = [None if t is None else kept_lines(t, *bits) for t, *bits in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["doc", "kept"]
            )

    schema = rows.select("doc", F.col("own_text").alias("kept")).schema
    done = rows.mapInArrow(cut, schema)
    return done.select(
        *(
            (F.col("kept").cast("string") if c == "text" else F.col("doc")[c]).alias(c)
            for c in docs.columns
        )
    )


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = _with_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", "own_text", "n_lines", "n_dropped", "keep"
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = zip(*(batch.column(i).to_pylist() for i in range(1, 5)))
            digests = [hashlib.sha256(kept_lines(*part)).hexdigest() for part in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(digests, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return rows.mapInArrow(
        digested, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string"
    )


ORACLE = r"""
with lines as (
    select n, doc_id, line, i,
        translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (select n, doc_id, unnest(parts) as line, unnest(range(len(parts))) as i
        from (select row_number() over () as n, doc_id,
                string_split(coalesce(text, ''), chr(10)) as parts from documents))
), frequent as (
    select key, max(doc_id) as largest from lines where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
), marked as (
    select lines.*, largest is not null and doc_id < largest as dropped
    from lines left join frequent using (key)
)
select any_value(doc_id) as doc_id, count(*) as n_lines,
    count(*) filter (where dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '')) as kept_sha256
from marked group by n
"""
