"""Phrase collocations by relational set mining over stored word occurrences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import table

# Words that share one vocabulary. More words in a block mean fewer rows per phrase, but longer ones.
BLOCK_WORDS = 1 << 18
# Bytes of one text that are split into words at a time.
_SEGMENT = 1 << 20
_PHRASES_AT_ONCE = 50_000
# Cells of the sketch of occurrences, as powers of two: one byte per cell in a task, one bit in all tasks.
_LEAST_BITS, _MOST_BITS = 16, 25
# The sketch travels in so many parts.
_SLICES = 64

# A-Z lower-cased; what ends a piece becomes a full stop, a tab a space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
    for c in range(256)
)
_CUT = re.compile(b"[ .]")
_END = b"."


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in order, a full stop where a piece ends; long texts in several lists."""
    plain = text.translate(_PLAIN)
    at = 0
    while at < len(plain):
        cut = _CUT.search(plain, at + _SEGMENT)
        end = cut.start() if cut else len(plain)
        yield plain[at:end].replace(_END, b" . ").split(b" ")
        at = end


class _Codes(dict):
    """Number of each word in order of appearance; 0 ends a piece."""

    def __init__(self):
        super().__init__({_END: 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) - 1
        return code


class _Block:
    """Word occurrences of one language, sorted by piece and position.

    ``codes`` holds one number per occurrence and 0 behind each piece. Words that only lead
    in from the block before are negative: phrases that end in them were counted there.
    """

    def __init__(self):
        self.codes, self.parts, self.size = _Codes(), [], 0

    def add(self, words: list[bytes], before: list[bytes]) -> None:
        lead = [-self.codes[w] for w in before]
        own = np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))
        own = own[own >= 0]
        self.parts += [np.array(lead, np.int32), own]
        self.size += len(own)

    def row(self) -> dict:
        codes = np.concatenate(self.parts)
        return {
            "vocabulary": zstandard.compress(b" ".join(w for w, c in self.codes.items() if c > 0)),
            "codes": zstandard.compress(codes.astype("<i4").tobytes()),
            "words": int(np.count_nonzero(codes > 0)),
        }


_BLOCK_FIELDS = [
    ("block", pa.int64()),
    ("lang", pa.string()),
    ("words", pa.int64()),
    ("vocabulary", pa.binary()),
    ("codes", pa.binary()),
]
_BLOCK_DDL = "block bigint, lang string, words bigint, vocabulary binary, codes binary"


def occurrence_blocks(docs: DataFrame, context: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The occurrence relation in blocks, written once; ``context`` words lead into a cut text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Block] = {}
        number = TaskContext.get().partitionId() << 32

        def flushed(lang: str) -> pa.RecordBatch:
            nonlocal number
            row = {"block": number, "lang": lang, **blocks.pop(lang).row()}
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([row[c]], t) for c, t in _BLOCK_FIELDS], names=[c for c, _ in _BLOCK_FIELDS]
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                before: list[bytes] = []
                for words in words_of(text or b""):
                    block = blocks.setdefault(lang, _Block())
                    block.add(words, before)
                    before = [*before, *filter(None, words)][-context:] if context else []
                    if block.size >= block_words:
                        yield flushed(lang)
                if lang in blocks:
                    blocks[lang].add([_END], [])
            if len(blocks) > 64:  # rare languages are many: give out their small blocks
                for lang in list(blocks):
                    yield flushed(lang)
        for lang in list(blocks):
            yield flushed(lang)

    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    return written(texts.mapInArrow(read, _BLOCK_DDL), "occurrences")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time, unpacked; ``at`` are the places where a frequent phrase starts."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            codes = np.frombuffer(zstandard.decompress(row["codes"]), "<i4")
            words = zstandard.decompress(row["vocabulary"]).split(b" ")
            marks = row.get("marks")
            if marks is None:
                at = np.flatnonzero(codes)
            else:
                at = np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), count=len(codes)))
            yield {**row, "codes": codes, "words": [b"", *words], "at": at}


def _ids(columns: list[np.ndarray]) -> np.ndarray:
    """One number per tuple of word codes, equal for equal tuples."""
    base = max(int(c.max(initial=0)) for c in columns) + 1
    ids = columns[0].astype(np.int64)
    for column in columns[1:]:
        ids = np.unique(ids * base + column, return_inverse=True)[1]
    return ids


def _joined(at: np.ndarray, k: int) -> np.ndarray:
    """Merge-join by piece and adjacent position: where both k-phrases of a longer one are frequent."""
    return at[:-1][np.diff(at) == 1] if k else at


def _columns(codes: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    return [np.abs(codes[at + i]) for i in range(k)]


def _starts(row: dict, k: int) -> np.ndarray:
    """Places of the phrases of k words to be counted in a block."""
    at = _joined(row["at"], k - 1)
    return at[row["codes"][at + k - 1] > 0]


def _cells(row: dict, at: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Cell of the sketch for each phrase of k words that starts ``at``; equal phrases share one."""
    seed = zlib.crc32(row["lang"].encode())
    hashes = np.array([zlib.crc32(w, seed) for w in row["words"]], np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    mixed = np.full(len(at), seed, np.uint64)
    for column in _columns(row["codes"], at, k):
        mixed = (mixed + hashes[column]) * factor
        mixed ^= mixed >> np.uint64(31)
    return ((mixed * factor) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch_bits(words: int) -> int:
    """Size of the sketch for so many words; 0 if it would be too full to tell rare phrases apart."""
    bits = max(_LEAST_BITS, (words >> 2).bit_length())
    return 0 if bits > _MOST_BITS + 2 else min(bits, _MOST_BITS)


def _held(possible: np.ndarray, row: dict, at: np.ndarray, k: int) -> np.ndarray:
    """Those of the places whose phrase of k words lies in a ``possible`` cell."""
    cells = _cells(row, at, k, (possible.size * 8).bit_length() - 1)
    return at[(possible[cells >> 3] >> (7 - (cells & 7))) & 1 == 1]


def _possible(blocks: DataFrame, k: int, min_count: int, bits: int) -> np.ndarray:
    """One bit per cell of a counting sketch: whether a phrase of k words in it may be frequent.

    A cell counts all occurrences of all its phrases, so it never counts a phrase too low. At most
    ``2 ** _MOST_BITS`` bits pass through the driver.
    """
    size = (1 << bits) // _SLICES
    least = min(min_count, 255)
    names = ["slice", "cells"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for row in _rows(batches):
            counts = np.zeros(1 << bits, np.uint8) if counts is None else counts
            cells, n = np.unique(_cells(row, _starts(row, k), k, bits), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + n, 255)
        for i in range(_SLICES if counts is not None else 0):
            part = zstandard.compress(counts[i * size : (i + 1) * size].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part], pa.binary())], names=names)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column("slice").to_pylist(), batch.column("cells")):
                part = np.frombuffer(zstandard.decompress(cells.as_py()), np.uint8).astype(np.uint16)
                sums[i] = np.minimum(sums.get(i, 0) + part, 255).astype(np.uint16)
        for i, total in sums.items():
            part = np.packbits(total >= least).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part], pa.binary())], names=names)

    ddl = "slice bigint, cells binary"
    parts = blocks.mapInArrow(sketch, ddl).repartition("slice").mapInArrow(added, ddl).collect()
    possible = np.zeros((_SLICES, size // 8), np.uint8)
    for part in parts:
        possible[part["slice"]] = np.frombuffer(part["cells"], np.uint8)
    return possible.reshape(-1)


_COUNTS_DDL = "block bigint, lang string, phrase string, n bigint"


def _counts(blocks: DataFrame, k: int, possible: np.ndarray | None = None) -> DataFrame:
    """Per block, how often each phrase of k words occurs whose shorter phrases are frequent.

    Phrases whose cell is not ``possible`` are too rare and left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            codes, words = row["codes"], row["words"]
            at = _starts(row, k)
            if possible is not None:
                at = _held(possible, row, at, k)
            _, first, n = np.unique(
                _ids(_columns(codes, at, k)), return_index=True, return_counts=True
            )
            for start in range(0, len(first), _PHRASES_AT_ONCE):
                part = slice(start, start + _PHRASES_AT_ONCE)
                named = ([words[c] for c in column] for column in _columns(codes, at[first[part]], k))
                phrases = pa.array(map(b" ".join, zip(*named)), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(phrases), row["block"], np.int64)),
                        pa.array([row["lang"]] * len(phrases), pa.string()),
                        phrases.cast(pa.string()),
                        pa.array(n[part].astype(np.int64)),
                    ],
                    names=["block", "lang", "phrase", "n"],
                )

    return blocks.mapInArrow(count, _COUNTS_DDL)


def _frequent(
    blocks: DataFrame, k: int, min_count: int, possible: np.ndarray | None = None
) -> DataFrame:
    """Phrases of k words that occur often enough: lang, phrase, f, and in which blocks.

    Sorted by phrase and group-counted. What arrives is one row per phrase and block, so a
    very common phrase is no hot key. For ``possible`` see ``_counts``; the counts stay exact.
    """
    same = Window.partitionBy("phrase", "lang")
    counted = _counts(blocks, k, possible).withColumn("f", F.sum("n").over(same))
    counted = counted.withColumn("first", F.min("block").over(same) == F.col("block"))
    return written(counted.filter(F.col("f") >= min_count).drop("n"), f"phrases-{k}")


def _with_marks(row: dict, codes: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """The block again, with ``marks`` at its places."""
    row["codes"] = zstandard.compress(codes.tobytes())
    row["words"] = int(np.count_nonzero(codes > 0))
    return pa.RecordBatch.from_arrays(
        [pa.array([row[c]], t) for c, t in _BLOCK_FIELDS]
        + [pa.array([np.packbits(marks).tobytes()], pa.binary())],
        names=[*(c for c, _ in _BLOCK_FIELDS), "marks"],
    )


_MARKED_DDL = f"{_BLOCK_DDL}, marks binary"


def _semi_joined_by_sketch(blocks: DataFrame, possible: np.ndarray, k: int) -> DataFrame:
    """The occurrence relation of phrases that may be frequent, without an exchange.

    ``marks`` has a bit for every place where a phrase of k words in a ``possible`` cell starts: no
    frequent one is missed, and further ones only lead to longer phrases that prove too rare.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            marks = np.zeros(len(row["codes"]), bool)
            marks[_held(possible, row, _joined(row["at"], k - 1), k)] = True
            yield _with_marks(row, row["codes"], marks)

    return blocks.mapInArrow(mark, _MARKED_DDL)


def _semi_joined(blocks: DataFrame, frequent: DataFrame, k: int) -> DataFrame:
    """The occurrence relation of frequent phrases: rare words are gone, ``marks`` has a bit
    for every place where a frequent phrase of k words starts."""
    kept = frequent.groupBy(F.col("block").alias("_block")).agg(F.collect_list("phrase").alias("kept"))
    joined = blocks.join(kept, F.col("block") == F.col("_block")).drop("_block")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            codes = row["codes"]
            number = {w: c for c, w in enumerate(row["words"])}
            kept = [
                np.array([number[w] for w in column], np.int32)
                for column in zip(*(phrase.encode().split(b" ") for phrase in row["kept"]))
            ]
            at = _joined(row["at"], k - 1)
            both = [np.concatenate(c) for c in zip(kept, _columns(codes, at, k))]
            ids, n = _ids(both), len(row["kept"])
            at = at[np.isin(ids[n:], ids[:n])]
            marks = np.zeros(len(codes), bool)
            marks[at] = True
            if k == 1:
                codes = np.where(marks, codes, 0).astype("<i4")
            yield _with_marks(row, codes, marks)

    return joined.mapInArrow(mark, _MARKED_DDL)


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _scored(frequent: DataFrame) -> DataFrame:
    """Lowest-scoring cut of every phrase of several words: lang, phrase, size, a, k, l, r, score."""
    words = F.split("phrase", " ")
    cuts = (
        frequent.filter("size > 1")
        .select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("_words"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("left", _part(F.col("_words"), F.lit(1), F.col("k")))
        .withColumn("right", _part(F.col("_words"), F.col("k") + 1, F.col("size") - F.col("k")))
        .drop("_words")
    )
    for side, name in (("left", "l"), ("right", "r")):
        parts = frequent.select(
            F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name)
        )
        cuts = cuts.join(parts, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part")))
        cuts = cuts.drop("_lang", "_part", side)

    # Decimals of 38 digits: a million squared counts of up to 15 digits are exact.
    def whole(name: str) -> Column:
        return F.col(name).cast("decimal(15,0)")

    numerator = F.lit(1_000_000).cast("decimal(7,0)") * whole("a") * whole("a")
    cuts = cuts.withColumn("_n", numerator).withColumn("_d", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("_n div _d"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select(
        "lang", "phrase", "size", "a", "cut.*"
    )


def _absorbed(frequent: DataFrame, max_words: int) -> DataFrame:
    """(lang, part, most): the largest count of a longer phrase around each shorter one."""
    words = F.split("phrase", " ")
    longer = frequent.filter("size > 2").select("lang", "f", "size", words.alias("_words"))
    parts = [
        longer.filter(F.col("size") > n)
        .withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("size") - (n - 1))))
        .select("lang", _part(F.col("_words"), F.col("_at"), F.lit(n)).alias("part"), "f")
        for n in range(2, max_words)
    ]
    if not parts:
        return longer.select("lang", F.lit("").alias("part"), F.col("f").alias("most")).limit(0)
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "part").agg(F.max("f").alias("most"))


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    max_words: int = 3,
    absorbed_percent: int = 50,
    top: int = 2000,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and into
    words at spaces and tabs. Phrases are 2 to ``max_words`` neighbouring words of a piece
    that occur a >= ``min_count`` times in a language. l and r count the two parts of the
    lowest-scoring cut, score is floor(1000000*a*a/(l*r)), n counts all words of the language. A phrase
    inside a longer one that has at least ``absorbed_percent`` of its count is left out.

    The occurrence relation is stored in blocks, sorted by piece and position, words
    numbered per block. It is merge-joined with itself by adjacent position; phrases are
    counted per block, then over all blocks; blocks keep the places of frequent phrases, and
    only these are extended. Counts are of phrases themselves, not of hashes. A counting sketch
    leaves out most phrases of several words that are too rare before they travel.

    A NULL or empty text has no words, a NULL language is ``und``. Repeated documents
    count each time. Long texts are cut into blocks without losing phrases. A language
    without such phrases, or an empty table, gives no rows. Ties in score are ordered by a,
    then by phrase in byte order. Columns besides ``lang`` and ``text`` are not read.
    """
    blocks = occurrence_blocks(docs, max_words - 1, block_words)
    totals = blocks.groupBy(F.col("lang").alias("_lang")).agg(F.sum("words").alias("n"))
    relation, levels, bits = blocks, [], 0
    for k in range(1, max_words + 1):
        possible = _possible(relation, k, min_count, bits) if bits else None
        found = _frequent(relation, k, min_count, possible)
        levels.append(found.filter("first").select("lang", "phrase", "f", F.lit(k).alias("size")))
        if k < max_words and bits:
            relation = _semi_joined_by_sketch(relation, possible, k)
        elif k < max_words:
            relation = written(_semi_joined(relation, found, k), f"occurrences-{k}")
            bits = _sketch_bits(relation.agg(F.sum("words")).first()[0] or 0)
    frequent = reduce(DataFrame.unionByName, levels)

    around = _absorbed(frequent, max_words).withColumnRenamed("lang", "_lang")
    inside = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("part"))
    kept = _scored(frequent).join(around, inside, "left").drop("_lang", "part")
    kept = kept.filter(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * absorbed_percent)
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: its best come from the best of its parts.
    spread = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    within = Window.partitionBy("lang", "_part").orderBy(*best)
    ahead = spread.withColumn("_place", F.row_number().over(within)).filter(F.col("_place") <= top)
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = ahead.withColumn("rank", ranks).filter(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


ORACLE = r"""
with pieces as (
    select lang, row_number() over () as piece, piece as words from (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece from documents)
), words as (
    select lang, regexp_extract_all(words, '[^\x20\x09]+') as w from pieces
), totals as (
    select lang, sum(len(w))::bigint as n from words group by lang
), phrases as (
    select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
        from words cross join (select unnest([1, 2, 3]) as size))
), counts as (
    select lang, size, phrase, count(*) as f from phrases group by all
), frequent as (
    select * from counts where f >= 10
), cuts as (
    select lang, size, phrase, f as a, k, array_to_string(w[1:k], ' ') as lefts,
        array_to_string(w[k + 1:size], ' ') as rights
    from (select *, string_split(phrase, ' ') as w, unnest(range(1, size)) as k
        from frequent where size > 1)
), scored as (
    select cuts.*, l.f as l, r.f as r,
        ((1000000::hugeint * a * a) // (l.f::hugeint * r.f))::bigint as score
    from cuts join counts l on l.lang = cuts.lang and l.phrase = lefts
        join counts r on r.lang = cuts.lang and r.phrase = rights
), lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
    select lang, part, max(f) as most from (
        select lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as part
        from (select lang, f, string_split(phrase, ' ') as w from frequent where size = 3))
    group by lang, part
), ranked as (
    select lowest.*, row_number() over (
        partition by lowest.lang order by score desc, a desc, phrase) as rank
    from lowest left join longer on longer.lang = lowest.lang and part = phrase
    where most is null or size = 3 or 100 * most < 50 * a
)
select lang, rank, phrase, a, l, r, n, score
from ranked join totals using (lang) where rank <= 2000
"""
