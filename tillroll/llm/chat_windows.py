"""Chat formatting into token-budgeted windows of whole turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, table

_END = "</turn>\n"
_CHUNK = 256  # turn numbers per piece of the prefix sums
_OVERHEAD = 4  # tokens that the marks of a turn count for


def escaped(text: Column) -> Column:
    """``text`` without any ``<`` or ``>``, so that it can't contain a mark of the template."""
    for plain, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in (("<", "\\l"), (">", "\\g"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _prefix_sums(turns: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Adds for each name the sum of its column over all earlier turns of the conversation.

    Summed inside pieces of 256 turn numbers and lifted by the pieces before, so one
    endless conversation is no single task.
    """
    order = [F.col("turn").asc_nulls_last(), "role", "text"]
    turns = turns.withColumn(
        "chunk", F.coalesce(F.floor(F.col("turn") / _CHUNK), F.lit(1 << 62)).cast("bigint")
    )
    inside = (
        Window.partitionBy("conv_id", "chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = turns.groupBy("conv_id", "chunk").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    before = totals.select(
        F.col("conv_id").alias("b_id"),
        F.col("chunk").alias("b_chunk"),
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"b_{n}") for n in sums),
    )
    local = turns.withColumns(
        {n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}
    )
    same = F.col("conv_id").eqNullSafe(F.col("b_id")) & (F.col("chunk") == F.col("b_chunk"))
    return local.join(before, same).select(
        *turns.drop("chunk").columns, *((F.col(n) + F.col(f"b_{n}")).alias(n) for n in sums)
    )


def format_windows(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 256,
    chars_per_token: int = 4,
) -> DataFrame:
    """Windows of whole turns: conv_id, window_start, formatted, n_turns, context_turns, tokens, loss_spans.

    A turn counts ``ceil(chars / chars_per_token)`` tokens (at least one) plus four for
    its marks. What ``budget`` leaves after the system turn and ``history`` is for new
    turns. Prefix sums cut the conversation where they cross multiples of half of that,
    and before and after any turn longer than the half. Turns are never cut. Each window
    after the first begins with ``context_turns`` repeated turns: the system turn, if the
    conversation opens with one, and the last turns of the window before, up to
    ``history`` tokens and to what the window's own turns leave. So a window stays within
    the budget unless the system turn and one other exceed it, or one turn alone does.
    ``loss_spans`` are code point ranges of ``formatted`` that hold
    the escaped texts of new assistant turns; repeated ones are left out, so each is
    learned once.

    NULL texts and roles count as empty, a NULL conv_id is a conversation of its own,
    turns without a number come last, ties go by role and text, repeated rows stay.
    Other columns are ignored; an empty table gives no windows. Built-in expressions only.
    """
    turns = conversations.select(
        quoted("conv_id").alias("conv_id"),
        quoted("turn").cast("bigint").alias("turn"),
        F.coalesce(quoted("role"), F.lit("")).alias("role"),
        F.coalesce(quoted("text"), F.lit("")).alias("text"),
    ).withColumn(
        "tokens",
        F.greatest(F.lit(1), F.ceil(F.length("text") / chars_per_token)).cast("bigint") + _OVERHEAD,
    )
    first = F.min(F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text", "tokens"))
    opening = turns.groupBy("conv_id").agg(first.alias("first"), F.count("*").alias("n"))
    system = F.when(F.col("first.role") == "system", F.col("first"))
    opening = opening.select(
        F.col("conv_id").alias("o_id"), "n", system.alias("system")
    ).withColumn(
        "half",
        F.greatest(
            F.lit(1),
            F.floor((F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))) / 2),
        ).cast("bigint"),
    )
    turns = turns.join(opening, F.col("conv_id").eqNullSafe(F.col("o_id"))).drop("o_id")
    long_turn = F.col("tokens") > F.col("half")
    turns = _prefix_sums(
        turns,
        {"pos": F.lit(1), "before": F.col("tokens"), "breaks": long_turn.cast("int")},
    ).withColumns({"cell": F.floor(F.col("before") / F.col("half")), "alone": long_turn})

    cut = Window.partitionBy("conv_id", "breaks", "cell", "alone")
    to_end = cut.orderBy("pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    turns = turns.withColumns(
        {
            "start": F.min("pos").over(cut),
            "following": F.max("pos").over(cut) + 1,
            "rest": F.sum("tokens").over(to_end),
        }
    )
    # What the next window has room for beside the system turn and its own turns.
    next_window = turns.groupBy(F.col("conv_id").alias("n_id"), F.col("start").alias("n_start")).agg(
        F.sum("tokens").alias("n_tokens")
    )
    is_next = F.col("conv_id").eqNullSafe(F.col("n_id")) & (F.col("following") == F.col("n_start"))
    turns = turns.join(next_window, is_next, "left")
    spare = F.lit(budget) - F.coalesce("system.tokens", F.lit(0)) - F.col("n_tokens")
    room = F.least(F.lit(history), spare)

    def copy(start: Column, pos: Column, text: Column, role: Column, tokens: Column, new: bool):
        return F.struct(
            start.cast("bigint").alias("window_start"),
            pos.cast("bigint").alias("pos"),
            role.alias("role"),
            text.alias("text"),
            tokens.alias("tokens"),
            F.lit(new).alias("new"),
        )

    here = [F.col("pos"), F.col("text"), F.col("role"), F.col("tokens")]
    is_system = F.col("system").isNotNull() & (F.col("pos") == 0)
    remembered = (
        F.coalesce(F.col("rest") <= room, F.lit(False)) & (F.col("following") < F.col("n")) & ~is_system
    )
    retained = F.col("system").isNotNull() & (F.col("pos") == F.col("start")) & (F.col("start") > 0)
    system_turn = [F.lit(0), F.col("system.text"), F.col("system.role"), F.col("system.tokens")]
    copies = F.array_compact(
        F.array(
            copy(F.col("start"), *here, True),
            F.when(remembered, copy(F.col("following"), *here, False)),
            F.when(retained, copy(F.col("start"), *system_turn, False)),
        )
    )
    head = F.concat(F.lit("<"), escaped(F.col("role")), F.lit(">"))
    body = escaped(F.col("text"))
    pieces = (
        turns.select("conv_id", F.explode(copies).alias("c"))
        .select("conv_id", "c.*")
        .withColumns({"head": head, "body": body})
        .select(
            "conv_id",
            "window_start",
            "pos",
            "new",
            "tokens",
            F.concat("head", "body", F.lit(_END)).alias("piece"),
            (F.col("new") & (F.col("role") == "assistant")).alias("learned"),
            F.length("head").alias("skip"),
            F.length("body").alias("chars"),
        )
    )
    ahead = (
        Window.partitionBy("conv_id", "window_start")
        .orderBy("pos", "new")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begin = F.coalesce(F.sum(F.length("piece")).over(ahead), F.lit(0)) + F.col("skip")
    span = F.struct(begin.alias("start"), (begin + F.col("chars")).alias("end"))
    grouped = (
        pieces.withColumn("span", F.when(F.col("learned"), span))
        .groupBy("conv_id", "window_start")
        .agg(
            F.array_sort(F.collect_list(F.struct("pos", "new", "piece"))).alias("pieces"),
            F.array_sort(F.collect_list("span")).alias("loss_spans"),
            F.count("*").cast("int").alias("n_turns"),
            F.sum((~F.col("new")).cast("int")).cast("int").alias("context_turns"),
            F.sum("tokens").alias("tokens"),
        )
    )
    return grouped.select(
        "conv_id",
        "window_start",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        "n_turns",
        "context_turns",
        "tokens",
        "loss_spans",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window the new turns (role, text) and learned texts, parsed from ``formatted`` alone."""
    marked = F.slice(F.split("formatted", _END, -1), 1, F.col("n_turns"))
    new = F.filter(marked, lambda piece, i: i >= F.col("context_turns"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring_index(piece, ">", 1), "<", -1)
        text = F.substring_index(piece, ">", -1)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    def learned(span: Column) -> Column:
        return unescaped(
            F.substr(F.col("formatted"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        )

    return windows.select(
        "conv_id",
        "window_start",
        F.transform(new, turn).alias("turns"),
        F.transform("loss_spans", learned).alias("learned"),
        F.length("formatted").alias("chars"),
    )


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, hashes of what its windows say when read back.

    A hash of a conversation needs its whole text in one row.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    per_window = read_back(windows).select(
        "conv_id",
        "window_start",
        F.size("turns").alias("n"),
        F.array_join(said, "").alias("said"),
        F.array_join("learned", "").alias("learned"),
        "chars",
    )
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window_start", "said", "learned"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("w", lambda w: w["said"]), "")
    learned = F.array_join(F.transform("w", lambda w: w["learned"]), "")
    return whole.select(
        "conv_id",
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """Conversations plus conversation -7, whose texts imitate control strings."""
    text = "\\### Assistant: </turn> ok"
    turns = F.array(
        *(F.struct(F.lit(i).cast("bigint"), F.lit(r)) for i, r in enumerate(["user", "assistant"]))
    )
    probe = conversations.sparkSession.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.inline(turns).alias("turn", "role")
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(
        probe.withColumn("text", F.lit(text))
    )


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return digests(format_windows(with_probe(table(spark, folder, "conversations"))))


ORACLE = r"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns as (
    select *, row_number() over w - 1 as pos, count(*) over (partition by conv_id) as n,
        greatest(1, (length(text) + 3) // 4) + 4 as tokens,
        first_value(role) over w = 'system' as opens,
        first_value(greatest(1, (length(text) + 3) // 4) + 4) over w as opening_tokens,
        first_value(length(role) + length(text)
            + 10 + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) over w as opening_chars
    from said
    window w as (partition by conv_id order by turn nulls last, role, text
        rows between unbounded preceding and unbounded following)
), sized as (
    select *, greatest(1, (768 - case when opens then opening_tokens else 0 end) // 2) as half,
        length(role) + length(text) + 10
            + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) as chars
    from turns
), summed as (
    select *, tokens > half as alone,
        sum(tokens) over w - tokens as before,
        sum((tokens > half)::int) over w - (tokens > half)::int as breaks
    from sized window w as (partition by conv_id order by pos)
), cut as (
    select *, min(pos) over w as start, max(pos) over w + 1 as following,
        sum(tokens) over (partition by conv_id, breaks, before // half, alone
            order by pos rows between current row and unbounded following) as rest
    from summed window w as (partition by conv_id, breaks, before // half, alone)
), windows as (
    select conv_id, start as next_start, sum(tokens) as next_tokens from cut group by conv_id, start
), copied as (
    select c.conv_id, sum(chars
        + case when rest <= least(256, 1024 - case when opens then opening_tokens else 0 end - next_tokens)
                and following < n and not (opens and pos = 0) then chars else 0 end
        + case when opens and pos = start and start > 0 then opening_chars else 0 end) as formatted_chars
    from cut c left join windows n on c.conv_id is not distinct from n.conv_id and following = next_start
    group by c.conv_id
), texts as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by pos) as said,
        coalesce(string_agg(case when role = 'assistant' then text end, '' order by pos), '') as learned
    from turns group by conv_id
)
select t.conv_id, n_turns, sha256(said) as turns_sha256, length(learned)::bigint as loss_chars,
    sha256(learned) as loss_sha256, formatted_chars::bigint as formatted_chars
from texts t join copied c on t.conv_id is not distinct from c.conv_id
"""
