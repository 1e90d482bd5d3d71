"""Chat formatting in budgeted, turn-aligned windows (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.llm.text import WORD

#: Turn markup. Escaped texts and roles contain neither "<" nor ">", so it can't be forged.
OPEN, OPEN_END, CLOSE = "<turn:", ">", "</turn>\n"
_TURN = "struct<ord:int,before:bigint,tok:bigint,role:string,text:string>"


def escape(col: Column) -> Column:
    """Reversible: backslash, "<" and ">" become two-character escapes."""
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        col = F.replace(col, F.lit(plain), F.lit(coded))
    return col


def unescape(col: Column) -> Column:
    """Inverse of ``escape``; every backslash in its input starts one of the escapes."""
    for coded, plain in (("\\g", ">"), ("\\l", "<"), ("\\b", "\\")):
        col = F.replace(col, F.lit(coded), F.lit(plain))
    return col


def format_windows(turns: DataFrame, budget: int = 2048, history: int = 256, overhead: int = 3) -> DataFrame:
    """Format conversations (conv_id, turn, role, text) as training windows.

    A turn costs its words plus ``overhead`` tokens. The room that a leading
    system turn leaves of ``budget`` is shared between history (half of it,
    at most ``history``) and a span S of new turns: prefix sums cut each
    conversation at multiples of S, turns inside one multiple form a window,
    a turn that crosses a multiple forms its own. Turns are never split. A
    later window starts with the leading system turn and as many of the turns
    just before it as fit in ``history`` tokens and in what its new turns
    leave of the budget; these are repeated, hence masked. So a window, with
    all that it repeats, stays within ``budget`` unless the system turn and
    one new turn alone exceed it; such a window repeats no other turn.

    Returns one row per window: conv_id, window, text, n_repeated (leading
    turns that repeat), loss_spans (start, len in code points: the escaped
    text of each new assistant turn) and n_tokens, of all its turns.

    Null text or role: empty. Rows order by (turn, role, text), null turns
    first; repeated rows are kept as turns. A null conv_id is one
    conversation. Empty input: no rows. Extra columns are ignored.
    A conversation's turns meet in one task, where they are sorted and
    spilled; its text as a whole is one value when it is read back.
    """
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    t = t.withColumn("tok", F.regexp_count("text", F.lit(WORD)).cast("long") + overhead)
    t = t.withColumn("ord", F.row_number().over(order))
    first_system = (F.col("ord") == 1) & (F.col("role") == "system")
    t = t.withColumn("sys_tok", F.first(F.when(first_system, F.col("tok")).otherwise(0)).over(order))
    t = t.withColumn("body_tok", F.when(first_system, F.lit(0)).otherwise(F.col("tok")).cast("long"))
    t = t.withColumn("end", F.sum("body_tok").over(order)).withColumn("before", F.expr("end - body_tok"))
    t = t.withColumn("span", F.expr(f"greatest(1L, {budget} - sys_tok - least({history}, greatest(0L, {budget} - sys_tok) div 2))"))
    t = t.withColumn("a", F.expr("before div span")).withColumn("b", F.expr("greatest(end - 1, before) div span"))
    t = t.withColumn("cut", F.expr("case when a = b then 2 * a else 2 * a + 1 end"))
    wins = t.groupBy("conv_id", "cut").agg(
        F.sort_array(F.collect_list(F.struct("ord", "before", "tok", "role", "text"))).alias("turns"),
        F.min("before").alias("start"),
        F.max("end").alias("stop"),
        F.sum("body_tok").alias("new_tok"),
        F.max("sys_tok").alias("sys_tok"),
    )
    along = conv.orderBy("cut")
    none = F.array().cast(f"array<{_TURN}>")
    wins = wins.withColumn("window", (F.row_number().over(along) - 1).cast("int"))
    wins = wins.withColumn(
        "lead_turn", F.first(F.expr("filter(turns, t -> t.ord = 1 and t.role = 'system')")).over(along)
    )
    wins = wins.withColumn(
        "tail", F.expr(f"filter(turns, t -> t.before >= stop - {history} and not (t.ord = 1 and t.role = 'system'))")
    )
    # Windows that start within the history, and the last one before them, which can reach into it.
    by_start = conv.orderBy("start")
    near = F.flatten(F.collect_list("tail").over(by_start.rangeBetween(-history, -1)))
    far = F.coalesce(F.last("tail").over(by_start.rangeBetween(Window.unboundedPreceding, -history - 1)), none)
    wins = wins.withColumn("earlier", F.concat(far, near))
    wins = wins.withColumn("reach", F.expr(f"greatest(0L, least({history}, {budget} - sys_tok - new_tok))"))
    wins = wins.withColumn("past", F.expr("filter(earlier, t -> t.before >= start - reach)"))
    wins = wins.withColumn("again", F.when(F.col("window") == 0, none).otherwise(F.concat("lead_turn", "past")))
    wins = wins.withColumn("n_repeated", F.size("again"))

    def shown(turn: Column, loss: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(OPEN_END))
        body = escape(turn["text"])
        return F.struct(
            F.concat(head, body, F.lit(CLOSE)).alias("s"),
            F.length(head).alias("off"),
            F.length(body).alias("len"),
            loss.alias("loss"),
        )

    wins = wins.withColumn(
        "parts",
        F.concat(
            F.transform("again", lambda x: shown(x, F.lit(False))),
            F.transform("turns", lambda x: shown(x, x["role"] == "assistant")),
        ),
    )
    spans = F.expr(
        "aggregate(parts, named_struct('pos', 0, 'spans', cast(array() as array<struct<start:int,len:int>>)), "
        "(st, p) -> named_struct('pos', st.pos + length(p.s), 'spans', "
        "if(p.loss, concat(st.spans, array(named_struct('start', st.pos + p.off, 'len', p.len))), st.spans)), "
        "st -> st.spans)"
    )
    return wins.select(
        "conv_id",
        "window",
        F.expr("array_join(transform(parts, p -> p.s), '')").alias("text"),
        "n_repeated",
        spans.alias("loss_spans"),
        F.expr("new_tok + sys_tok + if(window = 0, 0L, aggregate(past, 0L, (n, t) -> n + t.tok))").alias("n_tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: per conversation its turns and the text under the loss mask.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """

    def turn_text(piece: Column) -> Column:
        cut = F.instr(piece, OPEN_END)
        role = F.substring(piece, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        body = F.substring(piece, cut + 1, F.length(piece))
        return F.concat(unescape(role), F.lit("\n"), unescape(body), F.lit("\n"))

    pieces = F.split("text", CLOSE)
    w = windows.withColumn("pieces", pieces)
    w = w.withColumn("fresh", F.expr("slice(pieces, n_repeated + 1, size(pieces) - 1 - n_repeated)"))
    w = w.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform("fresh", turn_text), "").alias("turns"),
            F.array_join(
                F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["len"]))), ""
            ).alias("loss"),
        ).alias("part"),
        F.size("fresh").cast("long").alias("n"),
        F.length("text").cast("long").alias("chars"),
    )
    g = w.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.expr("array_join(transform(parts, p -> p.loss), '')")
    return g.select(
        "conv_id",
        "n_turns",
        F.sha2(F.expr("array_join(transform(parts, p -> p.turns), '')"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
