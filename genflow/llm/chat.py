"""Preference pairs from chosen and rejected conversations.

The longest common prefix of turns is rendered once, as the prompt; what
follows is two completions with the spans that carry loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
ESCAPED = "< |"
#: Turns whose spans are placed together.
RUN = 128


def _turns(table: DataFrame, key: str, name: str) -> DataFrame:
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.replace(F.coalesce("text", F.lit("")), F.lit(OPEN), F.lit(ESCAPED)).alias("text"))
    listed = F.array_sort(F.collect_list(turn))
    return table.groupBy(F.col(key).alias("_key")).agg(
        F.transform(listed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def rendered(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def loss_spans(turns: Column, trained: str = "assistant") -> Column:
    """``start:end`` of each trained reply with its end mark in the rendered text; code points, end exclusive.

    Turns are taken ``RUN`` at a time, and the places of the runs added up after
    that, so no growing list is copied once per turn of a long conversation.
    """
    def step(acc, t):
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(_body(t))
        span = F.struct(start.alias("start"), end.alias("end"))
        more = F.when(t["role"] == trained, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    last = F.floor(F.greatest(F.size(turns) - 1, F.lit(0)) / RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(F.slice(turns, i * RUN + 1, F.lit(RUN)), zero, step))
    starts = F.aggregate(runs, F.array(F.lit(0)), lambda acc, run: F.array_append(acc, F.element_at(acc, -1) + run["at"]))
    placed = F.zip_with(runs, F.slice(starts, 1, F.size(runs)), lambda run, at: F.transform(
        run["spans"], lambda x: F.concat_ws(":", x["start"] + at, x["end"] + at)))
    return F.array_join(F.flatten(placed), ",")


def preferences(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id", trained: str = "assistant") -> DataFrame:
    """One row per key in both tables of turns (``key``, turn, role, text).

    Turns go by number, then role, then text; null turns first, null roles and
    texts are empty. Two turns are equal if role and text are. The prompt is
    the longest common prefix; a side that ends there has an empty completion.
    ``<|`` in a text becomes ``< |``, so no text can forge a turn. Repeated
    rows are repeated turns; a null key is a key like any other. Empty tables
    give no rows; other columns are not carried. A conversation becomes one
    value, so it must fit one row; nothing else is gathered.
    """
    left, right = _turns(chosen, key, "_chosen"), _turns(rejected, key, "_rejected")
    right = right.withColumnRenamed("_key", "_other")
    both = left.join(right, F.col("_key").eqNullSafe(F.col("_other")))
    same = F.zip_with("_chosen", "_rejected", lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, False)
    both = both.withColumn("_n", F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int"))

    def after(side):
        return F.slice(side, F.col("_n") + 1, F.size(side) + 1)

    return both.select(
        F.col("_key").alias(key), F.col("_n").cast("long").alias("prompt_turns"),
        rendered(F.slice("_chosen", F.lit(1), F.col("_n"))).alias("prompt"),
        rendered(after("_chosen")).alias("chosen"), loss_spans(after("_chosen"), trained).alias("chosen_loss"),
        rendered(after("_rejected")).alias("rejected"), loss_spans(after("_rejected"), trained).alias("rejected_loss"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Rejected versions: each conversation with its last reply taken from its neighbour.

    The neighbour of conversations 2k and 2k+1 is the other one; without a
    neighbour's reply the reply is empty. A conversation without replies stays. Ids are integers;
    rows with a null id or turn stay as they are.
    """
    replies = turns.where((F.col("role") == "assistant") & F.col("turn").isNotNull())
    last = replies.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("_last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("_last.text").alias("_other"))
    swaps = last.select("conv_id", F.col("_last.turn").alias("_turn")).join(other, "conv_id", "left")
    joined = turns.select("conv_id", "turn", "role", "text").join(swaps, "conv_id", "left")
    hit = (F.col("role") == "assistant") & (F.col("turn") == F.col("_turn"))
    return joined.select("conv_id", "turn", "role", F.when(hit, F.col("_other")).otherwise(F.col("text")).alias("text"))


ORACLE = """
with t as (select conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') as text from conversations),
last as (select conv_id, max(turn) as turn from t where role = 'assistant' group by conv_id),
reply as (select l.conv_id, l.turn, max(t.text) as text from last l join t on t.conv_id = l.conv_id and t.turn = l.turn
    and t.role = 'assistant' group by l.conv_id, l.turn),
bad as (select t.conv_id, t.turn, t.role, case when r.turn is not null then coalesce(o.text, '') else t.text end as text
    from t left join reply r on r.conv_id = t.conv_id and r.turn = t.turn and t.role = 'assistant'
    left join reply o on o.conv_id = xor(t.conv_id, 1)),
c as (select conv_id, role, text, row_number() over (partition by conv_id order by turn, role, text) as i from t),
r as (select conv_id, role, text, row_number() over (partition by conv_id order by turn, role, text) as i from bad),
n as (select coalesce(c.conv_id, r.conv_id) as conv_id,
    coalesce(min(case when c.role is distinct from r.role or c.text is distinct from r.text then coalesce(c.i, r.i) end) - 1,
        max(coalesce(c.i, r.i))) as n
    from c full join r on c.conv_id = r.conv_id and c.i = r.i group by 1),
side as (select 'chosen' as kind, c.* from c union all select 'rejected', r.* from r),
part as (select s.kind, s.conv_id, s.role, s.i, n.n, s.i <= n.n as common,
        concat('<|', s.role, '|>', chr(10)) as head, concat(s.text, '<|end|>', chr(10)) as body
    from side s join n on n.conv_id = s.conv_id),
placed as (select *, sum(length(head) + length(body)) over (partition by kind, conv_id, common order by i) as e from part)
select conv_id, max(n) as prompt_turns,
    coalesce(string_agg(concat(head, body), '' order by i) filter (where common and kind = 'chosen'), '') as prompt,
    coalesce(string_agg(concat(head, body), '' order by i) filter (where not common and kind = 'chosen'), '') as chosen,
    coalesce(string_agg(concat(e - length(body), ':', e), ',' order by i)
        filter (where not common and kind = 'chosen' and role = 'assistant'), '') as chosen_loss,
    coalesce(string_agg(concat(head, body), '' order by i) filter (where not common and kind = 'rejected'), '') as rejected,
    coalesce(string_agg(concat(e - length(body), ':', e), ',' order by i)
        filter (where not common and kind = 'rejected' and role = 'assistant'), '') as rejected_loss
from placed group by conv_id
"""
