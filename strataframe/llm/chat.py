"""Operator 5: chat formatting by a finite-state machine over roles and a declarative template.

A conversation's turns are ordered by number and run through the template's
transitions. A valid one becomes text segments, three a turn (prefix, content,
suffix), each with its loss flag; an invalid one becomes one row with the first
error. One shuffle by conversation; everything stays in JVM expressions.

Defined cases: rows with a null ``conv_id`` are dropped; rows that repeat exactly
count once; different rows of one turn number, a missing turn number, an unknown
or null role, a role out of order and an end in a state that is not final make
the conversation invalid; a null text is an empty content segment; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.plans.runtime import pick

TEMPLATE = {
    "start": "start",
    #: state after a turn of that role, by the state before it
    "transitions": {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
    "final": ["assistant"],
    #: role -> (prefix, suffix, loss on content, loss on suffix)
    "roles": {
        "system": ("<|system|>\n", "<|end|>\n", False, False),
        "user": ("<|user|>\n", "<|end|>\n", False, False),
        "assistant": ("<|assistant|>\n", "<|end|>\n", True, True),
    },
}


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def format_chats(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """``(conv_id, segment, turn, role, text, loss, error)``; ``error`` is null for segments of valid conversations."""
    step = {f"{s}|{r}": t for s, by in template["transitions"].items() for r, t in by.items()}
    trans = "map(" + ", ".join(_text(x) for kv in step.items() for x in kv) + ")"
    final = ", ".join(_text(s) for s in template["final"])
    roles = template["roles"]
    by_role = lambda i, show: "case t.role " + " ".join(f"when {_text(r)} then {show(v[i])}" for r, v in roles.items()) + " end"
    flag = lambda x: "true" if x else "false"
    d = pick(conversations, conv_id="bigint", turn="bigint", role="string", text="string").filter("conv_id is not null")
    grouped = d.groupBy("conv_id").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    machine = grouped.selectExpr(
        "conv_id",
        "turns",
        f"""aggregate(turns, named_struct('state', {_text(template["start"])}, 'last', cast(null as bigint), 'error', cast(null as string)),
            (a, t) -> if(a.error is not null, a, named_struct(
              'state', coalesce({trans}[concat(a.state, '|', t.role)], a.state),
              'last', t.turn,
              'error', case when t.turn is null then 'no turn number'
                            when t.turn = a.last then concat('repeated turn ', t.turn)
                            when {trans}[concat(a.state, '|', t.role)] is null then concat('turn ', t.turn, ': ', coalesce(t.role, 'no role'), ' after ', a.state)
                       end)),
            a -> coalesce(a.error, if(a.state in ({final}), null, concat('ends in ', a.state)))) as error""",
    )
    segments = f"""flatten(transform(turns, t -> array(
        named_struct('turn', t.turn, 'role', t.role, 'text', {by_role(0, _text)}, 'loss', false),
        named_struct('turn', t.turn, 'role', t.role, 'text', coalesce(t.text, ''), 'loss', {by_role(2, flag)}),
        named_struct('turn', t.turn, 'role', t.role, 'text', {by_role(1, _text)}, 'loss', {by_role(3, flag)}))))"""
    none = "array(named_struct('turn', cast(null as bigint), 'role', cast(null as string), 'text', cast(null as string), 'loss', cast(null as boolean)))"
    return machine.selectExpr("conv_id", "error", f"posexplode(if(error is null, {segments}, {none})) as (p, s)").selectExpr(
        "conv_id", "if(error is null, cast(p as bigint), null) as segment", "s.turn", "s.role", "s.text", "s.loss", "error"
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _sql(template: dict = TEMPLATE) -> str:
    lit = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    roles = template["roles"]
    # in this template a state is named after the role that leads to it
    allowed = ", ".join(f"({lit(s)}, {lit(r)})" for s, by in template["transitions"].items() for r in by)
    case = lambda i, show: "case role " + " ".join(f"when {lit(r)} then {show(v[i])}" for r, v in roles.items()) + " end"
    flag = lambda x: "true" if x else "false"
    return f"""
with d as (select distinct conv_id, turn, role, text from conversations where conv_id is not null
), o as (
  select *, row_number() over w as i, lag(turn) over w as before, coalesce(lag(role) over w, {lit(template["start"])}) as state,
    row_number() over (partition by conv_id order by turn desc nulls last, role desc nulls last, text desc nulls last) as back
  from d window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first)
), e as (
  select *, case when turn is null then 'no turn number' when turn = before then 'repeated turn ' || turn
    when role is null or (state, role) not in ({allowed}) then 'turn ' || turn || ': ' || coalesce(role, 'no role') || ' after ' || state end as err from o
), verdict as (
  select conv_id, coalesce(arg_min(err, i) filter (err is not null),
    max(case when back = 1 and role not in ({", ".join(lit(s) for s in template["final"])}) then 'ends in ' || role end)) as error
  from e group by conv_id
), seg as (
  select conv_id, (i - 1) * 3 as segment, turn, role, {case(0, lit)} as text, false as loss from e
  union all select conv_id, (i - 1) * 3 + 1, turn, role, coalesce(text, ''), {case(2, flag)} from e
  union all select conv_id, (i - 1) * 3 + 2, turn, role, {case(1, lit)}, {case(3, flag)} from e
)
select conv_id, segment, turn, role, text, loss, error from seg join verdict using (conv_id) where error is null
union all select conv_id, null, null, null, null, null, error from verdict where error is not null
"""


SQL = _sql()
