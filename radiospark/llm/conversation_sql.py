"""DuckDB statement of the repair of conversations: a plain dynamic programme over (row, state), row by row.

A state's best way is one text, nine digits of cost and then the audit, so that the smaller text is the better way. Null
ids and turns, ties of turns and empty roles count as the operator defines them.
"""

from __future__ import annotations

WHITE = r"[\x20\x09-\x0D]"


def _add(way: str, cost: str, edit: str) -> str:
    return f"(lpad((left({way},9)::bigint+{cost})::varchar,9,'0')||substr({way},10)||'{edit}')"


def _step() -> str:
    """One row of the programme: ``acc`` holds the ways to the four states, ``x`` the row's must (go), cut and initial."""
    # inserted rows before the edit: to a user's state, then to an assistant's
    at = {k: f"acc.w{k}" for k in range(4)}
    user = f"least({at[2]}, {_add(at[0], '3', 'I')}, {_add(at[1], '3', 'I')}, {_add(at[3], '3', 'I')})"
    inner = f"list_transform([{{'w0': {at[0]}, 'w1': {at[1]}, 'w2': {user}, 'w3': acc.w3}}], lambda b: {{'w0': b.w0, 'w1': b.w1, 'w2': b.w2, 'w3': least(b.w3, {_add('b.w2', '3', 'I')})}})[1]"

    def ways(state: int) -> str:
        drop = _add(f"c.w{state}", "4", "D")
        keep, free = [], []
        for before, letter, after in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3)):
            if after == state:
                keep.append(f"case when not x.must and x.initial='{letter}' then {_add(f'c.w{before}', '3*x.cut', 'K')} end")
        for before, after in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if after == state:
                free.append(f"case when not x.must then {_add(f'c.w{before}', '3+3*x.cut', 'R')} end")
        return f"least({', '.join([drop, *keep, *free])}, null)"

    rows = ", ".join(f"'w{k}': {ways(k)}" for k in range(4))
    return f"list_transform([{inner}], lambda c: {{{rows}}})[1]"


START = "{'w0': '000000000', 'w1': null::varchar, 'w2': null::varchar, 'w3': null::varchar}"

SQL = rf"""
with hit as (
  select conv_id, turn, coalesce(role,' ') as role, coalesce(text,' ') as text, coalesce(conv_id::varchar,' ')||':'||coalesce(turn::varchar,' ') as name,
    row_number() over () as id from conversations
), bits as (
  select (select list(v) from (with recursive t(k, n, v) as (select k, 0, k from range(256) r(k) union all
    select k, n+1, case when v%2=1 then xor(v//2, 3988292384) else v//2 end from t where n<8) select v from t where n=8 order by k)) as tab
), drawn as (
  select conv_id, turn, role, text, id, xor(list_reduce([x::bigint for x in list_transform(range(1, strlen(name)+1), lambda i: ascii(substr(name, i, 1)))],
    lambda c, b: xor(c//256, tab[(xor(c, b) & 255)+1]), 4294967295), 4294967295) % 20 as draw from hit, bits
), damaged as (
  select conv_id, turn, case when draw=4 then 'user' else role end as role,
    case draw when 1 then '' when 2 then regexp_replace(text,'[.!?]','','g') else text end as text, id, unnest(range(case when draw=3 then 2 else 1 end)) as again
  from drawn where draw<>0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, id, again) as place from damaged
), faults as (
  select *, left(role,1) as initial, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by place)>1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else 'none' end as fault
  from placed
), pairs as (
  select *, lag(initial) over (partition by conv_id order by place)||initial as pair from faults
), whole as (
  select conv_id, coalesce(max(turn)-min(turn)+1-count(distinct turn),0)::bigint as gaps, count(*) filter (where fault='blank') as blank,
    count(*) filter (where fault='duplicate') as duplicate, count(*) filter (where fault='truncated') as truncated,
    count(*) filter (where pair not in ('su','ua','au')) as illegal, list(role order by place) as roles, list(text order by place) as texts,
    list({{'must': fault in ('blank','duplicate'), 'cut': (fault='truncated')::bigint, 'initial': initial}} order by place) as xs
  from pairs group by conv_id
), ended as (
  select *, list_reduce(xs, lambda acc, x: {_step()}, {START}) as e from whole
), best as (
  select *, least(e.w0, e.w3, {_add('e.w2', '3', 'I')}, {_add('e.w1', '6', 'II')}) as way from ended
), edits as (
  select conv_id, unnest(range(1, length(audit)+1)) as k, audit, roles, texts from (select conv_id, roles, texts, substr(way,10) as audit from best)
), told as (
  select *, substr(audit,k,1) as edit, length(replace(substr(audit,1,k),'I',''))::bigint as nth from edits
), kept as (
  select *, row_number() over (partition by conv_id order by k)-1 as j, first(edit='K' and left(roles[nth],1)='s') over (partition by conv_id order by k) as led from told where edit<>'D'
), lines as (
  select conv_id, k, case when edit='K' then roles[nth] when (j+led::bigint)%2=0 then 'user' else 'assistant' end||':'||case when edit='I' then '' else texts[nth] end as line from kept
), hashed as (
  select conv_id, string_agg(line, chr(10) order by k) as t from lines group by conv_id
)
select c.conv_id, coalesce(gaps,0)::bigint as gaps, coalesce(blank,0) as blank, coalesce(duplicate,0) as duplicate, coalesce(truncated,0) as truncated,
  coalesce(illegal,0) as illegal, coalesce(left(way,9)::bigint,0) as cost, coalesce(substr(way,10),'') as audit, sha256(coalesce(t,'')) as repaired_sha256
from (select distinct conv_id from conversations) c left join best b on b.conv_id is not distinct from c.conv_id left join hashed h on h.conv_id is not distinct from c.conv_id
"""
