"""DuckDB statements of the canonical tables, for the oracles."""

from __future__ import annotations

import re

from ..sources.fixtures import CALIBRATORS

_TABLES = {
    "vis": """select year(l_shipdate)-1995 as scan, least(l_suppkey%16, l_partkey%16) as ant1, greatest(l_suppkey%16, l_partkey%16) as ant2,
  l_orderkey%24 as chan, l_linenumber%4 as corr, avg(l_quantity-25) as re, avg(100*l_discount-5) as im,
  max(case when l_tax>=0.07 then 1 else 0 end)=1 as flag from lineitem group by 1,2,3,4,5""",
    "gains": """select ant, chan, pol, avg(1+p_retailprice/1000.0) as gr, avg(p_size/50.0) as gi, avg(p_retailprice/100.0) as snr,
  max(case when p_size=50 then 1 else 0 end)=1 as flag from (select p_partkey%16 as ant, cast(floor(p_partkey/16.0) as bigint)%24 as chan,
  p_size%2 as pol, p_retailprice, p_size from part) t group by 1,2,3""",
    "delays": "select cast(floor(s_suppkey/2.0) as bigint)%8 as ant, s_nationkey%2 as pol, s_suppkey%2 as epoch, avg(s_acctbal) as delay_ns from supplier group by 1,2,3",
    "uvw": """select a.id as ant1, b.id as ant2, (b.id-a.id)*7.0::double as u, (b.id*b.id-a.id*a.id)*0.5::double as v, (b.id%3-a.id%3)*1.5::double as w
  from (select distinct l_suppkey%16 as id from lineitem) a join (select distinct l_suppkey%16 as id from lineitem) b on a.id<=b.id""",
    "freqs": "select distinct l_orderkey%24 as chan, 55.0e6+(l_orderkey%24)*23926.0::double as f_hz from lineitem",
    "pixels": """select vec_id as image_id, (i%8)::int as x, (i//8)::int as y, cast(embedding[i+1] as double) as val
  from (select vec_id, embedding, unnest(range(64)) as i from embeddings) t""",
    "images": "select vec_id as image_id, label as band, row_number() over (partition by label order by vec_id)-1 as seq from embeddings",
    "scans": "select date_trunc('hour', ts) as ts, user_id%16 as spw, min(event_id) as scan_id from events group by 1,2",
    "tasklog": "select event_id as task_id, event_type as state, user_id as name, value as runtime, ts as finished, props as payload from events",
    "catalog": """select c_custkey as id, (c_custkey*7919)%3600/10.0::double as ra, (c_custkey*104729)%1700/10.0::double-85.0 as dec,
  abs(c_acctbal)+1.0 as peak_flux, 50.0::double+c_nationkey*20.0 as local_rms from customer""",
    "persist": """select s_suppkey as pid, (s_suppkey*7919)%3600/10.0::double as ra, (s_suppkey*104729)%1700/10.0::double-85.0 as dec,
  abs(s_acctbal)+1.0 as flux from supplier""",
    "flaglist": 'select cast(o_orderdate as date) as "date", o_custkey%16 as corr_num, o_orderpriority as source from orders',
    "calibrators": "select * from (values " + ", ".join(f"('{n}', {a}::double, {d}::double, {f}::double, {s}::double)" for n, a, d, f, s in CALIBRATORS) + ") t(label, ra, dec, flux, alpha)",
}
_NEEDS: dict[str, tuple[str, ...]] = {}


def define(name: str, sql: str, *needs: str) -> None:
    """A further common table expression for oracles, over others."""
    _TABLES[name], _NEEDS[name] = sql, needs


def again(prefix: str, within: list[str], names: list[str]) -> None:
    """The expressions ``names`` once more as ``prefix + name``, over those of ``within`` with the prefix."""
    turn = lambda text: re.sub(rf"\b({'|'.join(within)})\b", lambda m: prefix + m.group(1), text)
    for name in names:
        define(prefix + name, turn(_TABLES[name]), *(prefix + n if n in within else n for n in _NEEDS.get(name, ())))


def sql(body: str, *names: str) -> str:
    """``body`` with the named tables, and what they need, as common table expressions before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({_TABLES[n]})" for n in order) + "\n" + body.strip()
