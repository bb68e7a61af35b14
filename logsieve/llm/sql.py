"""DuckDB SQL for the queries that SQL can express, over the table views."""

from __future__ import annotations

import corpus_pipeline

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_CHAT_FORMAT = r"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
              union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
              union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24)::bigint as formatted_chars
from rows group by conv_id
"""

OP3_EMBEDDING_NEAR_DUPS = """
with recursive vec as (
  select vec_id, label, [x::double for x in embedding] as v from embeddings
  where label is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0),
link as (select a.vec_id as a, b.vec_id as b from vec a join vec b on a.label = b.label and a.vec_id <> b.vec_id
         and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, link.b from reach join link on reach.b = link.a)
select vec_id, (select count(*) from link where link.a = vec_id)::bigint as n_links,
       (select min(b) from reach where reach.a = vec_id) as component_id,
       vec_id = (select min(b) from reach where reach.a = vec_id) as kept
from embeddings
"""

OP5_DECONTAMINATE = rf"""
with item as (select cast(item_id as varchar) as item_id, {_WORDS.format("text")} as w from benchmark where text is not null),
win as (select distinct item_id, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as win, least(13, len(w)) as n
        from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item where len(w) > 0) t),
doc as (select row_number() over () as r, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
size as (select distinct n from win),
place as (select r, i, n, array_to_string(w[i : i + n - 1], ' ') as win
          from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, size where len(w) >= n) t
          where w[i] in (select split_part(win, ' ', 1) from win)),
occ as (select p.r, p.i, p.n, x.item_id from place p join win x on p.win = x.win and p.n = x.n),
hit as (select r, count(distinct k)::bigint as n_hit from (select r, unnest(range(i, i + n)) as k from occ) t group by r),
own as (select r, count(*)::bigint as n_items, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct r, item_id from occ where item_id is not null) t group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from doc left join hit using (r) left join own using (r)
"""

# Each order is played out: a document goes at the step of the first of its filters.
OP11_FILTER_AUDIT = r"""
with doc as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
least_id as (select t, min(doc_id) as m from doc group by t),
lab as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
fail as (select part, concat(
                  case when len(w) < 50 then 'A' else '' end,
                  case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end,
                  case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end,
                  case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end,
                  case when doc_id > m then 'E' else '' end) as fails,
                coalesce(good, false) as good, coalesce(toxic, false) as toxic
         from doc join least_id using (t) left join lab using (doc_id)),
cell as (select part, fails, count(*)::bigint as n, sum(good::int)::bigint as good, sum(toxic::int)::bigint as toxic
         from fail group by all),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
filter_orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
           where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
goes as (select part, filter_order, fails, n, good, toxic,
                coalesce(list_min([instr(filter_order, f) for f in string_split(fails, '') if f <> '']), 9) as at
         from cell, filter_orders),
steps as (select part, filter_order, k::int as step, filter_order[k] as f, goes from (select unnest(range(1, 6)) as k) s, goes),
counted as (select part, filter_order, step, f,
       sum(case when goes.at > step then goes.n else 0 end)::bigint as kept,
       sum(case when goes.at = step then goes.n else 0 end)::bigint as removed,
       sum(case when goes.at < step and contains(goes.fails, f) then goes.n else 0 end)::bigint as redundant,
       sum(case when goes.fails = f then goes.n else 0 end)::bigint as unique_fails,
       sum(case when goes.at = step then goes.good else 0 end)::bigint as good_lost,
       sum(case when goes.at = step then goes.toxic else 0 end)::bigint as toxic_lost
from steps group by part, filter_order, step, f)
select * exclude (f), (sum(removed) over (partition by part, f))::bigint as shapley from counted
"""


def op4_mix_sources(share: tuple[int, int] = (3, 4), epochs: int = 2, seed: int = 42) -> str:
    """The same budgets level by level, and a plain running sum over each leaf."""
    names = ["domain", "lang", "source"]

    def weight(depth: int) -> str:
        own = [k for k in corpus_pipeline.MIX_WEIGHTS if len(k) == depth and k[0] != "*"]
        wild = [k for k in corpus_pipeline.MIX_WEIGHTS if depth > 1 and k[0] == "*"]
        cases = [(" and ".join(f"{n} = '{x}'" for n, x in zip(names, k)), corpus_pipeline.MIX_WEIGHTS[k]) for k in own]
        cases += [(f"{names[depth - 1]} = '{k[-1]}'", corpus_pipeline.MIX_WEIGHTS[k]) for k in wild]
        return "case " + " ".join(f"when {c} then {w}" for c, w in cases) + " else 1 end" if cases else "1"

    def given(nodes: str, parent: str, up: str, keys: str) -> str:
        on = " and ".join(f"c.{k} is not distinct from p.{k}" for k in up.split(",") if k) or "true"
        part = "partition by " + up if up else "partition by 1"
        columns, name = ", ".join(f"c.{k}" for k in keys.split(",")), keys.split(",")[-1] + " nulls last"
        return f"""
select {keys}, (case when full_ then cap when share = 0 then 0
       else (l * upto) // share - (l * (upto - w)) // share end)::hugeint as b
from (select *, b - sum(case when full_ then cap else 0 end) over ({part}) as l,
             sum(case when full_ then 0 else w end) over ({part}) as share,
             sum(case when full_ then 0 else w end) over ({part} order by {name} rows unbounded preceding) as upto
      from (select *, w > 0 and cap * after_ <= w * (b - before_) as full_
            from (select *, coalesce(sum(cap) over ({part} order by w = 0, cap::double / nullif(w, 0)::double, {name}
                                     rows between unbounded preceding and 1 preceding), 0) as before_,
                         sum(w) over ({part} order by w = 0, cap::double / nullif(w, 0)::double, {name}
                                      rows between current row and unbounded following) as after_
                  from (select {columns}, c.cap, c.w, p.b from {nodes} c join {parent} p on {on}) t0
                 ) t1) t2) t3"""

    domain = corpus_pipeline.MIX_DOMAIN_SQL
    return rf"""
with doc as (select doc_id, {domain} as domain, lang, source,
             coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::hugeint as n_tokens from documents),
n3 as (select domain, lang, source, tokens, w, case when w > 0 then tokens * {epochs} else 0 end as cap
       from (select domain, lang, source, sum(n_tokens)::hugeint as tokens, ({weight(3)})::hugeint as w from doc group by all) t),
n2 as (select domain, lang, w, case when w > 0 then c else 0 end as cap
       from (select domain, lang, sum(cap)::hugeint as c, ({weight(2)})::hugeint as w from n3 group by all) t),
n1 as (select domain, w, case when w > 0 then c else 0 end as cap
       from (select domain, sum(cap)::hugeint as c, ({weight(1)})::hugeint as w from n2 group by all) t),
b0 as (select least(sum(cap), (select sum(n_tokens) * {share[0]} // {share[1]} from doc))::hugeint as b from n1),
b1 as ({given("n1", "b0", "", "domain")}),
b2 as ({given("n2", "b1", "domain", "domain,lang")}),
b3 as ({given("n3", "b2", "domain,lang", "domain,lang,source")}),
plan as (select n3.domain, n3.lang, n3.source, b // tokens as full_epochs, b % tokens as rest from b3 join n3
         on n3.domain is not distinct from b3.domain and n3.lang is not distinct from b3.lang
         and n3.source is not distinct from b3.source where b > 0),
ranked as (select doc.*, full_epochs, rest, md5(concat('{seed}|', full_epochs, '|', doc_id)) as h from doc join plan
           on doc.domain is not distinct from plan.domain and doc.lang is not distinct from plan.lang
           and doc.source is not distinct from plan.source),
placed as (select *, sum(n_tokens) over (partition by domain, lang, source order by h range unbounded preceding) as upto from ranked)
select doc_id, domain, lang, source, n_tokens::bigint as n_tokens, full_epochs::bigint as full_epochs,
       greatest(0, least(n_tokens, rest - (upto - n_tokens)))::bigint as take_tokens
from placed where full_epochs > 0 or (rest > 0 and upto - n_tokens < rest)
"""
