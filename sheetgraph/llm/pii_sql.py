"""DuckDB SQL of the personal data query: plain scans for the same patterns, validators and context words."""

from __future__ import annotations

from sheetgraph.llm import pii


def sql() -> str:
    """For `documents`. Patterns are the plain forms of those in pii.py, whose possessive ones only save time."""
    octet = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": pii._IBAN,
        "number": r"[(]?[0-9]([\x20()./-]{0,2}[0-9]){6,}",
    }
    hits = " union all ".join(f"select id, '{k}' as form, regexp_extract_all(text, '{p}') as own, string_split_regex(text, '{p}') as gaps from t" for k, p in patterns.items())
    words = lambda of: " ".join(f"when '{k}' then '{of[k]}'" for k in pii.KINDS)
    lengths = ", ".join(f"'{c}': {n}" for c, n in pii.IBAN_LENGTHS.items())
    places = " ".join(f"when '{k}' then {i}" for i, k in enumerate(pii.KINDS))
    validated = " ".join(f"when '{k}' then {v}" for k, v in pii.VALIDATED.items())
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    counts = ", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in pii.BASE)
    near_words = f"{pii.CONTEXT['tel']}|{pii.CONTEXT['pan']}"
    value = "case when x between '0' and '9' then ascii(x) - 48 else ascii(x) - 55 end"
    return rf"""with t as (select row_number() over () as id, doc_id, coalesce(text, '') as text from documents),
f as ({hits}),
h as (select id, form, unnest(own) as m, unnest(range(1, len(own) + 1)) as i, gaps from f where len(own) > 0),
p as (select id, form, m, right(gaps[i], {pii.BEFORE}) as before, left(gaps[i + 1], {pii.AFTER}) as after, cast(sum(length(m) + length(gaps[i])) over (partition by id, form order by i) as bigint) as fin from h),
d as (select *, fin - length(m) as start, regexp_replace(m, '[^0-9]', '', 'g') as digits, coalesce(map {{{lengths}}}[left(m, 2)], 99) as n, replace(m, ' ', '') as compact from p),
c as (select *, n + case when contains(m, ' ') then (n - 1) // 4 else 0 end as long, left(compact, n) as account,
  length(digits) <= 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda k: case when k % 2 = 1 then cast(digits[-k] as int) when cast(digits[-k] as int) > 4 then 2 * cast(digits[-k] as int) - 9 else 2 * cast(digits[-k] as int) end)) % 10 = 0 as luhn from d),
k as (select id, start, fin, before, after, form as kind from c where form = 'email' or (form = 'ip' and regexp_full_match(m, '{octet}(\.{octet}){{3}}')) or (form = 'card' and length(digits) between 14 and 19 and luhn) or (form = 'phone' and length(digits) between 10 and 15)
  union all select id, start, start + long, before, concat(m[long + 1:], after), form from c where form = 'iban' and length(account) = n and not regexp_matches(before, '[A-Za-z0-9]\z')
    and list_reduce(list_transform(string_split(concat(account[5:], account[:4]), ''), lambda x: [{value}, case when x between '0' and '9' then 10 else 100 end]), lambda r, x: [(r[1] * x[2] + x[1]) % 97, 0], [0, 0])[1] = 1
  union all select c.id, start, fin, before, after, case when length(digits) between 12 and 19 and luhn then 'pan' else 'tel' end from c join t using (id) where form = 'number' and (length(digits) between 7 and 15 or (length(digits) between 12 and 19 and luhn))
    and regexp_matches(lower(text), '{near_words}') and not regexp_matches(before, '[A-Za-z0-9+.,="''-]\z') and not regexp_matches(after, '^[A-Za-z0-9@=]')),
w as (select *, lower(concat_ws(' ', before, after)) as near from k),
s as (select id, start, fin, kind, case kind {places} end as place, (case kind {validated} end) + case when regexp_matches(near, case kind {words(pii.CONTEXT)} end) then {pii.FOR} else 0 end - case when regexp_matches(near, '{pii.AGAINST}') then {pii.LESS} else 0 end as score from w),
g as (select * from s where kind in ({base}) or round(score, 2) >= 0.6),
o as (select * from g where kind not in ('tel', 'pan') or not exists (select 1 from g as b where b.id = g.id and b.kind not in ('tel', 'pan') and b.start < g.fin and g.start < b.fin)),
j as (select id, {counts}, string_agg(kind || ':' || start || ':' || fin, ',' order by start, place, fin) filter (where kind in ({base})) as own, string_agg(kind || ':' || start || ':' || fin, ',' order by start, place, fin) as spans from o group by id)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone, sha256(coalesce(own, '')) as base_sha256, coalesce(spans, '') as spans from t left join j using (id)"""
