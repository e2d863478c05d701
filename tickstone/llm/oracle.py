"""SQL (DuckDB) that gives the same rows as the queries it stands beside."""

_DATA = r"""
page as (
  select page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
sited as (
  select *, nullif(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '') as site from page),
judged as (
  select doc_id as page_id, max((coalesce(quality = 0, false) or coalesce(toxic = 1, false))::int) as is_bad
  from labels where quality is not null or toxic is not null group by 1),
cut as (
  select site, string_split(site, '.') as labels,
    regexp_matches(site, '^[0-9]{1,3}([.][0-9]{1,3}){3}$') or starts_with(site, '[') as address,
    array_to_string(list_slice(string_split(site, '.'), -2, -1), '.') in
      ('co.uk','org.uk','ac.uk','com.au','net.au','co.nz','co.jp','com.br','co.in','com.cn') as two
  from (select distinct site from sited where site is not null)),
named as (
  select site, case when address then 'address' else
      array_to_string(list_slice(labels, case when two then -2 else -1 end, -1), '.') end as suffix,
    case when address then site else
      array_to_string(list_slice(labels, case when two then -3 else -2 end, -1), '.') end as domain
  from cut),
hosts as (
  select site as host, suffix, domain, count(*) as n, sum(is_bad) as bad
  from sited join judged using (page_id) join named using (site) group by 1, 2, 3),
overall as (select (sum(bad) + 0.5::double) / (sum(n) + 1) as m from hosts),
"""


def _strength(name: str, level: str) -> str:
    """The method-of-moments strength of one level, as a one-row table."""
    return f"""
{name}_sums as (
  select count(*) as k, sum(n * pow(bad / n::double - m, 2)) as between_,
    sum(m * (1 - m)) as within_, sum(n * m * (1 - m)) as mass from {level}),
{name}_rho as (
  select k, mass, case when mass - within_ > 0 then (between_ - within_) / (mass - within_) else 0 end as rho
  from {name}_sums),
{name}_strength as (
  select case when k = 0 or coalesce(mass, 0) = 0 or rho <= 0 then 1000.0::double
    else least(1000.0::double, greatest(1.0::double, 1 / rho - 1)) end as s from {name}_rho),
"""


OP4_SQL = (
    "with" + _DATA
    + """
suffix_level as (
  select suffix, sum(n) as n, sum(bad) as bad, (select m from overall) as m from hosts group by 1),"""
    + _strength("suffix", "suffix_level")
    + """
suffixes as (
  select suffix, ((select s from suffix_strength) * m + bad) / ((select s from suffix_strength) + n) as m
  from suffix_level),
domain_level as (
  select domain, suffix, sum(n) as n, sum(bad) as bad, any_value(s.m) as m
  from hosts join suffixes s using (suffix) group by 1, 2),"""
    + _strength("domain", "domain_level")
    + """
domains as (
  select domain, ((select s from domain_strength) * m + bad) / ((select s from domain_strength) + n) as m
  from domain_level),
host_level as (select host, n, bad, m from hosts join domains using (domain)),"""
    + _strength("host", "host_level")
    + """
beta as (
  select host, s * m + bad as a, s * (1 - m) + n - bad as b from host_level, host_strength),
bounds as (
  select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from beta),
ruled as (
  select page_id, host, path, bound,
    case
      when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
      when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/'
    end as rule
  from sited left join (select host as site, bound from bounds) using (site))
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow'
    when rule is not null then 'block'
    when bound > 0.5 then 'block' else 'allow' end as verdict
from ruled
"""
)

OP3_SQL = r"""
with doc as (
  select row_number() over () as rid, doc_id, source as host, text, coalesce(text, '') as t from documents),
cut as (
  select rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from doc),
word as (select rid, unnest(ws) as w, generate_subscripts(ws, 1) as i from cut),
five as (
  select rid, i, w || ' ' || lead(w, 1) over p || ' ' || lead(w, 2) over p || ' '
    || lead(w, 3) over p || ' ' || lead(w, 4) over p as g
  from word window p as (partition by rid order by i)),
again as (select rid, i, count(*) over (partition by rid, g) as n from five where g is not null),
repeated as (
  select rid, count(distinct i + k) as n_repeat_words
  from again, (select unnest([0, 1, 2, 3, 4]) as k) where n > 1 group by 1),
line as (
  select rid, translate(trim(regexp_replace(
    translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')),
    '123456789', '000000000') as l
  from (select rid, unnest(ls) as l from cut)),
hosts as (select host, count(distinct doc_id) as of_ from doc group by 1),
frequent as (
  select doc.host, l from line join doc using (rid) join hosts h on h.host is not distinct from doc.host
  group by doc.host, l
  having count(distinct doc_id) >= 20 and count(distinct doc_id) >= 0.001 * any_value(h.of_)),
removed as (
  select rid, sum(len(l) - len(replace(l, ' ', '')) + 1) as gone
  from line join doc using (rid) where exists (select 1 from frequent f where f.host is not distinct from doc.host and f.l = line.l) group by 1),
counted as (
  select doc_id, len(ws)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(gone, 0) as gone
  from doc join cut using (rid) left join repeated using (rid) left join removed using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_words - gone >= 10 and n_words - gone >= 0.5 * n_words as kept
from (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted)
"""
