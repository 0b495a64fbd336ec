"""The results of the queries in DuckDB's SQL, where SQL can express them."""

from recordloom.llm.divergence import LEAST_DOCUMENTS, SCALE, TOP_TERMS
from recordloom.llm.licenses import RULES, SENTENCES
from recordloom.llm.secrets import ACCESS, DISTINCT_CHARACTERS, HEX, ISSUED, LEAST_ASSIGNED, LOOSE, PLACEHOLDER, WIDE_OWNERS

_URLS = """
with rules(h, p, v) as (values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parsed as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parsed)
select page_id, host, path,
  (select h || p from rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
   order by length(h || p) desc, length(h) desc limit 1) as rule,
  coalesce((select v from rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
   order by length(h || p) desc, length(h) desc limit 1), 'allow') as verdict
from split
"""


def _licences() -> str:
    names = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, before = [], "ids"
    for at, (sequence, licence) in enumerate(RULES):
        pattern = " " + sequence.replace(" ", "  ") + " "
        steps.append(
            f"r{at} as (select doc_id, n, joined, replace(rest, '{pattern}', ' | ') as rest, "
            f"case when contains(rest, '{pattern}') then list_append(hits, '{licence}') else hits end as hits from {before})"
        )
        before = f"r{at}"
    return f"""
with known(sentence, id) as (values {names}),
parts as (
  select doc_id, nth, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) as sentence
  from (select doc_id, unnest(cut) as part, generate_subscripts(cut, 1) as nth
        from (select doc_id, string_split_regex(regexp_replace(coalesce(text, ''), '[.]([0-9])', '\x01\\1', 'g'), '[\n\r;:!?.]') as cut
              from documents))),
found as (
  select doc_id, count(id) as n, string_agg(id, ' ' order by nth) filter (id is not null) as joined
  from parts left join known using (sentence) group by doc_id),
ids as (
  select doc_id, n, coalesce(joined, '') as joined, ' ' || replace(coalesce(joined, ''), ' ', '  ') || ' ' as rest, []::varchar[] as hits from found),
{", ".join(steps)}
select doc_id, n as n_known, joined as sentence_ids, array_to_string(list_sort(list_distinct(hits)), ',') as licences,
  len(list_filter(string_split(rest, ' '), lambda x: x not in ('', '|'))) as unmatched
from {before}
"""



def _any_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


def _secrets() -> str:
    names = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
    assign = rf"""(?:{names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    patterns = [assign, ACCESS, HEX, ISSUED, LOOSE]
    scans = "\nunion all\n".join(
        f"select row, owner, repository, {kind} as kind, regexp_extract_all(text, '{p}') as found, "
        f"string_split_regex(text, '{p}') as gaps from texts"
        for kind, p in enumerate(patterns)
    )
    mixed = "regexp_matches(value, '[0-9]') and regexp_matches(value, '[a-z]') and regexp_matches(value, '[A-Z]')"
    return rf"""
with texts as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text, coalesce(source, '') as owner,
         coalesce(doc_id::varchar, '') as repository from documents),
scans as ({scans}),
sized as (
  select row, owner, repository, kind, found,
         list_transform(range(1, len(found) + 1), lambda i: length(gaps[i]) + length(found[i])) as sizes
  from scans where len(found) > 0),
placed as (
  select row, owner, repository, kind, unnest(found) as word,
         unnest(list_transform(range(1, len(found) + 1), lambda i: list_sum(sizes[1:i])))::bigint as stop from sized),
spans as (
  select *, stop - length(word) as start, case when kind = 0 then regexp_extract(word, '{assign}', 1) else word end as value
  from placed),
kept as (
  select * from spans
  where (kind <> 0 or length(value) >= {LEAST_ASSIGNED}) and (kind <> 4 or ({mixed}))),
owners as (
  select value, count(distinct owner) as n_owners from kept group by value),
judged as (
  select k.*, n_owners >= {WIDE_OWNERS} as copied,
         n_owners = 1 and len(list_distinct(string_split(value, ''))) >= {DISTINCT_CHARACTERS}
           and regexp_matches(value, '[0-9]') and not regexp_matches(value, '{PLACEHOLDER}') as live
  from kept k join owners using (value)),
added as (
  select a.row, a.kind, a.start, a.stop from judged a
  where a.kind >= 3 and a.live and not exists (
    select 1 from judged b where b.row = a.row and b.start < a.stop and a.start < b.stop and (b.kind < 3 or (
      b.live and (b.start, b.kind, b.stop) < (a.start, a.kind, a.stop))))),
shown as (
  select row, kind, start, stop, true as is_base from judged where kind < 3
  union all select row, kind, start, stop, false from added),
lines as (
  select row, start, kind, is_base,
         (['assign', 'access', 'hex', 'issued', 'loose'])[kind + 1] || ':' || start || ':' || stop as line from shown),
joined as (
  select row, string_agg(line, ',' order by start, kind) filter (is_base) as base, string_agg(line, ',' order by start, kind) as every,
         count(*) filter (is_base and kind = 0) as n_assign, count(*) filter (is_base and kind = 1) as n_access,
         count(*) filter (is_base and kind = 2) as n_hex
  from lines group by row),
totals as (
  select row, count(*) filter (live) as n_live, count(*) filter (copied) as n_copied from judged group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(every, '') as spans,
       coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from texts left join joined using (row) left join totals using (row)
"""


_DIVERGENCE = rf"""
with texts as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from texts),
kept as (
  select lang, term, count(*) as total from words group by lang, term having count(distinct row) >= {LEAST_DOCUMENTS}),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(total) as uses from kept group by lang),
groups as (
  select g.lang, g.source, coalesce((select sum(n) from counts c where c.lang = g.lang and c.source = g.source), 0)::hugeint + coalesce(v, 0) as size
  from (select distinct lang, source from texts) g left join langs using (lang)),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, (1 + ({SCALE}::hugeint * (coalesce(c.n, 0) + 1)) // g.size)::hugeint as p,
         (1 + ({SCALE}::hugeint * (k.total + 1)) // (l.uses + l.v)::hugeint)::hugeint as q
  from groups g join kept k using (lang) join langs l using (lang) left join counts c using (lang, source, term)),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from shares where n > 0 and p > q),
ranked as (
  select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from every)
select * from ranked where part = 'pair' or rank <= {TOP_TERMS}
"""


ORACLES: dict[str, str] = {"op5_url_filters": _URLS, "op8_license_scans": _licences(), "op11_secret_scans": _secrets(), "op12_source_divergence": _DIVERGENCE}
