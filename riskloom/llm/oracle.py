"""DuckDB SQL of the queries that SQL can express."""

from riskloom.llm.mixing import TARGET

_WORD = r"[^\x20\x09-\x0D]+"


def _weight(level: str) -> str:
    cases = "".join(
        f" when {level} = '{name}' then {weight}" for name, weight in TARGET.weights[level].items()
    )
    return f"cast(case{cases} else {TARGET.other} end as hugeint)"


def _level(name: str, given: str, parents: list[str], level: str) -> str:
    keys = ", ".join([*parents, level])
    part = f"partition by {', '.join(parents)}" if parents else ""
    link = f"using ({', '.join(parents)})" if parents else "on true"
    return f"""
{name}_nodes as (
  select {keys}, cast(sum(capacity) as hugeint) as capacity, {_weight(level)} as weight
  from leaves group by {keys}),
{name}_order as (
  select *, coalesce(cast(sum(capacity) over before as hugeint), 0) as taken_before,
    cast(sum(weight) over onward as hugeint) as weights_onward
  from {name}_nodes join {given} {link}
  window before as ({part} order by cast(capacity as double) / cast(weight as double), {level}
      rows between unbounded preceding and 1 preceding),
    onward as ({part} order by cast(capacity as double) / cast(weight as double), {level}
      rows between current row and unbounded following)),
{name}_full as (
  select *, capacity * weights_onward <= weight * (given - taken_before) as is_full
  from {name}_order),
{name}_sums as (
  select *, cast(sum(case when is_full then capacity else 0 end) over ({part}) as hugeint) as taken,
    cast(sum(case when is_full then 0 else weight end) over ({part}) as hugeint) as weights
  from {name}_full),
{name} as (
  select {keys}, case when is_full then capacity
    else (weight * (given - taken)) // greatest(weights, 1) end as given
  from {name}_sums)"""


MIXING = rf"""
with rows as (
  select doc_id, coalesce(lang, 'unknown') as lang, coalesce(source, 'unknown') as source,
    case when regexp_extract(coalesce(source, 'unknown'), '([0-9]{{1,9}})$', 1) = '' then 'unknown'
      else concat('domain', cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) as int) % {TARGET.domains})
      end as domain,
    len(regexp_extract_all(text, '{_WORD}')) as n_tokens
  from documents),
leaves as (
  select domain, lang, source, cast(sum(n_tokens) as hugeint) as tokens,
    cast(sum(n_tokens) as hugeint) * {TARGET.max_epochs} as capacity
  from rows where n_tokens > 0 group by all),
total as (
  select least(sum(capacity),
    (cast(sum(capacity) as hugeint) * {TARGET.budget_percent}) // {100 * TARGET.max_epochs}) as given
  from leaves),
{_level("top", "total", [], "domain")},
{_level("middle", "top", ["domain"], "lang")},
{_level("bottom", "middle", ["domain", "lang"], "source")},
plan as (
  select domain, lang, source, cast(given // tokens as bigint) as epochs,
    cast(given % tokens as bigint) as rest
  from bottom join leaves using (domain, lang, source)),
ordered as (
  select rows.*, epochs, rest, sum(n_tokens) over (
      partition by domain, lang, source
      order by md5(concat_ws('|', '{TARGET.seed}', epochs, doc_id))
      range between unbounded preceding and current row) as upto
  from rows join plan using (domain, lang, source) where n_tokens > 0),
times as (
  select *, epochs + case when upto <= rest then 1 else 0 end as n from ordered)
select doc_id, domain, lang, source, n_tokens,
  cast(unnest(range(n)) as int) as epoch
from times
"""

BIT_SEARCH = r"""
with found as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms, row_number() over () as doc
  from documents),
docs as (select doc, doc_id, cast(len(terms) as bigint) as n from found where len(terms) > 0),
totals as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as words from docs),
counts as (
  select doc, term, cast(count(*) as bigint) as tf
  from (select doc, unnest(terms) as term from found) group by all),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
weights as (
  select term, cast(floor(1000 * ln((2 * t.docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counts, totals t group by term, t.docs),
scored as (
  select item_id, doc_id, doc, cast(sum(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (50 + (50 * n * t.docs) // t.words)))) as bigint) as score
  from asked join weights using (term) join counts using (term) join docs using (doc), totals t
  group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 50
"""

JACCARD_JOIN = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
shingled as (
  select distinct doc_id, case when len(words) < 5 then array_to_string(words, ' ')
    else array_to_string(list_slice(words, i, i + 4), ' ') end as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i
    from worded where len(words) > 0)),
sizes as (select doc_id, count(*) as n from shingled group by doc_id),
shares as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared
  from shingled a join shingled b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select x, y from shares join sizes a on a.doc_id = x join sizes b on b.doc_id = y
  where 100 * shared >= 80 * (a.n + b.n - shared)),
reached as (
  select doc_id as x, doc_id as y from documents
  union
  select reached.x, links.y from reached join links on links.x = reached.y)
select doc_id, coalesce(n, 0) as n_shingles, min(y) as component_id
from documents left join sizes using (doc_id) join reached on reached.x = doc_id
group by all
"""

COLLOCATIONS = r"""
with texts as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from texts),
worded as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
grams as (
  select lang, k, array_to_string(list_slice(words, i, i + k - 1), ' ') as phrase
  from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i
    from worded, (select unnest([1, 2, 3]) as k) where len(words) >= k)),
f as (
  select lang, k, phrase, cast(count(*) as hugeint) as f from grams group by all),
totals as (
  select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
long as (
  select lang, k, f as a, phrase, string_split(phrase, ' ') as words from f where k > 1 and f >= 10),
cuts as (
  select c.lang, c.phrase, a, cut, h.f as l, t.f as r, (1000000 * a * a) // (h.f * t.f) as score
  from (select *, unnest(range(1, k)) as cut from long) c
  join f h on h.lang = c.lang and h.phrase = array_to_string(list_slice(words, 1, cut), ' ') and h.k = cut
  join f t on t.lang = c.lang and t.phrase = array_to_string(list_slice(words, cut + 1, c.k), ' ') and t.k = c.k - cut),
scored as (
  select * from cuts
  qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
around as (
  select lang, phrase, max(a) as around from (
    select lang, a, unnest([array_to_string(list_slice(words, 1, 2), ' '), array_to_string(list_slice(words, 2, 3), ' ')]) as phrase
    from long where k = 3)
  group by all),
kept as (
  select scored.* from scored left join around using (lang, phrase)
  where around is null or 100 * around < 50 * a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, cast(rank as int) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
  cast(r as bigint) as r, n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""

ORACLE = {
    "op8_mixing": MIXING,
    "op11_bit_search": BIT_SEARCH,
    "op12_jaccard_join": JACCARD_JOIN,
    "op13_collocations": COLLOCATIONS,
}
