"""The registered queries in DuckDB's SQL, written independently of the operators."""

from __future__ import annotations

from tabulon.llm import licenses

_LOWER = ("translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _words(text: str, pattern: str) -> str:
    return (f"coalesce(regexp_extract_all({_LOWER.format(text)}, '{pattern}'), "
            "cast([] as varchar[]))")


DECONTAMINATE = rf"""
with items as (
  select item_id, w, least(10, len(w)) as n
  from (select item_id, {_words('text', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} as w from benchmark)
  where len(w) > 0),
windows as (
  select distinct item_id, n, w[k:k + n - 1] as win
  from items, unnest(range(1, len(w) - n + 2)) t(k)),
docs as (
  select row_number() over () as r, doc_id,
    {_words('text', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} as w
  from documents),
places as (
  select r, k, n, w[k:k + n - 1] as win
  from docs, (select distinct n from windows) s, unnest(range(1, len(w) - n + 2)) t(k)
  where len(w) >= n),
hits as (select distinct r, k, n, item_id from places join windows using (n, win)),
covered as (
  select r, count(distinct p) as n_hit
  from (select r, unnest(range(k, k + n)) as p from hits) group by r),
found as (
  select r, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct r, cast(item_id as varchar) as i from hits where item_id is not null)
  group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join found using (r)
"""

JACCARD = rf"""
with recursive docs as (
  select row_number() over () as r, doc_id, {_words('text', r'[^\x20\x09-\x0D]+')} as w
  from documents),
shingles as (
  select distinct r, case when len(w) < 5 then w else w[k:k + 4] end as s
  from docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(k) where len(w) > 0),
sizes as (select r, count(*) as n from shingles group by r),
links as (
  select a.r as a, b.r as b from shingles a join shingles b on a.s = b.s and a.r <> b.r
  join sizes x on x.r = a.r join sizes y on y.r = b.r
  group by a.r, b.r, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached(a, b) as (
  select r, r from docs union select reached.a, links.b from reached join links
    on links.a = reached.b)
select d.doc_id, coalesce(n, 0) as n_shingles, m as component_id
from docs d left join sizes s using (r)
join (select a as r, min(doc_id) as m from reached join docs on docs.r = reached.b group by a)
  using (r)
"""

LINK_COUNTS = JACCARD.replace(
    "m as component_id", "m as component_id, coalesce(l, 0) as n_links") + """
left join (select a as r, count(*) as l from links group by a) using (r)
"""


def _license_sql() -> str:
    rows = []
    for name, text in licenses.TEMPLATES.items():
        w = licenses.template_words(text)
        m = len({tuple(w[i:i + licenses.SHINGLE]) for i in range(len(w) - licenses.SHINGLE + 1)})
        step = licenses.step_of(m)
        rows.append(f"('{name}', {w!r}, {m}, {step}, {m + step - 1})")
    words = ("list_filter(regexp_split_to_array(lower(coalesce(text, '')), "
             r"'[^\p{L}\p{N}]+'), lambda x: x <> '')")
    last = licenses.SHINGLE - 1
    return f"""
with templates(template, w, m, step, width) as (values {', '.join(rows)}),
wanted as (
  select distinct template, m, step, width, w[k:k + {last}] as s
  from templates, unnest(range(1, len(w) - {last} + 1)) t(k)),
docs as (select row_number() over () as r, doc_id, {words} as w from documents),
places as (
  select r, k - 1 as i, w[k:k + {last}] as s
  from docs, unnest(range(1, len(w) - {last} + 1)) t(k)),
held as (
  select r, template, m, k, s
  from places join wanted using (s),
    unnest(range(greatest(0, cast(ceil((i - width + 1) / step) as bigint)),
                 cast(floor(i / step) as bigint) + 1)) t(k)),
spans as (
  select r, template, k from held group by r, template, m, k
  having count(distinct s) >= {licenses.CONTAINED} * m),
found as (
  select r, count(*) as n_spans, string_agg(distinct template, ',' order by template) as licenses
  from spans group by r)
select doc_id, len(w) as n_words, coalesce(licenses, '') as licenses,
  coalesce(n_spans, 0) as n_spans
from docs left join found using (r)
"""


def _phrase_sql() -> str:
    """The scan's spans and the places of short notices together."""
    rows = ", ".join(f"('{name}', {licenses.template_words(text)!r})"
                     for name, text in licenses.PHRASES.items())
    more = f"""both_kinds as (
  select r, template, k from spans
  union all
  select r, template, k
  from docs, (values {rows}) p(template, pw), unnest(range(1, len(w) - len(pw) + 2)) t(k)
  where w[k:k + len(pw) - 1] = pw),
found as ("""
    return (_license_sql().replace("found as (", more, 1)
            .replace("from spans group by r)", "from both_kinds group by r)", 1))


CHAT = r"""
with recursive given as (
  select distinct conv_id, turn, text from conversations),
lines as (
  select conv_id, turn, raw,
    length(m) - length(replace(m, '>', '')) as level,
    trim(regexp_replace(lower(substr(raw, length(m) + 1)), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')
      as normal
  from (select conv_id, turn, raw, regexp_extract(raw, '^(?:[ \t]*>)+[ \t]?') as m
        from (select conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) as raw
              from given))),
hashed as (
  select distinct conv_id, turn, level, sha256(normal) as passage
  from lines where normal <> '' and turn is not null),
found as (
  select q.conv_id, q.turn, q.level, q.passage, max(o.turn) as source
  from hashed q left join hashed o on o.conv_id is not distinct from q.conv_id
    and o.passage = q.passage and o.level = 0 and o.turn < q.turn
  where q.level > 0 group by all),
votes as (
  select conv_id, turn, level, source, count(*) as n from found where source is not null
  group by all),
parents as (
  select conv_id, turn, source as parent from votes
  qualify row_number() over (partition by conv_id, turn order by level, n desc, source desc) = 1),
paths(conv_id, turn, path) as (
  select conv_id, turn, [parent, turn] from parents p where not exists (
    select 1 from parents a where a.conv_id is not distinct from p.conv_id
      and a.turn = p.parent)
  union all
  select p.conv_id, p.turn, list_append(a.path, p.turn) from parents p join paths a
    on a.conv_id is not distinct from p.conv_id and a.turn = p.parent),
quotes as (
  select conv_id, turn, count(*) as n_quoted, count(source) as n_linked from found group by all),
own as (
  select conv_id, turn, role, regexp_replace(array_to_string(list_filter(
    string_split(coalesce(text, ''), chr(10)),
    lambda x: not regexp_matches(x, '^(?:[ \t]*>)+[ \t]?')), chr(10)),
    '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as clean
  from conversations)
select o.conv_id, o.turn, o.role, sha256(clean) as text_sha256, length(clean) as n_chars,
  case when p.path is not null then p.path[-2] end as reply_to,
  coalesce(len(p.path) - 1, 0) as depth,
  coalesce(array_to_string(p.path, '>'), cast(o.turn as varchar), '') as path,
  coalesce(n_quoted, 0) as n_quoted, coalesce(n_linked, 0) as n_linked
from own o
left join quotes q on q.conv_id is not distinct from o.conv_id and q.turn = o.turn
left join paths p on p.conv_id is not distinct from o.conv_id and p.turn = o.turn
"""

DIVERGENCE = rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    {_words("coalesce(text, '')", r'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')} as w
  from documents),
terms as (select r, lang, source, unnest(w) as term from docs),
kept as (
  select lang, term from terms group by lang, term having count(distinct r) >= 30),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from terms group by lang, source, term),
cells as (
  select lang, source, term, coalesce(n, 0) as n
  from groups join kept using (lang) left join counts using (lang, source, term)),
wholes as (select lang, term, sum(n) as n from cells group by lang, term),
shares as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v) as p
  from cells join sizes using (lang)
  join (select lang, source, sum(n) as total from cells group by lang, source)
    using (lang, source)),
whole_shares as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v) as q
  from wholes join sizes using (lang)
  join (select lang, sum(n) as total from wholes group by lang) using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, p - q
  from shares join whole_shares using (lang, term) where n > 0 and p > q)
select * from (
  select lang, source, part, item, cast(value as bigint) as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as integer)
      as rank
  from parts)
where part = 'pair' or rank <= 50
"""

def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _edit(edit: str, cost: str, then: str, when: str = "true") -> str:
    """The rest of the edits, with one more in front."""
    return (f"case when {when} then {{'c': {cost} + {then}.c, 'a': '{edit}' || {then}.a}} "
            f"else {{'c': 1000000000000, 'a': ''}} end")


def _from_state(state: int) -> str:
    """The best edits from row i on, without insertions before it."""
    turn = 3 if state == 2 else 2
    kept = [("s", 1), ("u", 2)] if state == 0 else [("a", 3)] if state == 2 else [("u", 2)]
    usable = "fault in ('', 'truncated')"
    price = "case when fault = 'truncated' then 5 else 0 end"
    return _least(_edit("D", "2", f"b{state}"),
                  _edit("R", f"1 + {price}", f"b{turn}", usable),
                  *[_edit("K", price, f"b{to}", f"{usable} and left(role, 1) = '{initial}'")
                    for initial, to in kept])


CONVERSATIONS = rf"""
with recursive crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
      lambda x: cast(ascii(x) as bigint))),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 as kind
  from conversations, crc_table),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g')
      else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from given where kind <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first,
      sha256(length(role) || ':' || role || text)) as i,
    count(*) over (partition by conv_id) as n
  from damaged),
marked as (
  select conv_id, turn, role, text, i, n, case
    when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault,
    left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as before
  from ordered),
counts as (
  select conv_id, any_value(n) as n,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id),
best as (
  select conv_id, n + 1 as i, {{'c': 0::bigint, 'a': ''}} as b0, {{'c': 10::bigint, 'a': 'II'}} as b1,
    {{'c': 5::bigint, 'a': 'I'}} as b2, {{'c': 0::bigint, 'a': ''}} as b3
  from counts
  union all
  select conv_id, i, {_least('p0', _edit('I', '5', 'u'))}, {_least('p1', _edit('I', '5', 'u'))},
    u, {_least('p3', _edit('I', '5', 'p2'))}
  from (
    select *, {_least('p2', _edit('I', '5', 'p3'))} as u from (
      select m.conv_id, m.i, {_from_state(0)} as p0, {_from_state(1)} as p1,
        {_from_state(2)} as p2, {_from_state(3)} as p3
      from best join marked m on m.conv_id is not distinct from best.conv_id
        and m.i = best.i - 1))),
audits as (select conv_id, b0.c as cost, b0.a as audit from best where i = 1),
walk as (
  select conv_id, audit, 1 as p, 1::bigint as i, '' as state, cast([] as varchar[]) as lines
  from audits
  union all
  select conv_id, audit, p + 1, case when edit = 'I' then i else i + 1 end,
    case edit when 'D' then state when 'K' then left(role, 1)
      else case when state = 'u' then 'a' else 'u' end end,
    case edit when 'D' then lines when 'K' then list_append(lines, role || ':' || text)
      else list_append(lines, case when state = 'u' then 'assistant:' else 'user:' end ||
        case when edit = 'R' then text else '' end) end
  from (
    select w.*, substr(audit, p, 1) as edit, m.role, m.text
    from walk w left join marked m on m.conv_id is not distinct from w.conv_id and m.i = w.i
    where p <= length(audit)))
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(w.audit, '') as audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join audits a on a.conv_id is not distinct from o.conv_id
left join walk w on w.conv_id is not distinct from o.conv_id and p = length(w.audit) + 1
"""

SQL = {
    "op1_decontaminate": DECONTAMINATE,
    "op3_chat_formatting": CHAT,
    "op4_jaccard_join": LINK_COUNTS,
    "op8_license_scans": _phrase_sql(),
    "op11_source_divergence": DIVERGENCE,
    "op12_conversation_repair": CONVERSATIONS,
}
