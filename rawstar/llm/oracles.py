r"""DuckDB SQL for the queries that SQL can express."""

LINES = r"""
with split as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from split),
often as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
marked as (
  select keyed.*, often.k is not null and keyed.doc_id <> keeper as gone from keyed left join often using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

EXACT = r"""
with norm as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, sha256(t) as text_sha256
from norm window w as (partition by t)
"""


CONTAMINATION = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as n,
         array_to_string(w[unnest(range(1, greatest(2, len(w) - 8))):][:10], ' ') as win
  from iw where len(w) > 0),
sizes as (select distinct n from windows),
starts as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from dw, sizes where len(w) >= n),
hits as (
  select doc_id, i, s.n, item_id from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win from starts) s
  join windows using (win, n)),
words as (select distinct doc_id, unnest(range(i, i + n)) as p from hits),
per as (select doc_id, count(*) as n_hit from words group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join per using (doc_id) left join items using (doc_id)
"""


WINDOWS = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select doc_id, h, unnest(range(1, cast(length(h) / 2 as bigint) - 98)) as p from docs where length(h) >= 200),
wins as (select doc_id, p, md5(substr(h, 2 * p - 1, 200)) as w from starts),
repeats as (select doc_id, p from (
  select doc_id, p, row_number() over (partition by w order by doc_id, p) as n from wins) where n > 1),
gone as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from repeats),
bytes as (select doc_id, sum(case when before is null then 100 else least(100, p - before) end) as n_removed,
                 count(*) filter (before is null or p - before > 100) as n_spans
          from gone group by doc_id),
runs as (select doc_id, p, p + 100 as e, max(p + 100) over (partition by doc_id order by p rows between unbounded preceding and 1 preceding) as upto
         from repeats),
islands as (select doc_id, p, e, sum(case when upto is null or p > upto then 1 else 0 end) over (partition by doc_id order by p) as g from runs),
merged as (select doc_id, g, min(p) as a, max(e) as b, lag(max(e), 1, 1) over (partition by doc_id order by g) as prior from islands group by doc_id, g),
left_over as (select doc_id, string_agg(substr(h, 2 * prior - 1, 2 * (a - prior)), '' order by g) || substr(any_value(h), 2 * max(b) - 1) as kept
              from merged join docs using (doc_id) group by doc_id)
select doc_id, cast(length(h) / 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, h))) as kept_sha256
from docs left join bytes using (doc_id) left join left_over using (doc_id)
"""


# Captures of the given pages: each page's answer (some not found, some without validators), a
# not-modified revisit under another spelling of its URL, and for a third of the pages a
# revisit, rarely an answer, of one very common URL.
CAPTURES = """
select page_id * 4 as id, url, page_id * 10 as ts, 'response' as kind, case when page_id % 11 = 0 then 404 else 200 end as status,
       case when page_id % 5 = 0 then null else concat('"', md5(html), '"') end as etag,
       case when page_id % 7 = 0 then null else concat('day ', cast(page_id % 28 as string)) end as modified,
       cast(length(html) as string) as length, 'max-age=60' as cache
from {pages}
union all
select page_id * 4 + 1, case when page_id % 13 = 0 then null else concat(upper(left(url, 5)), substr(url, 6), '#again') end, page_id * 10 + 5, 'revisit', 304,
       case when page_id % 3 = 0 then concat('"', md5(url), '"') when page_id % 3 = 1 then concat('W/"', md5(html), '"') end,
       case when page_id % 2 = 0 then concat('day ', cast(page_id % 28 as string)) end, '0', concat('max-age=', cast(page_id % 100 as string))
from {pages}
union all
select page_id * 4 + 2, 'http://www.common.example.com:80/?b=2&a=1', page_id * 10 + 6, case when page_id % 60 = 0 then 'response' else 'revisit' end,
       case when page_id % 60 = 0 then 200 else 304 end, concat('"v', cast(floor(page_id / 90) as bigint), '"'), null, '7', null
from {pages} where page_id % 3 = 0
"""

REVISITS = (
    "with raw as ("
    + CAPTURES.format(pages="pages")
    + r"""),
cut as (
  select *, regexp_replace(trim(url), '(?s)#.*$', '') as u from raw),
parts as (
  select *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), ':(80|443)$', ''), '^www[0-9]*\.', '') as host,
         regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') as path,
         regexp_extract(u, '(?s)\?(.*)$', 1) as query
  from cut),
named as (
  select *, case when host <> '' then host || path || case when query <> '' then '?' || array_to_string(list_sort(string_split(query, '&')), '&') else '' end end as key
  from parts),
seen as (
  select *, last_value(case when kind = 'response' and status = 200 then id end ignore nulls)
              over (partition by key order by ts, id rows between unbounded preceding and 1 preceding) as rid
  from named),
pairs as (
  select s.*, r.etag as retag, r.modified as rmod, r.length as rlength, r.cache as rcache,
         coalesce(regexp_replace(s.etag, '^W/', '') = regexp_replace(r.etag, '^W/', ''), s.modified = r.modified) as same
  from seen s left join named r on r.id = s.rid and s.key is not null where s.kind = 'revisit'),
judged as (
  select *, case when key is null then 'no url or time' when rid is null then 'no earlier response' when same then 'resolved'
                 when same is null then 'no validator' else 'validators differ' end as outcome
  from pairs),
merged as (
  select *, outcome = 'resolved' as done from judged)
select id, key as canonical_url, case when done then rid end as response_id, outcome,
       concat_ws(chr(10),
         'cache-control: ' || case when done then coalesce(cache, rcache) else cache end,
         'content-length: ' || case when done then rlength else length end,
         'etag: ' || case when done then coalesce(etag, retag) else etag end,
         'last-modified: ' || case when done then coalesce(modified, rmod) else modified end) as headers
from merged
""".replace("\\\\", "\\")
)


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  select doc_id, '{kind}' as kind, {rank} as rank, s, s + size as e from (
    select doc_id, size, value,
           sum(gap + coalesce(size, 0)) over (partition by doc_id order by pos) - coalesce(size, 0) as s
    from (
      select doc_id, unnest(range(len(gaps))) as pos, length(unnest(gaps)) as gap,
             length(unnest(list_resize(found, len(gaps)))) as size, length(unnest(list_resize(vals, len(gaps)))) as value
      from (
        select doc_id, string_split_regex(text, '{quoted}') as gaps,
               regexp_extract_all(text, '{quoted}', 0) as found, regexp_extract_all(text, '{quoted}', {group}) as vals
        from documents where regexp_matches(text, '{quoted}'))))
  where value >= {least}"""


SECRETS = (
    "with found as ("
    + " union all ".join(
        _spans(*x)
        for x in (
            ("assign", 0, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", 2, r"[0-9a-f]+", 0, 24),
            ("pem", 3, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
            ("jwt", 4, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
        )
    )
    + r""")
select d.doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access,
       count(*) filter (rank = 2) as n_hex,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3), '')) as base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, rank), '') as spans
from documents d left join found using (doc_id) group by d.doc_id
"""
)


def _levels(name: str, count: int) -> str:
    """Nodes of ``count`` further levels over ``name0``; a tree of one node stays as it is."""
    return ",".join(
        f"""
{name}{k + 1} as (
  select tree, idx // 16 as idx, (any_value(n) + 15) // 16 as n,
         case when any_value(n) > 1 then sha256(string_agg(digest, '' order by idx)) else any_value(digest) end as digest
  from {name}{k} group by tree, idx // 16)"""
        for k in range(count)
    )


def _folds(name: str, nodes: str, count: int, rows: str) -> str:
    """``rows`` (tree, idx, proof, claimed, ...) with the siblings' text and the folded digest, level by level."""
    return ",".join(
        f"""
{name}{k} as (
  select p.* exclude (idx, proof, claimed), p.idx // 16 as idx,
         case when s.n > 1 then proof || l || r else proof end as proof,
         case when s.n > 1 then sha256(l || claimed || r) else claimed end as claimed
  from {rows if k == 0 else f'{name}{k - 1}'} p join (
    select a.tree, a.idx, any_value(a.n) as n,
           coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as l,
           coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as r
    from {nodes}{k} a join {nodes}{k} b on a.tree = b.tree and a.idx // 16 = b.idx // 16 group by a.tree, a.idx) s
  on p.tree = s.tree and p.idx = s.idx)"""
        for k in range(count)
    )


def _leaf(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(cast({f} as varchar)) || ':' || cast({f} as varchar), '-')" for f in fields) + ")"


_BITS = "flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))"
# CRC-32 of the id's digits, bit by bit.
_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295], {_BITS}),
  lambda a, b: xor(a >> 1, case when a & 1 <> b then 3988292384 else 0 end)))"""

# Six levels hold sources of 16 ** 6 rows, five levels 16 ** 5 sources.
MERKLE = (
    f"""
with leaves as (
  select doc_id, coalesce('1' || source, '0') as tree, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} as digest,
         case when {_CRC} % 5 = 0 then {_leaf('doc_id', 'source', 'lang', 'n_chars', 'lowered')} end as changed
  from (select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered from documents)),
a0 as (
  select *, row_number() over (partition by tree order by doc_id, digest) - 1 as idx, count(*) over (partition by tree) as n
  from leaves),"""
    + _levels("a", 6)
    + """,
b0 as (
  select 0 as tree, tree as member, row_number() over (order by tree) - 1 as idx, count(*) over () as n, digest from a6),"""
    + _levels("b", 5)
    + """,
rows as (select doc_id, digest as leaf, tree, idx, '' as proof, coalesce(changed, digest) as claimed from a0),"""
    + _folds("f", "a", 6, "rows")
    + """,
tops as (
  select doc_id, leaf, b0.digest as subroot, b0.tree, b0.idx, proof, claimed from f5 join b0 on f5.tree = member),"""
    + _folds("g", "b", 5, "tops")
    + """
select doc_id, leaf, subroot, b5.digest as root, sha256(proof) as proof_sha256, claimed as folded_root, claimed = b5.digest as verified
from g4 join b5 using (tree)
"""
)

NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from rows a join rows b on a.vec_id is distinct from b.vec_id or a.label <> b.label where a.vec_id % 100 = 0),
positives as (
  select * from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
found as (
  select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
         cast(row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as integer) as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
   and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 5
"""
