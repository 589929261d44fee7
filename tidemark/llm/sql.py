"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"

NEAR_DUPLICATES = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_FOLD}, {_BLANK_WORDS}) as ws from documents
), s as (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
      else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) end) as shingle from w)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), link as (
  select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n + nb.n - k)
), edge as (
  select a, b from link union select b, a from link
), reach as (
  select doc_id, doc_id as other from w union select r.doc_id, e.b from reach r join edge e on e.a = r.other
), component as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, w.doc_id = c.component_id as kept
from w left join n using (doc_id) join component c using (doc_id)
"""

SUBSTRINGS = f"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK_WORDS}) as ws from documents
), win as (
  select doc_id, unnest(range(1, len(ws) - 18)) as p, ws from w where len(ws) >= 20
), seq as (
  select doc_id, p, row_number() over (partition by array_to_string(ws[p:p+19], ' ') order by doc_id, p) > 1 as again from win
), gone as (
  select distinct doc_id, unnest(range(p, p + 20)) as i from seq where again
), word as (
  select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w
), kept as (
  select word.doc_id, string_agg(word, ' ' order by i) as text, count(*) as n from word left join gone using (doc_id, i) where gone.i is null group by 1
)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
"""

_ALNUM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
with d as (
  select doc_id, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) as ws from documents
), b as (
  select item_id, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) as ws from benchmark where text is not null and item_id is not null
), item as (
  select distinct item_id, size, array_to_string(ws[p:p+size-1], ' ') as words from (
    select item_id, ws, least(10, len(ws)) as size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as p from b where len(ws) > 0)
), place as (
  select doc_id, size, p, array_to_string(ws[p:p+size-1], ' ') as words from (
    select doc_id, size, ws, unnest(range(1, len(ws) - size + 2)) as p from d, (select distinct size from item) where len(ws) >= size)
), hit as (
  select doc_id, p, place.size, item_id from place join item on item.words = place.words and item.size = place.size
), covered as (
  select doc_id, count(distinct i) as n from (select doc_id, unnest(range(p, p + size)) as i from hit) group by 1
), items as (
  select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids from (select distinct doc_id, item_id::varchar as id from hit) group by 1
)
select d.doc_id, len(ws)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
  sha256(coalesce(i.ids, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join covered c using (doc_id) left join items i using (doc_id)
"""


def _secrets() -> str:
    """Spans of each rule from what lies between its matches, as SQL has no places of matches."""
    from tidemark.llm.secrets import BASE, RULES

    parts = []
    for number, r in enumerate(RULES):
        regex = r.pattern.replace("'", "''")
        flags = "'i'" if r.fold else "''"
        split = f"string_split_regex(t, '{regex}', 'i')" if r.fold else f"string_split_regex(t, '{regex}')"
        parts.append(
            f"select doc_id, {number} as kind_no, '{r.kind}' as kind, regexp_extract_all(t, '{regex}', 0, {flags}) as m, "
            f"regexp_extract_all(t, '{regex}', {r.group}, {flags}) as g, {split} as gap, {r.least} as least from d"
        )
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in BASE)
    named = "kind || ':' || a || ':' || z"
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(parts)}),
span as (
  select doc_id, kind_no, kind, least, len(g[i]) as size,
    list_sum(list_transform(gap[1:i], lambda x: len(x)))::bigint + coalesce(list_sum(list_transform(m[1:i-1], lambda x: len(x))), 0)::bigint as a, len(m[i]) as n
  from (select *, unnest(range(1, len(m) + 1)) as i from found where len(m) > 0)
), kept as (
  select doc_id, kind_no, kind, a, a + n as z from span where size >= least
), agg as (
  select doc_id, {counts}, string_agg({named}, ',' order by a, kind_no) filter (kind in ({base})) as base, string_agg({named}, ',' order by a, kind_no) as spans
  from kept group by doc_id
)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join agg using (doc_id)
"""


_CRC32 = """crc_table as (
  select list(c order by n) as tab from (
    with recursive bits(n, c, k) as (
      select i, i, 0 from range(256) r(i) union all select n, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8
    ) select n, c from bits where k = 8)
)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, where `tab` of crc_table is at hand."""
    return (
        f"xor(list_reduce(list_transform(range(0, 2 * octet_length(encode({text})), 2), lambda i: ('0x' || substr(hex(encode({text})), i + 1, 2))::bigint), "
        "lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::bigint), 4294967295)"
    )


PREFIX_TRIE = f"""
with {_CRC32}, t as (
  select conv_id, coalesce(text, '') as text, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) as turn,
    row_number() over (partition by conv_id order by turn nulls first, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) as pos
  from conversations where conv_id is not null
), c as (
  select conv_id, {_crc32('conv_id::varchar')} % 6 as h from (select distinct conv_id from t), crc_table
), r as (
  select c.conv_id, 0 as part, pos, turn, text from c join t on t.conv_id = c.conv_id - c.conv_id % 100 and pos <= h
  union all select conv_id, 1, pos, turn, text from c join t using (conv_id) where pos > h
), p as (
  select conv_id, row_number() over w as d, length(text) as chars, sha256(string_agg(turn, '') over w) as node from r window w as (partition by conv_id order by part, pos)
), q as (
  select conv_id, 0 as d, 0 as chars, 'root' as node from c union all select * from p
), n as (
  select node, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars from q group by node, d
), up as (
  select distinct q.node, q.d, a.node as above from q left join q a on a.conv_id = q.conv_id and a.d = q.d - 1
), k as (
  select above as node, count(*) as n_children from up where above is not null group by above
), below as (
  select distinct a.node, b.node as under from q a join q b on a.conv_id = b.conv_id and a.d <= b.d
), s as (
  select below.node, sum((m.n_convs - 1) * m.chars) as saved, count(*) filter (where k.node is null) as n_leaves from below join n m on m.node = below.under left join k on k.node = below.under group by below.node
), e as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids from (select conv_id, arg_max(node, d) as node from q group by conv_id) group by node
)
select n.conv_id, n.d::bigint as depth, m.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::bigint as n_children, s.n_leaves, s.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from n join up using (node) left join n m on m.node = up.above left join k on k.node = n.node join s on s.node = n.node left join e on e.node = n.node
"""

_ALNUM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

RESAMPLING = f"""
with {_CRC32}, x as (
  select 0 as side, doc_id, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) as ws from documents
  union all select 1, null, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) from benchmark
), f as (
  select side, doc_id, unnest(list_concat(ws, list_concat(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i+1], ' ')), list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))))) as f from x
), n as (
  select side, doc_id, f, count(*) as n from f group by all
), h as (
  select f, {_crc32('f')} % 10000 as b from (select distinct f from n), crc_table
), b as (
  select side, doc_id, b, sum(n) as n from n join h using (f) group by all
), totals as (
  select coalesce(sum(n) filter (where side = 0), 0)::double as s_all, coalesce(sum(n) filter (where side = 1), 0)::double as t_all from b
), gain as (
  select b, floor(1000 * ln((coalesce(sum(n) filter (where side = 1), 0)::double + 1) * (any_value(s_all) + 10000) / ((coalesce(sum(n) filter (where side = 0), 0)::double + 1) * (any_value(t_all) + 10000))))::bigint as g from b, totals group by b
), weight as (
  select doc_id, sum(n)::bigint as n_features, sum(n * g)::bigint as weight from b join gain using (b) where side = 0 group by doc_id
), scored as (
  select doc_id, len(ws) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from (select * from x where side = 0) left join weight using (doc_id)
), ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place, (5 * count(*) filter (where n_words >= 20) over ()) // 100 as most from scored
)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= most then place end as rank from ranked
"""

ORACLES = {
    "op12_importance_resampling": RESAMPLING,
    "op13_prefix_trie": PREFIX_TRIE,
    "op4_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_substring_dedup": SUBSTRINGS,
    "op7_secret_scan": _secrets(),
    "op9_decontamination": DECONTAMINATION,
}
