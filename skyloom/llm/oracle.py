"""DuckDB SQL of the text operators that SQL can express: 4, 7, 10 and 12.

Written from the definitions, not from the Spark plans: shingles and windows are
compared as strings, similar pairs are all found by their common shingles, and
classes are the closure of the links.
"""

from __future__ import annotations

_BLANKS = r"[ \t-\r]+"
#: White space of Unicode, as str.split() sees it.
_UNICODE_BLANKS = r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _words(blanks: str) -> str:
    return f"list_filter(regexp_split_to_array(t, '{blanks}'), lambda w: w <> '')"


def _window(width: int) -> str:
    """The join of `width` words from this one on."""
    return "concat_ws(' ', word, " + ", ".join(f"lead(word, {i}) over o" for i in range(1, width)) + ")"


FINGERPRINT = r"""
with docs as (select row_number() over (order by doc_id desc, coalesce(text, '')) as r, doc_id, coalesce(text, '') as t from documents),
placed as (select *, coalesce(lead(r) over (order by r), 1) as next_r, coalesce(lead(t) over (order by r), first_value(t) over (order by r)) as following from docs),
edits as (select *, left(t, length(t) - length(t) // 2) || left(following, length(t) // 2) as changed from placed),
texts as (select t from docs union select changed from edits),
keyed as (select row_number() over () as id, t, octet_length(encode(t)) as size from texts),
mix as (select printf('%02X', v) as h, v, (v * 40503 + (v >> 3) * 40503) & 65535 as f, (v * 60493 + (v >> 3) * 40503) & 65535 as s, (v * 26699 + (v >> 3) * 40503) & 65535 as d
    from (select unnest(range(256)) as v)),
hexed as (select id, unnest(l) as h, generate_subscripts(l, 1) as p from (select id, regexp_extract_all(hex(encode(t)), '..') as l from keyed)),
bytes as (select id, p, v, f, s, d from hexed join mix using (h)),
sums as (select id, sum(v) as total from bytes group by id),
wide as (select id, f, lead(s, 1) over o as s1, lead(s, 2) over o as s2, lead(s, 3) over o as s3, lead(d, 2) over o as d2, lead(d, 3) over o as d3, lead(d, 4) over o as d4
    from bytes window o as (partition by id order by p)),
triplets as (select id, unnest([
    xor((f + s1) & 65535, d2) * 40503, xor((f + s1) & 65535, d3) * 40505, xor((f + s2) & 65535, d3) * 40507,
    xor((f + s1) & 65535, d4) * 40509, xor((f + s2) & 65535, d4) * 40511, xor((f + s3) & 65535, d4) * 40513]) as x from wide where d4 is not null),
seen as (select id, ((x & 65535) >> 9) as bucket, count(*) as n from triplets group by all),
counts as (select k.id, list(coalesce(n, 0) order by b.bucket) as c, list_sort(list(coalesce(n, 0))) as sorted
    from keyed k cross join (select unnest(range(128)) as bucket) b left join seen s on s.id = k.id and s.bucket = b.bucket group by k.id),
quarters as (select id, sorted[32] as q1, sorted[64] as q2, greatest(sorted[96], 1) as q3,
    list_transform(c, lambda x: (x > sorted[32])::int + (x > sorted[64])::int + (x > sorted[96])::int) as q from counts),
heads as (select k.id, k.t, q, (31 * coalesce(total, 0) % 256)::int as a, least(255, floor(log2(size + 1) * 8))::int as b, (q1 * 16 // q3 % 16)::int as c, (q2 * 16 // q3 % 16)::int as d
    from keyed k join quarters using (id) left join sums using (id)),
digests as (select *, lower(printf('%02x%02x%x%x', a, b, c, d) ||
    array_to_string(list_transform(range(64), lambda i: printf('%x', q[2 * i + 1] * 4 + q[2 * i + 2])), '')) as digest from heads),
pairs as (select e.r, e.doc_id, length(e.t) as n_chars, sha256(e.changed) as edited_sha256, o.digest as fingerprint, m.digest as edited_fingerprint, o as own, m as made, x as next
    from edits e join docs y on y.r = e.next_r join digests o on o.t = e.t join digests m on m.t = e.changed join digests x on x.t = y.t)
select doc_id, n_chars::bigint as n_chars, edited_sha256, fingerprint, edited_fingerprint, 1.0::double - DIFFERENCE(own, made) / 816.0::double as near_edited,
    1.0::double - DIFFERENCE(own, next) / 816.0::double as near_next from pairs
"""


def _fingerprint() -> str:
    def difference(x: str, y: str) -> str:
        steps = f"list_sum(list_transform(range(1, 129), lambda i: [0, 1, 2, 6][abs({x}.q[i] - {y}.q[i]) + 1]))"
        header = " + ".join(f"least(12, abs({x}.{c} - {y}.{c}))" for c in "bcd")
        return f"({steps} + ({x}.a <> {y}.a)::int + {header})::double"

    return FINGERPRINT.replace("DIFFERENCE(own, made)", difference("own", "made")).replace("DIFFERENCE(own, next)", difference("own", "next"))


NGRAM_JOIN = f"""
with recursive docs as (select doc_id, coalesce(text, '') as t from documents),
texts as (select row_number() over () as id, t, n, first from (select t, count(*) as n, min(doc_id) as first from docs group by t)),
tokens as (select id, {_words(_UNICODE_BLANKS)} as w from texts),
placed as (select id, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as size from tokens),
runs as (select id, i, size, {_window(5)} as k from placed window o as (partition by id order by i)),
shingles as (select distinct id, k from runs where i <= greatest(1, size - 4)),
sizes as (select id, count(*) as m from shingles group by id),
common as (select a.id as x, b.id as y, count(*) as c from shingles a join shingles b on a.k = b.k and a.id <> b.id group by all),
links as (select x, y from common join sizes s on s.id = x join sizes z on z.id = y where 5 * c >= 4 * (s.m + z.m - c)),
reach(id, other) as (select id, id from texts union select r.id, l.y from reach r join links l on l.x = r.other),
classes as (select r.id, min(t.first) as class_id from reach r join texts t on t.id = r.other group by r.id),
counted as (select x as id, sum(t.n) as linked from links join texts t on t.id = y group by x)
select d.doc_id, case when s.id is null then d.doc_id else c.class_id end as class_id,
    case when s.id is null then 0 else t.n - 1 + coalesce(linked, 0) end::bigint as n_links
from docs d join texts t using (t) join classes c on c.id = t.id left join sizes s on s.id = t.id left join counted k on k.id = t.id
"""


def _quality_rules() -> str:
    classes = (r"[^\p{Ll}]+", r"[^\p{Lu}]+", r"[^\p{Nd}]+", r"[^.,;:!?''\"()-]+", r"[^#*$%&|<>@=/\\{}\[\]_^~+]+")
    lengths = ", ".join(f"length(regexp_replace(t, '{c}', '', 'g'))" for c in classes)
    part = "(case when {0} > 0 then {0} * log2(2 * {0} / ({0} + {1})) / 2 else 0 end)"
    scriptless = ", ".join(f"length(regexp_replace(t, '{c}', '', 'g'))" for c in (r"[^\p{L}\p{M}]+", r"[^\p{Nd}]+", r"[^\p{P}]+"))
    distance = f"sqrt(greatest(0, sum({part.format('p', 'q')} + {part.format('q', 'p')})))"
    return f"""
with docs as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t from documents),
tokens as (select r, {_words(_BLANKS)} as w from docs),
placed as (select r, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n from tokens),
wins as (select r, i, n, {_window(8)} as k from placed window o as (partition by r order by i)),
twice as (select r, i from (select r, i, count(*) over (partition by r, k) as c from wins where i <= n - 7) where c > 1),
repeated as (select r, count(distinct place) as n_repeat_words from (select r, unnest(range(i, i + 8)) as place from twice) group by r),
listed as (select r, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \\t-\\r]')) as l from docs),
base as (
    select d.r, d.doc_id, d.lang, len(w)::bigint as n_words, length(regexp_replace(t, '{_BLANKS}', '', 'g'))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words, length(t) as chars, [{lengths}] as c, [{scriptless}] as v
    from docs d join tokens using (r) join listed using (r) left join repeated using (r)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base),
known as (select lang from documents where lang is not null group by lang having count(*) >= 20),
frequent as (select lang, word, count(*) as n from (select distinct r, lang, lower(word) as word from placed join docs using (r)) join known using (lang) group by all),
common as (select lang, word, row_number() over (partition by lang order by n desc, word) - 1 as k from frequent qualify k < 20),
class_rows as (
    select r, lang, base_failed, unnest(range(6)) as k, unnest(list_append(c, greatest(0, chars - list_sum(c)))) as c, chars as total from judged join known using (lang)),
class_refs as (select lang, k, sum(c) / greatest(1, sum(sum(c)) over (partition by lang)) as q from class_rows where not base_failed group by lang, k),
class_far as (select r, {distance} as js from (select r, c / greatest(1, total)::double as p, q from class_rows join class_refs using (lang, k)) group by r),
visible_rows as (
    select r, unnest(list_append(v, greatest(0, word_chars - list_sum(v)))) / greatest(1, word_chars)::double as p, unnest([0.955, 0.005, 0.035, 0.005])::double as q
    from judged where lang is null or lang not in (select lang from known)),
visible_far as (select r, {distance} as js from visible_rows group by r),
found as (select r, k, count(*) as c from placed join docs using (r) join common using (lang) where lower(placed.word) = common.word group by all),
grid as (
    select j.r, j.lang, j.base_failed, j.n_words, g.k, coalesce(f.c, 0) as c
    from judged j join (select lang, unnest(range(20)) as k from known) g using (lang) left join found f on f.r = j.r and f.k = g.k),
word_rows as (
    select * from grid union all select r, any_value(lang), any_value(base_failed), any_value(n_words), 20, greatest(0, any_value(n_words) - sum(c)) from grid group by r),
word_refs as (select lang, k, sum(c) / greatest(1, sum(sum(c)) over (partition by lang)) as q from word_rows where not base_failed group by lang, k),
word_far as (select r, {distance} as js from (select r, c / greatest(1, n_words)::double as p, q from word_rows join word_refs using (lang, k)) group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed
    and not (n_words >= 20 and coalesce(a.js, v.js, 0) > 0.25 + 5.0::double / greatest(n_words, 1))
    and not (n_words >= 60 and coalesce(b.js, 0) > 0.29 + 3.0::double / greatest(n_words, 1)) as kept
from judged left join class_far a using (r) left join visible_far v using (r) left join word_far b using (r)
"""


#: Nodes as lists of turns; crc32 bit by bit.
PREFIX_TRIE = """
with turns as (select conv_id, turn, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as print, length(coalesce(text, '')) as chars
    from conversations where conv_id is not null),
own as (select conv_id, list({'p': print, 'c': chars} order by turn nulls first, print) as t from turns group by conv_id),
crcs as (select conv_id, t, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) as crc from own),
heads as (select c.conv_id, list_concat(coalesce(r.t[1:c.crc % 6], []), c.t[(c.crc % 6) + 1:]) as t from crcs c left join own r on r.conv_id = c.conv_id - c.conv_id % 100),
members as (select conv_id, len(t) as full_depth, d as depth, t[1:d] as node from heads, unnest(range(len(t) + 1)) u(d)),
nodes as (select node, depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (full_depth = depth), '')) as ends_sha256
    from members group by node, depth),
linked as (select n.*, p.conv_id as parent_conv_id, case when n.depth = 0 then 0 else (n.n_convs - 1) * n.node[-1].c end as own from nodes n left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.node = n.node[:-2]),
kids as (select node[:-2] as node, count(*) as n_children from nodes where depth > 0 group by 1),
counted as (select l.*, coalesce(k.n_children, 0) as n_children from linked l left join kids k on k.node = l.node),
sums as (select node[1:d] as node, sum((n_children = 0)::int) as n_leaves, sum(own) as saved_tokens from counted, unnest(range(depth + 1)) u(d) group by 1)
select c.conv_id, c.depth::bigint as depth, c.parent_conv_id, c.n_convs::bigint as n_convs, c.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves,
    s.saved_tokens::bigint as saved_tokens, c.ends_sha256 from counted c join sums s on s.node = c.node
"""


ORACLE_SQL = {"op4_fingerprint": _fingerprint(), "op7_ngram_join": NGRAM_JOIN, "op10_quality_rules": _quality_rules(), "op12_prefix_trie": PREFIX_TRIE}
