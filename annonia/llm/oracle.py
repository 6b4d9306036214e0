"""SQL for DuckDB, by brute force, of the queries of this subpackage that SQL can express.

Chat formatting is a concatenation of turns, near-duplicate groups are the closure of a self-join of
shingles, a split of a host is a recursion over its letters, shards are running sums in the order of the key (splitters and ranges only divide that work), and
repeats are byte strings with a row number above one. The other methods rest on merges,
decoding, fitted models or samples, which SQL can't say; their tests compare them with plain Python."""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def _escaped_length(text: str) -> str:
    """Code points of a text once its control strings are escaped: one more for each of them, or for each # of a run."""
    return rf"length({text}) + length({text}) - length(replace({text}, '\', '')) + len(regexp_extract_all({text}, '</turn>')) + length(array_to_string(regexp_extract_all({text}, '#{{3,}}'), ''))"


OP1_CHAT = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -7, i, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) as hard(i, role)
)
select
    conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(length('### : </turn>') + 1 + {_escaped_length("role")} + len(regexp_extract_all(role, ':')) + {_escaped_length("text")}) as bigint) as formatted_chars
from turns
group by conv_id
"""

OP2_MINHASH = f"""
with recursive words as (
    select doc_id, coalesce({_WORDS}, []) as w from documents
),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
    from words
),
sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n from shingles x join shingles y on x.shingle = y.shingle and x.doc_id < y.doc_id group by all
),
links as (
    select a, b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b where 100 * s.n >= 75 * (x.n + y.n - s.n)
),
edges as (
    select a, b from links union all select b, a from links
),
reached as (
    select doc_id, doc_id as other from documents
    union
    select r.doc_id, e.b from reached r join edges e on e.a = r.other
),
components as (
    select doc_id, min(other) as component_id from reached group by doc_id
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join components c on c.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

OP3_URLS = r"""
with recursive urls as (
    select page_id, html, case when contains(url, '://') then substring(url, instr(url, '://') + 3) else '' end as rest from pages
),
hosts as (
    select page_id, html, rest, regexp_extract(rest, '^[^/?#]*') as raw from urls
),
parts as (
    select page_id, html, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') as path from hosts
),
rules as (
    select * from (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) as r(h, p, v)
),
fitting as (
    select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as ruled
    from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id
),
base as (
    select a.page_id, a.host, a.path, a.html, f.rule, f.ruled from parts a left join fitting f on f.page_id = a.page_id
),
read as (
    select unnest(regexp_extract_all(lower(path), '[\p{L}\p{N}]+')) as piece from base
    union all
    select unnest(regexp_extract_all(lower(regexp_replace(coalesce(html, ''), '(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g')), '[\p{L}\p{N}]+')) from base
),
counts as (
    select piece, count(*) as n from read group by piece
),
total as (
    select cast(coalesce(sum(n), 0) as bigint) as total from counts
),
of_host as (
    select host, unnest(regexp_extract_all(host, '[\p{L}\p{N}]+')) as label from (select distinct host from base)
),
labels as (
    select distinct label from of_host
),
begins as (
    select label, unnest(range(1, length(label) + 1)) as b from labels
),
spans as (
    select label, b, unnest(range(b, length(label) + 1)) as e from begins
),
substrings as (
    select distinct label, label[b:e] as piece from spans
),
known as (
    select s.label, list(struct_pack(k := s.piece, v := ln(total + 1) - ln(c.n))) as entries from substrings s join counts c on c.piece = s.piece, total group by s.label
),
steps as (
    select l.label, total, coalesce(map_from_entries(entries), map {}) as cost, 0 as e, [cast(0 as double)] as costs, cast([] as bigint[]) as froms
    from labels l left join known k on k.label = l.label, total
    union all
    select label, total, cost, e + 1, list_append(costs, best.c), list_append(froms, best.b)
    from (
        select *, list_min(list_transform(range(0, e + 1), lambda b: struct_pack(c := costs[b + 1] + coalesce(cost[label[b + 1:e + 1]], ln(total + 1) + (e + 1 - b) * ln(10)), b := b))) as best
        from steps where e < length(label)
    )
),
back as (
    select label, froms, froms[e] as b, label[froms[e] + 1:e] as piece from steps where e = length(label)
    union all
    select label, froms, froms[b], label[froms[b] + 1:b] from back where b > 0
),
tokens as (
    select u.page_id, ruled, 'h:' || piece as token from base u join of_host o on o.host = u.host join back on back.label = o.label
    union all
    select page_id, ruled, 'p:' || unnest(regexp_extract_all(lower(path), '[\p{L}\p{N}]+')) from base
),
by_token as (
    select token, count(*) filter (where ruled = 'allow') as allow, count(*) filter (where ruled = 'block') as block from tokens where ruled is not null group by token
),
sums as (
    select coalesce(sum(allow), 0) + count(*) + 1 as allow, coalesce(sum(block), 0) + count(*) + 1 as block from by_token
),
prior as (
    select count(*) filter (where ruled = 'allow') as allow, count(*) filter (where ruled = 'block') as block from base
),
scores as (
    select page_id, sum(ln((t.block + 1) / s.block) - ln((t.allow + 1) / s.allow)) as odds from tokens k join by_token t on t.token = k.token, sums s where k.ruled is null group by page_id
)
select b.page_id, b.host, b.path, b.rule,
    coalesce(ruled, case when p.allow > 0 and p.block > 0 and round(coalesce(odds, 0) + ln(p.block / p.allow), 9) > 0 then 'block' else 'allow' end) as verdict
from base b left join scores s on s.page_id = b.page_id, prior p
"""

OP8_SHARDING = """
with bits as (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as c from range(256) as r(i)
),
crc as (
    select list(c order by i) as t from bits
),
texts as (
    select doc_id, coalesce(text, '') as text, encode(coalesce(text, '')) as b from documents
),
sized as (
    select
        cast(doc_id as bigint) as doc_id,
        octet_length(b) + 1 as size,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(b) + 1), lambda i: cast('0x' || hex(b[i:i]) as bigint))), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) as text_crc32,
        cast('0x' || substring(md5(text), 1, 15) as bigint) as k1,
        cast('0x' || substring(md5(coalesce(cast(doc_id as varchar), 'null') || ' order'), 1, 15) as bigint) as k2
    from texts, crc
),
placed as (
    select *, sum(size) over (order by k1, k2, doc_id, text_crc32 rows unbounded preceding) - size as start, sum(size) over () as total from sized
),
dealt as (
    select *, cast(least(floor((cast(start as double) + cast(size as double) / 2) * 8 / cast(total as double)), 7) as integer) as shard from placed
)
select doc_id, size, text_crc32, 'bytes' as law, shard, row_number() over (partition by shard order by k1, k2, doc_id, text_crc32) - 1 as slot, cast(null as integer) as grown_shard
from dealt
"""

OP10_REPEATS = """
with texts as (
    select doc_id, encode(coalesce(text, '')) as b from documents
),
cuts as (
    select doc_id, b, unnest(range(0, octet_length(b), 200)) as o from texts
),
pieces as (
    select doc_id, o, b[o + 1:o + 299] as piece from cuts
),
starts as (
    select doc_id, o, piece, unnest(range(octet_length(piece) - 99)) as i from pieces
),
numbered as (
    select doc_id, o + i as p, row_number() over (partition by piece[i + 1:i + 100] order by doc_id, o + i) as nth from starts
),
later as (
    select doc_id, p, lag(p) over (partition by doc_id order by p) as before from numbered where nth > 1
),
grouped as (
    select doc_id, p, sum(case when before is null or p > before + 100 then 1 else 0 end) over (partition by doc_id order by p) as run from later
),
runs as (
    select doc_id, run, min(p) as first, max(p) + 100 as last from grouped group by doc_id, run
),
gaps as (
    select doc_id, coalesce(lag(last) over (partition by doc_id order by first), 0) as first, first as last from runs
    union all
    select t.doc_id, coalesce(max(r.last), 0), octet_length(any_value(t.b)) from texts t left join runs r on r.doc_id = t.doc_id group by t.doc_id
),
kept as (
    select g.doc_id, unhex(string_agg(hex(t.b[g.first + 1:g.last]), '' order by g.first)) as b from gaps g join texts t on t.doc_id = g.doc_id group by g.doc_id
),
removed as (
    select doc_id, sum(last - first) as n_removed, count(*) as n_spans from runs group by doc_id
)
select
    t.doc_id,
    octet_length(t.b) as n_bytes,
    cast(coalesce(n_removed, 0) as bigint) as n_removed,
    coalesce(n_spans, 0) as n_spans,
    sha256(k.b) as kept_sha256
from texts t join kept k on k.doc_id = t.doc_id left join removed r on r.doc_id = t.doc_id
"""

_CRC_TABLE = """bits as (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as c from range(256) as r(i)
),
crc as (
    select list(c order by i) as t from bits
)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text, with the table ``t``."""
    b = f"encode({text})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length({b}) + 1), lambda i: cast('0x' || hex({b}[i:i]) as bigint))), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)))"


#: Every prefix of every rebuilt conversation, and every prefix of those for the sums over subtrees.
OP11_PREFIX_TRIE = rf"""
with {_CRC_TABLE},
plain as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
),
convs as (
    select conv_id, list(struct_pack(role := role, text := text) order by turn nulls first, md5(length(role) || ':' || role || text)) as turns from plain group by conv_id
),
heads as (
    select conv_id, {_crc32("cast(conv_id as varchar)")} % 4 as h from convs, crc
),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) as turns from convs c join heads on heads.conv_id = c.conv_id left join convs b on b.conv_id = c.conv_id - c.conv_id % 20
),
depths as (
    select *, unnest(range(len(turns) + 1)) as depth from rebuilt
),
nodes as (
    select turns[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where len(turns) = depth), '')) as ends_sha256
    from depths group by turns[1:depth], depth
),
children as (
    select prefix[1:depth - 1] as prefix, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by all
),
own as (
    select nodes.*, coalesce(n, 0) as n_children, case when depth > 0 then (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) else 0 end as saved
    from nodes left join children using (prefix, depth)
),
upward as (
    select *, unnest(range(depth + 1)) as top from own
),
sums as (
    select prefix[1:top] as prefix, top as depth, count(*) filter (where n_children = 0) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from upward group by all
)
select o.conv_id, o.depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
from own o join sums s using (prefix, depth) left join nodes p on p.depth = o.depth - 1 and p.prefix = o.prefix[1:o.depth - 1]
"""


def _by_state(value: str) -> str:
    """A list of a value for each of the states 0 to 3 (``s``), and for it the role to come (``nr``) and the state then (``ns``)."""
    return "[" + ", ".join(value.replace("{s}", str(s + 1)).replace("{ns}", str(ns + 1)).replace("{nr}", nr).replace("{kept}", f"case when initial = '{nr}' then v[{ns + 1}]{system} end") for s, (nr, ns, system) in enumerate((("u", 2, " when initial = 's' then v[2]"), ("u", 2, ""), ("a", 3, ""), ("u", 2, "")))) + "]"


#: Costs are carried from the last row to the first, in each state with no, one or two insertions; then the tight edits are taken one by one.
OP12_REPAIR = rf"""
with recursive {_CRC_TABLE},
damage as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as k from conversations, crc
),
damaged as (
    select conv_id, turn, case k when 4 then 'user' else role end as role, case k when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case k when 0 then 0 when 3 then 2 else 1 end)) as copy
    from damage
),
numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth from damaged
),
judged as (
    select conv_id, i, turn, role, text, role[1:1] as initial,
        case when not regexp_matches(text, '[^ 	-
]') then 'blank' when nth > 1 then 'duplicate' when regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
    from numbered
),
sizes as (
    select conv_id, max(i) as n from judged group by conv_id
),
costs as (
    select conv_id, n + 1 as i, [0, 6, 3, 0] as v from sizes
    union all
    select conv_id, i, [least(b[1], 3 + b[3], 6 + b[4]), least(b[2], 3 + b[3], 6 + b[4]), least(b[3], 3 + b[4]), least(b[4], 3 + b[3])]
    from (
        select j.conv_id, j.i, case when fault in ('blank', 'duplicate') then {_by_state("v[{s}] + 4")} else {_by_state("least(v[{s}] + 4, v[{ns}] + 3 + case fault when 'truncated' then 3 else 0 end, {kept} + case fault when 'truncated' then 3 else 0 end)")} end as b
        from costs c join judged j on j.conv_id is not distinct from c.conv_id and j.i = c.i - 1
    )
),
steps as (
    select conv_id, cast(1 as bigint) as i, 0 as s, '' as audit, cast([] as varchar[]) as lines from sizes
    union all
    select conv_id, case when e = 'I' then i else i + 1 end, case when e = 'D' then s when e = 'K' and initial = 's' then 1 when s = 2 then 3 else 2 end, audit || e,
        case e when 'D' then lines when 'K' then list_append(lines, role || ':' || text) else list_append(lines, case s when 2 then 'assistant:' else 'user:' end || case e when 'I' then '' else text end) end
    from (
        select p.*, j.role, j.text, j.initial,
            case when j.i is not null and 4 + a.v[s + 1] = c.v[s + 1] then 'D'
                when fault in ('blank', 'duplicate') then null
                when (j.i is not null or s in (1, 2)) and 3 + c.v[case s when 2 then 4 else 3 end] = c.v[s + 1] then 'I'
                when j.i is not null and (initial = 's' and s = 0 or initial = case s when 2 then 'a' else 'u' end) and case fault when 'truncated' then 3 else 0 end + a.v[case when initial = 's' then 2 when s = 2 then 4 else 3 end] = c.v[s + 1] then 'K'
                when j.i is not null then 'R' end as e
        from steps p
        join costs c on c.conv_id is not distinct from p.conv_id and c.i = p.i
        left join costs a on a.conv_id is not distinct from p.conv_id and a.i = p.i + 1
        left join judged j on j.conv_id is not distinct from p.conv_id and j.i = p.i
    )
    where e is not null
),
walked as (
    select conv_id, arg_max(audit, length(audit)) as audit, arg_max(lines, length(audit)) as lines from steps group by conv_id
),
pairs as (
    select conv_id, initial || lead(initial) over (partition by conv_id order by i) as pair from judged
),
illegal as (
    select conv_id, count(*) filter (where pair is not null and pair not in ('su', 'ua', 'au')) as illegal from pairs group by conv_id
),
faults as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated
    from judged group by conv_id
),
ids as (
    select distinct conv_id from conversations
)
select ids.conv_id, coalesce(f.gaps, 0) as gaps, coalesce(f.blank, 0) as blank, coalesce(f.duplicate, 0) as duplicate, coalesce(f.truncated, 0) as truncated, coalesce(g.illegal, 0) as illegal,
    cast(coalesce(c.v[1], 0) as bigint) as cost, coalesce(w.audit, '') as audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) as repaired_sha256
from ids
left join faults f on f.conv_id is not distinct from ids.conv_id
left join illegal g on g.conv_id is not distinct from ids.conv_id
left join walked w on w.conv_id is not distinct from ids.conv_id
left join costs c on c.conv_id is not distinct from ids.conv_id and c.i = 1
"""

ORACLE: dict[str, str] = {"op1_chat": OP1_CHAT, "op2_minhash": OP2_MINHASH, "op3_urls": OP3_URLS, "op8_sharding": OP8_SHARDING, "op10_repeats": OP10_REPEATS, "op11_prefix_trie": OP11_PREFIX_TRIE, "op12_repair": OP12_REPAIR}
