"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from linkrank.llm.bm25_wand import ANSWER_PART, LEAK, LEAK_PART, SHINGLE
from linkrank.llm.burst_trie import LONGEST_SHARED, SHARED
from linkrank.llm.de_bruijn import WINDOW
from linkrank.llm.hash_tree import HASH_DIGITS, SLOT_DIGITS, Shard, grown, regular_tree
from linkrank.llm.mixing import BITS, LEVELS, MAX_REPEATS, WEIGHTS

MIXING = f"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, md5(text), 'null')), 1, {LEVELS * BITS // 4}))::bigint as hash
  from documents),
totals as (select source, sum(size)::bigint as source_size from rows group by source),
caps as (
  select source, source_size, {MAX_REPEATS} * source_size as cap,
         [{", ".join(f"{w}::double" for w in WEIGHTS)}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as weight
  from totals),
placed as (
  select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over earlier, 0)::double) / sum(weight) over later as level
  from caps
  window earlier as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding),
         later as (order by cap / weight, source nulls last rows between current row and unbounded following)),
stops as (select *, cap <= level * weight as stops from placed),
targets as (
  select source, source_size,
         case when stops then cap::double
              else weight * (select arg_min(level, cap / weight) from stops where not stops) end as target
  from stops),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from targets),
buckets as (select source, hash, sum(size) as bucket_size from rows group by source, hash),
running as (
  select b.*, sum(bucket_size) over (partition by b.source order by hash) as upto, target - whole * source_size as budget
  from buckets b join budgets t on b.source is not distinct from t.source),
extra as (
  select source, hash,
         upto <= budget
         or (upto - bucket_size <= budget and upto - budget < budget - (upto - bucket_size)) as more
  from running)
select r.doc_id, r.size, t.source_size, t.target, (r.size * (t.whole + e.more::bigint))::bigint as taken
from rows r
join budgets t on r.source is not distinct from t.source
join extra e on r.source is not distinct from e.source and r.hash = e.hash
"""


def _winner(tree: list[Shard], level: str, parent: str | None) -> str:
    """A CASE for the child with the largest draw, for each parent."""
    weights: dict[int | None, dict[int, float]] = {}
    for s in tree:
        children = weights.setdefault(getattr(s, parent) if parent else None, {})
        children[getattr(s, level)] = children.get(getattr(s, level), 0.0) + s.weight
    cases = []
    for above, children in weights.items():
        draws = [
            f"{{'draw': ln((('0x' || substr(md5(key || '/{level}/{name}'), 1, {HASH_DIGITS}))::bigint + 0.5::double)"
            f" / {float(16**HASH_DIGITS)!r}::double) / {weight!r}::double, 'name': {-name}}}"
            for name, weight in sorted(children.items())
        ]
        best = f"-list_max([{', '.join(draws)}]).name"
        cases.append(f"when {parent} = {above} then {best}" if parent else f"when true then {best}")
    return f"case {' '.join(cases)} end"


def _placed(tree: list[Shard], name: str, rows: str) -> str:
    region = f"select *, {_winner(tree, 'region', None)} as region from {rows}"
    rack = f"select *, {_winner(tree, 'rack', 'region')} as rack from ({region})"
    shard = f"select *, ({_winner(tree, 'shard', 'rack')})::int as {name} from ({rack})"
    return f"(select * exclude (region, rack) from ({shard}))"


# crc32 bit by bit: 0xEDB88320 is the reflected polynomial of IEEE 802.3.
_STEP = "case when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end"
_ROUND = f"list_reduce(list_prepend(xor(crc, byte), range(8)), lambda crc, k: {_STEP})"
CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint,"
    " [('0x' || h)::bigint for h in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),"
    f" lambda crc, byte: {_ROUND}))"
)
SHARDING = f"""
with rows as (
  select doc_id, coalesce(doc_id::varchar, 'null') as key, (coalesce(octet_length(encode(text)), 0) + 1)::bigint as size,
         ({CRC32})::bigint as text_crc32
  from documents),
placed as (select * from {_placed(grown(regular_tree()), "grown_shard", _placed(regular_tree(), "shard", "rows"))})
select doc_id, size, text_crc32, 'key' as law, shard, grown_shard,
       row_number() over (
         partition by shard
         order by substr(md5(concat_ws('/', doc_id::varchar, text_crc32::varchar, size::varchar)), 1, {SLOT_DIGITS}),
                  doc_id nulls first, text_crc32, size) - 1 as slot
from placed
"""


def _shingled(table: str) -> str:
    return f"""
  select *, [array_to_string(words[i:i + {SHINGLE} - 1], ' ') for i in range(1, greatest(2, len(words) - {SHINGLE} + 2))] as shingles
  from (select *, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') as words from {table} where text is not null)
  where len(words) > 0"""


LEAKS = f"""
with docs as ({_shingled("(select row_number() over () as row, doc_id, text from documents)")}),
items as (
  select *, greatest(0, len(words) - ceil(len(words) / {ANSWER_PART}::double)::bigint - least({SHINGLE}, len(words)) + 1) as split
  from ({_shingled("(select row_number() over () as item, item_id, text from benchmark)")})),
in_docs as (select distinct row, doc_id, unnest(shingles) as shingle from docs),
in_items as (
  select item, item_id, len(shingles) as n, split, unnest(shingles) as shingle, unnest(range(len(shingles))) as place from items),
found as (
  select row, doc_id, item, item_id, n, split, count(*) filter (place < split) as question, count(*) filter (place >= split) as answer
  from in_docs join in_items using (shingle) group by all)
select doc_id, item_id, question::int as question_found, split::int as question_shingles,
       answer::int as answer_found, (n - split)::int as answer_shingles
from found
where question + answer >= {LEAK} * n and question >= {LEAK_PART} * split and answer >= {LEAK_PART} * (n - split)
"""


_STARTS = f"range(1, greatest(1, len(w) - {WINDOW - 2}))"
REPEATS = f"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (
  select doc_id, unnest({_STARTS}) as start, unnest([array_to_string(w[i:i + {WINDOW - 1}], ' ') for i in {_STARTS}]) as run from words),
ranked as (select doc_id, start, row_number() over (partition by run order by doc_id, start) as occurrence from windows),
gone as (select distinct doc_id, unnest(range(start, start + {WINDOW})) as place from ranked where occurrence > 1),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words),
kept as (
  select doc_id, count(gone.place) as n_removed, string_agg(word, ' ' order by place) filter (where gone.place is null) as text
  from placed left join gone using (doc_id, place) group by doc_id)
select words.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from words left join kept using (doc_id)
"""


_RUN = f"least({SHINGLE}, len(w))"
COMPONENTS = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select distinct doc_id, unnest([array_to_string(w[i:i + {_RUN} - 1], ' ') for i in range(1, len(w) - {_RUN} + 2)]) as shingle
  from words where len(w) > 0),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared
  from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select x, y from pairs join sizes a on x = a.doc_id join sizes b on y = b.doc_id
  where 100 * shared >= 85 * (a.n + b.n - shared)),
reached(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select reached.doc_id, y from reached join links on other = x)
select r.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id, r.doc_id = min(other) as kept
from reached r left join sizes on r.doc_id = sizes.doc_id group by r.doc_id
"""


CONV_CRC32 = CRC32.replace("coalesce(text, '')", "conv_id::varchar")
TRIE = f"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(role || ':' || text)) as pos,
         md5(strlen(role)::varchar || ':' || role || text) as entry, strlen(text)::bigint as size
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
ids as (select distinct conv_id, conv_id - conv_id % {SHARED} as base, ({CONV_CRC32})::bigint % {LONGEST_SHARED} as shared from turns),
rebuilt as (
  select i.conv_id, t.pos, 0 as part, t.entry, t.size from ids i join turns t on t.conv_id = i.base and t.pos <= i.shared
  union all
  select i.conv_id, t.pos, 1, t.entry, t.size from ids i join turns t on t.conv_id = i.conv_id and t.pos > i.shared),
sequences as (
  select i.conv_id, coalesce(list(entry order by part, pos) filter (entry is not null), []) as entries,
         coalesce(list(size order by part, pos) filter (entry is not null), []) as sizes
  from ids i left join rebuilt r on i.conv_id = r.conv_id group by i.conv_id),
members as (
  select conv_id, d as depth, md5(array_to_string(entries[1:d], '/')) || '/' || d as node,
         case when d > 0 then md5(array_to_string(entries[1:d - 1], '/')) || '/' || (d - 1) end as above,
         case when d > 0 then sizes[d] else 0 end as size, d = len(entries) as ends
  from (select *, unnest(range(0, len(entries) + 1)) as d from sequences)),
nodes as (
  select node, any_value(depth) as depth, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs,
         (count(*) - 1) * any_value(size) as saved,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from members group by node),
children as (select above as node, count(*) as n_children from nodes where above is not null group by above),
below as (
  select m.node, count(*) filter (c.n_children is null) as n_leaves, sum(n.saved)::bigint as saved_tokens
  from nodes n join members m on m.conv_id = n.conv_id and m.depth <= n.depth left join children c on c.node = n.node
  group by m.node)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children,
       b.n_leaves, b.saved_tokens, n.ends_sha256
from nodes n join below b on n.node = b.node left join nodes p on p.node = n.above left join children c on c.node = n.node
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_hash_tree_sharding": SHARDING,
        "op6_source_mixing": MIXING,
        "op7_de_bruijn_dedup": REPEATS,
        "op8_odd_sketch_dedup": COMPONENTS,
        "op9_benchmark_leaks": LEAKS,
        "op13_burst_trie": TRIE,
    }
