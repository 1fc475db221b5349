"""Expected results in DuckDB SQL, where SQL can express a query."""

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUALITY = rf"""
with d as (select row_number() over () as r, doc_id, source, text from documents),
words as (
    select r, unnest(regexp_extract_all(text, '{WORD}')) as w, generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) as i
    from d where text is not null
),
triples as (
    select r, i, w, lead(w, 1) over o as w1, lead(w, 2) over o as w2 from words window o as (partition by r order by i)
),
twice as (
    select r, i from (select r, i, count(*) over (partition by r, w, w1, w2) as n from triples where w2 is not null) where n > 1
),
repeats as (
    select r, count(*) as n from (select distinct r, i + unnest([0, 1, 2]) as i from twice) group by r
),
counted as (select r, count(*) as n_words, sum(length(w)) as word_chars from words group by r),
lines as (
    select r, source, text, unnest(string_split(text, chr(10))) as line from d where text is not null
),
normal as (
    select r, source, text, line, len(regexp_extract_all(line, '{WORD}')) as words,
        translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '{UPPER}123456789', '{LOWER}000000000') as norm
    from lines where regexp_matches(line, '{WORD}')
),
doubles as (select r, count(*) - count(distinct line) as n from normal group by r),
hosts as (select source, count(distinct text) as documents from d group by source),
frequent as (
    select n.source, n.norm from normal n join hosts h on n.source is not distinct from h.source
    group by n.source, n.norm, h.documents
    having count(distinct n.text) > 10 and count(distinct n.text) > 0.05::double * h.documents
),
gone as (
    select n.r, sum(n.words) as words from normal n join frequent f on n.source is not distinct from f.source and n.norm = f.norm
    group by n.r
),
figures as (
    select d.doc_id, coalesce(c.n_words, 0)::bigint as n_words, coalesce(c.word_chars, 0)::bigint as word_chars,
        coalesce(len(regexp_extract_all(d.text, '[#*$%&|<>]')), 0)::bigint as n_symbols,
        coalesce(s.n, 0)::bigint as n_dup_lines, coalesce(p.n, 0)::bigint as n_repeat_words,
        coalesce(g.words, 0)::bigint as n_removed_words
    from d left join counted c using (r) left join doubles s using (r) left join repeats p using (r) left join gone g using (r)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_removed_words >= 0.5::double * n_words as kept
from figures
"""

MIX = rf"""
with recursive d as (
    select doc_id, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size, coalesce(source, '') as k,
        source is null as nil, md5('mix-1:' || coalesce(doc_id::varchar, '')) as ticket
    from documents
),
sources as (select k, nil, sum(size)::bigint as source_size from d group by k, nil),
weighed as (
    select *, [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by nil, k) - 1) % 3 + 1)::int] as weight,
        2.0::double * source_size as most
    from sources
),
levels as (
    select *, most / weight as room,
        (1.5::double * sum(source_size) over () - coalesce(sum(most) over b, 0))
        / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
    from weighed window b as (order by most / weight, k, nil rows between unbounded preceding and 1 preceding)
),
shared as (select level from levels where room >= level order by room, k, nil limit 1),
targets as (select k, nil, source_size, coalesce(least(most, weight * (select level from shared)), most) as target from levels),
placed as (
    select d.*, t.source_size, t.target, coalesce(sum(size) over (
        partition by d.k, d.nil order by ticket, size rows between unbounded preceding and 1 preceding), 0)::bigint as pos
    from d join targets t on d.k = t.k and d.nil = t.nil
),
pieces as (
    select *, least(size, floor(target)::bigint - epoch * source_size - pos)::bigint as length, pos // 4096 as block
    from placed, (values (0), (1)) as e(epoch)
),
taken as (select * from pieces where length > 0),
ranked as (
    select k, nil, epoch, block, row_number() over (order by draw, k, nil, epoch, block) - 1 as rank
    from (select distinct k, nil, epoch, block,
        md5('mix-1-block:' || k || ':' || nil::varchar || ':' || epoch::varchar || ':' || block::varchar) as draw from taken)
),
depth as (
    select greatest(0, ceil(log2(greatest(1, sum(floor(target)) / 1048576))))::int as n from targets
),
tree as (
    select 0 as depth, 0::bigint as shard, 0::bigint as low, (select count(*) from ranked)::bigint as blocks
    union all
    select depth + 1, shard * 2 + side, low + side * ((blocks + 1) // 2),
        case when side = 1 then blocks - (blocks + 1) // 2 else (blocks + 1) // 2 end
    from tree, (values (0), (1)) as s(side) where depth < (select n from depth)
),
leaves as (select shard, low, blocks from tree where depth = (select n from depth)),
drawn as (select r.*, l.shard from ranked r join leaves l on r.rank >= l.low and r.rank < l.low + l.blocks),
summed as (
    select t.k, t.nil, t.pos, sum(t.length)::bigint as words, min(w.shard)::bigint as first_shard
    from taken t join drawn w on t.k = w.k and t.nil = w.nil and t.epoch = w.epoch and t.block = w.block
    group by t.k, t.nil, t.pos
)
select p.doc_id, p.size, p.source_size, p.target, coalesce(s.words, 0)::bigint as taken, s.first_shard
from placed p left join summed s on p.k = s.k and p.nil = s.nil and p.pos = s.pos and p.size > 0
"""

SUBSTRINGS = rf"""
with d as (
    select row_number() over () as r, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) as words from documents
),
starts as (select r, words, unnest(range(1, len(words) - 33)) as i from d where len(words) >= 35),
windows as (select r, i, array_to_string(words[i:i + 34], ' ') as seq from starts),
repeated as (select r, i from (select r, i, count(*) over (partition by seq) as n from windows) where n > 1),
covered as (select distinct r, i + unnest(range(0, 35)) as i from repeated),
each as (select r, unnest(words) as w, generate_subscripts(words, 1) as i from d),
left_over as (
    select e.r, string_agg(e.w, ' ' order by e.i) as kept, count(*) as n
    from each e left join covered c on e.r = c.r and e.i = c.i where c.i is null group by e.r
)
select d.doc_id, len(d.words)::bigint as n_words, (len(d.words) - coalesce(l.n, 0))::bigint as n_removed,
    sha256(coalesce(l.kept, '')) as kept_sha256
from d left join left_over l using (r)
"""

SEARCH = rf"""
with d as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents where text is not null
),
sized as (select r, doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as terms from sized),
counted as (select r, term, count(*)::bigint as tf from (select r, unnest(terms) as term from sized) group by r, term),
held as (select term, count(*)::bigint as df from counted group by term),
items as (
    select distinct item_id, text,
        unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where text is not null
),
scored as (
    select i.item_id, i.text, s.r, s.doc_id, sum(
        floor(1000 * ln((2 * t.docs + 2) / (2 * h.df + 1)))::bigint
        * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + (50 * s.n * t.docs) // t.terms)))
    )::bigint as score
    from items i join held h using (term) join counted c using (term) join sized s using (r), totals t
    group by i.item_id, i.text, s.r, s.doc_id
),
ranked as (
    select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last)::int as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

ORACLE_SQL = {
    "op5_line_frequency_quality": QUALITY,
    "op7_splitting_tree_mix": MIX,
    "op10_super_kmer_substrings": SUBSTRINGS,
    "op12_k2_treap_search": SEARCH,
}
