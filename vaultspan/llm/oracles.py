"""DuckDB SQL for the corpus queries that SQL can express over whole tables.

Each text states the result from its definition, by brute force where need be, and shares
no method with the operator. The rest have none: op2's and op4's order and files, op3's and
op4's tokenizers, op5's model, op8's entropy windows and op9 (its search may miss a neighbour).
"""

from __future__ import annotations

from vaultspan.llm.mixing import MOST_PASSES, SLOPES, WEIGHTS, WORD

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    """Lower case for A-Z alone."""
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes; needs ``crc_table`` (``steps``, a list of 256) beside the text."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    step = "lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({octets}, {step}, 4294967295::bigint), 4294967295::bigint)"


# Fixed value: the reversed polynomial of crc32.
_CRC_TABLE = """crc_table as (
    select list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, i::bigint)) as steps
)"""

_OP1 = f"""
with recursive texts as (
    select doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{WORD}') as words from documents
), docs as (
    select doc_id, words, case when len(words) > 0 then md5(array_to_string(words, ' ')) end as class from texts
), classes as (
    select class, any_value(words) as words, min(doc_id) as least, count(*) as copies from docs where class is not null group by class
), shingles as (
    select distinct class, md5(array_to_string(words[i:i + 4], ' ')) as shingle
    from (select class, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from classes)
), sizes as (
    select class, count(*) as n from shingles group by class
), common as (
    select a.class as u, b.class as v, count(*) as n from shingles a join shingles b on a.shingle = b.shingle and a.class <> b.class group by all
), links as (
    select u, v from common c join sizes a on a.class = u join sizes b on b.class = v where 100 * c.n >= 80 * (a.n + b.n - c.n)
), reach(u, v) as (
    select class, class from classes union select r.u, l.v from reach r join links l on l.u = r.v
), groups as (
    select u as class, min(c.least) as component_id from reach r join classes c on c.class = r.v group by u
), linked as (
    select u as class, sum(c.copies) as n from links l join classes c on c.class = l.v group by u
)
select doc_id, coalesce(s.n, 0)::bigint as n_shingles, coalesce(g.component_id, doc_id) as component_id,
    coalesce(c.copies - 1 + coalesce(l.n, 0), 0)::bigint as n_links
from docs d left join sizes s using (class) left join groups g using (class) left join classes c using (class) left join linked l using (class)
"""

_OP6 = """
with docs as (
    select row_number() over () as doc, doc_id, hex(encode(coalesce(text, ''))) as octets, octet_length(encode(coalesce(text, ''))) as n_bytes
    from documents
), pieces as (
    -- pieces that overlap by 199 bytes keep every string's search short
    select doc, base, substr(octets, (2 * base + 1)::bigint, 2 * 1199) as piece
    from (select doc, octets, unnest(range(0, n_bytes - 199, 1000)) as base from docs where n_bytes >= 200)
), strings as (
    select doc, base + i as start, md5_number(substr(piece, (2 * i + 1)::bigint, 400)) as string
    from (select doc, base, piece, unnest(range(0, least(1000, length(piece) // 2 - 199))) as i from pieces)
), repeated as (
    select doc, start, start - lag(start) over (partition by doc order by start) as gap
    from strings where string in (select string from strings group by string having count(*) > 1)
), spans as (
    select doc, min(start) as low, max(start) + 200 as high
    from (select doc, start, sum(case when gap <= 200 then 0 else 1 end) over (partition by doc order by start) as span from repeated)
    group by doc, span
), kept as (
    select doc, count(*) as n_spans, sum(high - low) as n_removed, max(high) as last,
        string_agg(substr(octets, (2 * before + 1)::bigint, (2 * (low - before))::bigint), '' order by low) as parts
    from (select s.*, octets, coalesce(lag(high) over (partition by doc order by low), 0) as before from spans s join docs using (doc))
    group by doc
)
select doc_id, n_bytes::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
    sha256(unhex(coalesce(parts, '') || substr(octets, (2 * coalesce(last, 0) + 1)::bigint))) as kept_sha256
from docs left join kept using (doc)
"""

_OP7 = f"""
with docs as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
        md5('mix:' || coalesce(doc_id::varchar, '')) as key
    from documents
), sources as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as turn from docs group by source
), weighed as (
    select *, {list(map(float, WEIGHTS))}[turn % 3 + 1]::double as weight, {list(SLOPES)}[turn % 3 + 1]::double as slope,
        source_size * {float(MOST_PASSES)}::double as cap
    from sources
), levels as (
    select (sum(source_size) over ()::double - coalesce(sum(cap) over earlier, 0)) / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
    from weighed window earlier as (order by cap / weight, turn rows between unbounded preceding and 1 preceding)
), shares as (
    select *, least(cap, (select max(level) from levels) * weight) as target from weighed
), planned as (
    select *, round(target)::bigint as words, case when source_size > 0 then round(target)::bigint // source_size else 0 end as whole from shares
), placed as (
    select d.doc_id, d.size, p.*, words - whole * source_size as rest,
        coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id nulls first, d.size
            rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from docs d join planned p on p.source is not distinct from d.source
), counted as (
    select *, greatest(0, least(size, rest - before)) as extra from placed
), shown as (
    select *, whole * size + extra as taken, case when size > 0 then whole + (extra > 0)::int else 0 end as passes,
        (before + case when whole > 0 then size else extra end / 2.0::double) / words as share
    from counted
)
select doc_id, size, source_size, target, taken::bigint as taken, passes::int as passes,
    case when passes > 0 then 2.0::double * share / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4.0::double * slope * share)) end as first_position
from shown
"""

_OP10 = """
with recursive vectors as (
    select row_number() over () as row, vec_id, label, embedding::double[] as v from embeddings
), usable as materialized (
    select * from vectors
    where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
    select a.row as u, b.row as v from usable a join usable b on a.label = b.label and a.row <> b.row and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(u, v) as (
    select row, row from vectors union select r.u, l.v from reach r join links l on l.u = r.v
), groups as (
    select u as row, min(o.vec_id) as component_id from reach r join vectors o on o.row = r.v group by u
)
select vec_id, (select count(*) from links l where l.u = a.row)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
from vectors a join groups using (row)
"""

_OP11 = f"""
with recursive {_CRC_TABLE}, runs as (
    select doc_id, {_lower("run")} as run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents)
    where length(run) >= 7 group by all
), marked as (
    select run, n, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs, crc_table
), words as (
    select word, sum(n)::bigint as n
    from (select n, case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from marked)
    where length(word) >= 7 group by word having sum(n) >= 2
), shorter as (
    select word, i, left(word, i) || substr(word, i + 2) as rest from (select word, unnest(range(length(word))) as i from words)
), near as (
    select a.word, b.word as other from shorter a join shorter b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select s.word, w.word from shorter s join words w on w.word = s.rest
    union select w.word, s.word from shorter s join words w on w.word = s.rest
), ranked as (
    select near.word, other, o.n, count(*) over (partition by near.word) as n_near,
        row_number() over (partition by near.word order by o.n desc, other) as place
    from near join words o on o.word = other
), formed as (
    select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.n >= 10 * w.n then r.other end as form, case when r.n >= 10 * w.n then r.n end as form_n
    from words w left join ranked r on r.word = w.word and place = 1
), chain(word, reached) as (
    select word, word from formed union all select c.word, f.form from chain c join formed f on f.word = c.reached where f.form is not null
)
select f.word, f.form, c.reached as root, f.n, f.n_near, f.form_n
from formed f join chain c on c.word = f.word join formed last on last.word = c.reached and last.form is null
"""

# A run of period q shares three words in a row with itself q words on, so equal triples seed every stretch.
_OP12 = f"""
with recursive {_CRC_TABLE}, texts as (
    select row_number() over () as doc, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as words,
        coalesce({_crc32("doc_id::varchar")}, 1) as h
    from documents, crc_table
), origins as (
    select *, case when h % 10 = 0 and len(words) > 0 then (h // 10) % len(words) end as a, 3 + (h // 10) % 8 as parts from texts
), docs as (
    select doc, doc_id, len(words) as n, case when a is null then words
        else list_transform(range(len(words)), lambda i: words[case when i < a then i else a + (i - a) % (1 + (len(words) - a) // parts) end + 1]) end as words
    from origins
), triples as (
    select doc, n, i, md5_number(array_to_string(words[i + 1:i + 3], ' ')) as triple
    from (select doc, n, words, unnest(range(n - 2)) as i from docs where n >= 6)
), matches as (
    select x.doc, x.i, y.i - x.i as period from triples x join triples y on x.doc = y.doc and x.triple = y.triple and y.i > x.i and 4 * (y.i - x.i) <= x.n
), stretches as (
    select doc, period, min(i) as start, count(*) + 2 + period as length
    from (select *, i - row_number() over (partition by doc, period order by i) as stretch from matches) group by doc, period, stretch
), found as (
    select doc, start, length, min(period) as period from stretches where length >= greatest(6, 4 * period) group by doc, start, length
), listed as (
    select doc, count(*) as n_runs, arg_min((start, length, period), (-length, start, period)) as best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
    from found group by doc
), dropped as (
    select distinct doc, unnest(range(start + period, start + length)) as i from found
), kept as (
    select doc, string_agg(word, ' ' order by i) as text
    from (select doc, unnest(words) as word, unnest(range(n)) as i from docs) anti join dropped using (doc, i) group by doc
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best[1]::bigint as start, best[2]::bigint as length, best[3]::bigint as period,
    (1000 * best[2]::bigint) // best[3]::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
    sha256(coalesce(text, '')) as collapsed_sha256, n::bigint as n_words
from docs left join listed using (doc) left join kept using (doc)
"""

_OP13 = """
with payloads as (
    select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages
), first as (
    select *, max(page_id) over (partition by payload) as response from payloads
)
select page_id, payload_bytes::bigint as payload_bytes, sha1(payload) as payload_digest,
    case when payload_bytes >= 1000 and page_id <> response then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> response then response end as refers_to
from first
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": _OP1,
        "op6_suffix_sort": _OP6,
        "op7_mixing": _OP7,
        "op10_tree_forest": _OP10,
        "op11_spelling": _OP11,
        "op12_periodic_runs": _OP12,
        "op13_warc": _OP13,
    }
