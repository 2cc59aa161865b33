"""DuckDB SQL for the corpus queries that it can express; each gives the query's rows."""

from __future__ import annotations

from cleargrist.llm.secret_scan import BASE_RULES, RULES, Rule

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(c: str) -> str:
    return f"translate({c}, '{_UPPER}', '{_UPPER.lower()}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(rule: Rule, rank: int) -> str:
    """Spans of one rule: the lengths of matches and of the pieces between them, added up."""
    pattern = _quoted(rule.pattern.replace(",}+", ",}"))
    return f"""select doc_id, {rank} as rank, '{rule.kind}' as kind, until - size as low, until as high
        from (select doc_id, m, g, length(m) as size, sum(length(p) + length(m)) over
              (partition by doc_id order by i rows unbounded preceding) as until
            from (select doc_id, unnest(regexp_extract_all(t, {pattern}, 0)) as m,
                unnest(regexp_extract_all(t, {pattern}, {rule.group})) as g,
                unnest(list_resize(regexp_split_to_array(t, {pattern}),
                    length(regexp_extract_all(t, {pattern}, 0)))) as p,
                generate_subscripts(regexp_extract_all(t, {pattern}, 0), 1) as i from d
                where regexp_matches(t, {pattern})))
        where length(g) >= {rule.min_chars}"""


_BASE = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
_JOINED = "coalesce(string_agg(kind || ':' || low || ':' || high, ',' order by low, rank)"

SECRETS = f"""with d as (select doc_id, coalesce(text, '') as t from documents),
    found as ({" union all ".join(_found(r, i) for i, r in enumerate(RULES))})
    select doc_id, {", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE_RULES)},
    sha256({_JOINED} filter (kind in ({_BASE})), '')) as base_sha256,
    {_JOINED} filter (kind is not null), '') as spans
    from documents left join found using (doc_id) group by doc_id"""

LINES = f"""with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from d),
    k as (select *, {_lower("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from l),
    common as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
    select doc_id, count(*) as n_lines, count(common.key) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (common.key is null), '')) as kept_sha256
    from k left join common using (key) group by doc_id"""

_SIZE = 4
COPIES = f"""with recursive w as (select doc_id, regexp_extract_all({_lower("coalesce(text, '')")},
        '[^\\x20\\x09-\\x0D]+') as words from documents),
    s as (select distinct doc_id, unnest(case when length(words) = 0 then [] when length(words) < {_SIZE}
        then [array_to_string(words, ' ')]
        else list_transform(range(1, length(words) - {_SIZE - 2}),
            lambda i: array_to_string(words[i : i + {_SIZE - 1}], ' ')) end) as shingle from w),
    n as (select doc_id, count(*) as n from s group by doc_id),
    pairs as (select a.doc_id as u, b.doc_id as v, count(*) as shared from s a join s b using (shingle)
        where a.doc_id < b.doc_id group by all),
    links as (select u, v from pairs join n a on a.doc_id = u join n b on b.doc_id = v
        where 100 * shared >= 80 * (a.n + b.n - shared)),
    edges as (select u, v from links union all select v, u from links),
    reach as (select u as a, v as b from edges union select a, v from reach join edges on b = u),
    least as (select a, min(b) as b from reach group by a)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, least.b) as component_id,
    d.doc_id <= coalesce(least.b, d.doc_id) as kept
    from documents d left join n using (doc_id) left join least on a = d.doc_id"""

_WINDOW = 10
_TERMS = "'[0-9a-z\\x{80}-\\x{10FFFF}]+'"


def _windows(size: str) -> str:
    return f"""list_transform(range(1, length(words) - {size} + 2),
        lambda i: [cast(i as varchar), array_to_string(words[i : i + {size} - 1], ' ')])"""


LEAKS = f"""with w as (select doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_TERMS}) as words
        from documents),
    b as (select cast(item_id as varchar) as item, regexp_extract_all({_lower("coalesce(text, '')")}, {_TERMS}) as words
        from benchmark),
    parts as (select item, least({_WINDOW}, length(words)) as n, words from b where length(words) > 0),
    wanted as (select distinct item, n, unnest({_windows("n")})[2] as part from parts),
    sizes as (select distinct n from wanted),
    have as (select doc_id, n, unnest({_windows("n")}) as x from w, sizes),
    hits as (select doc_id, item, n, cast(x[1] as bigint) as i from have join wanted using (n)
        where x[2] = part),
    words_hit as (select doc_id, count(distinct place) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as place from hits) group by doc_id),
    items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
        from (select distinct doc_id, item from hits) group by doc_id)
    select doc_id, cast(length(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
    coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
    from w left join words_hit using (doc_id) left join items using (doc_id)"""

# crc32 bit by bit: the bits of each byte, the lowest first, shifted through a register.
_BITS = """list_transform(range(0, 4 * length(h)), lambda k: ((instr('0123456789ABCDEF',
        substr(h, (2 * (k // 8) + case when k % 8 < 4 then 2 else 1 end)::int, 1)) - 1) >> (k % 4)::int) & 1)"""
_CRC = f"""xor(list_reduce(list_prepend(4294967295::bigint, {_BITS}::bigint[]), lambda c, b:
        xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::bigint)"""
VARIANTS = f"""with recursive r as (select doc_id, unnest(regexp_extract_all(coalesce({_lower("text")}, ''),
        '[a-z\u00C0-\u00FF]+')) as run from documents),
    d as (select doc_id, run, count(*) as n from r where length(run) >= 7 group by all),
    b as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from d),
    c as (select run, n, {_CRC} as crc from b),
    e as (select case when crc % 31 = 0 then substr(run, 1, (crc % length(run))::int)
        || substr(run, (crc % length(run))::int + 2) else run end as word, n from c),
    v as (select word, sum(n)::bigint as n from e where length(word) >= 7 group by word having sum(n) >= 2),
    i as (select word, n, unnest(range(1, length(word) + 1))::int as place from v),
    x as (select word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest from i),
    y as (select distinct x.word, x.n, v.word as near, v.n as near_n from x join v on rest = v.word),
    p as (select * from y union all select near, near_n, word, n from y union all
        select a.word, a.n, b.word, b.n from x a join x b using (place, rest) where a.word <> b.word),
    f as (select word, any_value(n) as n, count(*) as n_near, first(near order by near_n desc, near) as near,
        max(near_n) as near_n from p group by word),
    w as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * v.n then near end as form,
        case when near_n >= 10 * v.n then near_n end as form_n from v left join f using (word)),
    t as (select word, word as root, form as next from w union all
        select t.word, w.word, w.form from t join w on t.next = w.word)
    select w.word, form, root, w.n, n_near, form_n from w join t on w.word = t.word and next is null"""

NEGATIVES = """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings where vec_id is not null
        and label is not null and embedding is not null
        and length(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select a.vec_id as anchor_id, a.label as own, b.vec_id as other, b.label,
        list_inner_product(a.q, b.q)::bigint as score from v a join v b
        on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    p as (select anchor_id, own, other as positive_id, score as positive_score from s where label = own
        qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
    n as (select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id
            order by score desc, other)::int as rank, other as negative_id, positive_score, score as negative_score
        from p join s on p.anchor_id = s.anchor_id and label <> p.own
        and 100 * score between 30 * positive_score and 90 * positive_score)
    select * from n where rank <= 10"""
