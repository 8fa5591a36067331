"""DuckDB statements for the queries that SQL can express on whole tables.

Models that are trained (op1, op5, op10, op3), tokenizers (op4) and the pipeline
that has them are tested against brute force, round trips and held-out rows.
"""

_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({c}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = r"regexp_extract_all({c}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = ("(?:" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token"))
           + f"|{_either('api')}_?{_either('key')}" + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _spans(kind: str, pattern: str, kept: str) -> str:
    """Matches of a pattern with their places: a match begins after the texts between the matches and the matches before it."""
    return (f"select doc_id, '{kind}' as kind, i, m[i] as found, g, m from (select doc_id, "
            f"regexp_extract_all(text, '{pattern}') as m, regexp_split_to_array(text, '{pattern}') as g from d), "
            f"unnest(range(1, len(m) + 1)) as u(i) where {kept}")


_OP2 = (
    "with d as (select doc_id, coalesce(text, '') as text from documents), f as ("
    + _spans("assign", _ASSIGN, f"length(regexp_extract(m[i], '{_ASSIGN}', 1)) >= 6") + " union all "
    + _spans("access", "AKIA[A-Z0-9]+", "length(m[i]) >= 20") + " union all "
    + _spans("hex", "[0-9a-f]+", "length(m[i]) >= 24")
    + "), s as (select doc_id, kind, list_sum(list_transform(g[1:i], lambda x: length(x))) "
    "+ coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as a, length(found) as n from f), "
    "j as (select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, "
    "count(*) filter (where kind = 'hex') as n_hex, string_agg(kind || ':' || cast(a as bigint) || ':' || cast(a + n as bigint), ',' "
    "order by a, case kind when 'assign' then 0 when 'access' then 1 else 2 end) as spans from s group by doc_id) "
    "select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, "
    "0 as n_checked, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans from d left join j on d.doc_id = j.doc_id")

_OP6 = (
    f"with recursive w as (select doc_id, {_SPACE_WORDS.format(c=_LOWER.format(c='text'))} as w from documents), "
    "s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i+4], ' ') end as g "
    "from w, unnest(range(1, greatest(len(w) - 3, 2))) as u(i) where len(w) > 0), "
    "n as (select doc_id, count(*) as n from s group by doc_id), "
    "p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2), "
    "l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)), "
    "e as (select a, b from l union all select b, a from l), "
    "r as (select doc_id as node, doc_id as reach from documents union select r.node, e.b from r join e on e.a = r.reach) "
    "select documents.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id from documents left join n on n.doc_id = documents.doc_id "
    "join (select node, min(reach) as component_id from r group by node) c on c.node = documents.doc_id")

_OP7 = (
    f"with w as (select doc_id, coalesce({_SPACE_WORDS.format(c='text')}, []) as w from documents), "
    "x as (select doc_id, i, array_to_string(w[i:i+12], ' ') as g from w, unnest(range(1, len(w) - 11)) as u(i)), "
    "f as (select g, min(doc_id) as first from x group by g having count(distinct doc_id) > 1), "
    "h as (select distinct doc_id, k from x join f on f.g = x.g and x.doc_id > f.first, unnest(range(i, i + 13)) as u(k)), "
    "t as (select doc_id, k, w[k] as word from w, unnest(range(1, len(w) + 1)) as u(k)), "
    "o as (select t.doc_id, string_agg(word, ' ' order by t.k) as kept, count(*) as n from t left join h "
    "on h.doc_id = t.doc_id and h.k = t.k where h.doc_id is null group by t.doc_id) "
    "select w.doc_id, len(w) as n_words, len(w) - coalesce(o.n, 0) as n_removed, sha256(coalesce(o.kept, '')) as kept_sha256 "
    "from w left join o on o.doc_id = w.doc_id")

_OP8 = (
    "with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings "
    "where embedding is not null), p as (select q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.e, v.e) as bigint) as score "
    "from v q, v where q.vec_id % 50 = 0 and q.vec_id <> v.vec_id) "
    "select query_id, rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank "
    "from p) where rank <= 5")

_OP9 = (
    f"with b as (select item_id, {_ALNUM_WORDS.format(c=_LOWER.format(c='text'))} as w from benchmark), "
    "x as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i+least(len(w), 13)-1], ' ') as g "
    "from b, unnest(range(1, greatest(len(w) - 11, 2))) as u(i) where len(w) > 0), "
    f"d as (select doc_id, coalesce({_ALNUM_WORDS.format(c=_LOWER.format(c='text'))}, []) as w from documents), "
    "y as (select doc_id, i, n, array_to_string(w[i:i+n-1], ' ') as g from d, (select distinct n from x) as s, "
    "unnest(range(1, len(w) - n + 2)) as u(i)), "
    "h as (select doc_id, y.i, y.n, item_id from y join x on x.g = y.g and x.n = y.n), "
    "k as (select doc_id, count(distinct place) as n_hit from h, unnest(range(i, i + n)) as u(place) group by doc_id), "
    "m as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from "
    "(select distinct doc_id, cast(item_id as varchar) as item_id from h) group by doc_id) "
    "select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, "
    "sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated "
    "from d left join k on k.doc_id = d.doc_id left join m on m.doc_id = d.doc_id")

_OP12 = (
    f"with recursive p as (select doc_id, coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER.format(c='text')}, "
    "'[.,;:!?\\x0A-\\x0D]')) as piece from documents), "
    "w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p), "
    "n as (select lang, sum(len(w)) as n from w group by lang), "
    "g as (select lang, m, array_to_string(w[i:i+m-1], ' ') as g from w, unnest([1, 2, 3, 4]) as s(m), unnest(range(1, len(w) - m + 2)) as u(i)), "
    "f as (select lang, m, g, count(*) as f from g group by all having count(*) >= 30), "
    "c as (select *, string_split(g, ' ') as w from f where m > 1), "
    "k as (select c.lang, c.g, c.f as a, k, l.f as l, r.f as r, cast(2000000::hugeint * c.f // (l.f + r.f) as bigint) as score "
    "from c, unnest(range(1, m)) as u(k) join f l on l.lang = c.lang and l.g = array_to_string(c.w[1:k], ' ') "
    "join f r on r.lang = c.lang and r.g = array_to_string(c.w[k+1:], ' ')), "
    "b as (select * from k qualify row_number() over (partition by lang, g order by score, k) = 1), "
    "s as (select lang, array_to_string(w[i:i+z-1], ' ') as g, max(f) as f from c, unnest([2, 3]) as s(z), unnest(range(1, m - z + 2)) as u(i) "
    "where z < m group by 1, 2) "
    "select b.lang, rank, phrase, a, l, r, n.n as n, score from (select b.lang, b.g as phrase, a, l, r, score, row_number() over "
    "(partition by b.lang order by score desc, a desc, b.g) as rank from b left join s on s.lang = b.lang and s.g = b.g "
    "where s.f is null or 100 * s.f < 80 * a) b join n on n.lang = b.lang where rank <= 2000")

_OP13 = (
    "with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, "
    "list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings where embedding is not null and label is not null "
    "and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0), "
    "s as (select q.vec_id as anchor_id, v.vec_id, q.label = v.label as same, cast(list_dot_product(q.e, v.e) as bigint) as score "
    "from v q, v where q.vec_id % 100 = 0 and q.vec_id <> v.vec_id), "
    "p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same "
    "qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5) "
    "select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank, "
    "vec_id as negative_id, positive_score, score as negative_score from p join s on s.anchor_id = p.anchor_id "
    "where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score "
    "qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= 10")

ORACLE: dict[str, str] = {
    "op2_secret_scan": _OP2, "op6_ngram_jaccard": _OP6, "op7_substring_dedup": _OP7, "op8_exact_top_k": _OP8,
    "op9_decontamination": _OP9, "op12_collocations": _OP12, "op13_hard_negatives": _OP13,
}
