"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .secrets import ACCESS, ALLOWED, ASSIGN, ASSIGN_CHARS, CANDIDATE, CLASSES, GAIN, HEX, WINDOW, WORDS, gain_limit

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def exact_dedup() -> str:
    return r"""
    with h as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) s from documents)
    select doc_id, min(doc_id) over w keep_id, count(*) over w group_size, doc_id = min(doc_id) over w kept, s text_sha256 from h window w as (partition by s)"""


def ngram_jaccard(n: int = 3, num: int = 90, den: int = 100) -> str:
    return rf"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') a from documents),
    s as (select doc_id, case when len(a) = 0 then [] when len(a) < {n} then [array_to_string(a, ' ')] else list_distinct(list_transform(range(len(a) - {n} + 1), lambda i: array_to_string(a[i + 1 : i + {n}], ' '))) end g from w),
    c as (select doc_id, len(g) n, g from s), x as (select doc_id, n, unnest(g) t from c),
    l as (select a.doc_id a, b.doc_id b from x a join x b on a.t = b.t and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n having {den} * count(*) >= {num} * (a.n + b.n - count(*))),
    r as (select doc_id d, doc_id o from documents union select r.d, l.b from r join l on l.a = r.o)
    select c.doc_id, c.n n_shingles, min(r.o) component_id from c join r on r.d = c.doc_id group by c.doc_id, c.n"""


def sharding(shards: int = 40) -> str:
    hexes = "(instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1"
    shift = "xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end)"
    return f"""
    with recursive k as (select i, i::ubigint c, 0 step from range(256) t(i) union all select i, {shift}, step + 1 from k where step < 8),
    t as (select list(c order by i) tab from k where step = 8),
    b as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
    z as (select doc_id, len(h) // 2 + 16 size, case when h = '' then 0 else xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(len(h) // 2), lambda i: ({hexes})::ubigint)),
                 lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255)::int + 1])), 4294967295::ubigint) end crc from b, t),
    s as (select doc_id, arg_max(n, {{'h': md5(doc_id || ':' || n), 'n': -n}}) filter (n < {shards}) shard, arg_max(n, {{'h': md5(doc_id || ':' || n), 'n': -n}}) grown from documents, range({shards + 1}) r(n) group by doc_id)
    select doc_id, size, crc::bigint text_crc32, 'key' law, shard, row_number() over (partition by shard order by doc_id) - 1 slot, grown grown_shard from z join s using (doc_id)"""


def _matches(name: str, source: str, pattern: str, keep: str = "true", group: int = 0) -> str:
    p = _quoted(pattern)
    return f"""
    {name}0 as (select doc_id, regexp_extract_all(t, {p}) m, string_split_regex(t, {p}) g{f", regexp_extract_all(t, {p}, {group}) v" if group else ""} from {source}),
    {name} as (select doc_id, m[i + 1] s, list_sum(list_transform(g[1 : i + 1], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(m[1 : i], lambda x: length(x))), 0)::bigint a{", v[i + 1] v" if group else ""}
        from {name}0, unnest(range(len(m))) u(i) where {keep})"""


def secrets() -> str:
    allowed = " or ".join(f"regexp_matches(s, {_quoted(p)})" for p in [*ALLOWED, f"^[/_=-]*({WORDS})([/_=-]+({WORDS}))*[/_=-]*$"])
    limit = "case " + " ".join(f"when regexp_matches(s, {_quoted(p)}) then {gain_limit(bits)}" for _, p, bits in CLASSES) + " end"
    gains = "[" + ", ".join(map(str, GAIN)) + "]"
    return f"""
    with d as (select doc_id, coalesce(text, '') t from documents),
    {_matches("ma", "d", ASSIGN, f"length(v[i + 1]) >= {ASSIGN_CHARS}", 2)}, {_matches("mb", "d", ACCESS)}, {_matches("mc", "d", HEX)}, {_matches("me", "d", CANDIDATE)},
    w as (select doc_id, s, a, i, list_filter(string_split(s[i + 1 : i + {WINDOW}], ''), lambda x: x <> '') l from me, unnest(range(length(s) - {WINDOW - 1})) u(i) where not ({allowed})),
    e as (select doc_id, a, s, i, list_sum(list_transform(list_distinct(l), lambda c: {gains}[len(list_filter(l, lambda x: x = c)) + 1])) q from w),
    h as (select doc_id, a + min(i) a, a + max(i) + {WINDOW} b from e where q <= {limit} group by doc_id, a, s),
    p as (select doc_id, a, 1 o, 'assign' k, a + length(s) b from ma union all select doc_id, a, 2, 'access', a + length(s) from mb union all select doc_id, a, 3, 'hex', a + length(s) from mc union all select doc_id, a, 4, 'entropy', b from h)
    select d.doc_id, count(p.a) filter (o = 1) n_assign, count(p.a) filter (o = 2) n_access, count(p.a) filter (o = 3) n_hex, count(p.a) filter (o = 4) n_entropy,
           sha256(coalesce(string_agg(k || ':' || p.a || ':' || b, ',' order by p.a, o, b) filter (o < 4), '')) base_sha256, coalesce(string_agg(k || ':' || p.a || ':' || b, ',' order by p.a, o, b), '') spans
    from d left join p on d.doc_id = p.doc_id group by d.doc_id"""


def repeated_bytes(window: int = 100) -> str:
    return f"""
    with h as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
    w as (select doc_id, i, md5(h[2 * i + 1 : 2 * i + {2 * window}]) g from h, unnest(range(greatest(len(h) // 2 - {window - 1}, 0))) t(i)),
    f as (select doc_id, i a, i + {window} b from (select doc_id, i, row_number() over (partition by g order by doc_id, i) n from w) where n > 1),
    m as (select *, max(b) over (partition by doc_id order by a rows between unbounded preceding and 1 preceding) p from f),
    k as (select *, sum(case when a <= p then 0 else 1 end) over (partition by doc_id order by a rows unbounded preceding) z from m),
    s as (select doc_id, z, min(a) a, max(b) b from k group by doc_id, z),
    q as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) p from s),
    e as (select doc_id, string_agg(h[2 * p + 1 : 2 * a], '' order by a) front, max(b) last, sum(b - a)::bigint n_removed, count(*) n_spans from q join h using (doc_id) group by doc_id)
    select doc_id, len(h) // 2 n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(front, '') || h[2 * coalesce(last, 0) + 1 :])) kept_sha256 from h left join e using (doc_id)"""


def lexical_search(k: int = 50) -> str:
    words = lambda text: rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    with q as (select distinct item_id, unnest({words("text")}) t from benchmark),
    d as (select doc_id, {words("text")} a from documents), s as (select count(*)::bigint n, sum(len(a))::bigint l from d where len(a) > 0),
    p as (select doc_id, len(a)::bigint n, unnest(a) t from d), f as (select doc_id, n, t, count(*)::bigint tf from p where t in (select t from q) group by doc_id, n, t),
    w as (select t, floor(1000 * ln((2 * max(s.n) + 2)::double / (2 * count(*) + 1)::double))::bigint w from f, s group by t),
    z as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * f.n * s.n) // s.l))))::bigint score from q join f using (t) join w using (t), s group by item_id, doc_id),
    r as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) r from z where score > 0)
    select item_id, r::int rank, doc_id, score from r where r <= {k}"""
