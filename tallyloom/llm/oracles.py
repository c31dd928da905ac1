"""DuckDB SQL for the registered corpus queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _vector_codes_sql(rounds: int = 6) -> str:
    """Each round is a pair of tables: the nearest entry of every part, and the entries' means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} as materialized (
            select k, p.part, x, unnest(arg_min({{'entry': entry, 'd': d}}, d * 16 + entry, 1)) as hit from (
                select k, p.part, x, entry,
                       list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                from p join c{r} using (part)
            ) p group by k, p.part, x
        )""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} as materialized (
            with s as (
                select part, hit.entry as entry, j, sum(x[j])::hugeint as total, count(*)::hugeint as n
                from a{r}, unnest(range(1, len(x) + 1)) as t(j) group by all
            ), m as (
                select part, entry, list(((total - ((total % n) + n) % n) // n)::bigint order by j) as mean from s group by all
            )
            select part, entry, coalesce(mean, c) as c from c{r} left join m using (part, entry)
        )""")
    return f"""
        with g as materialized (
            select row_number() over (order by vec_id nulls last, embedding) as k, vec_id, label,
                   list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), p as materialized (
            select k, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] as x
            from g, unnest(range(8)) as t(part)
        ), c0 as materialized (select part, k - 1 as entry, x as c from p where k <= 16),
        {",".join(steps)},
        coded as (
            select k, string_agg(printf('%02x', hit.entry::int), '' order by part) as code, sum(hit.d)::bigint as error
            from a{rounds} group by k
        ), book as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as sha from c{rounds})
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, sha as codebooks_sha256
        from g join coded using (k), book
    """


ORACLES: dict[str, str] = {
    "op1_exact_dedup": f"""
        with t as (select doc_id, {_LOWER} as body from documents)
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               row_number() over (partition by body order by doc_id desc) = 1 as kept, sha256(body) as text_sha256
        from t window g as (partition by body)
    """,
    "op4_url_filter": """
        with cut as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages
        ), parts as (
            select page_id, regexp_extract(rest, '^([^/?#]*)', 1) as raw_host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from cut
        ), split as (
            select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path
            from parts
        ), rules(verdict, host, path) as (
            values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
                   ('allow', 'org', '/fr/')
        ), fits as (
            select s.page_id, r.host || r.path as rule, r.verdict,
                   row_number() over (partition by s.page_id order by length(r.host || r.path) desc) as place
            from split s join rules r
              on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
        )
        select s.page_id, s.host, s.path, f.rule,
               coalesce(f.verdict, case
                   when contains(s.host || s.path, '/login/') then 'block'
                   when regexp_matches(s.host || s.path, '(?s)/cart/.*/checkout/') then 'block'
                   when contains(s.host || s.path, '/ads/') then 'block'
                   else 'allow' end) as verdict
        from split s left join fits f on s.page_id = f.page_id and f.place = 1
    """,
    "op10_exact_topk": """
        with grid as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as g
            from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.g, c.g), lambda z: z[1] * z[2]))::bigint as score
            from grid q join grid c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
        )
        select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
    """,
    "op11_quality_rules": r"""
        with t as (select row_number() over () as k, doc_id, coalesce(text, '') as body from documents),
        u as (
            select k, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as w,
                   list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ln
            from t
        ), places as (select k, unnest(w) as a, unnest(range(len(w))) as i from u
        ), triples as (
            select k, i, a, lead(a) over o as b, lead(a, 2) over o as c from places window o as (partition by k order by i)
        ), windows as (
            select k, i, count(*) over (partition by k, a, b, c) as times from triples where c is not null
        ), covered as (
            select k, count(distinct j) as n from (
                select k, unnest([i, i + 1, i + 2]) as j from windows where times >= 2
            ) group by k
        ), c as (
            select u.k, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
                   length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols,
                   length(regexp_replace(body, '[^!]', '', 'g')) as n_exclamations,
                   length(regexp_replace(body, '[^A-Z]', '', 'g')) as n_capitals,
                   len(list_filter(w, lambda x: list_contains(string_split(
                       'the of and to in is that it for was with be on are this der die das und ist von den mit dem ein '
                       || 'eine nicht auf zu des le la les et de un une du est que qui pour dans en par el los las y se '
                       || 'del por con su para al lo como es', ' '), lower(x)))) as n_stop,
                   len(ln) as n_lines, len(ln) - len(list_distinct(ln)) as n_dup_lines,
                   len(list_filter(ln, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) as n_bullets,
                   len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) as n_open,
                   coalesce(n, 0) as n_repeat_words
            from u left join covered using (k)
        ), b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not (base_failed or word_chars < 2 * n_words or word_chars > 12 * n_words or 10 * n_symbols > n_words
                    or 10 * n_exclamations > n_words or 10 * n_capitals > 3 * word_chars or 50 * n_stop < n_words
                    or 2 * n_dup_lines > n_lines or 10 * n_bullets > 9 * n_lines or 10 * n_open > 3 * n_lines) as kept
        from b
    """,
    "op13_vector_codes": _vector_codes_sql(),
}
