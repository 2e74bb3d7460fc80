"""DuckDB statements for the corpus queries whose answer SQL can state."""

from .queries import URL_RULES


def _shrink(name: str, rows: str, parent: str, on: str) -> str:
    """The three steps of one level of the reputation: prior, strength, posterior."""
    join = f"JOIN {parent} AS p USING ({on})" if on else f", {parent} AS p"
    return f"""
        {name}_prior AS (SELECT l.*, p.mean AS prior FROM {rows} AS l {join}),
        {name}_strength AS (
            SELECT coalesce(CASE WHEN chi > n1 THEN least(1000.0, greatest(1.0, n2 / (chi - n1) - 1.0)) END, 1000.0)::DOUBLE AS strength
            FROM (SELECT sum((b - n * prior) * (b - n * prior) / (prior * (1 - prior))) AS chi, sum(n) AS n1, sum(n * (n - 1)) AS n2
                  FROM {name}_prior WHERE n > 1)
        ),
        {name} AS (
            SELECT *, alpha / (alpha + beta) AS mean
            FROM (SELECT l.*, strength * prior + b AS alpha, strength * (1 - prior) + n - b AS beta FROM {name}_prior AS l, {name}_strength)
        )"""


def _rules(answer: str) -> str:
    """CASE over the rules, longest first; ``answer`` picks the rule's text or its verdict."""
    fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
    whens = ""
    for verdict, text in sorted(URL_RULES, key=lambda r: -len(r[1])):
        host, _, path = text.partition("/")
        whens += f" WHEN {fits.format(h=host, p=path)} THEN '{text if answer == 'rule' else verdict}'"
    return f"CASE{whens} END"


ORACLE: dict[str, str] = {
    "op3_url_reputation": f"""
        WITH u AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ),
        seen AS (
            SELECT host, count(*)::DOUBLE AS n, sum(1 - quality)::DOUBLE AS b
            FROM u JOIN labels ON doc_id = page_id WHERE quality IS NOT NULL GROUP BY host
        ),
        hosts AS (
            SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
                   coalesce(n, 0) AS n, coalesce(b, 0) AS b
            FROM (SELECT DISTINCT host FROM u) LEFT JOIN seen USING (host)
        ),
        domains AS (SELECT suffix, domain, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY ALL),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM domains GROUP BY ALL),
        root AS (SELECT (sum(b) + 1) / (sum(n) + 2) AS mean FROM suffixes),{_shrink("suf", "suffixes", "root", "")},{_shrink("dom", "domains", "suf", "suffix")},{_shrink("top", "hosts", "dom", "suffix, domain")},
        judged AS (
            SELECT host, CASE WHEN mean - 1.645 * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) > 0.15
                         THEN 'block' ELSE 'allow' END AS said
            FROM top
        )
        SELECT page_id, host, path, {_rules("rule")} AS rule, coalesce({_rules("verdict")}, said) AS verdict
        FROM u JOIN judged USING (host)
    """,
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM d
    """,
    "op5_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        q AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS first_id,
                   [CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) for g in range(8)] AS parts
            FROM p
        )
        SELECT page_id,
               CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(((parts[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1) for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM q
    """,
    "op6_weighted_mix": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS src,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                   md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
            FROM documents
        ),
        s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
        w AS (SELECT *, list_value(5.0, 2.0, 1.0)[CAST((row_number() OVER (ORDER BY src = '', src) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight FROM s),
        c AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, CAST(3 * source_size AS DOUBLE) / weight AS full_at FROM w),
        l AS (
            SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
                       - coalesce(sum(cap) OVER (ORDER BY full_at, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY full_at, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM c
        ),
        g AS (SELECT arg_min(level, full_at) FILTER (WHERE full_at > level) AS level FROM l),
        t AS (
            SELECT src, source_size, CASE WHEN g.level IS NULL OR full_at <= g.level THEN cap ELSE g.level * weight END AS target
            FROM l, g
        ),
        o AS (
            SELECT d.*, source_size, target,
                   CAST(sum(size) OVER (PARTITION BY d.src ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS played
            FROM d JOIN t ON d.src = t.src
        ),
        f AS (SELECT *, CAST(e * source_size + played AS DOUBLE) / target AS finish FROM o, range(3) AS k(e) WHERE target > 0),
        m AS (SELECT r, sum(size) OVER (ORDER BY finish, src, key, e, doc_id, size ROWS UNBOUNDED PRECEDING) AS done FROM f),
        n AS (SELECT r, count(*) AS times FROM m WHERE done <= (SELECT sum(size) FROM d) GROUP BY r)
        SELECT doc_id, size, source_size, target, CAST(coalesce(times, 0) * size AS BIGINT) AS taken
        FROM o LEFT JOIN n ON n.r = o.r
    """,
    "op11_fill_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
            FROM documents
        ),
        d AS (
            SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
            FROM t
        ),
        p AS (
            SELECT doc_id, text, n,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                        THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(units[:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
                   array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
                   array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
            FROM d
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
    "op12_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        coded AS (
            SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '<turn>', '\a'), '<say>', '\b'), '</turn>', '\c'))
                    + length(replace(replace(replace(replace(text, '\', '\\'), '<turn>', '\a'), '<say>', '\b'), '</turn>', '\c'))
                    + length('<turn><say></turn>') + 1 AS chars, sha256(text) AS tie
            FROM turns
        ),
        joined AS (
            SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, tie) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, tie) FILTER (role = 'assistant'), '') AS learnt
            FROM coded GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars
        FROM joined
    """,
    "op13_lexical_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
        ),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY ALL),
        totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lengths),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term),
        items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score
            FROM items JOIN w USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        WHERE rank <= 10
    """,
}
