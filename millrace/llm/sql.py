"""DuckDB SQL for the queries that SQL can express."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _low(text: str) -> str:
    return f"translate({text}, '{_UP}', '{_LOW}')"


#: The table of the common 32-bit checksum, from its polynomial.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_table"""


def _crc32(points: str) -> str:
    """Unsigned checksum of the UTF-8 bytes of a list of code points; needs crc_table in reach."""
    many = f"""flatten(list_transform({points}, lambda p: CASE
        WHEN p < 128 THEN [p] WHEN p < 2048 THEN [192 + (p >> 6), 128 + (p & 63)]
        WHEN p < 65536 THEN [224 + (p >> 12), 128 + ((p >> 6) & 63), 128 + (p & 63)]
        ELSE [240 + (p >> 18), 128 + ((p >> 12) & 63), 128 + ((p >> 6) & 63), 128 + (p & 63)] END))"""
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {many}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"


def _points(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '(?s).'), lambda x: unicode(x)::BIGINT)"


def _curve(columns: list[str], bits: int) -> str:
    """Steps from table ``cells`` (doc and cells c0, c1, ...) to the place on the Hilbert curve, one bit and dimension after the other."""
    steps, at, last = [], "cells", len(columns) - 1
    names = [f"c{i}" for i in range(len(columns))]
    for bit in range(bits - 1, 0, -1):
        q, p = 1 << bit, (1 << bit) - 1
        for i in range(len(columns)):
            swap = f"xor(c0, c{i}) & {p}"
            new = {0: f"CASE WHEN c{i} & {q} > 0 THEN xor(c0, {p}) ELSE xor(c0, {swap}) END"}
            if i:
                new[i] = f"CASE WHEN c{i} & {q} > 0 THEN c{i} ELSE xor(c{i}, {swap}) END"
            picked = ", ".join(f"{new[k]} AS {n}" if k in new else n for k, n in enumerate(names))
            steps.append(f"s{bit}_{i} AS (SELECT mr, {picked} FROM {at})")
            at = f"s{bit}_{i}"
    for i in range(1, len(columns)):
        steps.append(f"g{i} AS (SELECT mr, {', '.join(f'xor(c{i}, c{i - 1}) AS c{i}' if k == i else n for k, n in enumerate(names))} FROM {at})")
        at = f"g{i}"
    flip = "0"
    for bit in range(1, bits):
        flip = f"xor({flip}, CASE WHEN c{last} & {1 << bit} > 0 THEN {(1 << bit) - 1} ELSE 0 END)"
    steps.append(f"f AS (SELECT mr, {', '.join(names)}, {flip} AS flip FROM {at})")
    places = [(bit, n) for bit in range(bits - 1, -1, -1) for n in names]
    sum_ = " + ".join(f"(((xor({n}, flip) >> {bit}) & 1) << {len(places) - 1 - k})" for k, (bit, n) in enumerate(places))
    steps.append(f"curve AS (SELECT mr, ({sum_})::BIGINT AS curve FROM f)")
    return ", ".join(steps)


SQL = {
    "op1_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_low("coalesce(text, '')")} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY body)""",
    "op3_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        k AS (SELECT *, {_low(f"trim(line, {_BLANK})")} AS key FROM l),
        r AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.*, r.keeper IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM k LEFT JOIN r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    # control strings are 4 + 4 + 8 characters a turn; an escaped character takes one more
    "op5_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t),
        n AS (
            SELECT *, lag(role, 1, '') OVER w AS prior, lead(role) OVER w IS NULL AS final,
                   16 + length(role || text) + length(regexp_replace(role || text, '[^\\#<]', '', 'g')) AS chars
            FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars,
               bool_and(prior || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
                        AND (NOT final OR role = 'assistant')) AS valid
        FROM n GROUP BY conv_id""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, payload_bytes, sha256(h) AS payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM m""",
    "op8_decontaminate": rf"""
        WITH t AS (
            SELECT doc_id AS id, true AS doc, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark),
        w AS (
            SELECT id, doc, regexp_extract_all({_low("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM t),
        i AS (
            SELECT DISTINCT id, least(10, len(ws)) AS n, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS win
            FROM w, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS g(s) WHERE NOT doc AND len(ws) > 0),
        d AS (
            SELECT w.id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS win
            FROM w, (SELECT DISTINCT n FROM i) AS sizes, unnest(generate_series(1, len(ws) - n + 1)) AS g(s) WHERE doc),
        o AS (SELECT d.id, d.s, d.n, i.id AS item FROM d JOIN i USING (n, win)),
        h AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(generate_series(s, s + n - 1)) AS p FROM o) GROUP BY id),
        c AS (
            SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM o) GROUP BY id)
        SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN h USING (id) LEFT JOIN c USING (id) WHERE doc""",
    "op9_near_dup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, hash(ws[g:g + 3]) AS sh FROM w, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS t(g)
            WHERE len(ws) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
        r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
        SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
        FROM documents JOIN r ON r.a = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op10_substrings": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        v AS (
            SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS win
            FROM w, unnest(generate_series(1, len(ws) - 34)) AS g(s)),
        d AS (SELECT doc_id, s, count(*) OVER (PARTITION BY md5(win)) AS c FROM v),
        g AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 34)) AS pos FROM d WHERE c > 1),
        k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
        m AS (SELECT k.*, g.pos IS NOT NULL AS gone FROM k LEFT JOIN g USING (doc_id, pos))
        SELECT w.doc_id, len(any_value(ws))::BIGINT AS n_words, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM w LEFT JOIN m USING (doc_id) GROUP BY w.doc_id""",
    "op11_sharding": f"""
        WITH crc AS ({_CRC_TABLE}),
        d AS (
            SELECT row_number() OVER () AS mr, doc_id, source, lang, n_chars, coalesce(strlen(text), 0) + 8 AS size,
                   {_crc32(_points("coalesce(text, '')"))} AS text_crc32
            FROM documents, crc),
        cells AS (
            SELECT mr, (64 * (rank() OVER (ORDER BY left(source, 64) NULLS FIRST) - 1)) // count(*) OVER () AS c0,
                   (64 * (rank() OVER (ORDER BY left(lang, 64) NULLS FIRST) - 1)) // count(*) OVER () AS c1,
                   (64 * (rank() OVER (ORDER BY n_chars NULLS FIRST) - 1)) // count(*) OVER () AS c2
            FROM d),
        {_curve(["source", "lang", "n_chars"], 6)},
        r AS (
            SELECT d.*, curve, row_number() OVER (ORDER BY curve, size NULLS FIRST, text_crc32 NULLS FIRST, doc_id NULLS FIRST) - 1 AS place,
                   count(*) OVER () AS n
            FROM d JOIN curve USING (mr))
        SELECT doc_id, size, text_crc32, 'rows' AS law, ((24 * place) // n)::INTEGER AS shard,
               place - ((24 * place) // n * n + 23) // 24 AS slot, NULL::INTEGER AS grown_shard, curve
        FROM r""",
    "op12_spelling": f"""
        WITH RECURSIVE crc AS ({_CRC_TABLE}),
        t AS (
            SELECT doc_id, unnest(regexp_extract_all({_low("text")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        u AS (SELECT doc_id, run, count(*) AS n FROM t GROUP BY ALL),
        h AS (SELECT *, {_crc32(_points("coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM u, crc),
        c AS (
            SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
        w AS (
            SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        -- a word without its code point i; words of one length that agree in it differ only there
        v AS (
            SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM w, unnest(generate_series(1, length(word))) AS g(i)),
        p AS (
            SELECT a.word AS x, b.word AS y, b.n AS m FROM v a JOIN v b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM v a JOIN w b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM v a JOIN w b ON a.rest = b.word),
        o AS (SELECT x, count(*) AS n_near, first(y ORDER BY m DESC, y) AS other, max(m) AS m FROM p GROUP BY x),
        f AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
            FROM w LEFT JOIN o ON x = word),
        k AS (
            SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT k.word, f.form, step + 1 FROM k JOIN f ON f.word = k.root WHERE f.form IS NOT NULL)
        SELECT f.word, n, n_near, form, form_n, r.root FROM f JOIN (SELECT word, arg_max(root, step) AS root FROM k GROUP BY word) r USING (word)""",
    "op13_search": rf"""
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS mr, regexp_extract_all({_low("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        d AS (SELECT mr, doc_id, len(ts)::BIGINT AS n, ts FROM t WHERE len(ts) > 0),
        s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
        q AS (
            SELECT DISTINCT item_id, text, unnest(regexp_extract_all({_low("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        p AS (
            SELECT mr, term, count(*)::BIGINT AS tf FROM (SELECT mr, unnest(ts) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, docs),
        i AS (
            SELECT p.mr, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS impact
            FROM p JOIN w USING (term) JOIN d USING (mr), s),
        r AS (
            SELECT item_id, q.text, mr, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) JOIN d USING (mr)
            GROUP BY ALL HAVING sum(impact) > 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10""",
}
