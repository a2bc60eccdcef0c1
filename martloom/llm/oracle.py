"""SQL for the queries of this package that SQL can express over whole tables."""

from __future__ import annotations

_HOST_AND_PATH = """
    WITH rest AS (
        SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, html,
            translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    )"""

URL_FILTER = f"""{_HOST_AND_PATH}, ruled AS (
        SELECT page_id, host, path, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule
        FROM parts
    ), thin AS (
        SELECT host FROM parts WHERE host <> ''
        GROUP BY host
        HAVING count(*) >= 3 AND 100 * sum(CASE WHEN length(regexp_replace(coalesce(html, ''), '<[^>]*>', '', 'g')) < 900 THEN 1 ELSE 0 END) >= 20 * count(*)
    ), listed AS (
        SELECT DISTINCT host || path AS key FROM parts
        WHERE regexp_matches(host, '(^|\\.)ads-') OR host IN (SELECT host FROM thin)
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN host || path IN (SELECT key FROM listed) THEN 'block'
        ELSE 'allow' END AS verdict
    FROM ruled"""

MIXING = """
    WITH sized AS (
        SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
    ), sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight,
            CAST(source_size AS DOUBLE) * 2.0 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS total
        FROM sources
    ), levels AS (
        SELECT *, cap / weight AS reach,
            (total - coalesce(sum(cap) OVER below, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
        FROM weighed
        WINDOW below AS (ORDER BY cap / weight, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), settled AS (
        SELECT *, (SELECT arg_min(level, reach) FROM levels WHERE level < reach) AS held FROM levels
    ), targets AS (
        SELECT source, source_size, CASE WHEN held IS NULL OR reach <= held THEN cap ELSE weight * held END AS target FROM settled
    ), rated AS (
        SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
            CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS draw
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, size, source_size, target, CAST(floor(rate) + (CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS copies,
        size * CAST(floor(rate) + (CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM rated"""


FILL_IN_MIDDLE = """
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest FROM documents
    ), lined AS (
        SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
            CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4,
            regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines
        FROM hashed
    ), placed AS (
        SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
            greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b
        FROM lined
    ), parted AS (
        SELECT *, array_to_string(list_slice(lines, 1, a), '') AS prefix, array_to_string(list_slice(lines, a + 1, b), '') AS middle,
            array_to_string(list_slice(lines, b + 1, n), '') AS suffix,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM placed
    )
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parted"""


COLLOCATIONS = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), starts AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), grams AS (
        SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
        FROM starts, (VALUES (1), (2), (3), (4)) AS orders(k) WHERE i + k - 1 <= len(w)
    ), totals AS (
        SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
    ), counts AS (
        SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
    ), cuts AS (
        SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w, c FROM counts, (VALUES (1), (2), (3)) AS places(c) WHERE c < k
    ), sides AS (
        SELECT lang, phrase, k, f, c, array_to_string(list_slice(w, 1, c), ' ') AS x, array_to_string(list_slice(w, c + 1, k), ' ') AS y FROM cuts
    ), scored AS (
        SELECT s.*, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * s.f // (x.f + y.f) AS BIGINT) AS score
        FROM sides AS s JOIN counts AS x ON x.lang = s.lang AND x.phrase = s.x JOIN counts AS y ON y.lang = s.lang AND y.phrase = s.y
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
    ), covers AS (
        SELECT lang, part, max(f) AS cover FROM (
            SELECT lang, x AS part, f FROM sides WHERE c = k - 1 UNION ALL SELECT lang, y, f FROM sides WHERE c = 1
        ) GROUP BY lang, part
    ), ranked AS (
        SELECT s.lang, s.phrase, s.f AS a, s.l, s.r, s.score,
            row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.f DESC, s.phrase) AS rank
        FROM lowest AS s LEFT JOIN covers AS c ON c.lang = s.lang AND c.part = s.phrase
        WHERE c.cover IS NULL OR CAST(100 AS HUGEINT) * c.cover < CAST(80 AS HUGEINT) * s.f
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": URL_FILTER, "op3_mixing": MIXING, "op11_collocations": COLLOCATIONS, "op13_fill_in_middle": FILL_IN_MIDDLE}
