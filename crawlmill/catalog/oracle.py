"""DuckDB SQL that computes the registered queries independently.

Shared steps are common table expressions; a query names those it needs and gets them
with everything they need in turn.
"""

from __future__ import annotations

from crawlmill import constants as C
from crawlmill.catalog import fixtures as X
from crawlmill.limits import COLUMN_LIMITS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _names(values) -> str:
    return ", ".join(_text(v) for v in values)


AS_OF = f"TIMESTAMP '{X.AS_OF}'"
OPENED = f"TIMESTAMP '{X.OPENED}'"
OPENS_LATER = f"TIMESTAMP '{X.OPENS_LATER}'"
SCOPE = _text(f"({'|'.join(X.SEARCH_DOMAINS)})/?$")
STRIP_CLASS = r"[\t-\r\x1c-\x1f\x{85}\pZ]"
EXTRA = " || CAST(p.page_id AS VARCHAR) || ".join(
    _text(part) for part in X.EXTRA_MARKUP.split("{id}")
)
LONG = " || CAST(p.page_id AS VARCHAR) || ".join(
    _text(part) for part in X.LONG_MARKUP.split("{id}")
)
EXTRA_NORMAL, LONG_NORMAL = (
    " || CAST(p.page_id AS VARCHAR) || ".join(_text(part) for part in text.split("{id}"))
    for text in (X.EXTRA_NORMAL, X.LONG_NORMAL)
)
LONG_PAGE = f"page_id % {X.LONG_STEP} = {X.LONG_REST}"
LONG_FILES = (("/long/" + X.LONG_NAME + "/", ".pdf"), ("/long/" + X.LONG_NAME[:300], ".png"))


def _decoded(text: str) -> str:
    """``text`` with the known references decoded once: an ampersand that comes out is set aside."""
    for reference, character in X.REFERENCES:
        text = f"replace({text}, {_text(reference)}, {'chr(1)' if character == '&' else _text(character)})"
    return f"replace({text}, chr(1), '&')"


ROBOTS_CASE = "CASE " + " ".join(
    f"WHEN starts_with(domain, {_text(prefix)}) THEN {_text(text)}" for prefix, text in X.ROBOTS
) + " END"


def _scheme(url: str) -> str:
    return f"nullif(lower(regexp_extract({url}, '^([^:/?#]+):', 1)), '')"


def _netloc(url: str) -> str:
    return f"nullif(regexp_extract({url}, '^(?:[^:/?#]+:)?//([^/?#]*)', 1), '')"


def _path(url: str) -> str:
    return f"regexp_extract({url}, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1)"


def _domain(url: str) -> str:
    return f"split_part({url}, '/', 3)"


def _canonical(scheme: str, netloc: str, path: str) -> str:
    """Canonical URL of given parts, scope not tested."""
    rooted = f"CASE WHEN starts_with({path}, '/') THEN {path} ELSE '/' || {path} END"
    indexed = f"regexp_replace({rooted}, {_text(C.INDEX_PAGE)}, '/', 'g')"
    encoded = (
        f"list_transform(string_split({indexed}, '/'), lambda s: url_encode(url_decode(s)))"
    )
    folded = (
        f"list_reduce(list_filter({encoded}, lambda s: s <> ''), lambda done, s: "
        "CASE s WHEN '.' THEN done WHEN '..' THEN done[1:len(done) - 1] "
        "ELSE list_append(done, s) END, CAST([] AS VARCHAR[]))"
    )
    joined = f"array_to_string({folded}, '/')"
    tail = f"CASE WHEN {path} LIKE '%/' OR {indexed} LIKE '%/' THEN '/' ELSE '' END"
    port = f"CASE {scheme} WHEN 'http' THEN ':80$' ELSE ':443$' END"
    return (
        f"CASE WHEN {scheme} IN ('http', 'https') THEN {scheme} || '://' || "
        f"regexp_replace(lower({netloc}), {port}, '') || '/' || {joined} || "
        f"CASE WHEN {joined} = '' THEN '' ELSE {tail} END END"
    )


def _robots_quote(text: str) -> str:
    return f"replace(url_encode({text}), '%2F', '/')"


def _attribute(name: str, tag: str = "[a-z]") -> str:
    return _text(rf"""(?is)<{tag}[^>]*?\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")


def _links(name: str, scope: bool) -> dict[str, str]:
    """Canonical and classified links from ``raw_links``."""
    in_scope = (
        f"(source = 3 OR regexp_matches(netloc, {SCOPE}))" if scope else "true"
    )
    return {
        f"{name}_parts": f"""
            SELECT page_id, from_url, source, pos, raw,
                   coalesce({_scheme('target')}, scheme) AS scheme,
                   coalesce({_netloc('target')}, host) AS netloc, {_path('target')} AS path
            FROM link_targets""",
        f"{name}_urls": f"""
            SELECT *, CASE WHEN {in_scope} THEN {_canonical('scheme', 'netloc', 'path')} END AS url
            FROM {name}_parts""",
        name: f"""
            SELECT * FROM (
                SELECT page_id, from_url, source, pos, raw, url, CASE
                    WHEN url IS NULL THEN NULL
                    WHEN source = 3 THEN
                        CASE WHEN regexp_matches(url, {_text(C.IMAGE_URL)}) THEN 'image' END
                    WHEN source = 1 AND regexp_matches(
                        raw, '^[\\pL\\pN_\\.\\+\\-]+\\@[\\pL\\pN_]+\\.[a-z]{{2,3}}$') THEN NULL
                    WHEN source = 1 AND regexp_matches(url, {_text(C.IGNORED_URL)}) THEN NULL
                    WHEN regexp_matches(url, {_text(C.DOCUMENT_URL)}) THEN 'binary'
                    WHEN source = 1 AND lower(regexp_extract(url, {_text(C.URL_EXTENSION)}, 1))
                        IN ({_names(C.DROPPED_EXTENSIONS)}) THEN NULL
                    ELSE 'page' END AS cls
                FROM {name}_urls)
            WHERE cls IS NOT NULL""",
    }


def _tight(text: str) -> str:
    tight = (
        f"regexp_replace(regexp_replace({text}, '>{STRIP_CLASS}+', '>', 'g'), "
        f"'{STRIP_CLASS}+<', '<', 'g')"
    )
    return f"regexp_replace({tight}, '^{STRIP_CLASS}+|{STRIP_CLASS}+$', '', 'g')"


def _normal(html: str) -> str:
    """A given page in normal form; its markup has few things that can be written in another way."""
    for old, new in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("<br>", "<br/>"), ("<!DOCTYPE html>", "<!doctype html>")):
        html = f"replace({html}, {_text(old)}, {_text(new)})"
    return _tight(f"regexp_replace({html}, '&(amp;?)?', '&amp;', 'g')")


BODY = "regexp_replace(html, '(?is)<head>.*?</head>', '', 'g')"

# The hash of an enriched page: what is put behind a page begins and ends with a tag.
ENRICHED_HASH = (
    f"md5({_normal(BODY.replace('html', 'p.html'))} || {EXTRA_NORMAL} || "
    f"CASE WHEN p.{LONG_PAGE} THEN {LONG_NORMAL} ELSE '' END)"
)

STEPS: dict[str, str] = {
    # --- derived tables -------------------------------------------------------------
    "own": f"""
        SELECT page_id, url AS raw, {_scheme('url')} AS scheme, {_netloc('url')} AS domain,
               {_path('url')} AS path
        FROM pages""",
    "canon": f"""
        SELECT page_id, raw, domain, {_canonical('scheme', 'domain', 'path')} AS url FROM own""",
    "hosts": "SELECT domain, min(page_id) AS id FROM own GROUP BY domain",
    "site": f"""
        SELECT id, domain, robots AS robots_content,
               CASE WHEN robots IS NULL THEN NULL WHEN id % 2 = 0 THEN {OPENED}
                    ELSE {OPENS_LATER} END AS next_acces,
               CASE WHEN robots IS NULL THEN NULL ELSE CAST(id % 5 + 2 AS INTEGER) END AS delay
        FROM (SELECT *, {ROBOTS_CASE} AS robots FROM hosts)""",
    "sitemap": f"""
        SELECT {_netloc('url')} AS domain, page_id // {X.SITEMAP_BLOCK} AS block, page_id, url
        FROM pages""",
    "tree": """
        SELECT (page_id - 1) // 2 AS src, page_id AS dst FROM pages WHERE page_id > 0
        UNION ALL SELECT page_id, (page_id - 1) // 2 FROM pages WHERE page_id > 0""",
    "tree_links": """
        SELECT t.src AS page_id, p.url, CAST(greatest(dst - 2 * t.src, 0) AS INTEGER) AS pos,
               q.url AS raw
        FROM tree t JOIN pages p ON p.page_id = t.src JOIN pages q ON q.page_id = t.dst""",
    "enriched": f"""
        SELECT p.page_id, p.url, p.html || {EXTRA} || CASE WHEN p.{LONG_PAGE} THEN {LONG} ELSE '' END
                   AS html
        FROM pages p""",
    "response": """
        SELECT page_id, url, html, CAST(CASE page_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 404
                   WHEN 2 THEN 500 ELSE 200 END AS INTEGER) AS status,
               'FRONTIER' AS old_type,
               CAST(CASE WHEN page_id % 20 = 1 THEN 404 END AS INTEGER) AS old_status
        FROM enriched""",
    "files": f"""
        SELECT o.scheme || '://' || o.domain || k.prefix || CAST(page_id AS VARCHAR) || k.suffix
                   AS url, html
        FROM enriched JOIN own o USING (page_id)
        CROSS JOIN (VALUES ('/f/', '.pdf', true), ('/i/', '.PNG', true),
            {", ".join(f"({_text(a)}, {_text(b)}, false)" for a, b in LONG_FILES)}) k(prefix, suffix, always)
        WHERE always OR {LONG_PAGE}""",
    "queue": """
        SELECT event_id AS page_id, user_id AS site_id, ts AS time_added,
               event_type = 'error' AS occupied FROM events""",
    "arrivals": """
        SELECT page_id, site_id, time_added, CASE WHEN moment <= low + (high - low) // 3 THEN 0
                   WHEN moment <= low + 2 * (high - low) // 3 THEN 1 ELSE 2 END AS third
        FROM (SELECT *, epoch_us(time_added) AS moment, min(epoch_us(time_added)) OVER () AS low,
                     max(epoch_us(time_added)) OVER () AS high FROM queue)""",
    "queue_site": f"""
        SELECT DISTINCT user_id AS id, CASE WHEN user_id % 3 = 0 THEN NULL
                   WHEN user_id % 2 = 0 THEN {OPENED} ELSE {OPENS_LATER} END AS next_acces,
               user_id % 7 + 1 AS delay FROM events WHERE user_id % 11 <> 5""",
    # --- extraction -----------------------------------------------------------------
    "markup": """
        SELECT page_id, url, regexp_replace(html,
            '(?is)<!--.*?-->|<head>.*?</head>|<script.*?</script>|<style.*?</style>', '', 'g') AS html
        FROM enriched""",
    "found": f"""
        SELECT page_id, url, 1 AS source, regexp_extract_all(html, {_attribute('href')}, 1) AS vals
        FROM markup
        UNION ALL
        SELECT page_id, url, 2, regexp_extract_all(html, {_attribute('onclick')}, 1) FROM markup
        UNION ALL
        SELECT page_id, url, 3, regexp_extract_all(html, {_attribute('src', 'img')}, 1) FROM markup""",
    "raw_links": f"""
        SELECT page_id, url AS from_url, source, CAST(n - 1 AS INTEGER) AS pos,
               {_scheme('url')} AS scheme, {_netloc('url')} AS host,
               {_decoded("""CASE WHEN left(val, 1) IN ('"', '''') THEN substr(val, 2, length(val) - 2)
                       ELSE val END""")} AS raw
        FROM (SELECT page_id, url, source, unnest(vals) AS val,
                     generate_subscripts(vals, 1) AS n FROM found)
        UNION ALL
        SELECT page_id, url, {X.TREE}, pos, {_scheme('url')}, {_netloc('url')}, raw
        FROM tree_links""",
    "link_targets": f"""
        SELECT *, CASE WHEN source = 2 THEN replace(replace(raw,
                   regexp_extract(raw, {_text(C.ONCLICK_ASSIGNMENT)}), ''), '''', '')
               ELSE raw END AS target
        FROM raw_links
        WHERE source <> 2 OR regexp_matches(raw, {_text(C.ONCLICK_ASSIGNMENT)})""",
    **_links("links", scope=True),
    **_links("any_links", scope=False),
    "page_links": "SELECT * FROM links WHERE cls = 'page'",
    "firsts": """
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY url ORDER BY page_id, source, pos) AS rn FROM page_links) WHERE rn = 1""",
    "fresh": f"""
        SELECT *, {_domain('url')} AS domain FROM firsts
        WHERE url NOT IN (SELECT url FROM canon)""",
    "added_pages": """
        SELECT *, (SELECT max(page_id) FROM pages) + row_number() OVER (ORDER BY page_id, source, pos) AS id
        FROM fresh""",
    "added_sites": """
        SELECT domain, (SELECT max(id) FROM site) + row_number() OVER (ORDER BY domain) AS id
        FROM (SELECT DISTINCT domain FROM fresh WHERE domain NOT IN (SELECT domain FROM site))""",
    "page_ids": "SELECT url, min(page_id) AS id FROM canon GROUP BY url",
    # --- robots ---------------------------------------------------------------------
    "robots_lines": """
        SELECT domain, n, line, trim(regexp_replace(line, '#.*', ''), chr(32) || chr(9)) AS body
        FROM (SELECT domain, unnest(lines) AS line, generate_subscripts(lines, 1) AS n
              FROM (SELECT domain, string_split(regexp_replace(coalesce(robots_content, ''),
                           '\\r\\n|\\r', chr(10), 'g'), chr(10)) AS lines FROM {robots}))""",
    "robots_kept": """
        SELECT domain, n, key, url_decode(val) AS val, CASE WHEN line = '' THEN 'blank'
                 WHEN key = 'user-agent' THEN 'agent'
                 WHEN key IN ('allow', 'disallow', 'crawl-delay', 'request-rate') THEN 'rule' END AS kind
        FROM (SELECT *, lower(trim(split_part(body, ':', 1))) AS key,
                     trim(substr(body, strpos(body, ':') + 1)) AS val
              FROM robots_lines WHERE line = '' OR contains(body, ':'))
        WHERE kind IS NOT NULL""",
    "robots_entries": """
        SELECT *, sum(CASE WHEN kind = 'agent' AND before IS DISTINCT FROM 'agent' THEN 1 ELSE 0 END)
                      OVER (PARTITION BY domain ORDER BY n) AS entry,
               last_value(CASE WHEN kind IN ('agent', 'blank') THEN kind END IGNORE NULLS)
                      OVER (PARTITION BY domain ORDER BY n
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gate
        FROM (SELECT *, lag(kind) OVER (PARTITION BY domain ORDER BY n) AS before FROM robots_kept)""",
    "robots_entry": """
        SELECT domain, entry FROM (
            SELECT *, row_number() OVER (PARTITION BY domain ORDER BY anyone, entry) AS place
            FROM (SELECT domain, entry, bool_or(kind = 'agent' AND val = '*') AS anyone,
                         bool_or(kind = 'agent' AND val = '') AS unnamed,
                         bool_or(kind = 'rule' AND gate = 'agent') AS has_rule
                  FROM robots_entries GROUP BY domain, entry)
            WHERE has_rule AND (anyone OR unnamed))
        WHERE place = 1""",
    "robots_chosen": """
        SELECT e.* FROM robots_entries e JOIN robots_entry USING (domain, entry)
        WHERE kind = 'rule' AND gate = 'agent'""",
    "rules": f"""
        SELECT domain, CAST(row_number() OVER (PARTITION BY domain ORDER BY n) - 1 AS INTEGER) AS pos,
               key = 'allow' OR val = '' AS allow, {_robots_quote('val')} AS prefix
        FROM robots_chosen WHERE key IN ('allow', 'disallow')""",
    "delays": f"""
        SELECT domain, CAST(coalesce(nullif(found, 0), {C.DEFAULT_CRAWL_DELAY}) AS INTEGER) AS delay
        FROM {{robots}} LEFT JOIN (
            SELECT domain, arg_max(CAST(val AS INTEGER), n) AS found FROM robots_chosen
            WHERE key = 'crawl-delay' AND regexp_matches(val, '^[0-9]+$') GROUP BY domain)
        USING (domain)""",
    "verdicts": f"""
        SELECT c.page_id, c.url, c.domain, coalesce(arg_min(r.allow, r.pos), true) AS allowed
        FROM canon c LEFT JOIN rules r ON r.domain = c.domain AND starts_with(
            {_robots_quote("url_decode(regexp_extract(c.url, '^[a-z]+://[^/]*(.*)$', 1))")}, r.prefix)
        GROUP BY c.page_id, c.url, c.domain""",
    "current": f"""
        SELECT id, domain, coalesce(robots_content, {_text(X.FETCHED_ROBOTS)}) AS robots_content,
               robots_content IS NULL AS first_visit, next_acces, delay AS stored FROM site""",
    "decisions": f"""
        SELECT page_id, url, v.domain, first_visit, CASE WHEN NOT allowed THEN 'FORBIDDEN'
                 WHEN first_visit OR next_acces <= {AS_OF} THEN 'FETCH' ELSE 'DELAY' END AS decision
        FROM verdicts v JOIN current USING (domain)""",
    # --- sitemaps ---------------------------------------------------------------------
    "locs": """
        SELECT domain, block, CAST(row_number() OVER (PARTITION BY domain, block
                   ORDER BY kind, page_id) - 1 AS INTEGER) AS pos, loc
        FROM (SELECT domain, block, 0 AS kind, page_id, url AS loc FROM sitemap
              UNION ALL
              SELECT DISTINCT domain, block, k.kind, 0, replace(k.loc, '{block}', CAST(block AS VARCHAR))
              FROM sitemap CROSS JOIN (VALUES (1, '/only-in-sitemap/{block}'),
                   (2, 'http://elsewhere.example.org/s'), (3, 'ftp://f.example.org/s'),
                   (4, 'http://elsewhere.example.org/sñ&&lt;')) k(kind, loc))""",
    "loc_urls": f"""
        SELECT domain, block, pos, url FROM (
            SELECT domain, block, pos, netloc, {_canonical('scheme', 'netloc', 'path')} AS url
            FROM (SELECT *, coalesce({_scheme('loc')}, 'http') AS scheme,
                         coalesce({_netloc('loc')}, domain) AS netloc, {_path('loc')} AS path
                  FROM locs))
        WHERE url IS NOT NULL AND regexp_matches(netloc, {SCOPE})""",
    "seed": "SELECT 'http://' || domain || '/' AS url FROM hosts",
    "met": """
        SELECT url FROM page_links UNION SELECT url FROM loc_urls UNION SELECT url FROM seed""",
    "met_verdicts": f"""
        SELECT m.url, {_domain('m.url')} AS domain, coalesce(arg_min(r.allow, r.pos), true) AS allowed
        FROM met m LEFT JOIN rules r ON r.domain = {_domain('m.url')} AND starts_with(
            {_robots_quote("url_decode(regexp_extract(m.url, '^[a-z]+://[^/]*(.*)$', 1))")}, r.prefix)
        GROUP BY m.url""",
    "outcomes": """
        SELECT m.url, m.domain, CASE WHEN NOT allowed THEN 'FORBIDDEN'
                   WHEN status < 400 THEN 'HTML' ELSE 'FRONTIER' END AS page_type_code,
               CASE WHEN allowed THEN status END AS http_status_code
        FROM met_verdicts m LEFT JOIN page_ids p ON p.url = m.url
        LEFT JOIN (SELECT page_id, status FROM response) ON page_id = p.id""",
    "leads": """
        SELECT DISTINCT c.url AS from_url, l.url AS to_url
        FROM page_links l JOIN page_ids c ON c.id = l.page_id
        JOIN outcomes o ON o.url = c.url WHERE o.page_type_code = 'HTML'""",
    "located": "SELECT DISTINCT domain, url FROM loc_urls",
    "first_round": """
        SELECT url, row_number() OVER (ORDER BY id, pos, url) AS place FROM (
            SELECT l.url, h.id, l.pos,
                   row_number() OVER (PARTITION BY l.url ORDER BY h.id, l.pos) AS rn
            FROM loc_urls l JOIN hosts h USING (domain))
        WHERE rn = 1 AND url NOT IN (SELECT url FROM seed)""",
    "second_round": """
        SELECT p.url AS from_url, l.url AS to_url, row_number() OVER (
                   PARTITION BY l.url ORDER BY f.place, l.source, l.pos) AS rn
        FROM first_round f JOIN outcomes o ON o.url = f.url AND o.page_type_code = 'HTML'
        JOIN page_ids p ON p.url = f.url JOIN page_links l ON l.page_id = p.id
        WHERE l.url NOT IN (SELECT url FROM first_round) AND l.url NOT IN (SELECT url FROM seed)""",
    "db_pages": f"""
        SELECT url, id AS page_id, {_domain('url')} AS domain, row_number() OVER (ORDER BY id) AS id
        FROM page_ids""",
    "db_turn": """
        SELECT *, row_number() OVER (PARTITION BY domain ORDER BY id) <= 5 AS taken FROM db_pages""",
    "db_updated": """
        SELECT t.*, CASE WHEN NOT taken THEN 'FRONTIER' WHEN NOT allowed THEN 'FORBIDDEN'
                      WHEN status < 400 THEN 'HTML' ELSE 'FRONTIER' END AS page_type_code,
               CASE WHEN taken AND allowed THEN status END AS http_status_code
        FROM db_turn t JOIN (SELECT url, bool_and(allowed) AS allowed FROM verdicts GROUP BY url)
            USING (url)
        JOIN (SELECT page_id, status FROM response) USING (page_id)""",
    "db_found": f"""
        SELECT url, {_domain('url')} AS domain,
               (SELECT count(*) FROM db_pages) + row_number() OVER (ORDER BY id, source, pos) AS id
        FROM (SELECT l.url, u.id, l.source, l.pos, row_number() OVER (
                         PARTITION BY l.url ORDER BY u.id, l.source, l.pos) AS rn
              FROM db_updated u JOIN page_links l ON l.page_id = u.page_id AND l.source < 4
              WHERE u.page_type_code = 'HTML' AND l.url NOT IN (SELECT url FROM db_pages))
        WHERE rn = 1""",
    "db_sites": """
        SELECT domain, row_number() OVER (ORDER BY later, domain) AS site_id FROM (
            SELECT domain, min(later) AS later FROM (
                SELECT domain, 0 AS later FROM db_pages UNION ALL SELECT domain, 1 FROM db_found)
            GROUP BY domain)""",
    # --- page state and content -----------------------------------------------------------
    "moves": """
        SELECT page_id, CASE WHEN status IS NULL THEN old_type
                 WHEN status >= 400 THEN CASE WHEN old_status IS NULL THEN 'FRONTIER' ELSE 'HTML' END
                 WHEN has_body AND is_dup THEN 'DUPLICATE' ELSE 'HTML' END AS page_type_code,
               coalesce(status, old_status) AS http_status_code, status,
               status IS NULL OR (status >= 400 AND old_status IS NULL) AS requeue,
               coalesce(status < 400 AND has_body AND NOT is_dup, false) AS store_content
        FROM (SELECT *, page_id % 10 <> 3 AS has_body, page_id % 3 = 0 AS is_dup FROM response)""",
    "doc_hashes": f"SELECT doc_id AS id, md5({_tight('text')}) AS content_hash FROM documents",
    "next_pages": """
        SELECT page_id AS id, c.url, c.domain,
               CASE WHEN status IS NULL THEN old_type ELSE m.page_type_code END AS page_type_code,
               CASE WHEN status IS NULL THEN old_status ELSE m.http_status_code END AS http_status_code
        FROM canon c JOIN moves m USING (page_id)
        JOIN (SELECT page_id, old_type, old_status FROM response) USING (page_id)""",
    "batch": f"""
        SELECT page_id, r.html, old_type, old_status, status, c.url,
               CASE WHEN status < 400 THEN {ENRICHED_HASH} END AS content_hash
        FROM response r JOIN canon c USING (page_id) JOIN pages p USING (page_id)""",
    "judged": """
        SELECT *, CASE WHEN status IS NULL THEN old_type
                    WHEN status >= 400 THEN CASE WHEN old_status IS NULL THEN 'FRONTIER' ELSE 'HTML' END
                    WHEN place > 1 THEN 'DUPLICATE' ELSE 'HTML' END AS page_type_code,
               coalesce(status, old_status) AS http_status_code,
               status IS NULL OR (status >= 400 AND old_status IS NULL) AS requeue,
               coalesce(status < 400 AND place = 1, false) AS store_content
        FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY page_id) AS place
              FROM batch)""",
    "stored_links": """
        SELECT l.* REPLACE (j.url AS from_url) FROM links l
        JOIN (SELECT page_id, url FROM judged WHERE store_content) j USING (page_id)
        WHERE source < 4""",
    "batch_found": f"""
        SELECT *, {_domain('url')} AS domain FROM (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, source, pos) AS rn
            FROM stored_links WHERE cls = 'page')
        WHERE rn = 1 AND url NOT IN (SELECT url FROM canon)""",
    "document_rows": f"""
        SELECT page_id, url, upper(regexp_extract(url, '[^.]*$')) AS data_type_code
        FROM {{links}} WHERE cls = 'binary' AND data_type_code IN ({_names(C.DATA_TYPES)})""",
    "image_rows": f"""
        SELECT page_id, url, replace(regexp_extract(url, '^(.*)\\.[^.]*$', 1), '.', '') AS filename,
               lower(regexp_extract(url, '[^.]*$')) AS content_type
        FROM {{links}} WHERE cls = 'image' AND content_type IN ({_names(C.STORED_IMAGE_TYPES)})""",
    # --- frontier ---------------------------------------------------------------------
    "ready": f"""
        SELECT page_id, site_id, time_added FROM queue WHERE NOT occupied AND site_id IN (
            SELECT id FROM queue_site WHERE next_acces IS NULL OR next_acces <= {AS_OF})""",
    "edges": """
        SELECT DISTINCT c.url AS from_url, l.url AS to_url
        FROM any_links l JOIN canon c USING (page_id) WHERE cls = 'page'""",
}


def _with(body: str, robots: str = "site", links: str = "links") -> str:
    """The query behind the steps it uses, directly or through other steps."""
    import re

    steps = {
        name: text.replace("{robots}", robots).replace("{links}", links)
        for name, text in STEPS.items()
    }
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in steps and name not in needed:
                visit(steps[name])
                needed[name] = None

    visit(body)
    recursive = "RECURSIVE " if "reach AS" in body else ""
    listed = [f"{name} AS ({steps[name]})" for name in needed]
    if body.lstrip().startswith("reach AS"):
        head, _, tail = body.partition("-- result")
        return f"WITH {recursive}" + ",\n".join([*listed, head.strip()]) + "\n" + tail
    return ("WITH " + ",\n".join(listed) + "\n" if listed else "") + body


def _discovery_rows(found: str) -> str:
    return f"""
        SELECT 'site' AS table_name, domain AS k1, '' AS k2, '' AS k3 FROM (
            SELECT DISTINCT domain FROM {found} WHERE domain NOT IN (SELECT domain FROM site))
        UNION ALL SELECT 'page', url, domain, 'FRONTIER' FROM {found}
        UNION ALL SELECT 'frontier', url, 'false', '' FROM {found}
        UNION ALL SELECT 'link', from_url, url, '' FROM {found}"""


LINK_COLUMNS = "page_id, pos, raw, url, cls"
SCHEDULE = f"""
    SELECT page_id, site_id, rank AS site_rank,
           greatest(coalesce(next_acces, {AS_OF}), {AS_OF})
               + to_seconds((rank - 1) * coalesce(delay, {C.DEFAULT_CRAWL_DELAY})) AS fetch_time
    FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY time_added, page_id) AS rank
          FROM queue) LEFT JOIN queue_site ON queue_site.id = site_id"""


def sql() -> dict[str, str]:
    plain = {
        "page_scan": "SELECT page_id, url, length(html) AS n_chars, md5(html) AS html_md5 FROM pages",
        "seed_frontier": f"""
            SELECT 'http://' || domain || '/' AS url, domain, 'FRONTIER' AS page_type_code,
                   {AS_OF} AS time_added
            FROM hosts WHERE 'http://' || domain || '/' NOT IN (SELECT url FROM canon)""",
        "site_scan": "SELECT id, domain, coalesce(robots_content, '') AS robots_content FROM site",
        "binary_assets": """
            SELECT d.page_id, d.url, data_type_code, octet_length(encode(html)) AS n_bytes,
                   md5(html) AS data_md5
            FROM document_rows d JOIN files f ON f.url = d.url""",
        "image_assets": f"""
            SELECT i.page_id, i.url, filename, content_type, {AS_OF} AS accessed_time,
                   octet_length(encode(html)) AS n_bytes, md5(html) AS data_md5
            FROM image_rows i JOIN files f ON f.url = i.url""",
        "rejected_rows": f"""
            SELECT 'page' AS table_name, page_id, url, 'url longer than {COLUMN_LIMITS.url}' AS reason
            FROM page_links WHERE length(url) > {COLUMN_LIMITS.url}
            UNION ALL
            SELECT 'image', page_id, url, 'filename longer than {COLUMN_LIMITS.filename}'
            FROM image_rows WHERE length(filename) > {COLUMN_LIMITS.filename}""",
        "write_tables": """
            SELECT 'site' AS table_name, CAST(id AS VARCHAR) AS k1, domain AS k2, '' AS k3 FROM added_sites
            UNION ALL SELECT 'page', CAST(f.id AS VARCHAR), url, CAST(s.id AS VARCHAR) FROM added_pages f
                JOIN (SELECT id, domain FROM site UNION ALL SELECT id, domain FROM added_sites) s USING (domain)
            UNION ALL SELECT 'frontier', CAST(id AS VARCHAR), 'false', '' FROM added_pages
            UNION ALL SELECT 'link', CAST(page_id AS VARCHAR), CAST(id AS VARCHAR), '' FROM added_pages
            UNION ALL SELECT 'page_data', CAST(d.page_id AS VARCHAR), data_type_code, sha256(html)
                FROM document_rows d JOIN files f ON f.url = d.url
            UNION ALL SELECT 'image', CAST(i.page_id AS VARCHAR), filename, content_type || ' ' || sha256(html)
                FROM image_rows i JOIN files f ON f.url = i.url
            UNION ALL SELECT DISTINCT 'payload', sha256(html), CAST(octet_length(encode(html)) AS VARCHAR), '' FROM files""",
        "apply_updates": "SELECT * FROM next_pages",
        "frontier_remove": """
            SELECT page_id, time_added, occupied FROM queue
            WHERE page_id NOT IN (SELECT event_id FROM events WHERE event_type = 'purchase')""",
        "code_tables": f"""
            SELECT code_table, code, coalesce(n, 0) AS n_rows
            FROM (SELECT 'page_type' AS code_table, unnest([{_names(C.PAGE_TYPES)}]) AS code
                  UNION ALL SELECT 'data_type', unnest([{_names(C.DATA_TYPES)}]))
            LEFT JOIN (
                SELECT 'page_type' AS code_table, page_type_code AS code, count(*) AS n
                FROM moves GROUP BY ALL
                UNION ALL
                SELECT 'data_type', upper(regexp_extract(url, '[^.]*$')) AS code, count(*)
                FROM links WHERE cls = 'binary' GROUP BY ALL) USING (code_table, code)""",
        "url_split": "SELECT page_id, scheme, domain AS netloc, path FROM own",
        "url_scope": f"""
            SELECT page_id, domain AS netloc, regexp_matches(domain, {SCOPE}) AS in_scope FROM own""",
        "url_canonical": "SELECT page_id, pos, raw, url FROM any_links_urls WHERE source = 1",
        "url_site": f"SELECT page_id, url, {_domain('url')} AS domain FROM canon",
        "html_body": f"SELECT page_id, {BODY} AS body FROM pages WHERE html ILIKE '%<body%'",
        "links_href": f"SELECT {LINK_COLUMNS} FROM links WHERE source = 1",
        "links_onclick": f"SELECT {LINK_COLUMNS} FROM links WHERE source = 2",
        "links_img": f"SELECT {LINK_COLUMNS} FROM links WHERE source = 3",
        "link_class": """
            SELECT source, cls, count(*) AS n_links, count(DISTINCT url) AS n_urls
            FROM links WHERE source < 4 GROUP BY source, cls""",
        "links_all": "SELECT page_id, source, pos, url FROM page_links WHERE source < 3",
        "first_discovery": "SELECT url, page_id, from_url, source, pos FROM firsts",
        "unseen_urls": "SELECT url FROM fresh",
        "new_sites": f"""
            SELECT DISTINCT {_domain('url')} AS domain FROM page_links
            WHERE {_domain('url')} NOT IN (SELECT domain FROM site)""",
        "discovery_links": "SELECT from_url, url AS to_url FROM fresh",
        "discover": _discovery_rows("fresh"),
        "page_by_url": """
            SELECT l.page_id, l.url, p.id AS target_id FROM page_links l JOIN page_ids p ON p.url = l.url""",
        "new_links": """
            SELECT DISTINCT l.page_id AS from_page, p.id AS to_page
            FROM page_links l JOIN page_ids p ON p.url = l.url
            WHERE (l.page_id, p.id) NOT IN (SELECT (src, dst) FROM tree WHERE dst > src)""",
        "link_graph": """
            SELECT url, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (
                SELECT unnest([from_url, to_url]) AS url, unnest([1, 0]) AS o, unnest([0, 1]) AS i
                FROM (SELECT DISTINCT c.url AS from_url, l.url AS to_url
                      FROM page_links l JOIN canon c USING (page_id)
                      WHERE l.url IN (SELECT url FROM canon)))
            GROUP BY url""",
        "content_hash": f"SELECT page_id, md5({_normal(BODY)}) AS content_hash FROM pages",
        "content_dup": """
            SELECT id, content_hash, CASE WHEN row_number() OVER (
                       PARTITION BY content_hash ORDER BY id) = 1
                   THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code
            FROM doc_hashes""",
        "content_dup_semi": """
            SELECT id FROM (SELECT id, count(*) OVER (PARTITION BY content_hash) AS n FROM doc_hashes)
            WHERE n > 1""",
        "robots_rules": "SELECT domain, pos, allow, prefix FROM rules",
        "crawl_delay": "SELECT domain, delay FROM delays",
        "robots_verdict": "SELECT page_id, url, allowed FROM verdicts",
        "sitemap_url": r"""
            SELECT domain, nullif(trim(regexp_extract(robots_content, 'Sitemap: ([^\n]*)', 1),
                       chr(32) || chr(13)), '') AS sitemap_url
            FROM site WHERE nullif(regexp_extract(robots_content, 'Sitemap: ([^\n]*)', 1), '')
                IS NOT NULL""",
        "sitemap_locs": "SELECT domain, block, pos, loc FROM locs",
        "sitemap_frontier": f"""
            SELECT url, domain AS site_domain, {_domain('url')} AS url_host,
                   'FRONTIER' AS page_type_code, {AS_OF} AS accessed_time, {AS_OF} AS time_added
            FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY domain, block, pos) AS rn
                  FROM loc_urls WHERE NOT (starts_with(domain, 'th') AND block % 2 = 1))
            WHERE rn = 1 AND url NOT IN (SELECT url FROM page_links WHERE source < 3)""",
        "frontier_ready": "SELECT * FROM ready",
        "frontier_pop": "SELECT * FROM ready ORDER BY time_added, page_id LIMIT 1",
        "frontier_occupy": """
            SELECT page_id, time_added, occupied OR page_id = (
                       SELECT page_id FROM ready ORDER BY time_added, page_id LIMIT 1) AS occupied
            FROM queue""",
        "frontier_batch": """
            SELECT page_id, site_id, CAST(rn AS INTEGER) AS site_rank FROM (
                SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY time_added, page_id) AS rn
                FROM ready)
            WHERE rn <= 3""",
        "frontier_reset": "SELECT page_id, time_added, false AS occupied FROM queue",
        "frontier_give_back": f"""
            SELECT page_id, time_added, occupied AND site_id NOT IN (
                       SELECT id FROM queue_site WHERE next_acces > {AS_OF}) AS occupied
            FROM queue""",
        "frontier_requeue": f"""
            SELECT page_id, CASE WHEN occupied THEN {AS_OF} ELSE time_added END AS time_added,
                   false AS occupied FROM queue""",
        "fetch_schedule": SCHEDULE,
        "fetch_schedule_split": SCHEDULE.replace("FROM queue)", "FROM queue WHERE NOT occupied)"),
        # Ranks count within a third of the arrivals; sites that come later are open and slow until then.
        "stream_schedule": f"""
            SELECT page_id, site_id, row_number() OVER (PARTITION BY site_id, third ORDER BY time_added, page_id) AS site_rank,
                   CASE WHEN site_id % 4 <> 1 OR delay IS NULL THEN opens + to_seconds((rank - 1) * coalesce(delay, {C.DEFAULT_CRAWL_DELAY}))
                        WHEN third = 0 THEN {AS_OF} + to_seconds((rank - 1) * {C.DEFAULT_CRAWL_DELAY})
                        WHEN early = 0 THEN opens + to_seconds((rank - 1) * delay)
                        ELSE {AS_OF} + to_seconds(early * {C.DEFAULT_CRAWL_DELAY} + (rank - early - 1) * delay) END AS fetch_time
            FROM (SELECT page_id, site_id, time_added, third, greatest(coalesce(next_acces, {AS_OF}), {AS_OF}) AS opens, delay,
                         row_number() OVER (PARTITION BY site_id ORDER BY time_added, page_id) AS rank,
                         count(*) FILTER (third = 0) OVER (PARTITION BY site_id) AS early
                  FROM arrivals LEFT JOIN queue_site ON queue_site.id = site_id)""",
        "page_state": """
            SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'no response'
                     WHEN page_id % 10 < 3 THEN 'error' ELSE 'ok' END AS state FROM pages""",
        "page_transition": f"""
            SELECT page_id, CASE WHEN status IS NULL THEN 'FRONTIER'
                       WHEN status >= 400 THEN CASE WHEN old_status IS NULL THEN 'FRONTIER' ELSE 'HTML' END
                       WHEN has_body AND place > 1 THEN 'DUPLICATE' ELSE 'HTML' END AS page_type_code,
                   coalesce(status, old_status) AS http_status_code,
                   status IS NULL OR (status >= 400 AND old_status IS NULL) AS requeue, false AS requeue_final,
                   coalesce(status < 400 AND has_body AND place = 1, false) AS store_content
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY CASE WHEN status < 400 AND has_body THEN text END ORDER BY page_id) AS place
                  FROM (SELECT doc_id AS page_id, {_tight('text')} AS text, doc_id % 10 <> 3 AS has_body,
                               CAST(CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 404 WHEN 2 THEN 500 ELSE 200 END AS INTEGER) AS status,
                               CASE WHEN doc_id % 20 = 1 THEN 404 END AS old_status
                        FROM documents))""",
        "fk_violations": f"""
            SELECT constraint_name, CAST(value AS VARCHAR) AS value, count(*) AS n_rows FROM (
                SELECT 'frontier_page' AS constraint_name, CAST(event_id AS VARCHAR) AS value
                FROM events WHERE event_id NOT IN (SELECT page_id FROM pages)
                UNION ALL
                SELECT 'link_to_page', CAST(dst + 1 AS VARCHAR) FROM tree
                WHERE dst + 1 NOT IN (SELECT page_id FROM pages)
                UNION ALL
                SELECT 'page_data_data_type', upper(regexp_extract(url, '[^.]*$')) AS code
                FROM links WHERE cls = 'binary' AND code NOT IN ({_names(C.DATA_TYPES)}))
            GROUP BY ALL""",
        "crawl_report": """
            SELECT coalesce(domain, 'all') AS domain, coalesce(page_type_code, 'all') AS page_type_code,
                   coalesce(CAST(http_status_code AS VARCHAR), 'all or none') AS status,
                   grouping(domain, page_type_code, http_status_code) AS level, count(*) AS n_pages
            FROM next_pages GROUP BY ROLLUP (domain, page_type_code, http_status_code)""",
        "bfs_levels": """
            reach AS (
                SELECT url, 0 AS level FROM canon WHERE page_id IN (SELECT id FROM hosts)
                UNION
                SELECT e.to_url, level + 1 FROM reach JOIN edges e ON e.from_url = reach.url
                WHERE level < 40)
            -- result
            SELECT url, min(level) AS level FROM reach GROUP BY url""",
        "crawl_replay_links": "SELECT from_url, to_url FROM second_round WHERE rn = 1",
        "crawl_round": """
            SELECT id, site_id, url, page_type_code, http_status_code
            FROM (SELECT id, url, domain, page_type_code, http_status_code FROM db_updated
                  UNION ALL SELECT id, url, domain, 'FRONTIER', NULL FROM db_found)
            JOIN db_sites USING (domain)""",
        "crawl_replay": f"""
            reach AS (
                SELECT url, 0 AS level FROM seed
                UNION
                SELECT to_url, level + 1 FROM (
                    SELECT e.to_url, level FROM reach JOIN leads e ON e.from_url = reach.url
                    UNION ALL
                    SELECT s.url, level FROM reach
                    JOIN located s ON s.domain = {_domain('reach.url')})
                WHERE level < 40)
            -- result
            SELECT o.url, o.domain, page_type_code, http_status_code, min(level) AS round
            FROM reach JOIN outcomes o ON o.url = reach.url GROUP BY ALL""",
        "stream_new_urls": f"""
            SELECT DISTINCT url FROM (
                SELECT l.url FROM page_links l JOIN pages p USING (page_id)
                WHERE source < 3 AND contains(regexp_replace(p.html, '(?is)<!--.*?-->|<head>.*?</head>', '', 'g'),
                               'href="' || replace(l.raw, '&', '&amp;') || '"'))""",
    }
    result = {name: _with(body) for name, body in plain.items()}
    result["stream_content_dup"] = result["content_dup"]
    result["fetch_decision"] = _with(
        "SELECT page_id, url, domain, decision FROM decisions", robots="current"
    )
    result["site_update"] = _with(f"""
        SELECT domain, CASE WHEN c.first_visit OR fetched > 0
                   THEN {AS_OF} + to_seconds(greatest(fetched, CAST(c.first_visit AS INTEGER))
                       * CASE WHEN c.first_visit THEN delay ELSE stored END)
                   ELSE next_acces END AS next_acces,
               CAST(CASE WHEN c.first_visit THEN delay ELSE stored END AS INTEGER) AS delay
        FROM current c JOIN delays USING (domain)
        JOIN (SELECT domain, count(*) FILTER (decision = 'FETCH') AS fetched FROM decisions GROUP BY domain)
            USING (domain)""", robots="current")
    result["apply_forbidden"] = _with(f"""
        SELECT page_id AS id,
               CASE decision WHEN 'FORBIDDEN' THEN decision ELSE old_type END AS page_type_code,
               CASE WHEN decision <> 'FORBIDDEN' THEN old_status END AS http_status_code,
               CASE WHEN decision = 'FORBIDDEN' THEN {AS_OF} END AS accessed_time,
               decision <> 'FORBIDDEN' AS queued
        FROM decisions JOIN (SELECT page_id, old_type, old_status FROM response) USING (page_id)""",
        robots="current")
    result["process_batch"] = _with(f"""
        SELECT 'updated_page' AS table_name, CAST(page_id AS VARCHAR) AS k1, page_type_code AS k2,
               coalesce(CAST(http_status_code AS VARCHAR), '') AS k3 FROM judged
        UNION ALL SELECT 'content', CAST(page_id AS VARCHAR), md5({BODY}), '' FROM judged
            WHERE store_content
        UNION ALL SELECT 'hash', CAST(page_id AS VARCHAR),
                         CASE WHEN store_content THEN content_hash ELSE '' END, '' FROM judged
        UNION ALL SELECT 'removed', CAST(page_id AS VARCHAR), '', '' FROM judged WHERE NOT requeue
        UNION ALL SELECT 'page_data', CAST(d.page_id AS VARCHAR), data_type_code, sha256(f.html)
            FROM document_rows d JOIN files f ON f.url = d.url
        UNION ALL SELECT 'image', CAST(i.page_id AS VARCHAR), filename, content_type
            FROM image_rows i JOIN files f ON f.url = i.url
        UNION ALL {_discovery_rows("batch_found")}""", links="stored_links")
    return result
