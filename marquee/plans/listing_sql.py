"""SQL of the listing queries."""

# The SQL has its own copies of the fixed values, so that a slip in the engine's shows.
T = "DATE '2026-08-01'"
# Names and codes of states and provinces.
_NAMED = "alabama AL,alaska AK,arizona AZ,arkansas AR,california CA,colorado CO,connecticut CT,delaware DE,florida FL,georgia GA,hawaii HI,idaho ID,illinois IL,indiana IN,iowa IA,kansas KS,kentucky KY,louisiana LA,maine ME,maryland MD,massachusetts MA,michigan MI,minnesota MN,mississippi MS,missouri MO,montana MT,nebraska NE,nevada NV,new hampshire NH,new jersey NJ,new mexico NM,new york NY,north carolina NC,north dakota ND,ohio OH,oklahoma OK,oregon OR,pennsylvania PA,rhode island RI,south carolina SC,south dakota SD,tennessee TN,texas TX,utah UT,vermont VT,virginia VA,washington WA,west virginia WV,wisconsin WI,wyoming WY,district of columbia DC,puerto rico PR"
_NAMED_CA = "alberta AB,british columbia BC,manitoba MB,new brunswick NB,newfoundland and labrador NL,nova scotia NS,northwest territories NT,nunavut NU,ontario ON,prince edward island PE,quebec QC,québec QC,saskatchewan SK,yukon YT"
_TERRITORIES = "VI GU AS MP"
# Words that do not tell organizations, or streets, apart; addresses that stand for none.
ORG_NOISE = r"\b(the|inc|incorporated|llc|ltd|limited|corp|corporation|co|company|dba|d b a|foundation|assn|association|society)\b"
STREET_NOISE = r"\b(street|st|avenue|ave|road|rd|drive|dr|boulevard|blvd|lane|ln|court|ct|place|pl|highway|hwy|route|rte|suite|ste|unit|apt|north|south|east|west|n|s|e|w|ne|nw|se|sw)\b"
PLACEHOLDER_DOMAINS = "domain.com mysite.com website.com example.com example.org yourdomain.com yoursite.com email.com address.com yourcompany.com company.com test.com".split()
MACHINE_DOMAINS = "group.calendar.google.com calendar.google.com".split()
PLACEHOLDER_MAILBOXES = "user example email yourname youremail your-email firstname firstname.lastname name test sample someone username myemail".split()
UNATTENDED_MAILBOXES = "noreply no-reply donotreply do-not-reply".split()
BLOCKED_PARTS = "example.com sentry.io wixpress.com squarespace.com godaddy.com wordpress.com @2x .png .jpg .jpeg .gif .webp .svg .css .js".split()
PREFERRED_MAILBOXES = "info boxoffice box_office admin contact hello office tickets theatre theater mail general".split()
_pairs = lambda named: [x.rsplit(" ", 1) for x in named.split(",")]
_names = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in _pairs(_NAMED) + _pairs(_NAMED_CA))
_us = ",".join(f"'{c}'" for c in [c for _, c in _pairs(_NAMED)] + _TERRITORIES.split())
_ca = ",".join(f"'{c}'" for _, c in _pairs(_NAMED_CA))
_codes = f"{_us},{_ca}"


def code(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) IN ({_codes}) THEN upper(trim({c})) ELSE CASE lower(trim({c})) {_names} ELSE trim({c}) END END"


def country(c: str) -> str:
    return f"CASE WHEN {c} IN ({_us}) THEN 'US' WHEN {c} IN ({_ca}) THEN 'CA' ELSE '' END"


def org(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '{ORG_NOISE}', ' ', 'g'), '\\s+', ' ', 'g'))"


def city(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


def key() -> str:
    return f"concat_ws('|', {org('organization')}, {city('city')}, upper({code('state')}))"


def street(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '{STREET_NOISE}', ' ', 'g'), '[^a-z0-9]', '', 'g')"


def title(c: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'), '\\s+', ' ', 'g')), '^(the|a|an) ', ''))"


def shouty(c: str) -> str:
    return f"regexp_matches(regexp_replace({c}, '[^\\p{{L}}]', '', 'g'), '^\\p{{Lu}}+$')"


KIND = "CASE WHEN start_date IS NULL OR end_date IS NULL THEN 'unknown' WHEN end_date < start_date THEN 'invalid' WHEN end_date - start_date <= 14 THEN 'performance run' WHEN end_date - start_date <= 120 THEN 'extended run' ELSE 'license window' END"


def url(c: str) -> str:
    full = f"CASE WHEN starts_with(trim({c}), 'http://') OR starts_with(trim({c}), 'https://') THEN trim({c}) ELSE 'http://' || trim({c}) END"
    host = f"regexp_replace(regexp_replace(regexp_extract({full}, '^https?://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')"
    return f"CASE WHEN trim({c}) <> '' AND length({host}) <= 253 AND regexp_matches(lower({host}), '^([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?\\.)+[a-z]{{2,63}}$') THEN {full} ELSE '' END"


GEO = f"""
WITH gp AS (SELECT seq, source, {city('city')} AS ck, state, country, lat, lng FROM productions),
r AS (SELECT ck, state AS rs, country AS rc, lat AS ry, lng AS rx, min(seq) AS rq FROM gp WHERE source = 'mti' AND lat IS NOT NULL AND lng IS NOT NULL AND state <> '' GROUP BY ALL),
o AS (SELECT * FROM gp WHERE state = '' OR country = ''),
bc AS (SELECT ck, min(rs) = max(rs) AS single, arg_min(rs, rq) AS s1, arg_min(rc, rq) AS c1 FROM r GROUP BY ck),
d AS (SELECT o.seq, 2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(ry) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(ry)) * pow(sin((radians(rx) - radians(lng)) / 2), 2)))) AS km, rs, rc, rq
      FROM o JOIN bc USING (ck) JOIN r USING (ck) WHERE NOT single AND lat IS NOT NULL AND lng IS NOT NULL),
ch AS (SELECT seq, arg_min(rs, (km, rq)) AS s2, arg_min(rc, (km, rq)) AS c2 FROM d WHERE km <= 60 GROUP BY seq),
w AS (SELECT o.seq, lat, lng FROM o LEFT JOIN bc USING (ck) LEFT JOIN ch USING (seq) WHERE NOT coalesce(single, false) AND s2 IS NULL AND lat IS NOT NULL AND lng IS NOT NULL),
g AS (SELECT w.seq, greatest(abs(i), abs(j)) AS ring, 2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(ry) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(ry)) * pow(sin((radians(rx) - radians(lng)) / 2), 2)))) AS km, rs, rc, rq
      FROM w, (SELECT unnest(range(-2, 3)) AS i) a, (SELECT unnest(range(-2, 3)) AS j) b JOIN r ON round_even(ry, 0) = round_even(lat, 0) + i AND round_even(rx, 0) = round_even(lng, 0) + j),
nh AS (SELECT seq, arg_min(rs, (ring, km, rq)) AS s3, arg_min(rc, (ring, km, rq)) AS c3 FROM g WHERE km <= 60 GROUP BY seq),
z AS (SELECT gp.seq, gp.state, gp.country, gp.state <> '' AND gp.country <> '' AS already, coalesce(single, false) AS single, s1, c1, s2, c2, s3, c3,
  CASE WHEN lat IS NULL OR lng IS NULL THEN '' WHEN lat >= 51 AND lng <= -130 THEN 'US' WHEN lat >= 49.5 THEN 'CA' WHEN lat >= 45 AND lng >= -95 THEN '' WHEN lat >= 24 AND lat < 49.5 THEN 'US' ELSE '' END AS cc
  FROM gp LEFT JOIN bc USING (ck) LEFT JOIN ch USING (seq) LEFT JOIN nh USING (seq)),
geo AS (SELECT seq,
  CASE WHEN state <> '' OR already THEN state WHEN single THEN s1 WHEN s2 IS NOT NULL THEN s2 WHEN s3 IS NOT NULL THEN s3 ELSE '' END AS geo_state,
  CASE WHEN country <> '' OR already THEN country WHEN single THEN c1 WHEN s2 IS NOT NULL THEN c2 WHEN s3 IS NOT NULL THEN c3 ELSE cc END AS geo_country,
  CASE WHEN already THEN 'already' WHEN single THEN 'city' WHEN s2 IS NOT NULL THEN 'city+distance' WHEN s3 IS NOT NULL THEN 'nearest' WHEN cc <> '' THEN 'coarse' ELSE 'unresolved' END AS geo_method FROM z)"""
# keys of organizations are made after places are resolved
REGISTRY = GEO + f""",
placed AS (SELECT productions.* REPLACE (geo_state AS state, geo_country AS country) FROM productions JOIN geo USING (seq)),
p AS (SELECT *, {key()} AS org_key, {url('org_website')} AS u, {shouty('organization')} AS loud FROM placed),
org_registry AS (SELECT org_key, arg_max(organization, (organization <> '', NOT loud, length(organization), -seq)) AS name, arg_min(city, seq) AS city, arg_min(state, seq) AS state,
  coalesce(arg_min(country, seq) FILTER (WHERE country <> ''), '') AS country, coalesce(arg_min(street, seq) FILTER (WHERE street <> ''), '') AS street,
  coalesce(arg_min(u, seq) FILTER (WHERE u <> ''), '') AS website, coalesce(arg_min(source, seq) FILTER (WHERE u <> ''), '') AS website_source,
  array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, count(*) AS production_count, min(seq) AS first_seq FROM p GROUP BY org_key)"""
SITES = REGISTRY + f""",
k AS (SELECT *, {street('street')} AS s, lower(trim(city)) AS c FROM org_registry),
lend AS (SELECT s, c, arg_min(website, first_seq) AS lent FROM k WHERE website <> '' AND s <> '' GROUP BY s, c),
sites AS (SELECT k.*, CASE WHEN website = '' AND lent IS NOT NULL THEN lent ELSE website END AS site, CASE WHEN website = '' AND lent IS NOT NULL THEN 'address-match' ELSE website_source END AS site_source
  FROM k LEFT JOIN lend USING (s, c))"""
SEEN = f"""
WITH l AS (SELECT key, coalesce(min(first_seen) FILTER (WHERE first_seen <> ''), '') AS known FROM sightings GROUP BY key),
news AS (SELECT DISTINCT p.key, coalesce(known, '2026-08-01') AS first_seen, '2026-08-01' AS last_seen, known IS NULL AS is_new FROM productions p LEFT JOIN l ON p.key = l.key WHERE p.key IS NOT NULL)"""
COUNTS = f"SELECT show_title, count(*) AS productions FROM productions WHERE start_date - {T} BETWEEN 30 AND 120 AND {KIND} <> 'license window' GROUP BY show_title"
FRESH = f"(contact_status IN ('found', 'no_website') OR coalesce({T} - try_cast(contact_checked AS DATE) < CASE contact_status WHEN 'found' THEN 365 WHEN 'error' THEN 7 ELSE 90 END, false))"
_a = "lower(trim(email))"
_box = f"CASE WHEN contains({_a}, '@') THEN regexp_extract({_a}, '^(.*)@[^@]*$', 1) ELSE {_a} END"
_dom = f"CASE WHEN contains({_a}, '@') THEN regexp_extract({_a}, '@([^@]*)$', 1) ELSE '' END"
_in = lambda xs: ",".join(f"'{x}'" for x in xs)
REJECT = (
    f"CASE WHEN {_a} = '' THEN 'empty' WHEN NOT regexp_matches({_a}, '^[^@\\s]+@[^@\\s]+\\.[a-z]{{2,}}$') THEN 'malformed' WHEN {_dom} IN ({_in(PLACEHOLDER_DOMAINS)}) THEN 'placeholder_domain' "
    + "WHEN " + " OR ".join(f"{_dom} = '{d}' OR ends_with({_dom}, '.{d}')" for d in MACHINE_DOMAINS) + " THEN 'machine_address' "
    + f"WHEN {_box} IN ({_in(PLACEHOLDER_MAILBOXES)}) THEN 'placeholder_mailbox' WHEN {_box} IN ({_in(UNATTENDED_MAILBOXES)}) THEN 'unattended_mailbox' "
    + "WHEN " + " OR ".join(f"contains({_a}, '{x}')" for x in BLOCKED_PARTS) + " THEN 'blocklisted' ELSE '' END"
)
RANK = "CASE " + " ".join(f"WHEN starts_with({_box}, '{m}') THEN {i}" for i, m in enumerate(PREFERRED_MAILBOXES)) + f" ELSE {len(PREFERRED_MAILBOXES)} END"
DIGITS = "regexp_replace(phone, '\\D', '', 'g')"
TEN = f"CASE WHEN length({DIGITS}) = 11 AND starts_with({DIGITS}, '1') THEN substr({DIGITS}, 2) ELSE {DIGITS} END"

REACHED = SITES + """,
kept AS (SELECT key AS org_key, arg_max(coalesce(email, ''), row_id) AS email, arg_max(coalesce(phone, ''), row_id) AS phone, arg_max(coalesce(facebook, ''), row_id) AS facebook, arg_max(coalesce(instagram, ''), row_id) AS instagram,
  arg_max(coalesce(contact_status, ''), row_id) AS contact_status, arg_max(coalesce(contact_checked, ''), row_id) AS contact_checked FROM organizations GROUP BY key),
reached AS (SELECT sites.*, coalesce(email, '') AS email, coalesce(phone, '') AS phone, coalesce(facebook, '') AS facebook, coalesce(instagram, '') AS instagram, coalesce(contact_status, '') AS contact_status, coalesce(contact_checked, '') AS contact_checked
  FROM sites LEFT JOIN kept USING (org_key))"""
NEXTS = REACHED + f""",
nexts AS (SELECT org_key, arg_min(key, (start_date, key)) AS key, min(start_date) AS start_date FROM p WHERE start_date >= {T} AND {KIND} <> 'license window' GROUP BY org_key)"""

SQL = {
    "scope_filter": f"SELECT seq, country, coalesce(strftime(end_date, '%Y-%m-%d'), '') AS end_date FROM productions WHERE country IN ('US', 'CA') AND (end_date IS NULL OR end_date >= {T})",
    "run_kinds": f"SELECT seq, coalesce(CAST(end_date - start_date AS VARCHAR), '') AS run_days, {KIND} AS run_kind FROM productions",
    "name_forms": f"""SELECT seq, {org('organization')} AS org_name, {key()} AS org_key, {street('street')} AS street_form, {title('show_title')} AS title_form, {shouty('organization')} AS shouty, {code('state')} AS state_code,
        {country(code('state'))} AS state_country, source || ':' || substr(sha1(lower(trim(organization)) || '|' || lower(trim(show_title))), 1, 16) AS content_key,
        regexp_replace(regexp_replace(lower(show_title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM productions""",
    "address_lines": "SELECT seq, array_to_string(list_filter([street, city, trim(CASE WHEN postal = '' THEN state WHEN state = '' THEN postal ELSE state || ' ' || postal END), CASE WHEN country = 'US' THEN '' ELSE country END], lambda x: x <> ''), ', ') AS address FROM productions",
    "union_floors": "SELECT s.source, count(p.key) AS rows, s.least, count(p.key) >= s.least AS ok FROM (VALUES ('mti', 1000), ('concord', 500), ('trw', 50)) s(source, least) LEFT JOIN productions p ON p.source = s.source GROUP BY s.source, s.least",
    "required_organization": "SELECT source, count(*) FILTER (WHERE trim(organization) <> '') AS kept, count(*) FILTER (WHERE trim(organization) = '') AS dropped FROM productions GROUP BY source",
    "box_scan": "SELECT source, count(*) AS rows FROM productions WHERE lat BETWEEN 23 AND 72 AND lng BETWEEN -172 AND -52 GROUP BY source",
    "box_quadrants": "SELECT q.* FROM (VALUES (0, 23.0, 47.5, -172.0, -112.0), (1, 23.0, 47.5, -112.0, -52.0), (2, 47.5, 72.0, -172.0, -112.0), (3, 47.5, 72.0, -112.0, -52.0)) q(quadrant, south, north, west, east) WHERE EXISTS (SELECT 1 FROM productions WHERE source = 'concord' AND lat BETWEEN south AND north AND lng BETWEEN west AND east)",
    "org_registry": REGISTRY + " SELECT * FROM org_registry",
    "org_sites": SITES + " SELECT org_key, site AS website, site_source AS website_source FROM sites",
    "site_writeback": SITES + " SELECT p.seq, p.org_key, CASE WHEN org_website = '' THEN coalesce(site, '') ELSE org_website END AS org_website FROM p LEFT JOIN sites ON p.org_key = sites.org_key",
    "org_coverage": SITES + """ SELECT count(*) AS orgs, count(*) FILTER (WHERE site <> '') AS with_website, count(*) FILTER (WHERE site <> '' AND sources <> 'mti' AND site_source IN ('mti', 'address-match')) AS cross_source_filled,
        CAST(round_even(100.0 * count(*) FILTER (WHERE site <> '') / count(*), 1) AS DOUBLE) AS pct_with_website FROM sites""",
    "org_sample": REGISTRY + """, so AS (SELECT org_key, max(CAST(org_website <> '' AS INT)) AS site, arg_min(source, seq) AS source, count(*) AS n FROM p GROUP BY 1),
        k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY site DESC, source, n DESC, org_key) AS r FROM so) SELECT org_key, source, n AS production_count FROM k ORDER BY r > 1, site DESC, source, n DESC, org_key LIMIT 50""",
    "geo_resolved": GEO + " SELECT * FROM geo",
    "geo_methods": GEO + " SELECT geo_method, count(*) AS rows FROM geo GROUP BY geo_method",
    "geo_cells": "SELECT seq, CAST(round_even(lat, 0) AS BIGINT) AS cell_lat, CAST(round_even(lng, 0) AS BIGINT) AS cell_lng, CASE WHEN lat >= 51 AND lng <= -130 THEN 'US' WHEN lat >= 49.5 THEN 'CA' WHEN lat >= 45 AND lng >= -95 THEN '' WHEN lat >= 24 AND lat < 49.5 THEN 'US' ELSE '' END AS coarse FROM productions WHERE lat IS NOT NULL AND lng IS NOT NULL",
    "first_rows": "SELECT key, min(seq) AS seq, arg_min(show_title, seq) AS show_title, arg_min(organization, seq) AS organization FROM productions GROUP BY key",
    "last_rows": "SELECT key, max(seq) AS seq, arg_max(show_title, seq) AS show_title, arg_max(organization, seq) AS organization FROM productions GROUP BY key",
    "distinct_runs": "SELECT organization, city, state, coalesce(strftime(start_date, '%Y-%m-%d'), '') AS start_date, coalesce(strftime(end_date, '%Y-%m-%d'), '') AS end_date, min(seq) AS seq FROM productions GROUP BY ALL",
    "seen_news": SEEN + " SELECT * FROM news",
    "new_by_source": SEEN + " SELECT split_part(lower(trim(key)), ':', 1) AS source, count(*) AS new_keys FROM news WHERE is_new GROUP BY 1",
    "ledger_upsert": """WITH o AS (SELECT key, min(first_seen) AS first_seen, min(source) AS source FROM sightings GROUP BY key), n AS (SELECT key, min(first_seen) AS first_seen, min(source) AS source FROM productions WHERE first_seen <> '' GROUP BY key)
        SELECT * FROM o WHERE key NOT IN (SELECT key FROM n) UNION ALL SELECT * FROM n""",
    "contact_freshness": f"SELECT row_id, {FRESH} AS fresh FROM organizations",
    "contact_disposition": f"""WITH o AS (SELECT key, arg_max({FRESH}, row_id) AS fresh, arg_min({url('website')}, row_id) AS u FROM organizations GROUP BY key)
        SELECT CASE WHEN fresh THEN 'fresh' WHEN u = '' THEN 'no_website' ELSE 'fetch' END AS disposition, count(*) AS organizations FROM o GROUP BY 1""",
    "email_checks": f"SELECT row_id, {REJECT} AS rejection, {_dom} AS domain, {RANK} AS mailbox_rank FROM organizations",
    "site_checks": f"SELECT row_id, {url('website')} AS url FROM organizations",
    "phone_forms": f"SELECT row_id, CASE WHEN length({TEN}) = 10 THEN '(' || substr({TEN}, 1, 3) || ') ' || substr({TEN}, 4, 3) || '-' || substr({TEN}, 7, 4) ELSE '' END AS phone FROM organizations",
    "title_counts": COUNTS,
    "link_merge": f"WITH n AS ({COUNTS}) SELECT coalesce(l.show_title, n.show_title) AS show_title, coalesce(sample_url, '') AS sample_url, coalesce(n.productions, l.productions) AS productions, coalesce(notes, '') AS notes FROM sample_links l FULL JOIN n ON l.show_title = n.show_title",
    "link_lookup": f"WITH l AS (SELECT {title('show_title')} AS t, arg_max(sample_url, file_row_number) AS sample_url FROM (SELECT *, row_number() OVER () AS file_row_number FROM sample_links) WHERE show_title <> '' AND sample_url <> '' GROUP BY 1) SELECT seq, coalesce(sample_url, '') AS sample_url FROM productions LEFT JOIN l ON {title('show_title')} = t",
    "production_sheet": REACHED + f""" SELECT show_title AS show, CASE WHEN venue <> '' THEN venue ELSE organization END AS venue, name AS organization,
        array_to_string(list_filter([p.street, p.city, trim(CASE WHEN postal = '' THEN p.state WHEN p.state = '' THEN postal ELSE p.state || ' ' || postal END), CASE WHEN p.country = 'US' THEN '' ELSE p.country END], lambda x: x <> ''), ', ') AS address,
        p.city, p.state, postal, p.country, coalesce(strftime(start_date, '%Y-%m-%d'), '') AS start, coalesce(strftime(end_date, '%Y-%m-%d'), '') AS end, coalesce(CAST(end_date - start_date AS VARCHAR), '') AS run_days, {KIND} AS date_type, venue_type,
        CASE WHEN org_website <> '' THEN org_website ELSE site END AS org_website, email, phone, facebook, instagram, upper(source) AS source, source_url, first_seen FROM p JOIN reached USING (org_key)""",
    "organization_sheet": REACHED + """ SELECT name AS organization, city, state, country, street AS address, site AS website, email, phone, facebook, instagram, production_count AS productions, replace(upper(sources), ',', ', ') AS licensors, contact_status, contact_checked AS last_checked FROM reached""",
    "contact_sheet": "SELECT key AS org_key, " + ", ".join(f"coalesce(arg_max({c}, row_id), '') AS {n}" for c, n in (("name", "name"), ("city", "city"), ("state", "state"), ("website", "website"), ("email", "email"), ("phone", "phone"), ("facebook", "facebook"), ("instagram", "instagram"), ("contact_status", "status"), ("contact_checked", "checked"))) + ", 'auto' AS source FROM organizations GROUP BY key",
    "next_shows": NEXTS + " SELECT org_key, key, strftime(start_date, '%Y-%m-%d') AS start_date FROM nexts",
    "shared_mailboxes": NEXTS + f""", boxes AS (SELECT org_key, lower(trim(email)) AS address, first_seq FROM reached WHERE ({REJECT}) = '')
        SELECT address, arg_min(org_key, (start_date, first_seq)) AS org_key, strftime(min(start_date), '%Y-%m-%d') AS start_date FROM nexts JOIN boxes USING (org_key) GROUP BY address""",
    "digest_top": SEEN + ", f AS (SELECT key, min(seq) AS seq, arg_min(show_title, seq) AS show_title, arg_min(organization, seq) AS organization FROM productions GROUP BY key) SELECT f.* FROM f JOIN news USING (key) WHERE is_new ORDER BY seq LIMIT 15",
    "run_log": "SELECT count(*) AS rows, count(*) FILTER (WHERE source = 'mti') AS mti, count(*) FILTER (WHERE source = 'concord') AS concord, count(*) FILTER (WHERE source = 'trw') AS trw, count(*) FILTER (WHERE country IN ('US', 'CA')) AS in_countries, count(DISTINCT key) AS keys, count(*) FILTER (WHERE org_website <> '') AS with_site FROM productions",
    "summary_sets": f"SELECT coalesce(source, '*') AS source, coalesce(kind, '*') AS kind, count(*) AS rows, CAST(GROUPING(source, kind) AS BIGINT) AS level FROM (SELECT source, {KIND} AS kind FROM productions) GROUP BY ROLLUP (source, kind)",
    "similar_fields": """WITH l AS (SELECT DISTINCT show_title AS t, list_distinct(list_filter(regexp_split_to_array(lower(show_title), '[^a-z0-9]+'), lambda w: w <> '')) AS a FROM sample_links)
        SELECT x.t AS wanted, y.t AS known, CAST(len(list_intersect(x.a, y.a)) AS BIGINT) AS shared FROM l x JOIN l y ON x.t < y.t WHERE len(list_intersect(x.a, y.a)) >= 1 AND (len(list_intersect(x.a, y.a)) >= 2 OR len(list_intersect(x.a, y.a)) = least(len(x.a), len(y.a)))""",
    "event_props": "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "stream_first_seen": "SELECT user_id, min(ts) AS first_seen FROM events GROUP BY user_id",
}
