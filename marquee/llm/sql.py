"""SQL of the queries that SQL can express on whole tables."""

from ..plans import listing_sql as fixed

_list = lambda values: ",".join(f"'{v}'" for v in values)
_BLOCKED = " OR ".join(f"contains(a, '{p}')" for p in fixed.BLOCKED_PARTS)
_MACHINE = " OR ".join(f"dom = '{d}' OR ends_with(dom, '.{d}')" for d in fixed.MACHINE_DOMAINS)

SQL = {
    # the rule that the prior odds of p6_found express; equal days or lengths have no SQL form
    "p6_found": f"""
WITH o AS (SELECT key, name, website, email, coalesce(try_cast(trim(contact_checked) AS DATE), DATE '1900-01-01') AS d, lower(trim(email)) AS a,
             CASE WHEN starts_with(trim(website), 'http://') OR starts_with(trim(website), 'https://') THEN trim(website) ELSE 'http://' || trim(website) END AS u FROM organizations),
x AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(u, '^https?://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '') AS host,
        CASE WHEN contains(a, '@') THEN regexp_extract(a, '^(.*)@[^@]*$', 1) ELSE a END AS box, regexp_extract(a, '@([^@]*)$', 1) AS dom FROM o),
c AS (SELECT key, 'name' AS field, name AS value, regexp_matches(name, '\\p{{Lu}}') AND regexp_matches(name, '\\p{{Ll}}') AS ok, length(name) AS rank FROM x
  UNION ALL SELECT key, 'website', website, trim(website) <> '' AND length(host) <= 253 AND regexp_matches(lower(host), '^([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?\\.)+[a-z]{{2,63}}$'), d - DATE '1900-01-01' FROM x
  UNION ALL SELECT key, 'email', email, regexp_matches(a, '^[^@\\s]+@[^@\\s]+\\.[a-z]{{2,}}$')
      AND dom NOT IN ({_list(fixed.PLACEHOLDER_DOMAINS)})
      AND NOT ({_MACHINE})
      AND box NOT IN ({_list([*fixed.PLACEHOLDER_MAILBOXES, *fixed.UNATTENDED_MAILBOXES])})
      AND NOT ({_BLOCKED}), d - DATE '1900-01-01' FROM x),
n AS (SELECT key, field FROM c WHERE key IS NOT NULL AND trim(value) <> '' GROUP BY key, field HAVING count(DISTINCT value) > 1)
SELECT c.key, c.field, max_by(value, (rank, value)) AS kept FROM c JOIN n ON c.key = n.key AND c.field = n.field WHERE ok AND trim(value) <> '' GROUP BY c.key, c.field""",
}
