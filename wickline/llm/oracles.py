"""DuckDB SQL of the numbered queries that SQL can express."""

OP2 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length('<s>[INST]  [/INST]</s>')
    + length(regexp_replace(regexp_replace(role, '\[(~*)(/?INST\])', '[~\1\2', 'g'), '<(~*)(/?s>)', '<~\1\2', 'g'))
    + length(regexp_replace(regexp_replace(text, '\[(~*)(/?INST\])', '[~\1\2', 'g'), '<(~*)(/?s>)', '<~\1\2', 'g')) AS chars,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), ends AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR place = turns THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM ends GROUP BY conv_id
"""

OP7 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

ORACLES = {"op2_chat_format": OP2, "op7_exact_dedup": OP7}

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i : i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * o >= 75 * (x.n + y.n - o)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM reached LEFT JOIN sizes ON a = doc_id GROUP BY a
"""
ORACLES["op6_jaccard_join"] = OP6


def _last(host: str, labels: int) -> str:
    return f"array_to_string(list_slice(string_split({host}, '.'), -{labels}, -1), '.')"


def _strength(groups: str) -> str:
    """Prior strength of the groups (n, good, prior): 1 / rho - 1, rho within its bounds."""
    return f"""(SELECT 1 / least(0.5, greatest(0.001, CASE WHEN k > 1 AND total > k THEN
        CASE WHEN b + ((total - nn / total) / (k - 1) - 1) * w > 0
             THEN (b - w) / (b + ((total - nn / total) / (k - 1) - 1) * w) ELSE 0.001 END ELSE 0.001 END)) - 1
      FROM (SELECT k, total, nn, between_ / nullif(k - 1, 0) AS b, within_ / nullif(total - k, 0) AS w
            FROM (SELECT count(*) AS k, sum(n) AS total, sum(n * n) AS nn,
                         sum(n * pow(good / n - prior, 2)) AS between_,
                         sum(n * (good / n) * (1 - good / n)) AS within_ FROM {groups})))"""


def _posterior(name: str, groups: str) -> str:
    return f"""{name} AS (SELECT *, prior * s + good AS alpha, (1 - prior) * s + n - good AS beta
  FROM {groups}, (SELECT {_strength(groups)} AS s))"""


_WIDE = "('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in')"
_PARTS = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
OP10 = f"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), {_PARTS}, 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), {_PARTS}, 2) AS path
  FROM pages
), parsed AS (
  SELECT *, CASE WHEN {_last('host', 2)} IN {_WIDE} THEN {_last('host', 3)} ELSE {_last('host', 2)} END AS domain,
    CASE WHEN {_last('host', 2)} IN {_WIDE} THEN {_last('host', 2)} ELSE {_last('host', 1)} END AS suffix
  FROM split
), hosts AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, CAST(count(*) AS DOUBLE) AS n,
    CAST(sum(quality) AS DOUBLE) AS good
  FROM parsed JOIN labels ON doc_id = page_id WHERE quality IS NOT NULL GROUP BY host
), everything AS (
  SELECT 1.0 + coalesce(sum(good), 0) AS alpha, 1.0 + coalesce(sum(n) - sum(good), 0) AS beta FROM hosts
), suffix_groups AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(alpha / (alpha + beta)) AS prior
  FROM hosts, everything GROUP BY suffix
), {_posterior('suffixes', 'suffix_groups')}, domain_groups AS (
  SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.good) AS good, any_value(s.alpha / (s.alpha + s.beta)) AS prior
  FROM hosts h JOIN suffixes s ON h.suffix = s.suffix GROUP BY h.suffix, h.domain
), {_posterior('domains', 'domain_groups')}, host_groups AS (
  SELECT h.host, h.n, h.good, d.alpha / (d.alpha + d.beta) AS prior
  FROM hosts h JOIN domains d ON h.domain = d.domain
), {_posterior('known', 'host_groups')}, scored AS (
  SELECT p.*, coalesce(k.alpha, d.alpha, s.alpha, e.alpha) AS a, coalesce(k.beta, d.beta, s.beta, e.beta) AS b
  FROM parsed p LEFT JOIN known k ON k.host = p.host LEFT JOIN domains d ON d.domain = p.domain
    LEFT JOIN suffixes s ON s.suffix = p.suffix, everything e
), bounded AS (
  SELECT *, a / (a + b) AS rate, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound
  FROM scored
), rules(rule_host, rule_path, says) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ruled AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(says, length(rule_host || rule_path)) AS says
  FROM (SELECT DISTINCT page_id, host, path FROM parsed) p JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT b.page_id, host, path, rule, coalesce(says, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict,
  round(rate, 6) AS rate, round(bound, 6) AS bound
FROM bounded b LEFT JOIN ruled r ON r.page_id = b.page_id
"""
ORACLES["op10_url_filter"] = OP10
