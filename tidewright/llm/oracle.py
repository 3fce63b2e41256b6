"""DuckDB SQL of the corpus queries that SQL can express."""

from tidewright.llm.license_scan import TEMPLATES
from tidewright.llm.secret_scan import ALLOWED, CLASSES, KINDS, SEPARATORS, highest_sum

_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, lower(source) AS host FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT r, unnest(range(1, len(w) - 3)) AS p, w FROM w WHERE len(w) >= 5),
grams AS (SELECT r, p, array_to_string(w[p:p+4], ' ') AS g FROM win),
twice AS (SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS nx
          FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT r, sum(least(5, coalesce(nx - p, 5))) AS n FROM twice GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT d.doc_id, d.host, len(w.w)::BIGINT AS n_words,
             length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s),
h AS (SELECT host, rule, count(*) AS n, sum(failed::BIGINT)::DOUBLE AS f
      FROM (SELECT host, unnest([1, 2, 3]) AS rule,
                   unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, base_failed]) AS failed FROM b WHERE host IS NOT NULL)
      GROUP BY host, rule),
m AS (SELECT rule, sum(f) / sum(n) AS mean, sum(n) AS n, count(*)::DOUBLE / sum(n) AS chance, sum(f * f / n) / sum(n) AS s FROM h GROUP BY rule),
v AS (SELECT rule, mean, chance, (s - mean * mean - mean * (1 - mean) * chance) / nullif(1 - chance, 0) AS v FROM m),
k AS (SELECT rule, mean, CASE WHEN v > 1e-12 THEN greatest(2.0, least(1e6, mean * (1 - mean) / v - 1)) ELSE 1e6 END AS k FROM v),
bad AS (SELECT DISTINCT host FROM h JOIN k USING (rule) WHERE (f + mean * k) / (n + k) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(b.host IN (SELECT host FROM bad), false) AS kept, b.host,
       coalesce(b.host IN (SELECT host FROM bad), false) AS host_failed
FROM b
"""

_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
)
_TAIL = r"[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)$"
_RUNS = {3 + k: "[" + c.letters.replace("-", "") + ("-" if "-" in c.letters else "") + f"]{{{c.window},}}" for k, c in enumerate(CLASSES)}
_TAKEN = " UNION ALL ".join(
    f"SELECT r, {k} AS k, regexp_extract_all(t, '{run}') AS m, string_split_regex(t, '{run}') AS g FROM d"
    for k, run in {0: _ASSIGN, 1: "AKIA[A-Z0-9]+", 2: "[0-9a-f]+", **_RUNS}.items()
)
_ALLOWED = " OR ".join(f"regexp_matches(y, '{pattern}')" for pattern in ALLOWED)
_MOST = " ".join(
    f"WHEN {3 + k} THEN CASE WHEN {' AND '.join(f"regexp_matches(z, '{m}')" for m in c.mixed)} "
    f"THEN {highest_sum(c)} ELSE {highest_sum(c, False)} END"
    for k, c in enumerate(CLASSES)
)
_NAMES = ", ".join(f"({k}, '{name}')" for k, name in enumerate(KINDS))
_SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p(k, name) AS (VALUES {_NAMES}),
taken AS ({_TAKEN}),
items AS (SELECT r, k, i, m[i] AS x, length(g[i]) AS gap FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM taken)),
placed AS (SELECT r, k, x, (sum(gap + length(x)) OVER (PARTITION BY r, k ORDER BY i))::BIGINT AS e FROM items),
cand AS (SELECT DISTINCT k, x FROM placed WHERE k >= 3),
parts AS (SELECT k, x, unnest(string_split(array_to_string(list_transform(string_split_regex(x, '{SEPARATORS}'),
              lambda y: CASE WHEN {_ALLOWED} THEN '~' ELSE y END), '/'), '~')) AS z FROM cand),
long AS (SELECT DISTINCT k, x, z, CASE k {_MOST} END AS most FROM parts WHERE length(z) >= 24),
wins AS (SELECT k, x, z, most, p, unnest(string_split(substr(z, p, 24), '')) AS ch
         FROM (SELECT *, unnest(range(1, length(z) - 22)) AS p FROM long WHERE most >= 0)),
sums AS (SELECT k, x, z, most, p, sum(round(1e6 * c * log2(c))::BIGINT) AS s
         FROM (SELECT k, x, z, most, p, ch, count(*) AS c FROM wins GROUP BY ALL) GROUP BY ALL),
dense AS (SELECT DISTINCT k, x FROM sums WHERE s <= most),
good AS (SELECT r, k, e - length(x) AS s, e FROM placed
    WHERE CASE k WHEN 0 THEN length(regexp_extract(x, '{_TAIL}', 1)) >= 12 WHEN 1 THEN length(x) >= 18
               WHEN 2 THEN length(x) >= 16 ELSE (k, x) IN (SELECT (k, x) FROM dense) END),
out AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c,
    string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
    string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
    FROM good JOIN p USING (k) GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN out USING (r)
"""

_NOTICES = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(TEMPLATES.items()))
_LICENSES = rf"""
WITH t(template, text) AS (VALUES {_NOTICES}),
tw AS (SELECT template, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM t),
tg AS (SELECT DISTINCT template, array_to_string(w[p:p+4], ' ') AS g
       FROM (SELECT template, w, unnest(range(1, len(w) - 3)) AS p FROM tw WHERE len(w) >= 5)),
tn AS (SELECT template, count(*) AS n FROM tg GROUP BY template),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, p - 1 AS p, array_to_string(w[p:p+4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
hit AS (SELECT doc_id, template, n, p, g.g FROM g JOIN tg USING (g) JOIN tn USING (template)),
begun AS (SELECT doc_id, template, n, p AS a FROM hit UNION SELECT doc_id, template, n, p // n * n FROM hit
          UNION SELECT doc_id, template, n, (p // n - 1) * n FROM hit WHERE p >= n),
win AS (SELECT b.doc_id, b.template, a, a % b.n = 0 AS even, count(DISTINCT g) / any_value(b.n) AS containment
        FROM begun b JOIN hit h ON b.doc_id = h.doc_id AND b.template = h.template AND h.p BETWEEN a AND a + 2 * b.n - 1
        GROUP BY ALL),
held AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY containment DESC, even DESC, a) AS i,
                count(*) FILTER (even) OVER (PARTITION BY doc_id, template) AS n_windows
         FROM win WHERE containment >= 0.8)
SELECT doc_id, template, containment, a::INTEGER AS first_word, n_windows FROM held WHERE i = 1
"""

_FINGERPRINTS = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER w AS u,
                  first_value(coalesce(text, '')) OVER w AS first FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, t, coalesce(u, first) AS u, length(t) // 3 AS k FROM n),
x AS (SELECT doc_id, t, u, substr(t, 1, length(t) - k) || substr(u, 1, k) AS e FROM e),
w AS (SELECT DISTINCT t, list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w
      FROM (SELECT t FROM x UNION ALL SELECT e FROM x)),
g AS (SELECT t, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p, w FROM w WHERE len(w) > 0),
h AS (SELECT DISTINCT t, substr(md5(array_to_string(w[p:p+4], ' ')), 1, 16) AS h FROM g),
s AS (SELECT t, coalesce(list(h ORDER BY h) FILTER (h < '2'), [min(h)]) AS s FROM h GROUP BY t),
j AS (SELECT x.*, coalesce(a.s, []::VARCHAR[]) AS a, coalesce(c.s, []::VARCHAR[]) AS c, coalesce(z.s, []::VARCHAR[]) AS z
      FROM x LEFT JOIN s a ON a.t = x.t LEFT JOIN s c ON c.t = x.e LEFT JOIN s z ON z.t = x.u),
v AS (SELECT *, len(list_intersect(a, c)) AS ac, len(list_intersect(a, z)) AS az FROM j)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(e) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(c, '') AS edited_fingerprint,
       CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE ac / (len(a) + len(c) - ac) END AS near_edited,
       CASE WHEN len(a) + len(z) = 0 THEN 1.0::DOUBLE ELSE az / (len(a) + len(z) - az) END AS near_next,
       CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE ac / len(a) END AS held_by_edited,
       CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE az / len(a) END AS held_by_next
FROM v
"""

_PHRASES = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM w),
f AS (SELECT lang, n, array_to_string(w[p:p + n - 1], ' ') AS phrase, count(*)::HUGEINT AS f
      FROM places, (VALUES (1), (2), (3)) v(n) WHERE p + n - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
cuts AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, n)) AS k FROM f WHERE n > 1),
scores AS (SELECT c.lang, c.n, c.phrase, a, k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(w[k:k + 1], ' ') AS phrase, max(a) AS a FROM cuts WHERE n = 3 GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE o.a IS NULL OR b.n = 3 OR 100 * o.a < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, totals.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

#: The same for documents under hosts by their length.
_RULES_BY_LENGTH = _RULES.replace("lower(source) AS host", "'len-' || CAST(least(n_chars // 40, 50) AS VARCHAR) AS host")

ORACLE = {
    "op1_secret_scan": _SECRETS,
    "op9_quality_rules": _RULES,
    "rules_by_length": _RULES_BY_LENGTH,
    "op10_license_scan": _LICENSES,
    "op12_document_fingerprints": _FINGERPRINTS,
    "op13_collocations": _PHRASES,
}
