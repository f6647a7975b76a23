"""DuckDB SQL per query, where SQL can express it."""

from __future__ import annotations

from repopulse.llm.divergence import COMMON_WORDS, Rules
from repopulse.llm.licenses import TEMPLATES

_RULES = Rules()


def _values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in p)) for p in pairs)


LICENSE_SCAN = rf"""
WITH templates AS (
    SELECT name, string_split(trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w
    FROM (VALUES {_values(list(TEMPLATES.items()))}) t(name, body)
), template_pairs AS (
    SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
    FROM templates
), normal AS (
    SELECT doc_id, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t
    FROM documents WHERE text IS NOT NULL
), split AS (
    SELECT doc_id, t, string_split(t, chr(10)) AS lines, regexp_split_to_array(t, '\n[ \n]*\n') AS blocks
    FROM normal
), passages AS (
    SELECT doc_id, 'line' AS kind, unnest(range(len(lines))) AS place, unnest(lines) AS words FROM split
    UNION ALL
    SELECT * FROM (
        SELECT doc_id, 'paragraph', unnest(range(len(blocks))), unnest(blocks) AS words FROM split
    ) WHERE contains(trim(words, ' ' || chr(10)), chr(10))
    UNION ALL SELECT doc_id, 'text', 0, t FROM split WHERE len(blocks) > 1
), worded AS (
    SELECT doc_id, kind, place,
           string_split(trim(regexp_replace(replace(words, chr(10), ' '), ' +', ' ', 'g')), ' ') AS w
    FROM passages
), pairs AS (
    SELECT doc_id, kind, place,
           list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
    FROM worded WHERE len(w) BETWEEN 2 AND 1000
), compared AS (
    SELECT doc_id, kind, place, name, len(p.pairs) AS n_bigrams,
           len(list_intersect(p.pairs, t.pairs)) AS shared,
           2 * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + len(t.pairs)) AS dice
    FROM pairs p JOIN template_pairs t ON len(p.pairs) < 3 * len(t.pairs)
), best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, kind, place ORDER BY dice DESC, name DESC) AS k
    FROM compared WHERE dice >= 0.8
)
SELECT doc_id, kind, CAST(place AS INTEGER) AS place, name AS license, shared, n_bigrams, dice
FROM best WHERE k = 1
"""

QUALITY_RULES = rf"""
WITH common(lang, term) AS (
    VALUES {_values([(k, w) for k, text in COMMON_WORDS.items() for w in text.split()])}
), docs AS (
    SELECT doc_id, lang, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), counted AS (
    SELECT doc_id, lang, len(w) AS n_words, w,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           length(t) AS n_chars,
           length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS upper,
           length(regexp_replace(t, '[^0-9]+', '', 'g')) AS digit,
           length(regexp_replace(t, '[^.,;:!?''"()-]+', '', 'g')) AS stop,
           length(regexp_replace(t, '[\p{{L}}0-9.,;:!?''"()\x20\x09-\x0D-]+', '', 'g')) AS other
    FROM docs
), classes AS (
    SELECT doc_id, lang, n_chars, unnest(['space', 'upper', 'digit', 'stop', 'other', 'letter']) AS class,
           unnest([n_chars - word_chars, upper, digit, stop, other,
                   word_chars - upper - digit - stop - other]) AS n
    FROM counted
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM counted WHERE len(w) >= 3)
), repeats AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p
          FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1)
    GROUP BY doc_id
), terms AS (
    SELECT doc_id, lower(word) AS term, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word FROM counted) WHERE lower(word) IN (SELECT term FROM common)
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(n_words) AS n FROM counted GROUP BY lang HAVING sum(n_words) > 0
), class_refs AS (
    SELECT lang, class, sum(c.n) / sum(sum(c.n)) OVER (PARTITION BY lang) AS q
    FROM classes c JOIN totals USING (lang) WHERE lang IN (SELECT lang FROM common) GROUP BY lang, class
), term_refs AS (
    SELECT c.lang, c.term, coalesce(s.n, 0) / t.n AS q
    FROM common c JOIN totals t USING (lang)
    LEFT JOIN (SELECT d.lang, term, sum(terms.n) AS n FROM terms JOIN counted d USING (doc_id) GROUP BY ALL) s
      ON c.lang = s.lang AND c.term = s.term
), word_refs AS (
    SELECT lang, term, q FROM term_refs
    UNION ALL SELECT lang, NULL, 1 - sum(q) FROM term_refs GROUP BY lang
), own AS (
    SELECT d.doc_id, r.lang, r.term, r.q, coalesce(t.n, 0) / d.n_words AS p
    FROM counted d JOIN term_refs r ON d.n_words > 0
    LEFT JOIN terms t ON t.doc_id = d.doc_id AND t.term = r.term
), word_bins AS (
    SELECT doc_id, lang, p, q FROM own
    UNION ALL
    SELECT o.doc_id, o.lang, 1 - sum(o.p), any_value(r.q)
    FROM own o JOIN word_refs r ON r.lang = o.lang AND r.term IS NULL GROUP BY o.doc_id, o.lang
), class_bins AS (
    SELECT doc_id, r.lang, n / n_chars AS p, q FROM classes c JOIN class_refs r USING (class) WHERE n_chars > 0
), distances AS (
    SELECT kind, doc_id, lang, sqrt(greatest(sum(
        CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS x
    FROM (SELECT 'words' AS kind, * FROM word_bins UNION ALL SELECT 'classes', * FROM class_bins)
    GROUP BY ALL
), nearest AS (
    SELECT w.doc_id, w.lang AS reference, w.x AS word_distance, c.x AS class_distance,
           row_number() OVER (PARTITION BY w.doc_id ORDER BY w.x, w.lang) AS k
    FROM distances w JOIN distances c ON w.kind = 'words' AND c.kind = 'classes'
     AND w.doc_id = c.doc_id AND w.lang = c.lang
), judged AS (
    SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, reference,
           n_words < {_RULES.least_words_base}
               OR 100 * coalesce(n_repeat_words, 0) > {_RULES.repeat_percent} * n_words AS base_failed,
           coalesce(n_chars >= {_RULES.least_chars} AND class_distance > {_RULES.class_distance}, false) AS odd_classes,
           coalesce(n_words >= {_RULES.least_words} AND word_distance > {_RULES.word_distance}, false) AS odd_words
    FROM counted c LEFT JOIN repeats USING (doc_id)
    LEFT JOIN nearest n ON n.doc_id = c.doc_id AND n.k = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR odd_classes OR odd_words) AS kept,
       CASE WHEN base_failed THEN 'base' WHEN odd_classes THEN 'classes' WHEN odd_words THEN 'words' END AS reason,
       reference
FROM judged
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM words WHERE len(w) >= 50
), hashed AS (
    SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS h FROM windows
), owned AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS owner FROM hashed
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM owned WHERE owner < doc_id
), removed AS (
    SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
), places AS (
    SELECT d.doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words d
), kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept
    FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(len(r.gone), 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

URL_FILTERS = r"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
           ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), rests AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                         ELSE '' END AS rest
    FROM pages
), parsed AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), fitting AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY p.page_id
                              ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
    FROM parsed p LEFT JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE k = 1
"""

# The checksum runs octet by octet over its table of 256 numbers, which is built here.
SHARDING = r"""
WITH step0 AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i)
), numbers AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS n
    FROM range(256) t(i)
), octets AS (
    SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
    SELECT doc_id, octet_length(encode(t)) + 8 AS size,
           xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(h), 2),
                   lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, n[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM octets, numbers
), placed AS (
    SELECT *, row_number() OVER w - 1 AS place,
           coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
           sum(size) OVER () AS total
    FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)
), cut AS (
    SELECT *, CAST((2 * start + size) * 24 // (2 * total) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       place - min(place) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

DECONTAMINATION = r"""
WITH texts AS (
    SELECT doc_id AS id, 'doc' AS kind, text FROM documents
    UNION ALL SELECT item_id, 'item', text FROM benchmark
), words AS (
    SELECT id, kind, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM texts
), item_windows AS (
    SELECT DISTINCT id, n, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT id, w, least(10, len(w)) AS n,
                 unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM words WHERE kind = 'item' AND len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT id, n, w, unnest(range(1, len(w) - n + 2)) AS i
          FROM words, lengths WHERE kind = 'doc' AND len(w) >= n)
), hits AS (
    SELECT d.id, d.n, d.i, b.id AS item FROM doc_windows d JOIN item_windows b USING (n, words)
), hit_words AS (
    SELECT id, count(DISTINCT p) AS n_hit
    FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY id
), hit_items AS (
    SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id
)
SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words USING (id) LEFT JOIN hit_items USING (id)
WHERE w.kind = 'doc'
"""

# Nodes are numbered per tree; every level is made from the one before it. Paths go the same way up.
MERKLE_MANIFEST = r"""
WITH RECURSIVE steps AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS n
    FROM range(256) t(i)
), fields AS (
    SELECT doc_id, lang, n_chars,
           coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS before,
           coalesce(octet_length(encode(text)) || ':' || text, '-') AS after,
           hex(encode(CAST(doc_id AS VARCHAR))) AS h
    FROM documents
), marked AS (
    SELECT *, coalesce(xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(h), 2),
                   lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, n[(xor(c, b) & 255) + 1]))) % 7 = 0, false) AS chosen
    FROM fields, steps
), leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree,
           sha256(before || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
           CASE WHEN chosen THEN sha256(
               before || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || after)
           END AS tampered
    FROM marked
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, place, leaf AS hash FROM numbered
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1
    GROUP BY tree, level, place // 2
), depths AS (
    SELECT tree, max(level) AS depth FROM nodes GROUP BY tree
), subroots AS (
    SELECT tree, hash, row_number() OVER (ORDER BY encode(tree)) - 1 AS place
    FROM nodes JOIN depths USING (tree) WHERE level = depth
), tops AS (
    SELECT 0 AS level, place, hash FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, place // 2
), root AS (
    SELECT hash AS root FROM tops ORDER BY level DESC LIMIT 1
), levels AS (
    SELECT tree, level, place, hash FROM nodes JOIN depths USING (tree) WHERE level < depth
    UNION ALL
    SELECT s.tree, d.depth + t.level, t.place, t.hash
    FROM tops t, subroots s JOIN depths d USING (tree) WHERE t.level > 0
    UNION ALL
    SELECT s.tree, d.depth, o.place, o.hash
    FROM subroots s JOIN depths d USING (tree), subroots o WHERE o.tree <> s.tree
), walk AS (
    SELECT n.tree, n.doc_id, 0 AS level, n.place AS place, '' AS proof,
           coalesce(n.tampered, n.leaf) AS folded, n.place AS leaf_place
    FROM numbered n
    UNION ALL
    SELECT w.tree, w.doc_id, w.level + 1, w.at // 2, proof || coalesce(o.hash, ''),
           sha256(CASE WHEN w.at % 2 = 0 THEN folded || coalesce(o.hash, '') ELSE o.hash || folded END),
           leaf_place
    FROM (
        SELECT w.*, CASE WHEN w.level = d.depth THEN s.place ELSE w.place END AS at
        FROM walk w JOIN depths d USING (tree) JOIN subroots s USING (tree)
        WHERE w.level < d.depth + (SELECT max(level) FROM tops)
    ) w LEFT JOIN levels o ON o.tree = w.tree AND o.level = w.level AND o.place = xor(w.at, 1)
)
SELECT n.doc_id, leaf, s.hash AS subroot, root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM numbered n JOIN depths d USING (tree) JOIN subroots s USING (tree)
JOIN walk w ON w.tree = n.tree AND w.leaf_place = n.place
 AND w.level = d.depth + (SELECT max(level) FROM tops), root
"""

# Costs of what follows, row by row from the last; then the edits, row by row from the first.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE steps AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS n
    FROM range(256) t(i)
), named AS (
    SELECT conv_id, coalesce('=' || conv_id, '') AS k, turn, coalesce(role, ' ') AS role,
           coalesce(text, ' ') AS text,
           hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
    FROM conversations
), faulty AS (
    SELECT *, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(h), 2),
                   lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, n[(xor(c, b) & 255) + 1]))) % 20 AS fault
    FROM named, steps
), damaged AS (
    SELECT k, turn, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy,
           CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM faulty WHERE fault <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS said, left(role, 1) AS kind
    FROM damaged
), judged AS (
    SELECT *, said = '' AS blank,
           said <> '' AND row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS copied,
           lag(kind) OVER (PARTITION BY k ORDER BY i) AS before
    FROM ordered
), coded AS (
    SELECT *, NOT blank AND NOT copied AND right(said, 1) NOT IN ('.', '!', '?') AS cut_off,
           CASE WHEN blank OR copied THEN 1000000 WHEN right(said, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS stay
    FROM judged
), ends AS (
    SELECT k, max(i) AS n FROM coded GROUP BY k
), back AS (
    SELECT k, n + 1 AS i, 0 AS v0, 6 AS v1, 3 AS v2, 0 AS v3 FROM ends
    UNION ALL
    SELECT k, i, least(b0, 3 + b2, 6 + b3), least(b1, 3 + b2, 6 + b3), least(b2, 3 + b3), least(b3, 3 + b2)
    FROM (
        SELECT c.k, c.i,
               least(4 + v0, stay + 3 + v2, CASE kind WHEN 's' THEN stay + v1 WHEN 'u' THEN stay + v2 ELSE 1000000 END) AS b0,
               least(4 + v1, stay + 3 + v2, CASE WHEN kind = 'u' THEN stay + v2 ELSE 1000000 END) AS b1,
               least(4 + v2, stay + 3 + v3, CASE WHEN kind = 'a' THEN stay + v3 ELSE 1000000 END) AS b2,
               least(4 + v3, stay + 3 + v2, CASE WHEN kind = 'u' THEN stay + v2 ELSE 1000000 END) AS b3
        FROM back b JOIN coded c ON c.k = b.k AND c.i = b.i - 1
    )
), walk AS (
    SELECT k, 1 AS i, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM ends
    UNION ALL
    SELECT k, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
           CASE WHEN edit = 'D' THEN q WHEN edit = 'K' AND kind = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END,
           audit || edit,
           CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                WHEN 'R' THEN list_append(lines, wanted || ':' || text) ELSE list_append(lines, wanted || ':') END
    FROM (
        SELECT w.*, c.kind, c.role, c.text, CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END AS wanted,
               CASE WHEN c.i IS NULL THEN 'I'
                    WHEN 4 + CASE q WHEN 0 THEN d.v0 WHEN 1 THEN d.v1 WHEN 2 THEN d.v2 ELSE d.v3 END = here THEN 'D'
                    WHEN 3 + CASE WHEN q = 2 THEN w.v3 ELSE w.v2 END = here THEN 'I'
                    WHEN stay + CASE WHEN kind = 's' AND q = 0 THEN d.v1 WHEN kind = 'u' AND q <> 2 THEN d.v2
                                     WHEN kind = 'a' AND q = 2 THEN d.v3 ELSE 1000000 END = here THEN 'K'
                    ELSE 'R' END AS edit
        FROM (
            SELECT w.*, b.v2, b.v3, CASE q WHEN 0 THEN b.v0 WHEN 1 THEN b.v1 WHEN 2 THEN b.v2 ELSE b.v3 END AS here
            FROM walk w JOIN back b USING (k, i)
        ) w
        LEFT JOIN coded c ON c.k = w.k AND c.i = w.i
        LEFT JOIN back d ON d.k = w.k AND d.i = w.i + 1
        WHERE c.i IS NOT NULL OR here > 0
    )
), repaired AS (
    SELECT w.k, audit, sha256(array_to_string(lines, chr(10))) AS digest
    FROM walk w JOIN ends e ON e.k = w.k AND w.i = e.n + 1
    WHERE q IN (0, 3)
), faults AS (
    SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (copied) AS duplicate,
           count(*) FILTER (cut_off) AS truncated,
           count(*) FILTER (before || kind NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY k
)
SELECT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(b.v0, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM named) n
LEFT JOIN faults USING (k) LEFT JOIN repaired USING (k) LEFT JOIN back b ON b.k = n.k AND b.i = 1
"""

LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
    SELECT doc_id, unnest(range(len(l))) AS place, unnest(l) AS line FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), frequent AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, coalesce(doc_id < last, false) AS gone FROM keyed k LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SQL: dict[str, str] = {
    "op2_license_scan": LICENSE_SCAN,
    "op3_quality_rules": QUALITY_RULES,
    "op4_url_filters": URL_FILTERS,
    "op5_sharding": SHARDING,
    "op7_decontamination": DECONTAMINATION,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op12_conversation_repair": CONVERSATION_REPAIR,
    "op13_line_dedup": LINE_DEDUP,
}
