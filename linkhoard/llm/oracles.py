"""DuckDB SQL for the rows of the registered queries of the subpackage.

Stated for line dedup, decontamination, WARC and collocations. The other queries use hashes, tokenizers, trained models or parsers that SQL
has not, and are tested against brute force.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {}


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


# A base32 digit is five bits, found in two neighbouring hexadecimal digits.
_HEX = "(instr('0123456789abcdef', substr(h || '0', {at}, 1)) - 1)"
_DIGIT = f"substr('{_UPPER}234567', ((({_HEX.format(at='5 * i // 4 + 1')} * 16 + {_HEX.format(at='5 * i // 4 + 2')}) >> (3 - 5 * i % 4)) & 31) + 1, 1)"

ORACLES["op6_warc"] = f"""
    WITH hashed AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: {_DIGIT}), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM firsts"""

ORACLES["op8_decontamination"] = f"""
    WITH docs AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
    cut AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0),
    forms AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k : k + 9], ' ') AS form FROM cut),
    sizes AS (SELECT DISTINCT n FROM forms),
    spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, sizes),
    hits AS (SELECT doc_id, k, n, item FROM (SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS form FROM spots) JOIN forms USING (form, n)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

ORACLES["op10_line_dedup"] = """
    WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    numbered AS (SELECT doc_id, lines, unnest(range(0, len(lines))) AS line_no FROM split),
    lines AS (SELECT doc_id, line_no, list_filter(string_split(translate(lower(lines[line_no + 1]), chr(9) || chr(13) || chr(11) || chr(12), '    '), ' '),
                                                  lambda x: x <> '') AS w FROM numbered),
    firsts AS (SELECT w, len(w) AS n, array_to_string(w, ' ') AS whole, min({'d': doc_id, 'l': line_no}) AS first FROM lines WHERE len(w) > 0 GROUP BY w),
    spots AS (SELECT *, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 5),
    forms AS (SELECT whole, n, first, i, array_to_string(w[1 : i - 1] || w[i + 1 : n], ' ') AS form FROM spots),
    replaced AS (SELECT whole, first, min(first) OVER (PARTITION BY n, i, form) AS least FROM forms),
    removed AS (SELECT a.whole AS a, b.whole AS b, a.first > b.first AS later FROM forms a JOIN firsts b ON a.form = b.whole AND b.n = a.n - 1 AND b.n >= 5),
    near AS (SELECT whole FROM replaced WHERE least < first UNION SELECT CASE WHEN later THEN a ELSE b END FROM removed),
    gone AS (SELECT doc_id, line_no FROM (SELECT *, array_to_string(w, ' ') AS whole FROM lines WHERE len(w) > 0) JOIN firsts USING (whole)
             WHERE first <> {'d': doc_id, 'l': line_no} OR whole IN (SELECT whole FROM near)),
    per_doc AS (SELECT doc_id, count(*) AS n_dropped, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS dropped FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(dropped, '') AS dropped
    FROM split LEFT JOIN per_doc USING (doc_id)"""

ORACLES["op11_collocations"] = f"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
    sizes AS (SELECT unnest(range(1, 6)) AS k),
    spots AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, sizes),
    counts AS (SELECT lang, w[i : i + k - 1] AS p, count(*) AS f FROM spots GROUP BY ALL),
    candidates AS (SELECT lang, p, f FROM counts WHERE len(p) > 1 AND f >= 100),
    cut AS (SELECT lang, p, f, unnest(range(1, len(p))) AS k FROM candidates),
    scored AS (SELECT cut.lang, cut.p, cut.f AS a, k, x.f AS l, y.f AS r, n, 1000 * CAST(cut.f AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS score
               FROM cut JOIN counts x ON x.lang = cut.lang AND x.p = cut.p[1 : k] JOIN counts y ON y.lang = cut.lang AND y.p = cut.p[k + 1 :] JOIN totals ON totals.lang = cut.lang),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    inner_spots AS (SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i FROM candidates, (SELECT unnest(range(2, 5)) AS k) WHERE k < len(p)),
    inside AS (SELECT lang, p[i : i + k - 1] AS p, max(f) AS longer FROM inner_spots GROUP BY ALL),
    kept AS (SELECT weakest.*, array_to_string(p, ' ') AS phrase FROM weakest LEFT JOIN inside USING (lang, p) WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM kept QUALIFY rank <= 2000"""


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
