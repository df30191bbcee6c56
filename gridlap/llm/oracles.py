"""SQL for the queries opN_<name> that SQL can express."""

from __future__ import annotations

from gridlap.llm.collocations import COVERED, LEAST, TOP
from gridlap.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS
from gridlap.llm.queries import SHARDS, URL_RULES

_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÑÓÔÖÚÜ"


def _jump(shards: int) -> str:
    """Each key's walk through the jumps; CRC-32 is taken byte by byte from a table of 256 remainders."""
    table = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END AS k FROM documents),
    walk AS (SELECT doc_id, k, 0::HUGEINT AS shard, 0::HUGEINT AS grown, 0::HUGEINT AS j, 0 AS n FROM (SELECT DISTINCT doc_id, k FROM d)
      UNION ALL SELECT doc_id, (k * 2862933555777941757 + 1) % 18446744073709551616, CASE WHEN j < {shards} THEN j ELSE shard END, j, ((j + 1) * 2147483648) // (((k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1), n + 1 FROM walk WHERE j <= {shards}),
    placed AS (SELECT doc_id, arg_max(shard, n)::INT AS shard, arg_max(grown, n)::INT AS grown_shard FROM walk GROUP BY 1),
    t AS (SELECT {table} AS t),
    b AS (SELECT doc_id, text, k, encode(text) AS e, hex(encode(text)) AS h FROM d),
    c AS (SELECT doc_id, k, octet_length(e) AS bytes, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)), lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]))) AS crc FROM b, t)
    SELECT doc_id, (bytes + 16)::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY ((((k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + crc) % 256)::INT, doc_id, crc, bytes) - 1 AS slot, grown_shard
    FROM c JOIN placed USING (doc_id)"""


def _rules() -> str:
    within = [f"{name} >= {low}" for name, low, _ in RULES if low is not None] + [f"{name} <= {high}" for name, _, high in RULES if high is not None]
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""WITH a AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS w FROM a),
    tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
    rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY 1),
    lines AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM w),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      length(text) - length(translate(text, '{_LETTERS}', '')) AS n_upper, len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop, len(string_split(text, chr(10))) AS n_lines FROM lines LEFT JOIN rep USING (r)),
    s AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio, CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END AS upper_ratio, CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio, n_dup_lines / n_lines AS dup_line_ratio,
      n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(within)} AS kept FROM s"""


def _urls() -> str:
    listed = ", ".join(f"('{r}', '{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for r, v in URL_RULES)
    return rf"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    p AS (SELECT page_id, row_number() OVER () AS n, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
    r(rule, verdict, h, q) AS (VALUES {listed}),
    best AS (SELECT n, arg_max(rule, length(rule) * 1000 + length(h)) AS rule FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY 1)
    SELECT page_id, host, path, b.rule AS rule, coalesce(r.verdict, 'allow') AS verdict FROM p LEFT JOIN best b USING (n) LEFT JOIN r ON r.rule = b.rule"""


def _runs() -> str:
    """Words that are equal at a distance, grouped into stretches; a stretch is a run if no shorter period has one over it."""
    table = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
    return rf"""WITH t AS (SELECT {table} AS t), d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
    h AS (SELECT r, doc_id, w, len(w) AS n, CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]))) END AS h FROM d, t),
    a AS (SELECT *, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a, CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p FROM h),
    i AS (SELECT r, n, w, planted, a, p, unnest(range(n)) AS i FROM a), words AS (SELECT r, n, i, w[(CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END) + 1] AS x FROM i),
    pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.r = b.r AND a.x = b.x AND b.i > a.i AND b.i <= a.i + a.n // 4),
    islands AS (SELECT r, q, min(i) AS s, count(*) + q AS size FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pairs) GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
    runs AS (SELECT * FROM islands x WHERE NOT EXISTS (SELECT 1 FROM islands y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.s + y.size >= x.s + x.size)),
    best AS (SELECT r, count(*) AS n_runs, first(s ORDER BY size / q DESC, s, q) AS s, first(size ORDER BY size / q DESC, s, q) AS size, first(q ORDER BY size / q DESC, s, q) AS q, string_agg(concat(s, ',', size, ',', q, chr(10)), '' ORDER BY s, q) AS said FROM runs GROUP BY r),
    gone AS (SELECT DISTINCT r, unnest(range(s + q, s + size)) AS i FROM runs), left_ AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, size::BIGINT AS length, q::BIGINT AS period, (1000 * size // q)::BIGINT AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM d LEFT JOIN best USING (r) LEFT JOIN left_ USING (r)"""


def _collocations() -> str:
    """Every n-gram of a piece is counted as it stands; parts of a phrase are as frequent as it is."""
    return rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-]')) AS piece FROM d)), every AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
    i AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM i) GROUP BY ALL HAVING count(*) >= {LEAST}),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1), cuts AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS j FROM c),
    scored AS (SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, j, (2000000::HUGEINT * c.a // (l.f + r.f))::BIGINT AS score FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : j], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1 : c.k], ' ')),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inside AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, a, k, w, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)) GROUP BY 1, 2)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest LEFT JOIN inside USING (lang, phrase) JOIN every USING (lang) WHERE longer IS NULL OR 100::HUGEINT * longer < {COVERED}::HUGEINT * a QUALIFY rank <= {TOP}"""


ORACLES = {"op1_sharding": _jump(SHARDS), "op3_quality_rules": _rules(), "op8_url_filter": _urls(), "op11_periodic_runs": _runs(), "op12_collocations": _collocations()}
