"""DuckDB SQL the registered queries must equal."""

# Words: runs of anything but ASCII white space.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_RULES = {
    "short": "n_words < 50", "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * word_chars", "lines": "100 * n_dup_lines > 50 * n_lines",
}


def host_rules(documents: str = "documents") -> str:
    """(all columns of documents, counts, base_failed, host_rejected, kept)."""
    fails = ", ".join(f"sum(({c})::int)::DOUBLE AS f_{r}" for r, c in _RULES.items())
    totals = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}, sum(f_{r} * f_{r} / n) / sum(n) AS s_{r}" for r in _RULES)
    between = {r: f"(CASE WHEN m_{r} * (1 - m_{r}) > 0 AND luck < 1 THEN (s_{r} - m_{r} * m_{r} - m_{r} * (1 - m_{r}) * luck) / (m_{r} * (1 - m_{r}) * (1 - luck)) ELSE 0.0 END)" for r in _RULES}
    strength = {r: f"least(1e6, greatest(1.0, (1 - {b}) / greatest({b}, 1e-9)))" for r, b in between.items()}
    bad = " OR ".join(f"(f_{r} + {strength[r]} * m_{r}) / (n + {strength[r]}) > 0.5" for r in _RULES)
    return f"""
    WITH numbered AS (SELECT *, row_number() OVER () AS rid, {_WORDS} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM {documents}),
    windows AS (SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM numbered)),
    twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY rid),
    counted AS (SELECT d.* EXCLUDE (w, ls), len(w)::BIGINT AS n_words,
        length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
        FROM numbered d LEFT JOIN covered c USING (rid)),
    hosts AS (SELECT source, count(*)::DOUBLE AS n, {fails} FROM counted WHERE source IS NOT NULL GROUP BY source),
    fit AS (SELECT count(*) / sum(n) AS luck, {totals} FROM hosts),
    bad AS (SELECT source AS bad_source FROM hosts, fit WHERE {bad})
    SELECT counted.* EXCLUDE (rid), ({_RULES['short']} OR {_RULES['repetitive']}) AS base_failed, bad_source IS NOT NULL AS host_rejected,
        NOT ({_RULES['short']} OR {_RULES['repetitive']}) AND bad_source IS NULL AS kept
    FROM counted LEFT JOIN bad ON source = bad_source"""


HOST_RULES = f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({host_rules()})"


def mix(documents: str = "documents", seed: int = 17) -> str:
    """(all columns of documents, size, source_size, target, copies, taken)."""
    return f"""
    WITH sized AS (SELECT *, len({_WORDS})::BIGINT AS size FROM {documents}),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources),
    weighted AS (SELECT *, ([5.0, 2.0, 1.0])[((place - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM placed),
    ratios AS (SELECT *, cap / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM weighted),
    levels AS (SELECT *, (budget - (sum(cap) OVER (ORDER BY ratio, place ROWS UNBOUNDED PRECEDING) - cap))
        / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ratios),
    chosen AS (SELECT arg_min(level, place_in_line) AS level FROM (SELECT *, row_number() OVER (ORDER BY ratio, place) AS place_in_line FROM levels) WHERE level <= ratio),
    targets AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target,
        ('0x' || md5('{seed}|' || coalesce('s' || source, 'n'))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u FROM weighted),
    lined AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate, u,
        row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)), bin(size)[1:3],
            ('0x' || md5('{seed}|' || coalesce(doc_id::VARCHAR, 'n'))[1:8])::BIGINT, doc_id NULLS LAST, size) AS r
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
    copied AS (SELECT * EXCLUDE (rate, u, r), (floor(rate * r + u) - floor(rate * (r - 1) + u))::INT AS copies FROM lined)
    SELECT *, (copies * size)::BIGINT AS taken FROM copied"""


MIX = f"SELECT doc_id, size, source_size, target, taken FROM ({mix()})"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPS = f"""
    WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM sets GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON d.doc_id = c.a LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


TOP_K = """
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
        FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
    SELECT query_id, rank::INT AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""


HARD_NEGATIVES = """
    WITH whole AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS q
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
        FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    chosen AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM chosen JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
    SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10"""


def _draw(k: int) -> str:
    return f"('0x' || h[{8 * k + 1}:{8 * k + 8}])::BIGINT"


FILL_MIDDLE = f"""
    WITH worded AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, 'null')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u FROM documents),
    drawn AS (SELECT *, len(u)::BIGINT AS n, {_draw(0)} % (len(u) + 1) AS x, {_draw(1)} % (len(u) + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_draw(2)} % 100 >= 50 THEN 'plain'
             WHEN {_draw(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM worded),
    parts AS (SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s FROM drawn)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM parts"""
