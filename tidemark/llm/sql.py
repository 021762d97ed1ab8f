"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import quality, secret_scan, warc

_WHITE = r"[\x09-\x0D\x20]+"


def op1_quality_rules() -> str:
    rules = quality.RULES
    fails = lambda r, bound: f"100 * {r.part} > {bound} * {r.whole}"
    failed = ", ".join(f"sum(({fails(r, r.inner)})::INT) AS f_{r.name}" for r in rules)
    means = ", ".join(
        f"sum(f_{r.name}) / sum(n) AS m_{r.name}, coalesce(sum(f_{r.name}) FILTER (WHERE n > 1) / sum(n) FILTER (WHERE n > 1), 0) AS p_{r.name}, "
        f"coalesce(sum(f_{r.name} * (f_{r.name} - 1) / (n - 1)) FILTER (WHERE n > 1) / sum(n) FILTER (WHERE n > 1), 0) AS b_{r.name}"
        for r in rules
    )
    alike = lambda r: f"((b_{r.name} - p_{r.name} * p_{r.name}) / (p_{r.name} * (1 - p_{r.name})))"
    fitted = lambda r: (
        f"CASE WHEN p_{r.name} * (1 - p_{r.name}) <= 0 OR {alike(r)} <= 0 THEN {quality.MOST_WEIGHT} "
        f"ELSE least({quality.MOST_WEIGHT}, greatest({quality.LEAST_WEIGHT}, 1 / {alike(r)} - 1)) END"
    )
    rate = quality.HOST_RATE
    weight = lambda r: (
        f"CASE WHEN m_{r.name} < {rate} THEN least({quality.MOST_WEIGHT}, greatest({fitted(r)}, 1.000001 * (1 - {rate}) / ({rate}::DOUBLE - m_{r.name}))) "
        f"ELSE {fitted(r)} END"
    )
    convicted = ", ".join(
        f"(f_{r.name} + m_{r.name} * ({weight(r)})) / (n + ({weight(r)})) > {quality.HOST_RATE} AS c_{r.name}" for r in rules
    )
    rejected = " OR ".join(f"({fails(r, r.outer)}) OR (c_{r.name} AND {fails(r, r.inner)})" for r in rules)
    names = ", ".join(f"CASE WHEN c_{r.name} THEN '{r.name}' END" for r in rules)
    symbols = "".join("\\" + c for c in quality.SYMBOLS)
    base = f"(n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, list_filter(regexp_split_to_array(t, '{_WHITE}'), lambda x: x <> '') AS w FROM texts),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x09-\\x0D\\x20]')) AS l FROM texts),
counts AS (
  SELECT rid, doc_id, host, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_WHITE}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[{symbols}]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper
  FROM texts JOIN words USING (rid) JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
hosts AS (SELECT host, count(*) AS n, {failed} FROM counts GROUP BY host),
prior AS (SELECT {means} FROM hosts),
verdicts AS (SELECT host, {convicted} FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed,
  NOT ({base} OR {rejected}) AS kept, concat_ws(',', {names}) AS host_convicted
FROM counts JOIN verdicts ON counts.host IS NOT DISTINCT FROM verdicts.host
"""


def op4_secret_scan() -> str:
    quoted = lambda s: s.replace("'", "''")
    scans = []
    for i, r in enumerate(secret_scan.RULES):
        scans.append(f"""SELECT rid, {i} AS place, '{r.kind}' AS kind, {r.group} AS grp, {r.least} AS least, '{quoted(r.pattern)}' AS pat,
  string_split(regexp_replace(t, '{quoted(r.pattern)}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS p FROM texts""")
    union = "\nUNION ALL\n".join(scans)
    kept = " ".join(
        f"WHEN place = {i} THEN length(regexp_extract(m, '{quoted(r.pattern)}', {r.group})) >= {r.least}"
        for i, r in enumerate(secret_scan.RULES)
    )
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)
    last = len(secret_scan.BASE)
    written = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
cut AS ({union}),
pieces AS (SELECT rid, place, kind, unnest(p) AS x, generate_subscripts(p, 1) AS k FROM cut WHERE len(p) > 1),
placed AS (SELECT rid, place, kind, k, split_part(x, chr(2), 1) AS m,
  sum(length(x) - (k > 1)::INT) OVER (PARTITION BY rid, place ORDER BY k) - (length(x) - (k > 1)::INT) AS s FROM pieces),
spans AS (SELECT rid, place, kind, s::BIGINT AS s, (s + length(m))::BIGINT AS e FROM placed WHERE k > 1 AND CASE {kept} END),
found AS (SELECT rid, {counts}, {written} FILTER (WHERE place < {last}) AS base, {written} AS spans FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}' for r in secret_scan.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (rid)
"""


def op5_warc() -> str:
    letters = " || ".join(
        f"substr('{warc.ALPHABET}', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)"
        for g in range(8) for s in (15, 10, 5, 0)
    )
    return f"""
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS f FROM payloads)
SELECT page_id, payload_bytes, {letters} AS payload_digest,
  CASE WHEN f IS NOT DISTINCT FROM page_id OR f IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f IS DISTINCT FROM page_id THEN f END AS refers_to
FROM firsts
"""


def op6_spherical_filters(cosine: float = 0.93) -> str:
    return f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (SELECT * FROM rows WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rid <> b.rid
  WHERE list_cosine_similarity(a.v, b.v) >= {cosine}),
reach(a, b) AS (SELECT rid, rid FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS rid, min(vec_id) AS component_id FROM reach JOIN rows ON rid = b GROUP BY a),
counts AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN least USING (rid) LEFT JOIN counts USING (rid)
"""


def op11_centroids(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    parts = [f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (SELECT rid, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INT AS j, v
  FROM kept QUALIFY j < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""e{r} AS (SELECT j, generate_subscripts(v, 1) AS d, unnest(v) AS y FROM c{r}),
s{r} AS (SELECT rid, j, sum((x - y) * (x - y))::BIGINT AS far FROM cells JOIN e{r} USING (d) GROUP BY rid, j),
a{r} AS MATERIALIZED (SELECT rid, arg_min(j, (far, j)) AS j, min(far) AS far FROM s{r} GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT j, d, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r} JOIN cells USING (rid) GROUP BY j, d),
f{r} AS (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS v FROM m{r} GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT j, coalesce(f{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN f{r} USING (j))""")
    end = rounds
    return ",\n".join(parts) + f""",
i AS (SELECT j, sum(far)::BIGINT AS cluster_inertia FROM a{end} GROUP BY j)
SELECT vec_id, a{end}.j AS "cluster", far AS distance, cluster_inertia, (SELECT sum(far)::BIGINT FROM a{end}) AS inertia,
  sha256(array_to_string(c{end}.v, ',')) AS centroid_sha256
FROM kept JOIN a{end} USING (rid) JOIN i ON i.j = a{end}.j JOIN c{end} ON c{end}.j = a{end}.j
"""


def op12_block_topk(every: int = 100, k: int = 10) -> str:
    return f"""
WITH rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
widest AS (SELECT max(len(v)) AS dims FROM rows),
full_rows AS MATERIALIZED (SELECT rid, vec_id, list_concat(v, list_transform(range(dims - len(v)), lambda x: 0::DOUBLE)) AS v FROM rows, widest),
scored AS (SELECT q.rid AS q, q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v, c.v) END::BIGINT AS score
  FROM full_rows q JOIN full_rows c ON q.rid <> c.rid WHERE q.vec_id % {every} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS FIRST))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {k}
"""


def op13_divergence(least_docs: int = 3, top: int = 200) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
words AS MATERIALIZED (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n_all FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= {least_docs}),
langs AS (SELECT lang, count(*) AS v, sum(n_all) AS total FROM kept GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
groups AS MATERIALIZED (SELECT g.lang, g.source, coalesce(s.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes s USING (lang, source)),
shares AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
  1 + 1000000000::HUGEINT * (k.n_all + 1) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""


SQL: dict[str, str] = {f.__name__: f() for f in (op1_quality_rules, op4_secret_scan, op5_warc, op6_spherical_filters, op11_centroids, op12_block_topk, op13_divergence)}
