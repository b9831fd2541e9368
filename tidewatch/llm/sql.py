"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def mixing_sql(share: tuple[int, int], weights: dict[str, dict[str, int]], max_epochs: int, seed: int) -> str:
    """Hierarchical budgeting: one share step a level, then epochs and prefix."""
    def weight(level: str) -> str:
        known = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in weights.get(level, {}).items())
        return f"CASE{known} ELSE 1 END" if known else "1"

    levels = ["domain", "language", "origin"]
    steps = ""
    for i, level in enumerate(levels):
        keys, parent = ", ".join(levels[:i + 1]), ", ".join(levels[:i])
        part = f"PARTITION BY {parent}" if parent else ""
        total = (f"JOIN b{i - 1} USING ({parent})" if i else
                 f"CROSS JOIN (SELECT floor(coalesce(sum(tokens), 0)::DOUBLE * {share[0]} / {share[1]})::BIGINT AS budget FROM leaves)")
        steps += f"""
        n{i} AS (SELECT x.*, budget AS total, CASE WHEN weight > 0 THEN cap::DOUBLE / weight ELSE 0.0 END AS ratio
          FROM (SELECT {keys}, sum(cap)::BIGINT AS cap, max(w_{level})::BIGINT AS weight FROM leaves GROUP BY {keys}) x {total}),
        f{i} AS (SELECT *, cap::DOUBLE * sum(weight) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT
            <= weight::DOUBLE * (total - coalesce(sum(cap) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS is_full
          FROM n{i}),
        b{i} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE least(cap, floor((total - spent)::DOUBLE * weight / nullif(open_, 0))::BIGINT) END AS budget
          FROM (SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0)::BIGINT AS spent,
                  sum(CASE WHEN NOT is_full THEN weight END) OVER ({part})::BIGINT AS open_ FROM f{i})),"""
    return f"""
        WITH d AS (SELECT doc_id, lang, source,
            CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
                 ELSE 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % 4)::VARCHAR END AS domain,
            coalesce(lang, '') AS language, coalesce(source, '') AS origin,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
          FROM documents),
        leaves AS (SELECT *, CASE WHEN w_domain > 0 AND w_language > 0 AND w_origin > 0 THEN tokens * {max_epochs} ELSE 0 END AS cap
          FROM (SELECT domain, language, origin, sum(n_tokens)::BIGINT AS tokens, {weight('domain')} AS w_domain,
                  {weight('language')} AS w_language, {weight('origin')} AS w_origin FROM d GROUP BY domain, language, origin)),{steps}
        plan AS (SELECT domain, language, origin, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
            CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaves JOIN b2 USING (domain, language, origin)),
        r AS (SELECT d.*, whole, rest, sum(n_tokens) OVER (PARTITION BY domain, language, origin
              ORDER BY md5('{seed}:' || (whole + 1)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, ''))) AS reach
          FROM d JOIN plan USING (domain, language, origin)),
        t AS (SELECT *, whole + CASE WHEN rest > 0 AND reach <= rest THEN 1 ELSE 0 END AS times FROM r)
        SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, times + 1))::INT AS epoch FROM t"""


def url_filter_sql(rules: list[tuple[str, str, str]], order: int, alphabet: int, held_out: str) -> str:
    """Rules, smoothed character models order by order, calibrated bar."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for h, p, _ in ranked]
    rule = "CASE" + "".join(f" WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, ranked)) + " END"
    label = "CASE" + "".join(f" WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, ranked)) + " END"
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    held = f"substr(md5(s), 1, 1) IN ({', '.join(repr(c) for c in held_out)})"
    grams = (f"SELECT *, substr(repeat(chr(2), {order}) || s || chr(3), i, {order + 1}) AS gram "
             "FROM (SELECT *, unnest(range(1, length(s) + 2)) AS i FROM {}) q")
    steps = f"p0 AS (SELECT DISTINCT gram, {1.0 / alphabet} AS pa, {1.0 / alphabet} AS pr FROM every_gram),"
    for k in range(order + 1):
        tail, context = f"substr(gram, {order + 1 - k}, {k + 1})", f"substr(gram, {order + 1 - k}, {k})"
        step = "CASE WHEN c{0} > 0 THEN (coalesce(n{0}, 0) + d{0} * p{0}) / (c{0} + d{0}) ELSE p{0} END AS p{0}"
        steps += f"""
        seen{k} AS (SELECT {tail} AS t, sum(a)::BIGINT AS na, sum(r)::BIGINT AS nr FROM counts GROUP BY 1),
        context{k} AS (SELECT substr(t, 1, {k}) AS c, sum(na)::BIGINT AS ca, sum(nr)::BIGINT AS cr,
            count(*) FILTER (na > 0) AS da, count(*) FILTER (nr > 0) AS dr FROM seen{k} GROUP BY 1),
        p{k + 1} AS (SELECT gram, {step.format('a')}, {step.format('r')} FROM p{k}
          LEFT JOIN seen{k} ON t = {tail} LEFT JOIN context{k} ON c = {context}),"""
    return f"""
        WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{pattern}', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '{pattern}', 2), '') AS path FROM pages),
        rows_ AS (SELECT *, {rule} AS rule, {label} AS label, host || path AS s FROM parts),
        urls AS (SELECT s, label, count(*) AS n FROM rows_ GROUP BY s, label),
        every_gram AS ({grams.format('urls')}),
        counts AS (SELECT gram, sum(CASE WHEN label = 'allow' THEN n ELSE 0 END)::BIGINT AS a,
            sum(CASE WHEN label = 'block' THEN n ELSE 0 END)::BIGINT AS r
          FROM every_gram WHERE label IS NOT NULL AND NOT {held} GROUP BY gram),
        {steps}
        ratios AS (SELECT gram, round((ln(pa) - ln(pr)) * 1000000)::BIGINT AS ratio FROM p{order + 1}),
        scored AS (SELECT s, label, n, greatest(least(floor(total / ((length(s) + 1) * 1000)), 20000), -20000)::BIGINT AS score
          FROM urls JOIN (SELECT s, sum(ratio)::BIGINT AS total FROM every_gram JOIN ratios USING (gram) GROUP BY s) USING (s)),
        bins AS (SELECT score, sum(CASE WHEN label = 'allow' THEN n ELSE 0 END)::BIGINT AS a,
            sum(CASE WHEN label = 'block' THEN n ELSE 0 END)::BIGINT AS r
          FROM scored WHERE label IS NOT NULL AND {held} GROUP BY score),
        errors AS (SELECT score, sum(a) OVER () AS ta, sum(r) OVER () AS tr,
            coalesce(sum(a) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low,
            coalesce(sum(r) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM bins),
        bar AS (SELECT coalesce((SELECT score FROM errors WHERE ta > 0 AND tr > 0
            ORDER BY low * tr + (tr - gone) * ta, abs(score), score LIMIT 1), 0) AS bar)
        SELECT page_id, host, path, rule, coalesce(rows_.label, CASE WHEN score >= bar THEN 'allow' ELSE 'block' END) AS verdict,
          score, bar::BIGINT AS bar FROM rows_ JOIN (SELECT s, score FROM scored) USING (s) CROSS JOIN bar"""


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def line_dedup_sql(min_chars: int, min_docs: int) -> str:
    """Lines by key; keys of enough documents stay in the last one only."""
    return f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
        lines AS (SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS i FROM d),
        keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), {_LOWER}) AS k FROM lines),
        often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= {min_chars}
          GROUP BY k HAVING count(DISTINCT doc_id) >= {min_docs}),
        told AS (SELECT keyed.*, last IS NOT NULL AND doc_id <> last AS goes FROM keyed LEFT JOIN often USING (k))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (goes)::BIGINT AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
        FROM told GROUP BY doc_id"""


def lexical_search_sql(k: int) -> str:
    """Every document's score for every item, then the best of each item."""
    terms = "regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH t AS (SELECT doc_id, translate(unnest({terms}), {_LOWER}) AS term FROM documents),
        q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM
          (SELECT item_id, translate(unnest({terms}), {_LOWER}) AS term FROM benchmark) GROUP BY ALL),
        lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id),
        whole AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM lengths),
        post AS (SELECT term, doc_id, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
          FROM (SELECT term, count(*)::BIGINT AS df FROM post GROUP BY term), whole),
        scores AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))))::BIGINT AS score
          FROM q JOIN post USING (term) JOIN w USING (term) JOIN lengths USING (doc_id), whole GROUP BY item_id, doc_id)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM
          (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
        WHERE rank <= {k}"""


def centroid_clusters_sql(k: int, rounds: int) -> str:
    """One assignment and one set of centroids a round, on long rows."""
    steps = ""
    for r in range(rounds + 1):
        steps += f"""
        a{r} AS MATERIALIZED (SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM
          (SELECT vec_id, c, sum((long.x - m.x) * (long.x - m.x))::BIGINT AS distance FROM long JOIN m{r} m USING (j) GROUP BY vec_id, c)
          GROUP BY vec_id),"""
        if r < rounds:
            steps += f"""
        m{r + 1} AS MATERIALIZED (SELECT m.c, m.j, coalesce(n.x, m.x) AS x FROM m{r} m LEFT JOIN
          (SELECT c, j, ((sum(x) - ((sum(x) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS x
            FROM a{r} JOIN long USING (vec_id) GROUP BY c, j) n ON m.c = n.c AND m.j = n.j),"""
    return f"""
        WITH kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        long AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS j, floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept),
        first AS (SELECT vec_id, (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1)::INT AS c FROM kept
          QUALIFY c < {k}),
        m0 AS MATERIALIZED (SELECT c, j, x FROM first JOIN long USING (vec_id)),{steps}
        digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS sha FROM m{rounds} GROUP BY c)
        SELECT vec_id, c AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
          sum(distance) OVER ()::BIGINT AS inertia, sha AS centroid_sha256 FROM a{rounds} JOIN digest USING (c)"""
