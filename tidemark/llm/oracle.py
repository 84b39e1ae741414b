"""DuckDB SQL of the fingerprint and clustering queries."""

from __future__ import annotations

from tidemark.llm import imatch


def _terms(text: str) -> str:
    return (f"list_distinct(list_filter(string_split_regex(translate({text}, '{imatch.UPPER}', '{imatch.LOWER}'), "
            f"'{imatch.BORDER}'), lambda x: x <> ''))")


def _level(n: str) -> str:
    return "(" + " + ".join(f"({n} >= {16 * 4 ** i})::INT" for i in range(1, imatch.LEVELS)) + ")"


def _fingerprint(terms: str, text: str) -> str:
    """From a sorted list of terms and its coded form (t, s, w), a column named ``<terms>_coded``."""
    entry = ("lambda s: s || substr(md5(array_to_string(list_transform(list_filter(kept, lambda c: c.s = s), lambda c: c.t), ' ')), 1, 6)")
    section = (f"(SELECT '|' || j || ':' || array_to_string(list_transform(list_sort(list_distinct(list_transform(kept, lambda c: c.s))), {entry}), ' ') "
               f"FROM (SELECT list_filter({terms}_coded, lambda c: c.w < 2 ** (16 - 2 * j)) AS kept) q WHERE len(kept) > 0)")
    sections = f"(SELECT string_agg(x, '' ORDER BY j) FROM (SELECT j, {section} AS x FROM range({_level(f'len({terms})')}, {imatch.LEVELS}) r(j)) u)"
    return (f"len({terms}) || '.' || substr(CASE WHEN len({terms}) > 0 THEN md5(array_to_string({terms}, ' ')) ELSE md5({text}) END, 1, 16) "
            f"|| coalesce(CASE WHEN len({terms}) > 0 THEN {sections} END, '')")


def _likeness(a: str, b: str) -> str:
    size = lambda f: f"split_part({f}, '.', 1)::INT"
    level = f"greatest({_level(size(a))}, {_level(size(b))})"
    part = lambda f: (f"coalesce(string_split(split_part(list_filter(string_split({f}, '|'), "  # noqa: E731
                      f"lambda x: starts_with(x, {level} || ':'))[1], ':', 2), ' '), [])")
    touched = f"len(list_distinct(list_transform(list_concat({part(a)}, {part(b)}), lambda x: substr(x, 1, 2))))"
    return (f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {touched} = 0 THEN 0.0::DOUBLE "
            f"ELSE len(list_intersect({part(a)}, {part(b)}))::DOUBLE / {touched} END")


def _coded(terms: str) -> str:
    return (f"list_transform({terms}, lambda t: {{'t': t, 's': substr(md5(t), 1, 1) || translate(substr(md5(t), 2, 1), '{imatch.HEX}', '{imatch.QUARTERS}'), "
            f"'w': ('0x' || substr(md5(t), 3, 4))::INT}})")


FINGERPRINTS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT doc_id, text, length(text) AS n, length(text) // 3 AS cut,
             coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
      FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, next_id, n, text, substr(text, 1, n - cut) || substr(next_text, 1, cut) AS edited FROM o),
counts AS (SELECT term, count(*) AS m FROM (SELECT unnest({_terms('text')}) AS term FROM d) t GROUP BY term),
size AS (SELECT greatest(2, ceil({imatch.RARE} * count(*))) AS low, greatest(2, ceil({imatch.RARE} * count(*)), floor({imatch.COMMON} * count(*))) AS high FROM d),
lexicon AS (SELECT term FROM counts, size WHERE m BETWEEN low AND high),
hits AS (SELECT doc_id, side, list_sort(list(term)) AS terms FROM (
             SELECT doc_id, 0 AS side, unnest({_terms('text')}) AS term FROM e
             UNION ALL SELECT doc_id, 1, unnest({_terms('edited')}) FROM e) t JOIN lexicon USING (term) GROUP BY doc_id, side),
k AS (SELECT e.*, coalesce(a.terms, []) AS own, coalesce(b.terms, []) AS other FROM e
      LEFT JOIN hits a ON a.doc_id = e.doc_id AND a.side = 0 LEFT JOIN hits b ON b.doc_id = e.doc_id AND b.side = 1),
c AS (SELECT *, {_coded('own')} AS own_coded, {_coded('other')} AS other_coded FROM k),
f AS (SELECT doc_id, next_id, n, sha256(edited) AS edited_sha256,  {_fingerprint('own', 'text')} AS f, {_fingerprint('other', 'edited')} AS g FROM c)
SELECT f.doc_id, f.n::BIGINT AS n_chars, f.edited_sha256, f.f AS fingerprint, f.g AS edited_fingerprint,
       {_likeness('f.f', 'f.g')} AS near_edited,
       {_likeness('f.f', 'x.f')} AS near_next
FROM f JOIN f x ON x.doc_id = f.next_id"""


def clusters(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2") -> str:
    parts = [f"""
v AS (SELECT row_number() OVER (ORDER BY vec_id, e) AS rid, vec_id, e FROM (
        SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) q),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), e) - 1 AS c, e FROM v QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
    SELECT rid, vec_id, any_value(v.e) AS e,
           min({{'d': (list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e))::BIGINT, 'c': c.c}}) AS best
    FROM v, c{r} c GROUP BY rid, vec_id)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM (
           SELECT best.c AS c, i, sum(e[i]) AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) t(i) GROUP BY best.c, i) q GROUP BY c),
c{r + 1} AS (SELECT c{r}.c, coalesce(m{r}.e, c{r}.e) AS e FROM c{r} LEFT JOIN m{r} USING (c))""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.c = best.c"""
