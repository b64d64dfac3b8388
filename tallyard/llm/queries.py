"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import ann, bpe, codes, html, jaccard, media, packing, sharding, simhash, substring, toxicity, trie

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_token_matrix": packing.op2_token_matrix,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_nearest_neighbours": ann.op4_nearest_neighbours,
    "op5_media_columns": media.op5_media_columns,
    "op6_bpe": bpe.op6_bpe,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_html_extraction": html.op9_html_extraction,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_simhash": simhash.op13_simhash,
}

_VECTORS = "SELECT vec_id, embedding::double[] AS v FROM embeddings WHERE embedding IS NOT NULL AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"

def _codes_sql(parts: int = 16, rounds: int = 2) -> str:
    """Codebooks of ``rounds`` rounds as a chain of common tables; vectors of one length, a multiple of ``parts``."""
    assign = lambda k: (
        f"a{k} AS MATERIALIZED (SELECT vec_id, part, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (SELECT p.vec_id, p.part, p.x, b.e,"
        f" list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint AS d FROM p JOIN b{k} b ON b.part = p.part) GROUP BY 1, 2)"
    )
    mean = lambda k: (
        f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (SELECT part, e, list(((s - ((s % n) + n) % n) // n)::bigint ORDER BY i) AS x FROM"
        f" (SELECT part, e, i, sum(v)::bigint AS s, count(*) AS n FROM (SELECT part, best.e AS e, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{k}) GROUP BY 1, 2, 3) GROUP BY 1, 2) m ON m.part = b.part AND m.e = b.e)"
    )
    steps = ", ".join(f"{assign(k)}, {mean(k)}" for k in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x FROM (SELECT vec_id, v, unnest(range({parts})) AS part FROM kept)),
b0 AS MATERIALIZED (SELECT part, x, e FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e FROM p) WHERE e < 64),
{steps}, {assign(rounds)},
coded AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::bigint AS error FROM a{rounds} GROUP BY 1)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::bigint AS label_error,
(SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256 FROM coded c JOIN kept k ON k.vec_id = c.vec_id
"""


def _xxh64_sql(hx: str, n: str, seed: int = 42) -> str:
    """XXH64 of bytes given as lower-case hex digits, in 128-bit arithmetic modulo 2**64; ``n``: how many bytes."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261  # fixed values of the algorithm
    m = "18446744073709551616::uhugeint"
    num = lambda k: f"{k}::uhugeint"
    times = lambda x, k: f"(({x}) * {num(k)}) % {m}"
    let = lambda name, x, body: f"list_transform([{x}], lambda {name}: {body})[1]"
    turn = lambda name, x, r: let(name, x, f"({name} * {num(1 << r)}) % {m} + {name} // {num(1 << (64 - r))}")
    mix = lambda name, x, r: let(name, x, f"xor({name}, {name} // {num(1 << r)})")
    byte = lambda at: f"substr({hx}, 2 * ({at}) + 1, 2)"
    little = lambda at, size: "('0x' || " + " || ".join(byte(f"{at} + {k}") for k in range(size - 1, -1, -1)) + ")::ubigint::uhugeint"
    step = lambda name, acc, lane: times(turn(name, f"({acc} + {times(lane, p2)}) % {m}", 31), p1)
    stripes = f"range(0, {n} // 32)"
    lane_of = lambda j: f"list_reduce(list_prepend({num((seed + (p1 + p2, p2, 0, -p1)[j]) % (1 << 64))}, list_transform({stripes}, lambda k: {little(f'32 * k + {8 * j}', 8)})), lambda v, lane: {step('t', 'v', 'lane')})"
    merged = " + ".join(turn(f"r{j}", f"v[{j + 1}]", r) for j, r in enumerate((1, 7, 12, 18)))
    fold = f"({merged}) % {m}"
    for j in range(4):
        fold = f"({times(f'xor({fold}, {step(chr(97 + j), num(0), f'v[{j + 1}]')})', p1)} + {num(p4)}) % {m}"
    long = let("v", f"[{', '.join(lane_of(j) for j in range(4))}]", fold)
    begin = f"(CASE WHEN {n} >= 32 THEN {long} ELSE {num((seed + p5) % (1 << 64))} END + {n}::uhugeint) % {m}"
    # what is left behind the stripes: eights, a four, and bytes, each marked above its 64 bits
    at = f"{n} // 32 * 32"
    eights = f"list_transform(range({at}, {n} - 7, 8), lambda k: {num(8 << 64)} + {little('k', 8)})"
    four = f"list_transform(CASE WHEN {n} % 8 >= 4 THEN [{n} // 8 * 8] ELSE [] END, lambda k: {num(4 << 64)} + {little('k', 4)})"
    ones = f"list_transform(range({n} // 4 * 4, {n}), lambda k: {num(1 << 64)} + {little('k', 1)})"
    eight = f"({times(turn('u', f'xor(h, {step('t', num(0), f's % {m}')})', 27), p1)} + {num(p4)}) % {m}"
    quad = f"({times(turn('u', f'xor(h, {times(f's % {m}', p1)})', 23), p2)} + {num(p3)}) % {m}"
    one = times(turn("u", f"xor(h, {times(f's % {m}', p5)})", 11), p1)
    tail = f"list_reduce(list_prepend({begin}, list_concat({eights}, list_concat({four}, {ones}))), lambda h, s: CASE WHEN s >= {num(8 << 64)} THEN {eight} WHEN s >= {num(4 << 64)} THEN {quad} ELSE {one} END)"
    return mix("z", times(mix("y", times(mix("x", tail, 33), p2), 29), p3), 32)


SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT w.doc_id, count(g.p) AS n_removed, string_agg(CASE WHEN g.p IS NULL THEN w.w END, ' ' ORDER BY w.p) AS rest FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY 1)
SELECT d.doc_id, cast(len(ws) AS bigint) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
    # the exact neighbours: on small tables the search finds all of them
    "op4_nearest_neighbours": f"""
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM (
SELECT q.vec_id AS query_id, e.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: (e.v[i] - q.v[i]) * (e.v[i] - q.v[i])), lambda s, x: s + x)) AS score
FROM ({_VECTORS}) q JOIN ({_VECTORS}) e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 100 = 0)) WHERE rank <= 10
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) m ON m.a = d.doc_id
""",
    # CRC-32 bit by bit: SQL has no function for it
    "op11_prefix_trie": r"""
WITH c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
  lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
t AS MATERIALIZED (SELECT conv_id, id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS i FROM (
  SELECT conv_id, turn, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS id, length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1),
r AS (SELECT c.conv_id, t.i AS d, t.id, t.chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 WHERE t.i <= c.h
  UNION ALL SELECT c.conv_id, t.i - c.h + least(c.h, coalesce(s.n, 0)), t.id, t.chars FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN sizes s ON s.conv_id = c.conv_id - c.conv_id % 100 WHERE t.i > c.h),
steps AS MATERIALIZED (SELECT conv_id, 0 AS d, 'root' AS k, 0 AS chars FROM c UNION ALL SELECT conv_id, d, sha256(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY d)), chars FROM r),
paths AS MATERIALIZED (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY d) AS up, lead(k) OVER (PARTITION BY conv_id ORDER BY d) IS NULL AS last FROM steps),
n AS MATERIALIZED (SELECT k, any_value(d) AS depth, any_value(up) AS up, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM paths GROUP BY k),
kids AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY 1),
under AS (SELECT a, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT DISTINCT x.k AS a, y.k AS b FROM paths x JOIN paths y ON x.conv_id = y.conv_id AND x.d <= y.d) p JOIN n ON n.k = p.b LEFT JOIN kids ON kids.up = p.b GROUP BY a)
SELECT n.conv_id, n.depth::bigint AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::bigint AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n up ON up.k = n.up LEFT JOIN kids ON kids.up = n.k JOIN under ON under.a = n.k
""",
    "op12_vector_codes": _codes_sql(),
    # the hash of each shingle in 128-bit arithmetic, the bits of each document, and all pairs of fingerprints
    "op13_simhash": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, array_to_string(ws[i:i + 2], ' ') AS t FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 1, 2) END)) AS i FROM d)),
u AS MATERIALIZED (SELECT t, lower(hex(encode(t))) AS hx, octet_length(encode(t))::bigint AS n FROM (SELECT DISTINCT t FROM s)),
h AS MATERIALIZED (SELECT t, ({_xxh64_sql("hx", "n")})::ubigint AS h FROM u),
c AS (SELECT s.doc_id, count(*) AS n, {", ".join(f"sum((h.h >> {b}) & 1)::bigint AS c{b}" for b in range(64))} FROM s JOIN h ON s.t = h.t GROUP BY 1),
f AS MATERIALIZED (SELECT d.doc_id, coalesce({" + ".join(f"(2 * c{b} > n)::uhugeint * {1 << b}" for b in range(64))}, 0)::uhugeint AS fp FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
k AS MATERIALIZED (SELECT fp, min(doc_id) AS doc_id FROM f GROUP BY 1),
l AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM k x JOIN k y ON x.doc_id <> y.doc_id AND bit_count(xor(x.fp, y.fp)::hugeint::bit) <= 2),
reach AS (SELECT doc_id AS a, doc_id AS b FROM k UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT f.doc_id, lower(lpad(hex(f.fp::ubigint), 16, '0')) AS fingerprint, m.component_id FROM f JOIN k ON k.fp = f.fp JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) m ON m.a = k.doc_id
""",
}
