"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from . import merkle_manifest as merkle
from . import poisson_mix as mix
from . import quality_divergence as quality
from . import walsh_clusters as walsh
from .secret_ledger import RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for rank, rule in enumerate(RULES):
        p = _quoted(rule.pattern)
        parts.append(
            f"SELECT doc_id, row_id, '{rule.kind}' AS kind, {rank} AS rank, {rule.least} AS least, "
            f"regexp_split_to_array(t, {p}) AS gaps, regexp_extract_all(t, {p}, 0) AS found, "
            f"regexp_extract_all(t, {p}, {rule.group}) AS parts FROM d WHERE regexp_matches(t, {p})"
        )
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (
  SELECT row_id, kind, rank, least, i, length(gaps[i]) AS gap, length(found[i]) AS len, length(parts[i]) AS part
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)),
s AS (
  SELECT row_id, kind, rank, part >= least AS ok,
    CAST(sum(gap + len) OVER (PARTITION BY row_id, rank ORDER BY i) AS BIGINT) AS e, len
  FROM e),
h AS (
  SELECT row_id,
    count(*) FILTER (WHERE rank = 0) AS n0, count(*) FILTER (WHERE rank = 1) AS n1,
    count(*) FILTER (WHERE rank = 2) AS n2,
    string_agg(kind || ':' || (e - len) || ':' || e, ',' ORDER BY e - len, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(kind || ':' || (e - len) || ':' || e, ',' ORDER BY e - len, rank) AS every
  FROM s WHERE ok GROUP BY row_id)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN h USING (row_id)
"""


def _quality() -> str:
    space = r"[ \t\n\x0B\f\r]+"
    rest = ["t"]
    for c in quality.CHAR_CLASSES:
        rest.append(f"regexp_replace({rest[-1]}, {_quoted(c)}, '', 'g')")
    chars = [f"length({a}) - length({b})" for a, b in zip(rest, rest[1:], strict=False)] + [f"length({rest[-1]})"]
    listed = {k: list(v) for k, v in quality.COMMON_WORDS.items()}
    cases = " ".join(
        f"WHEN '{k}' THEN list_transform([{', '.join(_quoted(w) for w in v)}], "
        "lambda c: len(list_filter(w, lambda x: x = c OR x = upper(c[1]) || c[2:] OR x = upper(c))))"
        for k, v in listed.items()
    )
    n_classes, n_words = len(quality.CHAR_CLASSES) + 1, len(listed["en"]) + 1

    def jsd(p: str, q: str) -> str:
        def side(a: str) -> str:
            return f"CASE WHEN {a} > 0 THEN {a} * log2({a} / m) ELSE 0 END"

        return (
            f"(SELECT sum(({side('a')} + {side('b')}) / 2) FROM (SELECT a, b, (a + b) / 2 AS m FROM "
            f"(SELECT unnest({p}) / list_sum({p})::DOUBLE AS a, unnest({q}) / list_sum({q})::DOUBLE AS b)))"
        )

    shares = "list_transform({0}, lambda x: CAST(floor(x * 1000000 / list_sum({0})) AS BIGINT))"
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t,
    CASE WHEN lang IN ({", ".join(_quoted(k) for k in listed)}) THEN lang ELSE '*' END AS ref
  FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, {_quoted(space)}), lambda x: x <> '') AS w FROM d),
tri AS (
  SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
rep AS (
  SELECT row_id, count(DISTINCT i + o) AS n FROM
    (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, k) AS c FROM tri), (VALUES (0), (1), (2)) v(o)
  WHERE c > 1 GROUP BY row_id),
dup AS (
  SELECT row_id, count(*) - count(DISTINCT x) AS n
  FROM (SELECT row_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY row_id),
counts AS (
  SELECT row_id, doc_id, ref, length(t) AS n_text, len(w) AS n_words,
    length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    [{", ".join(chars)}] AS chars, CASE ref {cases} END AS listed
  FROM w LEFT JOIN rep USING (row_id) LEFT JOIN dup USING (row_id)),
stats AS (SELECT *, list_append(listed, n_words - list_sum(listed)) AS common FROM counts),
shares AS (
  SELECT ref, {shares.format("chars")} AS c,
    CASE WHEN n_words >= {quality.MIN_WORDS} AND ref <> '*' THEN {shares.format("common")} END AS w
  FROM stats WHERE n_text >= {quality.MIN_CHARS}),
refs AS (
  SELECT ref, [{", ".join(f"sum(c[{i + 1}])::DOUBLE" for i in range(n_classes))}] AS rc,
    [{", ".join(f"sum(w[{i + 1}])::DOUBLE" for i in range(n_words))}] AS rw
  FROM (SELECT ref, c, w FROM shares WHERE ref <> '*' UNION ALL SELECT '*', c, NULL FROM shares) GROUP BY ref),
judged AS (
  SELECT s.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_text >= {quality.MIN_CHARS} THEN {jsd("chars", "rc")} END AS cj,
    CASE WHEN n_words >= {quality.MIN_WORDS} AND ref <> '*' THEN {jsd("common", "rw")} END AS wj
  FROM stats s LEFT JOIN refs USING (ref))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(cj, 0) <= {quality.MAX_CHAR_JSD} AND coalesce(wj, 0) <= {quality.MAX_WORD_JSD} AS kept
FROM judged
"""


def _mix() -> str:
    weight = " ".join(f"WHEN {_quoted(k)} THEN {v!r}" for k, v in mix.WEIGHTS.items())
    seed = mix.SEED
    return f"""
WITH d AS (
  SELECT *, CASE WHEN source IN ({", ".join(_quoted(k) for k in mix.WEIGHTS)}) THEN source ELSE '{mix.OTHER}' END AS cls,
    coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, '')) AS ident
  FROM documents),
n AS (SELECT cls, count(*) AS n, CASE cls {weight} ELSE {mix.DEFAULT_WEIGHT!r} END AS w FROM d GROUP BY cls),
r AS (SELECT cls, sum(n) OVER () * w / sum(w) OVER () / n AS rate FROM n),
p AS (
  SELECT cls, greatest(ceil(rate / {mix.MAX_STEP}), 1) AS draws, rate / greatest(ceil(rate / {mix.MAX_STEP}), 1) AS mean FROM r),
cdf AS (
  SELECT cls, k, sum(q) OVER (PARTITION BY cls ORDER BY k) AS c
  FROM (SELECT cls, k, exp(-mean) * pow(mean, k) / gamma(k + 1) AS q FROM p, range(0, 100) t(k))),
u AS (
  SELECT d.*, j, (('0x' || md5('{seed}:' || ident || ':' || j)[1:13])::BIGINT + 0.5) / 4503599627370496 AS u
  FROM (SELECT d.*, unnest(range(1, CAST(draws AS BIGINT) + 1)) AS j FROM d JOIN p USING (cls)) d),
drawn AS (
  SELECT row_id, sum((SELECT count(*) FROM cdf WHERE cdf.cls = u.cls AND u.u > cdf.c)) AS n
  FROM (SELECT *, row_number() OVER () AS row_id FROM u) u GROUP BY row_id),
c AS (SELECT u.*, drawn.n FROM (SELECT *, row_number() OVER () AS row_id FROM u) u JOIN drawn USING (row_id))
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
  md5('{seed}:order:' || ident || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM c)
"""


def _clusters() -> str:
    size, scale, k, seed = walsh.SIZE, walsh.SCALE, walsh.CENTROIDS, walsh.SEED

    def nearest(n: int) -> str:
        return f"""a{n} AS (
  SELECT r, any_value(id) AS id, any_value(k.v) AS v, min({{'d': CAST(list_sum(list_transform(list_zip(k.v, c.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS best
  FROM k CROSS JOIN c{n} AS c GROUP BY r)"""

    def moved(n: int) -> str:
        return f"""s{n} AS (
  SELECT best.c AS c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT best, unnest(v) AS x, unnest(range(1, {size + 1})) AS i FROM a{n}) GROUP BY best.c, i),
m{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{n} GROUP BY c),
c{n + 1} AS (SELECT c.c, CAST(coalesce(m.v, c.v) AS BIGINT[]) AS v FROM c{n} AS c LEFT JOIN m{n} AS m USING (c))"""

    rounds = ",\n".join(f"{nearest(n)},\n{moved(n)}" for n in range(walsh.ROUNDS))
    return f"""
WITH f AS (
  SELECT vec_id AS id, embedding FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
k AS (
  SELECT row_number() OVER () AS r, id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM f),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || id), v) - 1 AS INTEGER) AS c, v
  FROM k WHERE id IS NOT NULL QUALIFY c < {k}),
{rounds},
{nearest(walsh.ROUNDS)}
SELECT id AS vec_id, a.best.c AS cluster, a.best.d AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{walsh.ROUNDS} AS a JOIN c{walsh.ROUNDS} AS c ON a.best.c = c.c
"""


def _merkle() -> str:
    def digest(text: str) -> str:
        parts = ("doc_id", "source", "lang", "n_chars", text)
        each = [f"coalesce(strlen(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts]
        return f"sha256({' || '.join(each)})"

    n = merkle.FANOUT

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (
  SELECT 0 AS l, g, i, n, h FROM {leaves}
  UNION ALL
  SELECT l + 1, g, i // {n}, (n + {n - 1}) // {n}, sha256(string_agg(h, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY l, g, i // {n}, n),
{name}_runs AS (SELECT l, g, i // {n} AS j, list(h ORDER BY i) AS run FROM {name} WHERE n > 1 GROUP BY l, g, i // {n})"""

    def climb(name: str, over: str, start: str) -> str:
        return f"""{name} AS (
  SELECT r, 0 AS l, g, i, now, beside FROM {start}
  UNION ALL
  SELECT r, p.l + 1, p.g, p.i // {n},
    sha256(array_to_string(run[1:p.i % {n}], '') || now || array_to_string(run[p.i % {n} + 2:], '')),
    beside || array_to_string(run[1:p.i % {n}], '') || array_to_string(run[p.i % {n} + 2:], '')
  FROM {name} AS p JOIN {over}_runs AS q ON p.l = q.l AND p.g = q.g AND p.i // {n} = q.j),
{name}_end AS (SELECT r, max_by(now, l) AS now, max_by(beside, l) AS beside FROM {name} GROUP BY r)"""

    bits = (
        "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda ch: list_transform(range(8), lambda b: (ascii(ch) >> b) & 1)))"
    )
    crc = (
        f"list_reduce(list_concat([4294967295], {bits}), "
        "lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END))"
    )
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
    coalesce({crc} & 1 = 1, false) AS even  -- of the register before its last inversion
  FROM documents),
e AS (
  SELECT r, doc_id, source, {digest("text")} AS h,
    CASE WHEN even THEN {digest("replace(text, chr(10), '')")} ELSE {digest("text")} END AS now
  FROM d),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n
  FROM e),
{tree("own", "leaves")},
subroots AS (SELECT g AS s, h FROM own WHERE n = 1),
heads AS (SELECT 0 AS g, s AS i, count(*) OVER () AS n, h FROM subroots),
{tree("top", "heads")},
{climb("low", "own", "(SELECT r, g, i, now, '' AS beside FROM leaves)")},
{climb("high", "top", "(SELECT r, 0 AS g, leaves.g AS i, low_end.now, low_end.beside FROM low_end JOIN leaves USING (r))")}
SELECT doc_id, leaves.h AS leaf, subroots.h AS subroot, root.h AS root, sha256(high_end.beside) AS proof_sha256,
  high_end.now AS folded_root, high_end.now = root.h AS verified
FROM leaves JOIN high_end USING (r) JOIN subroots ON subroots.s = leaves.g
  CROSS JOIN (SELECT h FROM top WHERE n = 1) AS root
"""


ORACLE_SQL: dict[str, str] = {
    "op1_secret_ledger": _secrets(),
    "op6_quality_divergence": _quality(),
    "op9_poisson_mix": _mix(),
    "op11_walsh_clusters": _clusters(),
    "op13_merkle_manifest": _merkle(),
}
