"""DuckDB SQL for the operators that SQL can express; the others are tested by brute force."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.pos, l.line, r.key IS NOT NULL AND l.doc_id <> r.last AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM good
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
first AS (SELECT a, min(b) AS first FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(f.first, e.vec_id) AS component_id,
       e.vec_id = coalesce(f.first, e.vec_id) AS kept
FROM embeddings e LEFT JOIN first f ON e.vec_id = f.a LEFT JOIN counted c ON e.vec_id = c.a
"""

# spans of one pattern: what stands before each match, and the match, lengths summed up
_SPANS = """
  SELECT doc_id, {rule} AS rule, '{kind}' AS kind, size, tested,
         CAST(sum(before + size) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS stop
  FROM (SELECT doc_id, generate_subscripts(found, 1) AS pos, length(unnest(found)) AS size, length(unnest(tested)) AS tested,
               length(unnest(before[1:len(found)])) AS before
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}', 0) AS found,
                     regexp_extract_all(coalesce(text, ''), '{pattern}', {group}) AS tested,
                     string_split_regex(coalesce(text, ''), '{pattern}') AS before FROM documents)) m"""


# spans from an opening to the next end, or over the lines of the key that follow it
_UNTIL = """
  SELECT doc_id, {rule} AS rule, '{kind}' AS kind, length(span) AS size, length(span) AS tested, CAST(start + length(span) AS BIGINT) AS stop
  FROM (SELECT doc_id, start, CASE WHEN following SIMILAR TO '{until}' THEN mark || after || following
                                   ELSE mark || regexp_replace(regexp_extract(after, '{key}', 0), '[ \t\r\n>|#*;-]+$', '') END AS span, mark
        FROM (SELECT doc_id, mark, after, lead(mark) OVER d AS following,
                     sum(length(before) + length(mark)) OVER d - length(mark) AS start
              FROM (SELECT doc_id, generate_subscripts(marks, 1) AS pos, unnest(marks) AS mark, unnest(pieces[1:len(marks)]) AS before,
                           unnest(pieces[2:]) AS after
                    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}|{until}', 0) AS marks,
                                 string_split_regex(coalesce(text, ''), '{pattern}|{until}') AS pieces FROM documents)) m
              WINDOW d AS (PARTITION BY doc_id ORDER BY pos)) s
        WHERE mark SIMILAR TO '{pattern}') k"""


def _secrets() -> str:
    from tidemark.llm.secret_scan import BASE, QUOTED, RULES
    line_end = r"[ \t\r]*(?m:$)"
    key = (rf"^(?:[ \t]*[A-Za-z0-9+/=\\]*{line_end}(?:\n{QUOTED}[A-Za-z0-9-]+: [^\n]*)*(?:\n{QUOTED}[A-Za-z0-9+/=]*{line_end})*|"
           r"[ \t]*[A-Za-z0-9+/=\\]{16,})")
    spans = " UNION ALL ".join(f"(SELECT doc_id, rule, kind, size, tested, stop FROM ({(_UNTIL if r.until else _SPANS).format(rule=i, kind=r.kind, group=r.group, pattern=r.pattern.replace(chr(39), chr(39) * 2), until=r.until, key=key)}) s{i}"
                               f" WHERE tested >= {r.least})" for i, r in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    text = "kind || ':' || (stop - size) || ':' || stop"
    return f"""
WITH spans AS ({spans})
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg({text}, ',' ORDER BY stop - size, rule) FILTER (WHERE rule < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg({text}, ',' ORDER BY stop - size, rule) FILTER (WHERE kind IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""


def _rules() -> str:
    from tidemark.llm.quality_rules import SHARES
    low = "greatest(length(bin({v})) - 6, 0)"
    shares = ", ".join(f"CASE WHEN {of} > 0 THEN {factor} * {part} // {of} ELSE 0 END AS {name}"
                       for name, (part, of, factor, _, _) in SHARES.items())
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{n}' AS share, ({n} >> {low.format(v=n)}) << {low.format(v=n)} AS value FROM shares WHERE NOT base_failed"
        for n in SHARES)

    def level(name: str, keys: list[str]) -> str:
        head = "".join(f"{k}, " for k in keys)
        same = "".join(f" AND b.{k} IS NOT DISTINCT FROM g.{k}" for k in keys)
        listed = "".join(f"g.{k}, " for k in keys)
        return f"""{name} AS (
  SELECT {head}share, value, sum(n) OVER (PARTITION BY {head}share ORDER BY value) / sum(n) OVER (PARTITION BY {head}share) AS f,
         sum(n) OVER (PARTITION BY {head}share) AS n
  FROM (SELECT {listed}g.share, v.value, count(b.value) AS n FROM (SELECT DISTINCT {head}share FROM bucketed) g
        JOIN (SELECT DISTINCT share, value FROM bucketed) v ON g.share = v.share
        LEFT JOIN bucketed b ON b.share = v.share AND b.value = v.value{same} GROUP BY ALL))"""
    sides = [(n, side, pair) for n, v in SHARES.items() for side, pair in (("high", v[3]), ("low", v[4])) if pair]
    twice = ", ".join(f"max(CASE WHEN share = '{n}' THEN q{p} + q{q} END) AS {n}_{side}" for n, side, (p, q) in sides)
    quantiles = ", ".join(f"min(CASE WHEN f >= {p / 1000!r} - 1e-9 THEN value END) AS q{p}" for p in sorted({p for *_, pair in sides for p in pair}))
    fine = " AND ".join(f"2 * ((s.{n} >> {low.format(v=f's.{n}')}) << {low.format(v=f's.{n}')}) {'<=' if side == 'high' else '>='} t.{n}_{side}"
                        for n, side, _ in sides)
    return f"""
WITH words AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_WHITE}) <> '') AS lines FROM documents),
windows AS (SELECT doc_id, pos, list_slice(words, pos, pos + 7) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM words WHERE len(words) >= 8)),
twice AS (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next
  FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, CAST(sum(least(8, coalesce(next - pos, 8))) AS BIGINT) AS n FROM twice GROUP BY doc_id),
counted AS (SELECT w.doc_id, lang, source, len(words) AS n_words, len(lines) AS n_lines,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id),
shares AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {shares} FROM counted),
bucketed AS ({values}),
{level('o', ['lang', 'source'])}, {level('l', ['lang'])}, {level('w', [])},
blended AS (
  SELECT o.lang, o.source, o.share, o.value,
         CAST(o.n AS DOUBLE) / (o.n + 200) * o.f + (1 - CAST(o.n AS DOUBLE) / (o.n + 200)) * (
           CAST(l.n AS DOUBLE) / (l.n + 200) * l.f + (1 - CAST(l.n AS DOUBLE) / (l.n + 200)) * w.f) AS f
  FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.share = l.share AND o.value = l.value
  JOIN w ON o.share = w.share AND o.value = w.value),
t AS (SELECT lang, source, {twice} FROM (SELECT lang, source, share, {quantiles} FROM blended GROUP BY lang, source, share) GROUP BY lang, source)
SELECT s.doc_id, s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, s.base_failed,
       coalesce(NOT s.base_failed AND {fine}, false) AS kept
FROM shares s LEFT JOIN t ON s.lang IS NOT DISTINCT FROM t.lang AND s.source IS NOT DISTINCT FROM t.source
"""

NEGATIVES = """
WITH good AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM good a JOIN good b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.x) = len(b.x)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

ORACLE_SQL = {
    "op3_embedding_dedup": VECTORS,
    "op6_line_dedup": LINES,
    "op7_quality_rules": _rules(),
    "op10_secret_scan": _secrets(),
    "op13_hard_negatives": NEGATIVES,
}
