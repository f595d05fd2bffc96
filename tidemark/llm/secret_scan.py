"""Secrets in texts by a trigram inverted index (operator 10), DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived: what every match must
contain. The index holds, for each trigram that any query names, the documents that contain
it; a rule's postings are combined by its query (bits of a document's postings, AND within
an alternative, OR over alternatives), and only the documents left are verified with the
pattern. Rules whose matches need no trigram scan every text. Text is compared in lower
case in the index, so case never hides a candidate.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters; ``early``: redacted before others.

    With ``until`` a match of ``pattern`` opens a span that goes to the end of the next match of ``until``, however far that
    is, if no other ``pattern`` comes before it; else over the key's lines after the opening (``_after_opening``).
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    early: bool = False
    until: str = ""


#: the kinds that the base digest takes, in order; hex runs are maximal, so their least
#: length can stand in the pattern
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# How the issuers' tokens look.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----", early=True, until=r"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    # the last 21 characters of a longer scheme, so that a long run is not scanned from each of its characters; the
    # password ends at the last @ before a slash or white space, so it may hold colons and @
    Rule("login", r"(?:[A-Za-z][A-Za-z0-9+.-]{1,20}|[0-9+.-]{21})://[^\s/:@]*:[^\s/]{3,}@", early=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}|hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}|ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{50,}"),
    Rule("huggingface", r"hf_[A-Za-z0-9]{30,}"),
    Rule("temporary", r"ASIA[A-Z0-9]{16}"),
)
RULES = BASE + MORE

Query = list[frozenset[str]] | None     # alternatives of trigrams that must all be there; None: no condition


def _fewest(query: list[frozenset[str]]) -> Query:
    """Without alternatives that another one implies; none if one alternative needs nothing."""
    kept = [a for a in set(query) if not any(b < a for b in query)]
    return None if not kept or frozenset() in kept else sorted(kept, key=sorted)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _fewest([x | y for x, y in product(a, b)]) if len(a) * len(b) <= 256 else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _fewest([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings])


def _analyse(items) -> tuple[set[str] | None, Query]:
    """(all strings an expression can be, or None; what every match must contain)."""
    run: set[str] = {""}
    whole, need = True, None
    for op, arg in items:
        exact, own = _item(str(op), arg)
        if exact is not None and len(run) * len(exact) <= 128:
            run = {a + b for a, b in product(run, exact)}
            continue
        need = _both(_both(need, _of_strings(run)), own if exact is None else _of_strings(exact))
        run, whole = {""}, False
    return (run, _of_strings(run)) if whole else (None, _both(need, _of_strings(run)))


def _item(op: str, arg) -> tuple[set[str] | None, Query]:
    if op == "LITERAL":
        return {chr(arg).lower()}, None
    if op == "AT":
        return {""}, None
    if op == "IN":
        chars = {chr(a).lower() for o, a in arg if str(o) == "LITERAL"}
        return (chars, None) if all(str(o) == "LITERAL" for o, _ in arg) and len(chars) <= 8 else (None, None)
    if op == "SUBPATTERN":
        return _analyse(arg[3])
    if op == "BRANCH":
        parts = [_analyse(p) for p in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= 64:
            return set().union(*(e for e, _ in parts)), None
        needs = [n for _, n in parts]
        return None, None if any(n is None for n in needs) else _fewest([a for n in needs for a in n])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = arg
        exact, need = _analyse(body)
        if exact is not None and int(high) <= 4 and len(exact) ** int(high) <= 64:
            return {"".join(t) for n in range(low, int(high) + 1) for t in product(exact, repeat=n)}, None
        return None, (need if low else None)
    return None, None


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams, one of which every match contains whole; None: no condition."""
    return _analyse(parser.parse(pattern))[1]


def _key(text: Column, id_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text"))


def candidates(df: DataFrame, rules: tuple[Rule, ...], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row key, array of the rules that may match) from the postings of the rules' trigrams."""
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted({g for q in queries if q for a in q for g in a})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(_key(text, id_col).alias("key"), F.lower(text).alias("text"))
    # postings: trigram number and row
    found = F.array_compact(F.array(*[F.when(F.contains(F.col("text"), F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    postings = rows.select("key", F.explode(found).alias("gram"))
    words = [F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("gram") % 62))
                      .otherwise(F.lit(0).cast("long"))).alias(f"b{w}") for w in range(len(grams) // 62 + 1)]
    bits = postings.groupBy("key").agg(*words)

    def holds(query: list[frozenset[str]]) -> Column:
        any_ = F.lit(False)
        for alternative in query:
            masks: dict[int, int] = {}
            for g in alternative:
                i = grams.index(g)
                masks[i // 62] = masks.get(i // 62, 0) | 1 << i % 62
            all_ = F.lit(True)
            for w, m in masks.items():
                all_ &= F.col(f"b{w}").bitwiseAND(F.lit(m)) == F.lit(m)
            any_ |= all_
        return any_
    may = F.array_compact(F.array(*[F.when(holds(q), F.lit(i)) for i, q in enumerate(queries) if q]))
    return bits.select("key", may.alias("may")).where(F.size("may") > 0)


def _rows(df: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """The rows as ``_row``, with ``_key``, ``_text`` and ``_may``: the rules to verify on it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    may = candidates(df, rules, id_col=id_col, text_col=text_col)
    always = F.array(*[F.lit(i) for i, r in enumerate(rules) if trigram_query(r.pattern) is None]).cast("array<int>")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), _key(text, id_col).alias("_key"), text.alias("_text"))
    rows = rows.join(may.withColumnsRenamed({"key": "_key", "may": "_may"}), "_key", "left")
    return rows.withColumn("_may", F.concat(F.coalesce("_may", F.array().cast("array<int>")), always))


#: what may stand before a line of a key that is quoted, commented or indented
QUOTED = r"[ \t>|#*;-]*"
#: on the opening's own line, all of it or a long run; escaped line ends are part of it
SAME_LINE, SAME_RUN = r"^[ \t]*[A-Za-z0-9+/=\\]*[ \t\r]*$", r"^[ \t]*[A-Za-z0-9+/=\\]{16,}"
FIELD_LINE, KEY_LINE = rf"^{QUOTED}[A-Za-z0-9-]+: [^\n]*$", rf"^{QUOTED}[A-Za-z0-9+/=]*[ \t\r]*$"


def _let(value: Column, use) -> Column:
    """``use`` of a value that stands in the expression, and is worked out, once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _leading(lines: Column, pattern: str) -> Column:
    """How many lines at the start match."""
    fits = F.transform(lines, lambda x: F.regexp_like(x, F.lit(pattern)))
    return _let(fits, lambda f: F.when(F.array_contains(f, F.lit(False)), F.array_position(f, F.lit(False)) - 1).otherwise(F.size(f)).cast("int"))


def _from(items: Column, skip: Column | int) -> Column:
    return F.slice(items, F.lit(1) + skip, F.greatest(F.size(items) - skip, F.lit(0)))


def _after_opening(rest: Column) -> Column:
    """What of the text after an opening without an end belongs to the key: a long run on its line, or, if that line holds
    nothing else, header fields and then the lines that are nothing but base64, quoted or not."""
    def body(lines: Column, more: Column) -> Column:
        n = _let(_leading(more, FIELD_LINE), lambda fields: F.lit(1) + fields + _leading(_from(more, fields), KEY_LINE))
        # blank lines after the key are not part of it
        return F.regexp_replace(F.array_join(F.slice(lines, F.lit(1), n), "\n"), r"[ \t\r\n>|#*;-]+$", "")
    return _let(F.split(rest, "\n", -1), lambda lines: F.when(
        F.regexp_like(F.get(lines, F.lit(0)), F.lit(SAME_LINE)), _let(_from(lines, 1), lambda more: body(lines, more))).otherwise(
        F.regexp_extract(F.get(lines, F.lit(0)), SAME_RUN, 0)))


def _spanned(rule: Rule, text: Column) -> Column:
    """Texts before and in each span of an ``until`` rule, and what follows the last: one walk over the texts that start
    with an opening or an end."""
    kind = "struct<before:string,found:string,tested:string>"
    opening, ending = F.lit(f"^(?:{rule.pattern})"), f"^(?:{rule.until})"
    segments = F.split(text, f"(?={rule.pattern}|{rule.until})", -1)

    def piece(before: Column, found: Column) -> Column:
        return F.array(F.struct(before.alias("before"), found.alias("found"), found.alias("tested")).cast(kind))

    def unended(held: Column, use) -> Column:
        """``use`` of the key's text and of what follows it."""
        key = _let(F.regexp_extract(held, f"^(?:{rule.pattern})", 0), lambda head: F.concat(
            head, _after_opening(F.substring(held, F.char_length(head) + 1, F.char_length(held)))))
        return _let(key, lambda k: use(k, F.substring(held, F.char_length(k) + 1, F.char_length(held))))

    def state(done: Column, tail: Column, open_: Column) -> Column:
        return F.struct(done.alias("done"), tail.alias("tail"), open_.alias("open"))

    def step(acc: Column, s: Column) -> Column:
        opens, none = F.regexp_like(s, opening), F.lit(None).cast("string")
        now_open, now_tail = F.when(opens, s), F.when(opens, F.lit("")).otherwise(s)
        closed = _let(F.regexp_extract(s, ending, 0), lambda end: F.when(end != "", state(
            F.concat(acc["done"], piece(acc["tail"], F.concat(acc["open"], end))), F.substring(s, F.char_length(end) + 1, F.char_length(s)), none)))
        cut = unended(acc["open"], lambda key, rest: state(
            F.concat(acc["done"], piece(acc["tail"], key)), F.concat(rest, now_tail), now_open))
        return F.when(acc["open"].isNull(), state(acc["done"], F.concat(acc["tail"], now_tail), now_open)).otherwise(F.coalesce(closed, cut))

    def finish(acc: Column) -> Column:
        last = F.lit(None).cast("string")
        return F.when(acc["open"].isNull(), F.concat(acc["done"], piece(acc["tail"], last))).otherwise(
            unended(acc["open"], lambda key, rest: F.concat(acc["done"], piece(acc["tail"], key), piece(rest, last))))
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit("").alias("tail"), F.lit(None).cast("string").alias("open"))
    return F.aggregate(segments, start, step, finish)


def _parts(i: int, rule: Rule, text: Column) -> Column:
    """Texts before, in and of the tested group of each match; what follows the last stands alone."""
    pattern = F.lit(rule.pattern)
    if rule.until:
        parts = _spanned(rule, text)
    else:
        found = F.regexp_extract_all(text, pattern, F.lit(0))
        tested = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
        parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("before"), found.alias("found"), tested.alias("tested"))
    return F.when(F.array_contains("_may", i) & F.regexp_like(text, pattern), parts)


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``spans``: array of (start, rule, end, kind) by start, then rule.

    Matches of a rule are leftmost and do not overlap; those whose tested group is too short
    are dropped after matching. A private key goes from its opening to its end line, however many lines lie between. A login's
    scheme counts from its last 21 characters. Spans of one start are in the rules' order. Positions are code points, ``end``
    exclusive. Null and empty texts have no spans, null ids are kept, rows that repeat are each returned, other columns
    are not read, an empty table gives an empty one.
    """
    rows = _rows(df.select(id_col, F.col(text_col).alias(text_col)), rules, id_col, text_col)
    rows = rows.select("_key", *[_parts(i, r, F.col("_text")).alias(f"r{i}") for i, r in enumerate(rules)])
    lengths = F.concat(*[F.coalesce(F.transform(F.filter(f"r{i}", lambda x: x["found"].isNotNull()), lambda x, at: F.struct(
        F.lit(i).alias("rule"), at.alias("at"), F.char_length(x["before"]).alias("before"), F.char_length(x["found"]).alias("size"),
        (F.char_length(x["tested"]) >= r.least).alias("fits"))), F.array().cast(
            "array<struct<rule:int,at:int,before:int,size:int,fits:boolean>>")) for i, r in enumerate(rules)])
    # rows of one text are dealt together once; repeated rows have equal matches
    matches = rows.select("_key", F.explode(lengths).alias("m")).select("_key", "m.*").distinct()
    upto = Window.partitionBy("_key", "rule").orderBy("at")
    spans = (matches.withColumn("end", F.sum(F.col("before") + F.col("size")).over(upto)).where("fits")
             .withColumn("start", F.col("end") - F.col("size")))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    per_row = spans.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(
        "start", "rule", "end", F.get(kinds, F.col("rule")).alias("kind")))).alias("spans"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = df.select(F.col(id_col), _key(text, id_col).alias("_key"))
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>")
    return ids.join(per_row, "_key", "left").select(id_col, F.coalesce("spans", none).alias("spans"))


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, mark: str = "[REDACTED]", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``df`` with every secret in the text replaced by ``mark``; all columns and rows are kept.

    Rules work one after the other, each on what the rules before it left; early rules come
    first, so no other rule takes a part of what they need. Candidates come from the same
    index as for ``scan``. A null text stays null, and a text without secrets
    is unchanged.
    """
    rows = _rows(df, rules, id_col, text_col)
    def without(i: int, r: Rule, text: Column) -> Column:
        parts = F.transform(_parts(i, r, text), lambda x: F.concat(F.coalesce(x["before"], F.lit("")), F.when(
            F.char_length(x["tested"]) >= r.least, F.lit(mark)).otherwise(F.coalesce(x["found"], F.lit("")))))
        return F.coalesce(F.array_join(parts, ""), text)
    for i, r in sorted(enumerate(rules), key=lambda x: not x[1].early):
        cleaned = _let(F.col("_text"), lambda t: without(i, r, t))       # built at once, with this rule
        rows = rows.withColumn("_text", F.when(F.array_contains("_may", i), cleaned).otherwise(F.col("_text")))
    return rows.select(*[F.when(F.col("_row")[c].isNotNull(), F.col("_text")).alias(c) if c == text_col else F.col("_row")[c].alias(c)
                         for c in df.columns])
