"""Secret scans in DataFrame functions only: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Positions come from one split and one extraction of the same pattern, added up block by block, so a text is walked a fixed
number of times however many matches it holds. The entropy of a window follows from the last one's by the counts of the characters that
leave and enter it. Windows that touch an allow-listed stretch give no entropy span; pattern spans always stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerframe.llm.common import table

#: The contract's patterns. Runs that are too short to count are left out here where that changes no other
#: match (access, hex); assignments are matched first and then judged by the length of their value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
#: Candidates for the entropy scan: unbroken strings with a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least entropy, in bits a character, of a window by the candidate's character class.
LEAST_BITS = {"hex": 3.05, "alnum": 3.63, "symbol": 3.83}
#: Stretches that are no secrets: UUIDs, alphabets and counting runs, placeholders, runs of one character.
ALLOW = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)abcdefghij|0123456789|qwertyuiop",
    r"(?i)example|placeholder|changeme",
    r"(.)\1{7,}",
)
#: A candidate that is a path of plain words (in one case, capitalised, or digits; joined by _, - or =) is no secret.
_NAME = r"(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+|[0-9]+)"
PATH = rf"^/?(?:{_NAME}(?:[_=-]{_NAME})*/){{2,}}(?:{_NAME}(?:[_=-]{_NAME})*)?$"
#: Matches whose lengths are added up at once.
BLOCK = 256
_SPANS = "array<struct<s:int,kind:int,e:int>>"


_PLACED = "array<struct<s:int,e:int,x:string>>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, x>>: start and end in code points, and the text, of each leftmost non-overlapping match.

    Matches are placed in blocks: a block's start is the length of the blocks before it, so no array is copied once a match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda p, x: F.struct(p.alias("p"), x.alias("x")))

    def step(a: Column, m: Column) -> Column:
        s = a["at"] + F.char_length(m["p"])
        e = s + F.char_length(m["x"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), m["x"].alias("x")))).alias("out"))

    def placed(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), F.array().cast(_PLACED).alias("out")), step, lambda a: a["out"])

    def in_blocks(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, BLOCK))
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, m: n + F.char_length(m["p"]) + F.char_length(m["x"])))
        before = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(sizes, before, lambda a, n: F.struct((a["n"] + n).alias("n"), F.concat(a["out"], F.array(a["n"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(blocks, starts, placed))

    # One element of an array binds the matches, so that they are found once.
    return F.flatten(F.transform(F.array(both), lambda all_: F.when(F.size(all_) <= BLOCK, placed(all_, F.lit(0))).otherwise(in_blocks(all_))))


def _n_log_n(n: Column) -> Column:
    """n log2 n for a count n of at most the window's length."""
    return F.get(F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(WINDOW + 1)]), n)


def _count(char: Column, text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, char, F.lit("")))


def high_entropy(candidate: Column, allowed: Column) -> Column:
    """struct<first, last>: the first and last window of candidate whose entropy is enough for its class and that touches none of the allowed stretches; nulls if none."""
    free = lambda i: ~F.exists(allowed, lambda a: (i < a["e"]) & (a["s"] < i + WINDOW))
    bits = F.when(candidate.rlike("^[0-9a-fA-F]+$"), LEAST_BITS["hex"]).when(candidate.rlike("^[A-Za-z0-9]+$"), LEAST_BITS["alnum"]).otherwise(LEAST_BITS["symbol"])
    most = WINDOW * (math.log2(WINDOW) - bits)
    window = F.substring(candidate, 1, WINDOW)
    total = F.aggregate(F.array_distinct(F.split(window, "")), F.lit(0.0), lambda a, c: a + F.when(c == "", 0.0).otherwise(_n_log_n(_count(c, window))))
    at = lambda hit, i: F.when(hit, i)
    start = F.struct(total.alias("sum"), window.alias("win"), at((total <= most) & free(F.lit(0)), F.lit(0)).alias("first"), at((total <= most) & free(F.lit(0)), F.lit(0)).alias("last"), most.alias("most"), F.split(candidate, "").alias("chars"))

    def slide(a: Column, i: Column) -> Column:
        leaves, enters, rest = F.substring(a["win"], 1, 1), F.get(a["chars"], i + (WINDOW - 1)), F.substring(a["win"], 2, WINDOW)
        out, into = _count(leaves, a["win"]), _count(enters, rest)
        total = a["sum"] - _n_log_n(out) + _n_log_n(out - 1) - _n_log_n(into) + _n_log_n(into + 1)
        hit = (total <= a["most"]) & free(i)
        return F.struct(
            total.alias("sum"), F.concat(rest, enters).alias("win"), F.coalesce(a["first"], at(hit, i)).alias("first"), F.coalesce(at(hit, i), a["last"]).alias("last"), a["most"].alias("most"), a["chars"].alias("chars")
        )

    steps = F.when(F.char_length(candidate) > WINDOW, F.sequence(F.lit(1), F.char_length(candidate) - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, slide, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """(doc_id, found): array<struct<s, kind, e>> of each whole text, by start and then kind, one row per row of docs.

    kind is an index of KINDS; s and e count code points, e exclusive. A null text is an empty one and has no spans; equal
    texts, repeated rows among them, have equal spans; very long texts are scanned whole; an empty table gives an empty result; a
    null id is kept; other columns are not read, whatever their names. No shuffle.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast(_SPANS)
    spans = lambda found, kind: F.transform(found, lambda m: F.struct(m["s"].alias("s"), F.lit(kind).alias("kind"), m["e"].alias("e")))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    long_enough = F.filter(F.zip_with(matches(text, ASSIGN), values, lambda m, v: F.struct(m["s"].alias("s"), m["e"].alias("e"), v.alias("v"))), lambda m: F.char_length(m["v"]) >= 8)
    candidates = F.filter(matches(text, CANDIDATE), lambda m: m["x"].rlike("[0-9]") & m["x"].rlike("[A-Za-z]") & (F.lit(not allow) | ~m["x"].rlike(PATH)))
    some = lambda x, p: F.when(x.rlike(p), matches(x, p)).otherwise(F.array().cast(_PLACED))
    allowed = lambda x: F.concat(F.array().cast(_PLACED), *[some(x, p) for p in allow])
    windows = F.transform(candidates, lambda m: F.struct(m["s"].alias("s"), F.transform(F.array(allowed(m["x"])), lambda a: high_entropy(m["x"], a))[0].alias("w")))
    windows = F.transform(F.filter(windows, lambda m: m["w"]["first"].isNotNull()), lambda m: F.struct((m["s"] + m["w"]["first"]).alias("s"), F.lit(3).alias("kind"), (m["s"] + m["w"]["last"] + WINDOW).alias("e")))
    found = F.array_sort(F.concat(
        F.when(text.rlike(ASSIGN), spans(long_enough, 0)).otherwise(none),
        F.when(text.rlike(ACCESS), spans(matches(text, ACCESS), 1)).otherwise(none),
        F.when(text.rlike(HEX), spans(matches(text, HEX), 2)).otherwise(none),
        F.when(text.rlike(CANDIDATE), windows).otherwise(none),
    ))
    return rows.select("doc_id", found.cast(_SPANS).alias("found"))


def op8(spark, sf_dir: str) -> DataFrame:
    """The contract's digest columns of scan_secrets over all documents; odd rows as there."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), m["kind"]), m["s"], m["e"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("long")
    base = said(F.filter("found", lambda m: m["kind"] < 3))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(base, 256).alias("base_sha256"), said(F.col("found")).alias("spans"))


def _matches_sql(pattern: str, more: str, source: str = "docs", text: str = "t", group: int = 0) -> str:
    """Rows (more, s, x, g) of a pattern's matches: texts between matches and matches, added up, give the places."""
    p = pattern.replace("'", "''")
    return f"""SELECT {more}, (list_sum(list_transform(list_slice(ps, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(ms, 1, i - 1), lambda x: length(x))), 0))::BIGINT AS s, ms[i] AS x, gs[i] AS g
      FROM (SELECT {more}, ms, ps, gs, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT {more}, regexp_extract_all({text}, '{p}') AS ms, string_split_regex({text}, '{p}') AS ps, regexp_extract_all({text}, '{p}', {group}) AS gs FROM {source}) WHERE len(ms) > 0)"""


_BASE_SQL = " UNION ALL ".join(f"SELECT rid, {k} AS kind, s, x, g FROM ({_matches_sql(p, 'rid', group=g)})" for k, (p, g) in enumerate(((ASSIGN, 1), (ACCESS, 0), (HEX, 0))))
_ALLOW_SQL = " UNION ALL ".join(f"SELECT cid, s AS a, s + length(x) AS b FROM ({_matches_sql(p, 'cid', 'cand', 'x')})" for p in ALLOW if "\\1" not in p)
OP8_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT rid, kind, s, s + length(x) AS e FROM ({_BASE_SQL}) WHERE kind > 0 OR length(g) >= 8),
cand AS (SELECT row_number() OVER () AS cid, rid, s, x, CASE WHEN regexp_full_match(x, '[0-9a-fA-F]+') THEN {LEAST_BITS['hex']} WHEN regexp_full_match(x, '[A-Za-z0-9]+') THEN {LEAST_BITS['alnum']} ELSE {LEAST_BITS['symbol']} END::DOUBLE AS bits
  FROM ({_matches_sql(CANDIDATE, 'rid')}) WHERE regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND NOT regexp_matches(x, '{PATH}')),
allowed AS ({_ALLOW_SQL} UNION ALL SELECT cid, j - 1, j + 7 FROM (SELECT cid, x, unnest(range(1, length(x) - 6)) AS j FROM cand) WHERE substr(x, j, 8) = repeat(substr(x, j, 1), 8)),
wins AS (SELECT cid, rid, s, i, bits, list_sum(list_transform(map_values(list_histogram(string_split(substr(x, i + 1, {WINDOW}), ''))), lambda n: n * log2(n))) AS total FROM (SELECT *, unnest(range(0, length(x) - {WINDOW - 1})) AS i FROM cand)),
hits AS (SELECT * FROM wins WHERE total <= {WINDOW} * (log2({WINDOW}) - bits)),
free AS (SELECT * FROM hits ANTI JOIN allowed ON hits.cid = allowed.cid AND i < b AND a < i + {WINDOW}),
more AS (SELECT rid, 3 AS kind, s + min(i) AS s, s + max(i) + {WINDOW} AS e FROM free GROUP BY rid, cid, s),
spans AS (SELECT *, (['{"', '".join(KINDS)}'])[kind + 1] || ':' || s || ':' || e AS said FROM (SELECT * FROM base UNION ALL SELECT * FROM more)),
per AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c, string_agg(said, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY s, kind, e) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN per USING (rid)
"""
