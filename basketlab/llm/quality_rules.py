"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule bounds a ratio of two counts of the text by whole percents, so that it is
decided in integers. The counts and verdicts of a row depend on that row alone: no
shuffle, no user function.

Defined cases: a null text has no words, counts of 0 and fails; an empty or blank text
likewise. Repeated rows each get their own verdict. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it for was on with as be at by this are from or an "
    "der die und das von den mit zu ist im für auf sich nicht ein eine "
    "de la le les et des en un une du que qui dans est pour par sur "
    "el los las y se del por con su para una"
).split()
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``low`` <= 100 * part / whole <= ``high``; a side that is None is open. A whole of 0 passes."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def failed(self) -> Column:
        part, whole = F.lit(100) * F.col(self.part), F.col(self.whole)
        failed = F.lit(False)
        if self.low is not None:
            failed = failed | (part < F.lit(self.low) * whole)
        if self.high is not None:
            failed = failed | (part > F.lit(self.high) * whole)
        return failed


RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("shouted_words", "n_upper_words", "n_words", high=40),
    Rule("stop_words", "n_stop_words", "n_words", low=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=40),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=30),
)


def _is_stop_word(word: Column) -> Column:
    """One search in the joined list: inside a lambda an IN list would be rebuilt for every word."""
    listed = F.lit(f" {' '.join(dict.fromkeys(STOP_WORDS))} ")
    short = F.octet_length(word) <= max(len(w.encode()) for w in STOP_WORDS)
    return short & F.contains(listed, F.concat(F.lit(" "), F.lower(word), F.lit(" ")))


def _counts(docs: DataFrame, text: str) -> DataFrame:
    """The counts that rules refer to, as columns beside those of ``docs``."""
    value = F.coalesce(F.col(text), F.lit(""))
    plain = value
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    split = docs.select(
        "*",
        F.array_remove(F.split(value, BLANK, -1), "").alias("_words"),
        F.filter(F.split(value, "\n", -1), lambda line: line.rlike("[^ \\t\\n\\x0B\\f\\r]")).alias("_lines"),
        (F.octet_length(value) - F.octet_length(plain)).cast("long").alias("n_symbols"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)),
    )
    counted = split.select(
        "*",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(words, _is_stop_word)).cast("long").alias("n_stop_words"),
        F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1)))
        .cast("long").alias("n_upper_words"),
        F.size(F.filter(lines, lambda line: line.rlike("^\\s*[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda line: line.rlike("(\\.\\.\\.|…)\\s*$"))).cast("long").alias("n_ellipsis_lines"),
        windows.alias("_windows"),
    )
    # Texts whose window hashes all differ repeat none. For the others the windows are sorted
    # with their places, so that equal ones become neighbours; nothing else is more than linear.
    placed = F.sort_array(F.transform("_windows", lambda _, i: F.struct(
        F.concat_ws(" ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("window"),
        i.alias("place"),
    )))
    unequal = F.size(F.array_distinct("_windows")) == F.size("_windows")
    sorted_windows = counted.withColumn("_placed", F.when(~unequal, placed))
    repeated = sorted_windows.withColumn("_repeated", F.filter("_placed", lambda x, i: (
        (x["window"] == F.coalesce(F.get("_placed", i - 1)["window"], F.lit("")))
        | (x["window"] == F.coalesce(F.get("_placed", i + 1)["window"], F.lit("")))
    )))
    covered = F.flatten(F.transform("_repeated", lambda x: F.array(x["place"], x["place"] + 1, x["place"] + 2)))
    n_repeat = F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))
    return repeated.withColumn("n_repeat_words", F.greatest(n_repeat, F.lit(0)).cast("long"))


def quality_rules(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
    min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED_PERCENT,
) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, the names of ``failed_rules``, and ``kept``.

    A column of ``docs`` with the name of a new one is replaced.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
           "n_upper_words", "n_bullet_lines", "n_ellipsis_lines", "base_failed", "failed_rules", "kept"]
    given = [c for c in docs.columns if c.lower() not in new]
    counted = _counts(docs.select(*[F.col(f"`{c}`") for c in given]), text)
    base = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(rule.failed(), F.lit(rule.name)) for rule in rules]), lambda x: x.isNotNull())
    judged = counted.withColumn("base_failed", base).withColumn("failed_rules", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).select(
        *[F.col(f"`{c}`") for c in given], *new
    )


QUERY_COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
]


def query(spark, folder: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).select(*QUERY_COLUMNS)


def _failed_sql(rule: Rule) -> str:
    sides = [f"100 * {rule.part} < {rule.low} * {rule.whole}"] if rule.low is not None else []
    sides += [f"100 * {rule.part} > {rule.high} * {rule.whole}"] if rule.high is not None else []
    return " OR ".join(sides)


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
ORACLE_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS three
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (
  SELECT doc_id, unnest(list(i)) AS i FROM windows WHERE three IS NOT NULL GROUP BY doc_id, three HAVING count(*) >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) offsets(k) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(words, lambda w: lower(w) IN ({_STOPS}))) AS n_stop_words,
    len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w) AND length(w) > 1)) AS n_upper_words,
    len(list_filter(lines, lambda l: regexp_matches(l, '^\s*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words
    OR {" OR ".join(_failed_sql(r) for r in RULES)}) AS kept
FROM counted
"""
